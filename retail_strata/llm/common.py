"""What several operators share: vectorised word hashes, a bounded hash filter, components, scratch.

Words are the runs of bytes outside ``0x20`` and ``0x09-0x0D`` of the UTF-8 text, with A-Z lowered.
"""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from functools import cache, wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_strata.session import scratch_path

U64 = np.uint64
#: Bytes of text hashed at a time; the working arrays are some twenty times as large.
BLOCK_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def ship(spark: SparkSession) -> None:
    """Send this package's code to the executors, once per application, as ``--py-files`` would.

    The archive is made beside the driver, which serves it; executors fetch it from there.
    """
    context = spark.sparkContext
    if getattr(context, "_retail_strata_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="retail-strata-code-"), "retail_strata_code.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    context._retail_strata_shipped = True


def stage(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back, which ends its lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@cache
def _trim() -> Callable[[int], int] | None:
    return getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it


def lean(function: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``function`` of a task's batches; after it, its worker gives freed memory back to the system.

    Workers are reused, also as ones that wait, and allocators keep what was freed: unless it is given
    back, an executor holds the largest task of every stage before.
    """

    @wraps(function)
    def run(batches: Iterator) -> Iterator:
        try:
            yield from function(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = _trim()
            if trim is not None:
                trim(0)

    return run


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = np.asarray(x, dtype=U64)
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    ahead = np.full(size, U64(_BASE))
    back = np.full(size, U64(pow(_BASE, -1, 1 << 64)))
    ahead[0] = back[0] = 1
    return np.multiply.accumulate(ahead), np.multiply.accumulate(back)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string column; a null counts as an empty text."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.uint8)
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return at - at[0], raw[at[0] : at[-1]]


def blocks(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold some ``BLOCK_BYTES`` together; a longer row is alone in its range."""
    first = 0
    while first < len(offsets) - 1:
        end = int(np.searchsorted(offsets, offsets[first] + BLOCK_BYTES, side="right")) - 1
        end = max(end, first + 1)
        yield first, end
        first = end


def word_hashes(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of a block of rows, and the words' bounds per row (one more than rows)."""
    offsets = offsets - offsets[0]
    rows, size = len(offsets) - 1, len(data)
    if size == 0:
        return np.zeros(0, dtype=U64), np.zeros(rows + 1, dtype=np.int64)
    space = _SPACE[data]
    before = np.empty(size, dtype=bool)
    before[0], before[1:] = True, space[:-1]
    before[offsets[:-1][offsets[:-1] < size]] = True
    after = np.empty(size, dtype=bool)
    after[-1], after[:-1] = True, space[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = True
    starts = np.flatnonzero(~space & before)
    ends = np.flatnonzero(~space & after) + 1
    grown = 1 << max(20, (size - 1).bit_length())
    ahead, back = _powers(grown)
    total = np.zeros(size + 1, dtype=U64)
    np.cumsum((_LOWER[data].astype(U64) + U64(1)) * ahead[:size], out=total[1:])
    words = mix((total[ends] - total[starts]) * back[starts] + (ends - starts).astype(U64))
    return words, np.searchsorted(starts, offsets)


def as_long(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


class HashFilter:
    """A bitmap of hashes whose size is bounded; it lets other hashes through now and then.

    Each hash sets two bits, among ``spread`` for each hash as long as that stays within
    ``MAX_BITS`` (16 MB). Past that more foreign hashes pass, and the exact join that follows has
    more to drop; no row is lost.
    """

    MAX_BITS = 27
    #: Bits of a piece, the unit in which the bitmap is made and collected: 4 KB, 4,096 pieces at most.
    PIECE_BITS = 15

    def __init__(self, bits: int, words: np.ndarray) -> None:
        self.bits, self.words = bits, words

    @classmethod
    def of(cls, df: DataFrame, column: str, spread: int = 32) -> HashFilter:
        bits = min(cls.MAX_BITS, max(cls.PIECE_BITS, (spread * df.count()).bit_length()))
        return cls(bits, cls.pack(cls.pieces(df, column, bits), bits))

    @classmethod
    def pieces(cls, df: DataFrame, column: str, bits: int) -> DataFrame:
        """``(piece, bitmap)`` of the pieces with a bit set; the driver gets packed bits, no row a word."""
        both = F.array(
            F.shiftrightunsigned(F.col(column), 64 - bits),
            F.shiftrightunsigned(F.col(column), 64 - 2 * bits).bitwiseAND(F.lit((1 << bits) - 1)),
        )
        slots = df.select(F.explode(both).alias("slot")).where("slot is not null").select(
            F.shiftright("slot", cls.PIECE_BITS).alias("piece"),
            F.col("slot").bitwiseAND(F.lit((1 << cls.PIECE_BITS) - 1)).alias("bit"),
        )
        # Dealt as slots: a bitmap for each piece and map task would be mostly zeros.
        return slots.repartition("piece").groupBy("piece").agg(F.bitmap_construct_agg("bit").alias("bitmap"))

    @classmethod
    def pack(cls, pieces: DataFrame, bits: int) -> np.ndarray:
        packed = np.zeros((1 << (bits - cls.PIECE_BITS), (1 << cls.PIECE_BITS) // 8), dtype=np.uint8)
        for piece, bitmap in pieces.collect():
            packed[piece] = np.frombuffer(bitmap, dtype=np.uint8)
        return packed.reshape(-1).view("<u4")

    def _bit(self, slot: np.ndarray) -> np.ndarray:
        held = self.words[(slot >> U64(5)).astype(np.int64)]
        return (held >> (slot & U64(31)).astype(np.uint32)) & np.uint32(1) == 1

    def has(self, hashes: np.ndarray) -> np.ndarray:
        found = self._bit(hashes >> U64(64 - self.bits))
        if found.any():
            some = np.flatnonzero(found)
            second = (hashes[some] >> U64(64 - 2 * self.bits)) & U64((1 << self.bits) - 1)
            found[some] = self._bit(second)
        return found


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the undirected edges ``(u, v)``; root is the least node.

    Alternates large-star and small-star steps, each a grouping and a join, and writes the edges
    between rounds. A node's neighbours are never gathered. Rounds grow with the logarithm of the
    longest chain. Null ends and loops are ignored; no edges give no rows.
    """
    edges = edges.where("u is not null and v is not null and u <> v").select("u", "v").distinct()
    edges = stage(edges, "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.where("u <> v").select(
            F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
        )
        down = down.distinct()
        root = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            down.join(root, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).unionByName(root.select("u", F.col("m").alias("v")))
        edges = stage(small.where("u <> v").distinct(), "stars")
        # Done when all are stars: a node has one edge down, or edges from above, but not both.
        ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up"))
        ends = ends.unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up")))
        sums = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
        if sums.where("down + up > 1").isEmpty():
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def held_out(doc_id: str) -> Column:
    """Whether a row belongs to the fold that no label is learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))
