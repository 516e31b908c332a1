"""Token ids as files of fixed-width bit-packed blocks.

A shard holds the ids of some consecutive documents, each id in the least number of bits that the
vocabulary needs. Its layout, all little-endian::

    "BPK1" | width u8 | has-null-key u8 | reserved u16 | documents u32 | ids per block u32 | ids u64
    document keys i64[documents] | document lengths u32[documents] | block offsets u64[blocks + 1]
    blocks, each padded to whole bytes; bit k of an id is bit (i * width + k) of its block

Every block of a shard holds the same number of ids (the last may hold fewer), so id i lies in
block i // B at bit (i % B) * width: ``Shard`` unpacks blocks with numpy and reads any range
without touching the rest.

Keys are integers; rows with a null key come first, in the order of their ids. Rows with the same
key follow one another, shorter ones first. Null and empty texts consist of the end id alone.
Repeated rows are written as often as they occur, an empty table gives a table without shards, and
columns besides the two named are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_strata.llm import bpe

MAGIC = b"BPK1"
HEAD = struct.Struct("<4sBBHIIQ")
#: Ids of a block, and ids after which a shard is closed.
BLOCK, SHARD = 4096, 1 << 20
#: Widths of whole bytes, whose ids are packed and joined without going through single bits.
WHOLE = (8, 16, 32)
#: Documents that a range of keys holds, and the most ranges there are (their totals are broadcast).
RANGE_ROWS, MAX_RANGES = 2000, 10_000

PACKED = "range int, n bigint, packed binary"
_SHARDS = "range int, seq int, before bigint, docs bigint, ids bigint, data binary"


def width_of(vocabulary: int) -> int:
    """Bits that the largest id of a vocabulary needs."""
    return max(1, (max(vocabulary, 1) - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    if width in WHOLE and ids.dtype == f"<u{width // 8}":  # as ``stored`` gives them
        return ids.tobytes()
    ids = np.ascontiguousarray(ids, dtype="<u4")
    if len(ids) and int(ids.max()) >> width:
        raise ValueError(f"an id needs more than {width} bits")
    if width in WHOLE:
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = np.unpackbits(ids.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return np.packbits(bits[:, :width].reshape(-1), bitorder="little").tobytes()


def pack_each(ids: np.ndarray, counts: np.ndarray, width: int) -> list[bytes]:
    """``pack`` of ``counts`` ids each, which follow one another."""
    ends = np.cumsum(counts, dtype=np.int64)
    if width in WHOLE:
        raw, step = pack(ids, width), width // 8
        bounds = zip((step * (ends - counts)).tolist(), (step * ends).tolist(), strict=True)
        return [raw[first:last] for first, last in bounds]
    return [pack(x, width) for x in np.split(ids, ends[:-1])] if len(counts) else []


def stored(data: bytes | memoryview, count: int, width: int) -> np.ndarray:
    """Packed ids as they lie there if they are whole bytes, else unpacked."""
    if width in WHOLE:
        return np.frombuffer(data, dtype=f"<u{width // 8}", count=count)
    return unpack(data, count, width)


def unpack(data: bytes | memoryview, count: int, width: int) -> np.ndarray:
    if width in WHOLE:
        return stored(data, count, width).astype("<u4")
    raw = np.frombuffer(data, dtype=np.uint8, count=-(-count * width // 8))
    bits = np.unpackbits(raw, count=count * width, bitorder="little").reshape(count, width)
    full = np.zeros((count, 32), dtype=np.uint8)
    full[:, :width] = bits
    return np.packbits(full.reshape(-1), bitorder="little").view("<u4")


def write_shard(
    keys: list[int | None], documents: list[np.ndarray], width: int, block: int = BLOCK
) -> bytes:
    """The bytes of one shard. Null keys lead and are counted in the header's second field."""
    ids = np.concatenate(documents) if documents else np.zeros(0, dtype="<u4")
    parts = [pack(ids[i : i + block], width) for i in range(0, len(ids), block)]
    offsets = np.cumsum([0, *map(len, parts)]).astype("<u8")
    nulls = sum(k is None for k in keys)
    if nulls not in (0, len(keys)):
        raise ValueError("null keys have shards of their own")
    head = HEAD.pack(MAGIC, width, nulls > 0, 0, len(keys), block, len(ids))
    return b"".join(
        [
            head,
            np.array([k or 0 for k in keys], dtype="<i8").tobytes(),
            np.array([len(d) for d in documents], dtype="<u4").tobytes(),
            offsets.tobytes(),
            *parts,
        ]
    )


class Shard:
    """Random access to the ids of a shard's bytes."""

    def __init__(self, data: bytes) -> None:
        magic, self.width, self.null_keys, _, docs, self.block, self.ids = HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a shard of packed ids")
        at = HEAD.size
        self.keys = np.frombuffer(data, "<i8", docs, at)
        self.lengths = np.frombuffer(data, "<u4", docs, at + 8 * docs)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths, dtype=np.int64)])
        at += 12 * docs
        self.offsets = np.frombuffer(data, "<u8", -(-self.ids // self.block) + 1, at)
        self.payload = memoryview(data)[at + 8 * len(self.offsets) :]

    def read(self, first: int, last: int) -> np.ndarray:
        """Ids ``first`` to ``last`` (not included), from the blocks that hold them."""
        if first >= last:
            return np.zeros(0, dtype="<u4")
        found = []
        for b in range(first // self.block, (last - 1) // self.block + 1):
            count = min(self.block, self.ids - b * self.block)
            raw = self.payload[int(self.offsets[b]) : int(self.offsets[b + 1])]
            found.append(unpack(raw, count, self.width))
        base = first // self.block * self.block
        return np.concatenate(found)[first - base : last - base]

    def document(self, k: int) -> np.ndarray:
        return self.read(int(self.starts[k]), int(self.starts[k + 1]))


def range_bounds(df: DataFrame, key: str) -> np.ndarray:
    """Keys that part the rows into ranges of about ``RANGE_ROWS``, from the key column alone."""
    keys = df.select(F.col(key).cast("double").alias("key"))
    ranges = min(MAX_RANGES, max(1, keys.count() // RANGE_ROWS))
    marks = [i / ranges for i in range(1, ranges)]
    return np.unique(keys.approxQuantile("key", marks, 0.1 / ranges) if marks else [])


def pack_rows(bounds: np.ndarray, width: int, end_id: int | None) -> bpe.Finish:
    """Makes ``PACKED`` rows of keys and ids: the range of the key, and the ids with their end."""
    end = np.array([] if end_id is None else [end_id], dtype="<u4").tobytes()

    def packed(keys: pa.Array, ids: list[bytes]) -> pa.RecordBatch:
        null = keys.is_null().to_numpy(zero_copy_only=False)
        values = keys.cast(pa.int64()).fill_null(0).to_numpy()
        at = np.where(null, -1, np.searchsorted(bounds, values, side="right"))
        every = [x + end for x in ids]
        n = np.array([len(x) // 4 for x in every], dtype=np.int64)
        data = pack_each(np.frombuffer(b"".join(every), dtype="<u4"), n, width)
        return pa.RecordBatch.from_arrays(
            [
                keys,
                pa.array(at, pa.int32()),
                pa.array(n, pa.int64()),
                pa.array(data, pa.binary()),
            ],
            ["key", "range", "n", "packed"],
        )

    return packed


def write_shards(packed: DataFrame, path: str, width: int) -> None:
    """Write ``key`` and ``PACKED`` rows as shards in key order.

    A task streams through the ranges it is dealt and closes a shard whenever it is full, so the
    size of a range does not matter to memory.
    """

    def sharded(batches):
        state = {"range": None, "seq": 0, "before": 0}
        keys: list[int | None] = []
        documents: list[np.ndarray] = []
        held = 0

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal held
            if keys:
                row = [state["range"], state["seq"], state["before"], len(keys), held]
                types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                data = write_shard(keys, documents, width)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], t) for v, t in zip(row, types, strict=True)]
                    + [pa.array([data], pa.binary())],
                    ["range", "seq", "before", "docs", "ids", "data"],
                )
                state["seq"] += 1
                state["before"] += held
                keys.clear()
                documents.clear()
                held = 0

        for batch in batches:
            for at, k, n, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at != state["range"]:
                    yield from close()
                    state.update(range=at, seq=0, before=0)
                keys.append(k)
                documents.append(stored(data, n, width))
                held += n
                if held >= SHARD:
                    yield from close()
        yield from close()

    (
        packed.select("range", F.col("key").cast("bigint").alias("key"), "n", "packed")
        .repartition("range")
        .sortWithinPartitions("range", "key", "n", "packed")
        .mapInArrow(sharded, _SHARDS)
        .write.option("compression", "none")
        .parquet(path)
    )


def read_shards(spark, path: str) -> DataFrame:
    """Shards with ``start``, the number of ids in all shards before each."""
    shards = spark.read.schema(_SHARDS).parquet(path)
    totals = shards.groupBy("range").agg(F.sum("ids").alias("ids")).toPandas()  # MAX_RANGES rows
    totals = totals.sort_values("range")
    totals["base"] = totals["ids"].cumsum() - totals["ids"]
    base = spark.createDataFrame(
        [(int(r), int(b)) for r, b in zip(totals["range"], totals["base"], strict=True)],
        "range int, base bigint",
    )
    return shards.join(F.broadcast(base), "range").withColumn("start", F.col("base") + F.col("before"))


def read_documents(shards: DataFrame, key: str) -> DataFrame:
    """``(key, start, n_tokens, ids_crc32)`` of every document in the shards."""

    def documents(batches):
        for batch in batches:
            for start, data in zip(batch["start"].to_pylist(), batch["data"].to_pylist(), strict=True):
                shard = Shard(data)
                ids = shard.read(0, shard.ids)  # each block once, for all of its documents
                ends = zip(shard.starts[:-1].tolist(), shard.starts[1:].tolist(), strict=True)
                crc = [zlib.crc32(ids[first:last]) for first, last in ends]
                keys = pa.array(shard.keys, pa.int64(), mask=np.full(len(crc), bool(shard.null_keys)))
                yield pa.RecordBatch.from_arrays(
                    [
                        keys,
                        pa.array(shard.starts[:-1] + start, pa.int64()),
                        pa.array(shard.lengths.astype(np.int64), pa.int64()),
                        pa.array(crc, pa.int64()),
                    ],
                    ["key", "start", "n_tokens", "ids_crc32"],
                )

    return (
        shards.select("start", "data")
        .mapInArrow(documents, "key bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
        .withColumnRenamed("key", key)
    )


def pack_documents(
    df: DataFrame, key: str, text: str, tokenizer_path: str, path: str, end_id: int
) -> DataFrame:
    """Encode whole texts, append ``end_id``, write the shards to ``path`` and open them."""
    vocabulary = bpe.load(tokenizer_path).get_vocab_size(with_added_tokens=True)
    width = width_of(vocabulary)
    finish = pack_rows(range_bounds(df, key), width, end_id)
    packed = bpe.encode(df, key, text, tokenizer_path, finish=finish, columns=PACKED)
    write_shards(packed, path, width)
    return read_shards(df.sparkSession, path)
