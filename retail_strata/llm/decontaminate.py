"""Benchmark decontamination with spaced seeds.

A seed is a mask over neighbouring words; the hash of the words at its set positions does not see
the others, so it survives substitutions there. ``MASKS`` is lossless: whichever two words of a
window of 13 are substituted, one of the masks fits between them (a test tries all cases). Test and
training hashes are joined, and around every hit the two texts are laid side by side.

An item is leaked in a document if, at some alignment, 13 neighbouring words of it agree with the
document in 11 places or more. An item of 8 to 12 words is leaked if it occurs with one word
substituted at most; its masks each leave out every third word, so one of the three fits whichever
word that is. A shorter item is leaked if all of it occurs. ``item_words`` says how long the item
is, so that a caller can set short ones aside. Items without words and empty texts match nothing.

Training hashes pass a bitmap of the test hashes, bounded in size, before anything is shuffled;
only documents with hits are written to scratch. Equal texts are searched once. Every row of a
leaked text is reported, with each item (repeated items too). Null ids are kept. Empty tables give
no rows, and only the named columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_strata.llm.common import (
    U64,
    HashFilter,
    as_long,
    blocks,
    lean,
    mix,
    stage,
    utf8,
    word_hashes,
)

# Positions that each mask compares.
MASKS = (
    (0, 3, 4, 5, 8, 9, 10),
    (0, 2, 3, 4, 5, 7, 8),
    (0, 1, 2, 3, 6, 7, 8),
    (0, 1, 2, 4, 7, 9, 10),
)
#: Words of a window, and how many of them must agree.
WINDOW, AGREE = 13, 11
#: Words from which on a shorter item may have one of them substituted.
TOLERANT = 8


def all_masks() -> list[tuple[int, tuple[int, ...]]]:
    """Each mask with the length of the items that it serves (``WINDOW``: that or longer)."""
    masks = [(WINDOW, mask) for mask in MASKS]
    for n in range(1, WINDOW):
        if n < TOLERANT:
            masks.append((n, tuple(range(n))))
        else:
            masks += [(n, tuple(p for p in range(n) if p % 3 != left)) for left in range(3)]
    return masks


def needed(width: int) -> int:
    """Words that must agree in a window, or in a whole item that is shorter."""
    return AGREE if width == WINDOW else width - 1 if width >= TOLERANT else width


def seed_hashes(words: np.ndarray, mask: tuple[int, ...], salt: int) -> np.ndarray:
    """Hash of the masked words at every place where the mask fits."""
    places = len(words) - mask[-1]
    if places <= 0:
        return np.zeros(0, dtype=U64)
    factors = mix(np.arange(1, len(mask) + 1, dtype=U64) + U64(64 * (salt + 1))) | U64(1)
    total = np.zeros(places, dtype=U64)
    for offset, factor in zip(mask, factors, strict=True):
        total += words[offset : offset + places] * factor
    return mix(total)


def text_key(words: np.ndarray) -> int:
    """A 64-bit digest of a sequence of words."""
    places = mix(np.arange(1, len(words) + 1, dtype=U64)) | U64(1)
    total = (mix(words) * places).sum(dtype=U64) + U64(len(words))
    return int(mix(np.array([total]))[0].astype(np.int64))


def _words(column: pa.Array):
    """Words of every row."""
    offsets, data = utf8(column)
    for first, end in blocks(offsets):
        words, at = word_hashes(offsets[first : end + 1], data[offsets[first] : offsets[end]])
        for a, b in zip(at[:-1], at[1:], strict=True):
            yield words[a:b]


def test_items(benchmark: DataFrame, item: str, text: str) -> DataFrame:
    """``(item, item_key, words)`` of every item that has words."""
    rows = benchmark.select(F.col(item).alias("item"), F.col(text).alias("text"))
    kind = rows.schema["item"].dataType.simpleString()

    def found(batches):
        for batch in batches:
            words = list(_words(batch["text"]))
            keep = pa.array([len(w) > 0 for w in words], pa.bool_())
            words = [w for w in words if len(w)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["item"].filter(keep),
                    pa.array([text_key(w) for w in words], pa.int64()),
                    pa.array([w.tobytes() for w in words], pa.binary()),
                ],
                ["item", "item_key", "words"],
            )

    return rows.mapInArrow(lean(found), f"item {kind}, item_key bigint, words binary")


def test_hashes(items: DataFrame) -> DataFrame:
    """``(hash, item_key, place)`` of the distinct items' seeds."""

    def found(batches):
        for batch in batches:
            for key, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = np.frombuffer(packed, dtype=U64)
                for salt, (length, mask) in enumerate(all_masks()):
                    if length != min(len(words), WINDOW):
                        continue
                    # A short item has one place, even where its mask leaves room for more.
                    hashes = seed_hashes(words, mask, salt)[: len(words) - length + 1 if length < WINDOW else None]
                    yield pa.RecordBatch.from_arrays(
                        [
                            as_long(hashes),
                            pa.array([key] * len(hashes), pa.int64()),
                            pa.array(range(len(hashes)), pa.int64()),
                        ],
                        ["hash", "item_key", "place"],
                    )

    distinct = items.groupBy("item_key").agg(F.first("words").alias("words"))
    return distinct.mapInArrow(lean(found), "hash bigint, item_key bigint, place bigint")


def documents_with_hits(docs: DataFrame, hashes: DataFrame, masks: list[int]) -> DataFrame:
    """``(id, text_key, words, hits)`` of the documents with a seed that the test hashes may hold.

    ``masks`` numbers the masks in use. ``hits`` are pairs of a hash and its place, packed.
    """
    kind = docs.schema["id"].dataType.simpleString()
    # A document asks for some thousand hashes, so few may pass by chance.
    held = docs.sparkSession.sparkContext.broadcast(HashFilter.of(hashes, "hash", spread=2048))
    every = all_masks()

    def found(batches):
        for batch in batches:
            at, keys, texts, hits = [], [], [], []
            for k, words in enumerate(_words(batch["text"])):
                pairs = []
                for salt in masks:
                    seeds = seed_hashes(words, every[salt][1], salt)
                    places = np.flatnonzero(held.value.has(seeds))
                    pairs.append(np.stack([seeds[places], places.astype(U64)]))
                pairs = np.concatenate(pairs, axis=1) if pairs else np.zeros((2, 0), dtype=U64)
                if pairs.size:
                    at.append(k)
                    keys.append(text_key(words))
                    texts.append(words.tobytes())
                    hits.append(pairs.tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"].take(pa.array(at, pa.int64())),
                    pa.array(keys, pa.int64()),
                    pa.array(texts, pa.binary()),
                    pa.array(hits, pa.binary()),
                ],
                ["id", "text_key", "words", "hits"],
            )

    return docs.mapInArrow(lean(found), f"id {kind}, text_key bigint, words binary, hits binary")


def best_window(words: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, int, int]:
    """``(agreeing words, first, end)`` in the document, of the best window at one alignment."""
    low, high = max(0, -shift), min(len(item), len(words) - shift)
    width = min(WINDOW, len(item))
    if high - low < width:
        return 0, 0, 0
    same = np.concatenate([[0], np.cumsum(words[low + shift : high + shift] == item[low:high])])
    each = same[width:] - same[:-width]
    good = np.flatnonzero(each >= needed(width))
    if not len(good):
        return 0, 0, 0
    covered = np.zeros(high - low, dtype=bool)
    for g in good:
        covered[g : g + width] = True
    agree = int((covered & (words[low + shift : high + shift] == item[low:high])).sum())
    return agree, int(low + shift + good[0]), int(low + shift + good[-1] + width)


def find_leaks(
    df: DataFrame, id_column: str, text: str, benchmark: DataFrame, item: str, item_text: str
) -> DataFrame:
    """``(id, item, agreeing, first_word, end_word, item_words)``: every leaked item of every document."""
    docs = df.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    items = stage(test_items(benchmark, item, item_text), "items")
    hashes = stage(test_hashes(items), "test-hashes")
    length = F.least(F.length("words") / 8, F.lit(WINDOW)).cast("int")
    lengths = {r["n"] for r in items.select(length.alias("n")).distinct().collect()}  # WINDOW at most
    masks = [salt for salt, (n, _) in enumerate(all_masks()) if n in lengths]
    found = stage(documents_with_hits(docs, hashes, masks), "hits")
    texts = stage(
        found.groupBy("text_key").agg(F.first("words").alias("words"), F.first("hits").alias("hits")),
        "texts-with-hits",
    )

    def seeds(batches):
        for batch in batches:
            for key, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                hash_, place = np.frombuffer(packed, dtype=U64).reshape(2, -1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key] * len(place), pa.int64()), as_long(hash_), as_long(place)],
                    ["text_key", "hash", "at"],
                )

    hits = texts.select("text_key", "hits").mapInArrow(
        lean(seeds), "text_key bigint, hash bigint, at bigint"
    )
    shifts = (
        hits.join(hashes, "hash")
        .select("text_key", "item_key", (F.col("at") - F.col("place")).alias("shift"))
        .groupBy("text_key", "item_key")
        .agg(F.collect_set("shift").alias("shifts"))  # no more than a document's places
    )
    distinct = items.groupBy("item_key").agg(F.first("words").alias("item_words"))

    def verified(batches):
        for batch in batches:
            out = []
            for x in batch.to_pylist():
                words = np.frombuffer(x["words"], dtype=U64)
                other = np.frombuffer(x["item_words"], dtype=U64)
                best = max(best_window(words, other, s) for s in sorted(x["shifts"]))
                if best[0]:
                    out.append((x["text_key"], x["item_key"], *best))
            columns = list(zip(*out, strict=True)) if out else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns],
                ["text_key", "item_key", "agreeing", "first_word", "end_word"],
            )

    leaks = (
        shifts.join(distinct, "item_key")
        .join(texts.select("text_key", "words"), "text_key")
        .select("text_key", "item_key", "shifts", "words", "item_words")
        .mapInArrow(
            lean(verified),
            "text_key bigint, item_key bigint, agreeing bigint, first_word bigint, end_word bigint",
        )
    )
    return (
        found.select("id", "text_key")
        .join(leaks, "text_key")
        .join(items.select("item", "item_key", (F.length("words") / 8).cast("long").alias("n")), "item_key")
        .select(
            F.col("id").alias(id_column),
            F.col("item").alias(item),
            "agreeing",
            "first_word",
            "end_word",
            F.col("n").alias("item_words"),
        )
    )


def drop_leaked(
    df: DataFrame, id_column: str, leaks: DataFrame, least_words: int = TOLERANT
) -> DataFrame:
    """The rows of ``df`` whose id is in no leak. Equal ids, null among them, stand or fall together.

    Items of fewer than ``least_words`` words are phrases that clean documents hold too; they are
    found and reported, but no document goes for them.
    """
    ids = leaks.where(F.col("item_words") >= least_words).select(F.col(id_column).alias("leaked_id")).distinct()
    return df.join(ids, df[id_column].eqNullSafe(ids["leaked_id"]), "left_anti")
