"""Substring deduplication by hashing of sentences and lines.

A text is cut into units: a run of characters up to and with the sentence marks ``. ! ?`` and line
breaks that follow it, never over a line's end. A unit is normalised (lower case, white space as one
space, trimmed) and hashed to 128 bits. Globally, the occurrence in the least document id is kept,
there the first; every other occurrence is a repeat and is removed. Only sentences inside a line
that is no repeat itself stay if they and their neighbouring repeats have fewer than
``CHANCE_WORDS`` words together: such meet by chance, the more often the larger the corpus. Whole
lines are removed whatever their length: as their sentences are repeats wherever they are, only
lines of fewer words than that need hashes of their own. With ``min_words``, neighbouring repeats of fewer words stay, lines too.
Offsets are code points of the original text.

Documents with the same id count as one document, so their texts are no repeats of each other; a
null id ranks last. Null and empty texts have no units. Rows repeated in full are reported once. An
empty table gives no rows. Only the named columns are read; ``remove`` returns all columns as they
were, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_strata.llm.common import U64, HashFilter, lean, stage

#: Words of neighbouring repeats inside a line from which they are removed.
CHANCE_WORDS = 20
_UNIT = re.compile(r"[^\n.!?]+[.!?]*\n*|[.!?]+\n*|\n+")


def units(text: str) -> list[tuple[bytes, int, int, int]]:
    """``(digest, start, end, words)`` of every unit with a word."""
    found = []
    for match in _UNIT.finditer(text):
        words = match.group().lower().split()
        if words:
            digest = hashlib.blake2b(" ".join(words).encode(), digest_size=16).digest()
            found.append((digest, match.start(), match.end(), len(words)))
    return found


def short_lines(
    text: str, mine: list[tuple[bytes, int, int, int]], chance: int
) -> list[tuple[bytes, int, int]]:
    """``(digest, first unit, end unit)`` of every whole line of fewer than ``chance`` words."""
    found, first = [], 0
    for k in range(1, len(mine) + 1):
        if k < len(mine) and "\n" not in text[mine[k - 1][1] : mine[k][1]]:
            continue
        if sum(u[3] for u in mine[first:k]) < chance:
            words = text[mine[first][1] : mine[k - 1][2]].lower().split()
            digest = hashlib.blake2b(" ".join(words).encode(), digest_size=16, person=b"line").digest()
            found.append((digest, first, k))
        first = k
    return found


def _rows(df: DataFrame, id_column: str, text: str) -> DataFrame:
    return df.select(
        F.col(id_column).cast("bigint").alias("id"),
        F.xxhash64(F.col(text)).alias("text_key"),
        F.col(text).alias("text"),
    )


def repeated_units(rows: DataFrame, chance: int) -> DataFrame:
    """``(d1, d2, kept_id)`` of every digest of a unit or short line that occurs more than once."""

    def found(batches):
        for batch in batches:
            ids, digests, times = [], [], []
            for doc, text in zip(batch["id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                counts: dict[bytes, int] = {}
                mine = units(text or "")
                for digest, *_ in [*mine, *short_lines(text or "", mine, chance)]:
                    counts[digest] = counts.get(digest, 0) + 1
                ids += [doc] * len(counts)
                digests += counts.keys()
                times += counts.values()
            halves = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.ascontiguousarray(halves[:, 0])),
                    pa.array(np.ascontiguousarray(halves[:, 1])),
                    pa.array(ids, pa.int64()),
                    pa.array(times, pa.int64()),
                ],
                ["d1", "d2", "id", "times"],
            )

    each = rows.select("id", "text").mapInArrow(lean(found), "d1 bigint, d2 bigint, id bigint, times bigint")
    return (
        each.groupBy("d1", "d2")
        .agg(F.min("id").alias("kept_id"), F.sum("times").alias("times"))
        .where("times > 1")
        .select("d1", "d2", "kept_id")
    )


def candidates(
    rows: DataFrame, repeated: DataFrame, min_words: int | None, chance: int
) -> DataFrame:
    """Units of neighbours that may all be repeated and hold enough words, and short lines alike.

    A unit's row has a place ``unit`` and one ``unit``; that of a line has all of its ``units``.
    """
    least, whole_lines = (chance, True) if min_words is None else (min_words, False)
    held = rows.sparkSession.sparkContext.broadcast(HashFilter.of(repeated, "d1", spread=8))

    def found(batches):
        for batch in batches:
            out = []
            for doc, key, text in zip(
                *(batch[c].to_pylist() for c in ("id", "text_key", "text")), strict=True
            ):
                mine = units(text or "")
                if not mine:
                    continue
                halves = np.frombuffer(b"".join(u[0] for u in mine), dtype="<i8").reshape(-1, 2)
                may = held.value.has(np.ascontiguousarray(halves[:, 0]).view(U64))
                words = np.where(may, [u[3] for u in mine], 0)
                run = np.cumsum(~may)
                together = np.bincount(run, weights=words)[run]
                seen: set[bytes] = set()
                for k, (digest, start, end, n) in enumerate(mine):
                    if may[k] and together[k] >= least:
                        first = digest not in seen
                        out.append((doc, key, k, 1, False, *halves[k].tolist(), start, end, n, first))
                    seen.add(digest)
                lines = short_lines(text, mine, chance) if whole_lines else []
                if not lines:
                    continue
                halves = np.frombuffer(b"".join(x[0] for x in lines), dtype="<i8").reshape(-1, 2)
                may = held.value.has(np.ascontiguousarray(halves[:, 0]).view(U64))
                for k, (digest, begin, stop) in enumerate(lines):
                    if may[k]:
                        out.append(
                            (doc, key, begin, stop - begin, True, *halves[k].tolist())
                            + (mine[begin][1], mine[stop - 1][2])
                            + (sum(u[3] for u in mine[begin:stop]), digest not in seen)
                        )
                    seen.add(digest)
            columns = list(zip(*out, strict=True)) if out else [()] * 11
            kinds = [pa.int64()] * 4 + [pa.bool_()] + [pa.int64()] * 5 + [pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                ["id", "text_key", "unit", "units", "line", "d1", "d2", "start", "end", "words"]
                + ["first_here"],
            )

    return rows.mapInArrow(
        lean(found),
        "id bigint, text_key bigint, unit bigint, units bigint, line boolean, d1 bigint, d2 bigint,"
        " `start` bigint, `end` bigint, words bigint, first_here boolean",
    )


def neighbours(parts: list[dict]) -> list[list[dict]]:
    """Parts in order of their units, those that follow on each other together."""
    runs: list[list[dict]] = []
    for u in sorted(parts, key=lambda u: u["unit"]):
        if runs and runs[-1][-1]["unit"] + runs[-1][-1]["units"] == u["unit"]:
            runs[-1].append(u)
        else:
            runs.append([u])
    return runs


def find_repeats(
    df: DataFrame,
    id_column: str,
    text: str,
    min_words: int | None = None,
    chance: int = CHANCE_WORDS,
) -> DataFrame:
    """``(id, text_key, start, end, units, words, kept_id)`` of every passage to be removed.

    ``kept_id`` is the document that keeps the first unit of the passage. With ``min_words``, lines
    and sentences of fewer words together with their neighbours are no passages; without it that
    holds for sentences of fewer than ``chance`` words inside lines that are no repeats.
    """
    least = chance if min_words is None else min_words
    rows = _rows(df, id_column, text)
    repeated = stage(repeated_units(rows, chance), "repeated-units")
    some = stage(candidates(rows, repeated, min_words, chance), "repeat-candidates")
    repeats = (
        some.join(repeated, ["d1", "d2"])
        .where("not first_here or id > kept_id or (id is null and kept_id is not null)")
        .dropDuplicates(["id", "text_key", "unit", "line"])
    )

    def passages(batches):
        for batch in batches:
            out = []
            for x in batch.to_pylist():
                long = [
                    run
                    for run in neighbours([u for u in x["units"] if not u["line"]])
                    if sum(u["words"] for u in run) >= least
                ]
                inside = {u["unit"] for run in long for u in run}
                short = neighbours([u for u in x["units"] if u["line"] and u["unit"] not in inside])
                for run in long + short:
                    out.append(
                        (x["id"], x["text_key"], run[0]["start"], run[-1]["end"])
                        + (sum(u["units"] for u in run), sum(u["words"] for u in run))
                        + (run[0]["kept_id"],)
                    )
            columns = list(zip(*out, strict=True)) if out else [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns],
                ["id", "text_key", "start", "end", "units", "words", "kept_id"],
            )

    one = F.struct("unit", "units", "line", "start", "end", "words", "kept_id")
    return (
        repeats.groupBy("id", "text_key")
        .agg(F.collect_list(one).alias("units"))  # the units of one document
        .mapInArrow(
            lean(passages),
            "id bigint, text_key bigint, `start` bigint, `end` bigint, units bigint, words bigint,"
            " kept_id bigint",
        )
        .withColumnRenamed("id", id_column)
    )


def remove(df: DataFrame, id_column: str, text: str, repeats: DataFrame) -> DataFrame:
    """``df`` with the passages cut out of ``text``; other columns are unchanged."""
    own = uuid.uuid4().hex  # so that no column of ``df`` has these names
    id_, key, cut = (f"{name}_{own}" for name in ("id", "key", "spans"))
    spans = repeats.groupBy(F.col(id_column).alias(id_), F.col("text_key").alias(key)).agg(
        F.sort_array(F.collect_set(F.struct("start", "end"))).alias(cut)
    )
    same = df[id_column].cast("bigint").eqNullSafe(spans[id_]) & (F.xxhash64(df[text]) == spans[key])
    # What stays: from the end of one passage to the start of the next.
    begins = F.concat(F.array(F.lit(0).cast("bigint")), F.col(f"{cut}.end"))
    ends = F.concat(F.col(f"{cut}.start"), F.array(F.length(df[text]).cast("bigint")))
    pieces = F.transform(
        F.arrays_zip(begins.alias("b"), ends.alias("e")),
        lambda x: F.substring(df[text], (x["b"] + 1).cast("int"), (x["e"] - x["b"]).cast("int")),
    )
    cleaned = F.when(F.col(cut).isNull(), df[text]).otherwise(F.array_join(pieces, ""))
    return df.join(spans, same, "left").select(
        *[cleaned.alias(c) if c == text else df[c] for c in df.columns]
    )
