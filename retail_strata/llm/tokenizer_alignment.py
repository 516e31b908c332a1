"""Cross-tokenizer alignment by diagonal run skipping.

Two tokenizers cut the same bytes into tokens; ``a_ends`` and ``b_ends`` are the byte offsets at
which their tokens end. While both cut alike, token ``i`` of one ends with token ``i + shift`` of the
other. Such a stretch is a run of equal numbers on a diagonal of the two arrays: it is skipped by
comparing ever longer slices (1, 2, 4, ... numbers, as bytes) and, where a slice differs, ever
shorter ones. At its end the tokens are irregular: there the array that is behind moves on token by
token until both end together again, which closes a group and gives the new shift.

Links are pairs of tokens that end together. A pair of ids can be linked only if the bytes of one
are the end of the other's, so there are at most as many different pairs as the two vocabularies have
bytes (half a million for vocabularies of 50,257 and 32,000). That bounds the table of pair
counts, which is broadcast, and each task's own table of counts, which is all that is shuffled.

Texts are cut into stretches at places where both tokenizers always end a token: before a space that
follows no white space, between a Latin letter and a mark after it, and on both sides of a single
line break. (B's vocabulary is searched for pieces that reach over such a place; with any of them
texts are taken whole.) Stretches are remembered with their groups, within a bound. Those that are
new in a block of texts are encoded together, and their tokens, one after another, are the pair of
long arrays that is aligned.

Null and empty texts, and texts whose tokens of A or B do not join to a space and the text, have no
tokens. Repeated rows give a row each and count each. Only the columns named are read, so extra
columns of any name do no harm; an empty table gives no rows. A text is read whole, in memory linear
in its length.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_strata.llm.common import stage

#: Characters of all remembered stretches together, and of the longest one.
REMEMBERED, LONGEST = 5_000_000, 64
#: Texts that a task handles at a time, and their characters.
ROWS, CHARACTERS = 2048, 4_000_000

_LETTERS, _MARKS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff", ".,;:!?"
#: A word before a space or mark; a mark after it; a line break; else all up to a space that does
#: not follow white space (or a format character that some take for it).
_STRETCH = re.compile(
    f" ?[{_LETTERS}]+(?=[ {_MARKS}])|[{_MARKS}](?= )|[{_MARKS}]?\n(?=\\S)"
    "|.(?:[^ ]|(?<=[\\s\u180e\u200b\ufeff]) )*",
    re.DOTALL,
)
#: What a piece must not hold, else it might reach over a cut.
_OVER = re.compile(f"[^\u2581]\u2581|[{_LETTERS}][{_MARKS}]|\n")
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")


def byte_letters() -> dict[str, int]:
    """The byte behind each letter of a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Vocabulary:
    """Bytes of each id, their lengths, and the ids as text."""

    def __init__(self, entries: list[bytes]) -> None:
        self.entries = entries
        self.lengths = np.array([len(x) for x in entries], dtype=np.int64)
        self.decimal = [str(k) for k in range(len(entries))]

    def join(self, ids: list[int]) -> bytes:
        return b"".join([self.entries[i] for i in ids])


class Pair:
    """Tokenizers A (byte-level, a JSON file) and B (pieces, a model file)."""

    def __init__(self, a_path: str, b_path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters = byte_letters()
        size = self.a.get_vocab_size(with_added_tokens=True)
        shown = [self.a.id_to_token(k) or "" for k in range(size)]
        self.a_vocabulary = Vocabulary(
            [bytes(letters[c] for c in t) if set(t) <= letters.keys() else t.encode() for t in shown]
        )
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        self.b_vocabulary = Vocabulary(
            [
                bytes([int(m[1], 16)]) if (m := _BYTE.fullmatch(p)) else p.replace("▁", " ").encode()
                for p in pieces
            ]
        )
        pre = json.loads(self.a.to_str())["pre_tokenizer"]
        self.apart = not any(map(_OVER.search, pieces)) and (
            pre["type"] == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"]
        )
        self.break_ids = self.b.encode("\n")
        self.known: dict[str, tuple[str, bytes, int] | None] = {}
        self.held = 0

    def bound(self) -> int:
        """The most pairs of ids that can be linked."""
        return int(self.a_vocabulary.lengths.sum() + self.b_vocabulary.lengths.sum())

    def encode(self, stretches: list[str]) -> Iterator[tuple[list[int], list[int]] | None]:
        """Ids of A and of B of each stretch; None if their bytes are not the stretch's.

        B puts a space before what it encodes. That is the one a stretch begins with; others are
        encoded after a line break, whose ids go again.
        """
        a = self.a.encode_batch_fast(stretches, add_special_tokens=False)
        spaced = [s[0] == " " and len(s) > 1 for s in stretches]
        told = [s[1:] if own else f"\n{s}" for s, own in zip(stretches, spaced, strict=True)]
        b = self.b.encode(told, num_threads=1)
        extra = len(self.break_ids)
        for stretch, own, x, y in zip(stretches, spaced, a, b, strict=True):
            if not own:
                y = y[extra:] if y[:extra] == self.break_ids else []
            data, ids = stretch.encode(), x.ids
            fits = self.a_vocabulary.join(ids) == data and self.b_vocabulary.join(y) == data
            yield (ids, y) if fits else None

    def _learn(self, stretches: list[str]) -> dict[str, tuple[str, bytes, int] | None]:
        """Groups as text, links and numbers of tokens of new stretches, aligned as one text."""
        both = list(self.encode(stretches))
        a = np.array([i for x in both if x for i in x[0]], dtype=np.int64)
        b = np.array([i for x in both if x for i in x[1]], dtype=np.int64)
        groups, a_last, b_last = self.groups(a, b)
        links = ((a[a_last] << 32) | b[b_last]).tobytes()
        stops = np.searchsorted(a_last, np.cumsum([len(x[0]) for x in both if x]) - 1) + 1
        learned: dict[str, tuple[str, bytes, int] | None] = {}
        first, stops = 0, iter(stops.tolist())
        for stretch, x in zip(stretches, both, strict=True):
            if x is None:
                learned[stretch] = None
                continue
            stop = next(stops)
            learned[stretch] = (
                ";".join(groups[first:stop]),
                links[8 * first : 8 * stop],
                len(x[0]) << 32 | len(x[1]),
            )
            first = stop
        return learned

    def groups(self, a: np.ndarray, b: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Each group as text, and the places of its last tokens."""
        a_text = list(map(self.a_vocabulary.decimal.__getitem__, a.tolist()))
        b_text = list(map(self.b_vocabulary.decimal.__getitem__, b.tolist()))
        a_ends = np.cumsum(self.a_vocabulary.lengths[a])
        b_ends = np.cumsum(self.b_vocabulary.lengths[b])
        written: list[str] = []
        a_last: list[int] = []
        b_last: list[int] = []
        for i, i_stop, j, j_stop, run in align(a_ends, b_ends):
            if run:
                written += map("|".join, zip(a_text[i:i_stop], b_text[j:j_stop], strict=True))
                a_last += range(i, i_stop)
                b_last += range(j, j_stop)
            else:
                written.append(f"{','.join(a_text[i:i_stop])}|{','.join(b_text[j:j_stop])}")
                a_last.append(i_stop - 1)
                b_last.append(j_stop - 1)
        return written, np.array(a_last, dtype=np.int64), np.array(b_last, dtype=np.int64)

    def texts(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, str, bytes, bytes]]:
        """Of each text: tokens of A and B, groups, their digest, and its links with their times."""
        cut = [(_STRETCH.findall(f" {t}") if self.apart else [f" {t}"]) if t else [] for t in texts]
        if self.held > REMEMBERED:
            self.known, self.held = {}, 0
        known = self.known
        new = list(set().union(*cut).difference(known))
        learned = self._learn(new) if new else {}
        short = {s: x for s, x in learned.items() if len(s) <= LONGEST}
        known.update(short)
        self.held += sum(map(len, short))
        long = {s: x for s, x in learned.items() if len(s) > LONGEST}
        for stretches in cut:
            if long:
                parts = [known[s] if s in known else long[s] for s in stretches]
            else:
                parts = list(map(known.__getitem__, stretches))
            if not parts or None in parts:
                yield 0, 0, 0, "", b"", b""
                continue
            written, links, tokens = zip(*parts, strict=True)
            found = np.frombuffer(b"".join(links), dtype="<i8")
            once, times = np.unique(found, return_counts=True)
            a, b = divmod(sum(tokens), 1 << 32)
            digest = hashlib.sha256(";".join(written).encode()).hexdigest()
            yield a, b, len(found), digest, once.tobytes(), times.astype("<i8").tobytes()


@cache
def pair(a_path: str, b_path: str) -> Pair:
    return Pair(a_path, b_path)


def align(a_ends: np.ndarray, b_ends: np.ndarray) -> Iterator[tuple[int, int, int, int, bool]]:
    """``(i, i_stop, j, j_stop, run)``: the groups of two ascending arrays of ends, in order.

    A run is a stretch of groups of one token on either side; others are one group each.
    """
    a, b = a_ends.astype("<i8").tobytes(), b_ends.astype("<i8").tobytes()
    a_list, b_list = a_ends.tolist(), b_ends.tolist()
    n, m = len(a_list), len(b_list)
    i = j = 0
    while i < n and j < m:
        first, at, step = i, 8 * (j - i), 8  # the diagonal: b's bytes lie ``at`` beside a's
        x, stop = 8 * i, 8 * min(n, m - j + i)
        while x + step <= stop and a[x : x + step] == b[x + at : x + at + step]:
            x += step
            step *= 2
        while step > 8:
            step //= 2
            if x + step <= stop and a[x : x + step] == b[x + at : x + at + step]:
                x += step
        i, j = x // 8, (x + at) // 8
        if i > first:
            yield first, i, j - (i - first), j, True
        if i == n or j == m:
            break
        p, q = i, j
        end_a, end_b = a_list[p], b_list[q]
        while end_a != end_b:  # tokens behind move on until both end together
            if end_a < end_b:
                p += 1
                end_a = a_list[p]
            else:
                q += 1
                end_b = b_list[q]
        yield i, p + 1, j, q + 1, False
        i, j = p + 1, q + 1


def _counted(links: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each link once, with the sum of its times."""
    if len(links) == 0:
        return links, times
    order = np.argsort(links, kind="stable")
    links, times = links[order], times[order]
    first = np.flatnonzero(np.concatenate([[True], links[1:] != links[:-1]]))
    return links[first], np.add.reduceat(times, first)


_ROWS = "key {kind}, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, links binary, times binary"


def align_texts(df: DataFrame, key: str, text: str, a_path: str, b_path: str) -> DataFrame:
    """One row a text: counts, digest of the groups, and its links (as packed 64-bit pairs of ids,
    ascending, A's in the upper half) with the times of each."""
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def aligned(batches):
        tokenizers = pair(a_path, b_path)
        for batch in batches:
            texts = batch["text"].to_pylist()
            first = 0
            while first < len(texts):
                stop, characters = first, 0
                while stop < len(texts) and stop - first < ROWS and characters < CHARACTERS:
                    characters += len(texts[stop] or "")
                    stop += 1
                made = list(tokenizers.texts(texts[first:stop]))
                columns = list(zip(*made, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [batch["key"].slice(first, stop - first)]
                    + [pa.array(columns[k], pa.int64()) for k in range(3)]
                    + [pa.array(columns[3], pa.string())]
                    + [pa.array(columns[k], pa.binary()) for k in (4, 5)],
                    ["key", "n_a", "n_b", "n_groups", "groups_sha256", "links", "times"],
                )
                first = stop

    return rows.mapInArrow(aligned, _ROWS.format(kind=rows.schema["key"].dataType.simpleString()))


def _arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All links of a batch, their times, and the number of links in each row."""
    links, times = batch["links"].to_pylist(), batch["times"].to_pylist()
    sizes = np.array([len(x) // 8 for x in links], dtype=np.int64)
    return (
        np.frombuffer(b"".join(links), dtype="<i8"),
        np.frombuffer(b"".join(times), dtype="<i8"),
        sizes,
    )


def count_links(aligned: DataFrame) -> DataFrame:
    """``(link, times)`` over all rows of ``align_texts``. A task keeps one table of bounded size."""

    def counted(batches):
        links, times = np.zeros(0, np.int64), np.zeros(0, np.int64)
        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            more, their, _ = _arrays(batch)
            waiting.append(_counted(more, their))
            size += len(waiting[-1][0])
            if size > max(1_000_000, 2 * len(links)):
                links, times = _counted(*map(np.concatenate, zip((links, times), *waiting, strict=True)))
                waiting, size = [], 0
        links, times = _counted(*map(np.concatenate, zip((links, times), *waiting, strict=True)))
        yield pa.RecordBatch.from_arrays([pa.array(links), pa.array(times)], ["link", "times"])

    return (
        aligned.select("links", "times")
        .mapInArrow(counted, "link bigint, times bigint")
        .groupBy("link")
        .agg(F.sum("times").alias("times"))
    )


def alignment(df: DataFrame, key: str, text: str, a_path: str, b_path: str) -> DataFrame:
    """``(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` of every row.

    ``n_best`` are links whose count over all rows is the highest of their B id, ``count_sum`` sums
    the counts over the links. What ``align_texts`` found is written once and read twice.
    """
    aligned = stage(align_texts(df, key, text, a_path, b_path), "aligned")
    table = count_links(aligned).toPandas()  # bounded by the vocabularies, see above
    order = np.argsort(table["link"].to_numpy())
    links = table["link"].to_numpy(np.int64)[order]
    counts = table["times"].to_numpy(np.int64)[order]
    b_ids = links & 0xFFFFFFFF
    highest = np.zeros(int(b_ids.max(initial=0)) + 1, np.int64)
    np.maximum.at(highest, b_ids, counts)
    shared = df.sparkSession.sparkContext.broadcast((links, counts, counts == highest[b_ids]))

    def scored(batches):
        known, count, best = shared.value
        for batch in batches:
            found, times, sizes = _arrays(batch)
            at = np.searchsorted(known, found)
            ends = np.concatenate([[0], np.cumsum(sizes)])

            def per_row(values: np.ndarray, ends: np.ndarray = ends) -> pa.Array:
                total = np.concatenate([[0], np.cumsum(values)])
                return pa.array(total[ends[1:]] - total[ends[:-1]], pa.int64())

            yield pa.RecordBatch.from_arrays(
                [batch["key"], batch["n_a"], batch["n_b"], batch["n_groups"], per_row(times)]
                + [per_row(times * best[at]), per_row(times * count[at]), batch["groups_sha256"]],
                ["key", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
            )

    kind = aligned.schema["key"].dataType.simpleString()
    return aligned.mapInArrow(
        scored,
        f"key {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint,"
        " count_sum bigint, groups_sha256 string",
    ).withColumnRenamed("key", key)
