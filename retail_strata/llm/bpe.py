"""BPE encoding and decoding by tree concatenation.

A text longer than a leaf is cut into leaves, which tasks encode in parallel. Neighbouring halves
are then put together in a tree. At a join inside an unsplit run, a window around it is encoded
anew and doubled until its tokens agree with those of both halves over several tokens; the halves'
tokens up to there and the window's between are the encoding of the whole. This is exact, because a
sequence of BPE tokens is the encoding of its text if every two neighbours are.

The tokenizer must treat the words between ASCII white space apart from each other (as the word
BPE does: its pre-tokenizer drops white space and its normaliser does not reach over it). Words
are looked up in a bounded memory of each worker and only new ones go through the library.

Null and empty texts have no tokens. Repeated rows give a row each. Only the columns named are
read, so extra columns of any name do no harm; an empty table gives no rows.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import os
import re
import unicodedata
from array import array
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_strata.llm.common import lean

#: Characters of a leaf.
LEAF = 32_768
#: Tokens on each side of a join in the first window, and tokens that must agree.
WINDOW, AGREE = 16, 4
#: Words a worker remembers, and the longest such word in bytes.
REMEMBERED, WORD_BYTES = 500_000, 64

_WHITE = "\t\n\x0b\x0c\r "
_RUNS = re.compile(r"[^\t-\r ]+")


@cache
def load(path: str):
    """The library's tokenizer, once per worker, without truncation and padding."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


_MARKS = frozenset((b".", b",", b";", b":", b"!", b"?"))
#: Words that need no normalising but lower case: printable ASCII, Latin letters with accents.
_PLAIN = re.compile("[!-~\u00c0-\u012f\u0131-\u017e]+")
#: First bytes in UTF-8 of U+0300 to U+037F, which hold all marks that compose with ASCII letters.
_MARK_BYTES = (b"\xcc", b"\xcd")


def _split_pattern(tokenizer) -> str | None:
    """The pattern of the pieces that the tokenizer merges apart from each other.

    Known for tokenizers that lower the text in NFC, split it by one pattern and map its bytes to
    letters; for others there is none and every word goes through the whole library.
    """
    rule = json.loads(tokenizer.to_str())
    norm = [x["type"] for x in (rule["normalizer"] or {}).get("normalizers", [])]
    steps = (rule["pre_tokenizer"] or {}).get("pretokenizers", [])
    if norm != ["NFC", "Replace", "Lowercase"] or [x["type"] for x in steps] != ["Split", "ByteLevel"]:
        return None
    split, to_bytes = steps
    if not split["invert"] or split["behavior"] != "Removed" or "Regex" not in split["pattern"]:
        return None
    return None if to_bytes["add_prefix_space"] or to_bytes["use_regex"] else split["pattern"]["Regex"]


def _plain_split(pattern: str) -> Callable[[str], list[str]]:
    """The pieces of ``_PLAIN`` words, by a pattern whose classes list such letters and digits."""
    plain = [c for c in map(chr, range(0x180)) if _PLAIN.fullmatch(c)]
    for kind in "LN":
        listed = "".join(c for c in plain if unicodedata.category(c)[0] == kind)
        pattern = pattern.replace(f"\\p{{{kind}}}", listed)
    return (regex if "\\p" in pattern.lower() else re).compile(pattern).findall


def _byte_letters() -> str:
    """The letter by which byte-level vocabularies write each byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}
    return "".join(letters[b] for b in range(256))


class Memory(dict):
    """A bounded memory of what a function makes of its argument; short arguments are kept."""

    def __init__(self, make, most: int | None = None) -> None:
        super().__init__()
        self.make, self.most = make, REMEMBERED if most is None else most

    def __missing__(self, x):
        made = self.make(x)
        if len(x) <= WORD_BYTES:
            if len(self) >= self.most:
                self.clear()
            self[x] = made
        return made


class WordEncoder:
    """Ids of texts, word by word, with a bounded memory of words and of the pieces they split in."""

    def __init__(self, path: str) -> None:
        self.tokenizer = load(path)
        self.model = self.tokenizer.model
        pattern = _split_pattern(self.tokenizer)
        self.split = _plain_split(pattern) if pattern else None
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added_low = [t.lower() for t in self.added]
        self.added_bytes = [t.encode() for t in self.added_low]
        # No added token can lie within letters and one mark.
        self.quick = self.split is not None and not any(
            re.fullmatch(r"[^\W\d_]*[.,;:!?]?", t) for t in self.added_low
        )
        self.letters = _byte_letters()
        self.words = Memory(self._word)

    def _piece(self, piece: bytes) -> bytes:
        shown = codecs.charmap_decode(piece, "strict", self.letters)[0]
        return array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()

    def _word(self, word: bytes) -> bytes:
        known = self.words
        if self.quick:  # letters are one piece, and so is a mark after them
            if word.isalpha():
                low = word.lower()
                return self._piece(word) if low == word else known[low]
            if word[-1:] in _MARKS and word[:-1].isalpha():
                return known[word[:-1].lower()] + known[word[-1:]]
        text = word.decode()
        if self.split is not None and _PLAIN.fullmatch(text):
            low = text.lower()  # an added token in other letters is none, but would be once lowered
            if self.quick and low.isalpha():
                return self._piece(word) if low == text else known[low.encode()]
            if self.quick and word[-1:] in _MARKS and low[:-1].isalpha():
                return known[low[:-1].encode()] + known[word[-1:]]
            if not any(t in low for t in self.added_low):
                pieces = [p.encode() for p in self.split(low)]
                return self._piece(word) if pieces == [word] else b"".join([known[p] for p in pieces])
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _lowered(self, text: bytes) -> bytes:
        """The text with A-Z lowered where that gives the same ids, so that fewer words are new.

        Letters may compose with marks in one case only, and added tokens count as written.
        """
        if self.split is None or any(b in text for b in _MARK_BYTES):
            return text
        low = text.lower()
        return text if any(t in low for t in self.added_bytes) else low

    def encode(self, texts: Iterable[bytes]) -> Iterator[bytes]:
        """Little-endian 32-bit ids of each UTF-8 text."""
        known = self.words.__getitem__
        for text in texts:
            yield b"".join(map(known, self._lowered(text).split()))


@cache
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


@dataclass
class Run:
    """Part of an unsplit run: its text, tokens, and each token's first and last character."""

    text: str
    ids: list[int]
    starts: list[int]
    ends: list[int]


def encode_run(tokenizer, text: str) -> Run:
    found = tokenizer.encode(text, add_special_tokens=False)
    spans = found.offsets
    return Run(text, list(found.ids), [s for s, _ in spans], [e for _, e in spans])


def _meet(a: list[tuple], b: list[tuple], first: int) -> tuple[int, int] | None:
    """Places in ``a`` and ``b`` (from ``first`` on in ``a``) where ``AGREE`` tokens are the same."""
    places = {}
    for j in range(len(b) - AGREE + 1):
        places.setdefault(b[j], []).append(j)
    for i in range(first, len(a) - AGREE + 1):
        for j in places.get(a[i], ()):
            if a[i : i + AGREE] == b[j : j + AGREE]:
                return i, j
    return None


def join_runs(tokenizer, left: Run, right: Run) -> Run:
    """Encoding of two neighbouring parts, by growing windows around the place where they meet."""
    shift = len(left.text)
    text = left.text + right.text
    size = WINDOW
    while True:
        i, j = max(0, len(left.ids) - size), min(len(right.ids), size)
        while i > 0 and left.starts[i] < left.ends[i - 1]:
            i -= 1
        while 0 < j < len(right.ids) and right.starts[j] < right.ends[j - 1]:
            j += 1
        begin = left.starts[i] if i > 0 else 0
        end = right.starts[j] + shift if j < len(right.ids) else len(text)
        window = encode_run(tokenizer, text[begin:end])
        middle = list(
            zip(
                window.ids,
                (s + begin for s in window.starts),
                (e + begin for e in window.ends),
                strict=True,
            )
        )
        head = list(zip(left.ids[i:], left.starts[i:], left.ends[i:], strict=True))
        tail = [
            (t, s + shift, e + shift)
            for t, s, e in zip(right.ids[:j], right.starts[:j], right.ends[:j], strict=True)
        ]
        low = (0, 0) if i == 0 else _meet(head, middle, 0)
        high = (len(tail), len(middle)) if j >= len(right.ids) else None
        if high is None and low is not None:
            met = _meet(tail, middle, 0)
            high = met if met is None or met[1] >= low[1] else None
        if low is not None and high is not None:
            tokens = [
                *zip(left.ids[: i + low[0]], left.starts, left.ends, strict=False),
                *middle[low[1] : high[1]],
                *(
                    (t, s + shift, e + shift)
                    for t, s, e in zip(
                        right.ids[high[0] :], right.starts[high[0] :], right.ends[high[0] :], strict=True
                    )
                ),
            ]
            return Run(text, [t[0] for t in tokens], [t[1] for t in tokens], [t[2] for t in tokens])
        size *= 2


def join_tree(tokenizer, runs: list[Run]) -> Run:
    """Join neighbours pairwise until one run is left."""
    while len(runs) > 1:
        runs = [
            join_runs(tokenizer, runs[k], runs[k + 1]) if k + 1 < len(runs) else runs[k]
            for k in range(0, len(runs), 2)
        ]
    return runs[0]


def _last_white(text: str, first: int, end: int) -> int:
    """Place of the last ASCII white space of a part of a text, else -1."""
    return max(text.rfind(c, first, end) for c in _WHITE)


def cut(text: str, leaf: int) -> list[tuple[str, bool]]:
    """Leaves of a text, each with whether it is cut off from its left neighbour inside a run.

    A cut is put at the last white space of the leaf, or, in an unsplit run, at its very end.
    """
    leaves, at, inside = [], 0, False
    while at < len(text):
        end = min(at + leaf, len(text))
        hard = False
        if end < len(text):
            space = _last_white(text, at, end)
            hard = space <= at
            end = end if hard else space
        leaves.append((text[at:end], inside))
        at, inside = end, hard
    return leaves or [("", False)]


def encode_leaf(encoder: WordEncoder, text: str, joins_left: bool, joins_right: bool):
    """``(head, ids, tail)``: runs that touch a cut inside a run, and the ids of what is between.

    An unsplit leaf is a head alone.
    """
    head = tail = None
    first, last = 0, len(text)
    if joins_left and (run := _RUNS.match(text)):
        head = encode_run(encoder.tokenizer, run.group())
        first = run.end()
    start = _last_white(text, 0, len(text)) + 1
    if joins_right and start < len(text) and (head is None or start > 0):
        tail = encode_run(encoder.tokenizer, text[start:])
        last = start
    (ids,) = encoder.encode([text[first:last].encode()])
    return head, ids, tail


def concatenate(tokenizer, leaves: list[dict]) -> bytes:
    """Ids of a text from its encoded leaves, in order."""
    out: list[bytes] = []
    open_runs: list[Run] = []

    def close() -> None:
        if open_runs:
            out.append(np.array(join_tree(tokenizer, open_runs).ids, dtype="<u4").tobytes())
            open_runs.clear()

    for k, leaf in enumerate(leaves):
        if not leaf["inside"]:
            close()
        if leaf["head"] is not None:
            open_runs.append(leaf["head"])
        unsplit = leaf["head"] is not None and len(leaf["head"].text) == leaf["size"]
        if not unsplit:
            close()
            out.append(leaf["ids"])
        if leaf["tail"] is not None:
            open_runs.append(leaf["tail"])
    close()
    return b"".join(out)


def _pack(run: Run | None) -> dict | None:
    return None if run is None else vars(run)


_RUN = pa.struct(
    [("text", pa.string())] + [(x, pa.list_(pa.int64())) for x in ("ids", "starts", "ends")]
)
_RUN_SQL = "struct<text:string,ids:array<bigint>,starts:array<bigint>,ends:array<bigint>>"


#: Makes rows of keys and the ids of their texts.
Finish = Callable[[pa.Array, list[bytes]], pa.RecordBatch]


def keys_and_ids(keys: pa.Array, ids: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([keys, pa.array(ids, pa.binary())], ["key", "ids"])


def encode_long(docs: DataFrame, path: str, leaf: int, finish: Finish, schema: str) -> DataFrame:
    """What ``finish`` makes of long texts ``(row, key, text)``: leaves in parallel, then the tree."""
    kind = docs.schema["key"].dataType.simpleString()

    def leaves(batches):
        for batch in batches:
            for k, text in enumerate(batch["text"].to_pylist()):
                parts = cut(text, leaf)
                inner = [inside for _, inside in parts] + [False]
                same = pa.array([k] * len(parts))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["row"].take(same),
                        batch["key"].take(same),
                        pa.array(range(len(parts)), pa.int32()),
                        pa.array(inner[:-1], pa.bool_()),
                        pa.array(inner[1:], pa.bool_()),
                        pa.array([t for t, _ in parts], pa.string()),
                    ],
                    ["row", "key", "leaf", "left", "right", "text"],
                )

    def encoded(batches):
        encoder = word_encoder(path)
        for batch in batches:
            for k, x in enumerate(batch.drop_columns(["key"]).to_pylist()):
                head, ids, tail = encode_leaf(encoder, x["text"], x["left"], x["right"])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([x["row"]], pa.int64()),
                        batch["key"].slice(k, 1),
                        pa.array([x["leaf"]], pa.int32()),
                        pa.array([x["left"]], pa.bool_()),
                        pa.array([len(x["text"])], pa.int64()),
                        pa.array([_pack(head)], _RUN),
                        pa.array([ids], pa.binary()),
                        pa.array([_pack(tail)], _RUN),
                    ],
                    ["row", "key", "leaf", "inside", "size", "head", "ids", "tail"],
                )

    def merged(table: pa.Table) -> pa.Table:
        rows = sorted(table.drop_columns(["key"]).to_pylist(), key=lambda x: x["leaf"])
        for x in rows:
            x |= {k: Run(**x[k]) if x[k] is not None else None for k in ("head", "tail")}
        ids = concatenate(load(path), rows)
        return pa.Table.from_batches([finish(table["key"].combine_chunks().slice(0, 1), [ids])])

    return (
        docs.mapInArrow(
            lean(leaves),
            f"row bigint, key {kind}, leaf int, `left` boolean, `right` boolean, text string",
        )
        .repartition(F.col("row"), F.col("leaf"))
        .mapInArrow(
            lean(encoded),
            f"row bigint, key {kind}, leaf int, inside boolean, size bigint, head {_RUN_SQL},"
            f" ids binary, tail {_RUN_SQL}",
        )
        .groupBy("row")
        .applyInArrow(merged, schema)
    )


def encode(
    df: DataFrame,
    key: str,
    text: str,
    path: str,
    leaf: int = LEAF,
    finish: Finish = keys_and_ids,
    columns: str = "ids binary",
    forget: bool = False,
) -> DataFrame:
    """``(key, ids)`` for every row: ids as little-endian unsigned 32-bit integers.

    Texts of one leaf are encoded where they are read; only longer ones are cut and shuffled.
    ``finish`` may make something else of the ids in the same task: ``key`` and ``columns``. With
    ``forget`` a worker gives back what it remembered of words after a task, which leaves room for
    what runs next and costs time.
    """
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    is_long = F.coalesce(F.length("text") > leaf, F.lit(False))
    schema = f"key {rows.schema['key'].dataType.simpleString()}, {columns}"

    def whole(batches):
        encoder = word_encoder(path)
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                part = batch.slice(first, 512)
                texts = part["text"].cast(pa.large_binary()).fill_null(b"").to_pylist()
                yield finish(part["key"], list(encoder.encode(texts)))
        if forget:
            encoder.words.clear()

    short = rows.where(~is_long).mapInArrow(lean(whole), schema)
    long = rows.where(is_long).select(F.monotonically_increasing_id().alias("row"), "key", "text")
    return short.unionByName(encode_long(long, path, leaf, finish, schema))


def decode(tokenizer, ids: bytes) -> str:
    """The library's text of packed ids, special tokens included."""
    return tokenizer.decode(np.frombuffer(ids, dtype="<u4").tolist(), skip_special_tokens=False)


def digests(df: DataFrame, key: str, text: str, path: str, leaf: int = LEAF) -> DataFrame:
    """``(key, n_tokens, ids_sha256, decoded_sha256)`` of every row's tokens and decoded text."""

    def hashed(keys: pa.Array, packed: list[bytes]) -> pa.RecordBatch:
        tokenizer, decimal = load(path), decimals(path)
        n, ids_hex, text_hex = [], [], []
        for data in packed:
            ids = np.frombuffer(data, dtype="<u4").tolist()
            written = " ".join(map(decimal.__getitem__, ids))
            n.append(len(ids))
            ids_hex.append(hashlib.sha256(written.encode()).hexdigest())
            text_hex.append(hashlib.sha256(decode(tokenizer, data).encode()).hexdigest())
        return pa.RecordBatch.from_arrays(
            [keys, pa.array(n, pa.int64()), pa.array(ids_hex), pa.array(text_hex)],
            ["key", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    columns = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return encode(df, key, text, path, leaf, hashed, columns, forget=True).withColumnRenamed("key", key)


@cache
def decimals(path: str) -> list[str]:
    """Every id of the vocabulary as text."""
    return [str(i) for i in range(load(path).get_vocab_size(with_added_tokens=True))]
