"""Toxicity of texts whose words may be disguised: a noisy channel, then a classifier.

Disguised words (letters mixed with digits or signs, letters one by one, or a letter repeated) are
read as lattices: a character may stand for itself or for the letters it resembles, a separator or a
repetition may have been put in. Viterbi decoding finds the most probable letters under a character
model of the corpus, whose counts come from all texts, and the channel's costs. Words of letters
alone are left as they are, so the channel costs nothing where there is nothing to restore.

The restored text is scored by a logistic model over words, and stems of words with how often they
occur. It is fitted on at most ``FIT_ROWS`` labelled rows (the ones with the least hash of their id,
all if there are fewer) that are not held out, each with one text of its id (that with the least
hash), with the ``FEATURES`` features that part their labels
best. Labels, languages, sources and ids are no inputs.

Null and empty texts have no features and get the score of the constant term. A row without id has
no label and is not held out. Rows are scored as often as they occur; contradicting labels of an id
each count. Without a label to learn from, scores are the constant 0. Empty tables give no rows.
Only the named columns are read.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_strata.llm.bpe import Memory
from retail_strata.llm.common import _LOWER, blocks, held_out, lean, stage, utf8

#: Labelled rows that the classifier is fitted on, and its features.
FIT_ROWS, FEATURES = 8_192, 20_000
#: Tokens remembered while features are not chosen yet.
UNCHOSEN = 100_000
#: Documents that a feature must be in, and lengths of stems.
SUPPORT, STEMS = 4, (4, 5, 6, 7, 8)

# Letters that a sign or digit may stand for.
LOOKS = {
    "0": "o",
    "1": "il",
    "2": "z",
    "3": "e",
    "4": "a",
    "5": "s",
    "6": "gb",
    "7": "t",
    "8": "b",
    "9": "g",
    "@": "a",
    "$": "s",
    "!": "i",
    "|": "il",
    "+": "t",
    "(": "c",
    "€": "e",
    "£": "l",
    "¡": "i",
}
SEPARATORS = "._-*~'^ "
# Natural logarithms of the channel's probabilities.
SUBSTITUTED, SEPARATED, REPEATED, KEPT = -2.0, -0.7, -1.0, -0.05

#: Letters of the model: 0 for a word's edge, then a to z; other characters end a word.
ORDER, LETTERS = 4, 27

_WORD = re.compile(r"[a-z]+")
_MARKS = re.compile("[\u0300-\u036f]+")
_TRIPLE = re.compile(r"([a-z])\1\1")
#: Runs of letters, look-alikes and separators; and three or more single characters in a row.
_MIXED = re.compile("[a-z" + re.escape("".join(LOOKS) + SEPARATORS.strip()) + "]+")
_SPACED = re.compile(r"(?<!\S)\S(?: \S){2,}(?!\S)")
_EDGES = "".join(c for c in LOOKS if not c.isalnum()) + SEPARATORS


def fold(text: str) -> str:
    """Lower case without accents."""
    text = text.lower()
    return text if text.isascii() else _MARKS.sub("", unicodedata.normalize("NFKD", text))


class CharacterModel:
    """Log-probabilities of a letter after the ``ORDER - 1`` letters before it."""

    def __init__(self, counts: np.ndarray) -> None:
        counts = counts.reshape([LETTERS] * ORDER).astype(np.float64)
        lower = np.full(LETTERS, 1.0 / LETTERS)
        for order in range(1, ORDER + 1):
            seen = counts.sum(axis=tuple(range(ORDER - order)))
            total = seen.sum(axis=-1, keepdims=True)
            lower = (seen + 5.0 * lower) / (total + 5.0)
        self.log = np.log(lower).reshape(-1)
        self.contexts = LETTERS ** (ORDER - 1)

    def step(self, context: int, letter: int) -> tuple[float, int]:
        at = context * LETTERS + letter
        return float(self.log[at]), at % self.contexts


def restore(token: str, model: CharacterModel) -> str:
    """The most probable letters behind a disguised word.

    A state is the letters before, and the last letter read, so that a repetition is told from a
    letter that is really doubled; of the ways into a state only the best is kept.
    """
    states: dict[tuple[int, str], tuple[float, tuple]] = {(0, ""): (0.0, ())}
    for shown in token:
        after: dict[tuple[int, str], tuple[float, tuple]] = {}
        readings = [(shown, KEPT)] if "a" <= shown <= "z" else []
        readings += [(letter, SUBSTITUTED) for letter in LOOKS.get(shown, "")]
        skipped = None  # a sign between letters may be a mere ornament
        if shown in SEPARATORS or not readings:
            skipped = SEPARATED
        elif shown in LOOKS:
            skipped = SUBSTITUTED + SEPARATED
        for (context, last), (cost, path) in states.items():
            ways = [] if skipped is None else [((context, last), cost + skipped, path)]
            for letter, channel in readings:
                step, following = model.step(context, ord(letter) - 96)
                ways.append(((following, letter), cost + channel + step, (path, letter)))
                if letter == last:
                    ways.append(((context, last), cost + channel + REPEATED, path))
            for state, total, way in ways:
                if state not in after or total > after[state][0]:
                    after[state] = (total, way)
        states = after
    path = max(
        ((cost + model.step(context, 0)[0], path) for (context, _), (cost, path) in states.items()),
        key=lambda x: x[0],
    )[1]
    letters = []
    while path:
        path, letter = path
        letters.append(letter)
    return "".join(reversed(letters))


def disguised(token: str) -> list[str]:
    """Stretches of a folded token that may be a disguised word."""
    if token.isalpha() and not _TRIPLE.search(token):
        return []
    found = []
    for stretch in _MIXED.findall(token):
        whole = stretch.rstrip(SEPARATORS).lstrip(SEPARATORS + "!|+(")
        core = whole.rstrip(_EDGES)
        if _WORD.search(core) and (not core.isalpha() or _TRIPLE.search(core)):
            found.append(core)
            if whole != core:  # the signs at its end may be letters too
                found.append(whole)
    return found


class Reader:
    """Features of texts: the words of the restored text, and stems of them, by how often they occur.

    ``known``: the features that count, if not all do.
    """

    def __init__(self, model: CharacterModel, known: dict[str, int] | None = None) -> None:
        self.model, self.known = model, known
        # Without a choice of features a token has many names, so fewer tokens are remembered.
        self.memory = Memory(self._token, UNCHOSEN if known is None else None)

    def _token(self, token: str) -> tuple[str, ...]:
        token = fold(token)
        if " " in token:
            words = [restore(token, self.model)]
        else:
            words = _WORD.findall(token)
            words += [restore(core, self.model) for core in disguised(token)]
        names = []
        for word in words:
            if word:
                names.append("w" + word)
                names += ["s" + word[:n] for n in STEMS if len(word) > n]
        return tuple(n for n in names if self.known is None or n in self.known)

    def read(self, text: str) -> dict[str, int]:
        found: dict[str, int] = {}
        tokens = text.split()
        single = 0
        for token, times in Counter(tokens).items():
            single += times * (len(token) == 1)
            for name in self.memory[token]:
                found[name] = found.get(name, 0) + times
        if single > 2:
            for match in _SPACED.finditer(text):
                for name in self.memory[match.group()]:
                    found[name] = found.get(name, 0) + 1
        return found


def levels(found: dict[str, int]) -> list[str]:
    """A feature counts once, and anew when it occurs twice and three times."""
    return [
        f"{name}#{level}" if level > 1 else name
        for name, times in found.items()
        for level in range(1, min(times, 3) + 1)
    ]


def character_counts(texts: DataFrame) -> np.ndarray:
    """How often every ``ORDER`` letters follow each other, over all texts.

    Tasks count their own texts and send the counts they have; sums are made by key. The result has
    ``LETTERS ** ORDER`` cells however large the corpus is.
    """
    code = np.zeros(256, dtype=np.int64)
    code[97:123] = np.arange(1, 27)

    def counted(batches):
        total = np.zeros(LETTERS**ORDER, dtype=np.int64)
        for batch in batches:
            offsets, data = utf8(batch["text"])
            for first, end in blocks(offsets):
                part = code[_LOWER[data[offsets[first] : offsets[end]]]]
                part = np.concatenate([np.zeros(ORDER - 1, np.int64), part, np.zeros(1, np.int64)])
                at = np.zeros(len(part) - ORDER + 1, dtype=np.int64)
                for k in range(ORDER):
                    at = at * LETTERS + part[k : k + len(at)]
                total += np.bincount(at, minlength=len(total))
        some = np.flatnonzero(total)
        for k in range(0, len(some), 10_000):
            part = some[k : k + 10_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), pa.array(total[part], pa.int64())], ["cell", "times"]
            )

    found = (
        texts.select("text")
        .mapInArrow(lean(counted), "cell int, times bigint")
        .groupBy("cell")
        .agg(F.sum("times").alias("times"))
    ).toPandas()
    total = np.zeros(LETTERS**ORDER, dtype=np.int64)
    total[found["cell"].to_numpy(np.int64)] = found["times"].to_numpy(np.int64)
    return total


def learnable(labels: DataFrame, label_id: str, label: str) -> DataFrame:
    """``(id, label, order)`` of at most ``FIT_ROWS`` labels that may be learned from."""
    marks = labels.select(F.col(label_id).alias("id"), F.col(label).cast("int").alias("label"))
    marks = marks.where(F.col("label").isin(0, 1) & F.col("id").isNotNull() & ~held_out("id"))
    marks = marks.distinct()
    order = F.xxhash64(F.col("id").cast("string"))
    return marks.withColumn("order", order).orderBy("order", "id", "label").limit(FIT_ROWS)


def count_features(rows: DataFrame, model) -> DataFrame:
    """``(feature, positive, negative)``: in how many rows of either label each feature is."""

    def counted(batches):
        reader = Reader(model.value)
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for label, text in zip(batch["label"].to_pylist(), batch["text"].to_pylist(), strict=True):
                counts[label].update(levels(reader.read(text or "")))
        names = list(counts[0] | counts[1])
        for k in range(0, len(names), 10_000):
            some = names[k : k + 10_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.string())]
                + [pa.array([counts[y][n] for n in some], pa.int64()) for y in (1, 0)],
                ["feature", "positive", "negative"],
            )

    each = rows.select("label", "text").mapInArrow(
        lean(counted), "feature string, positive bigint, negative bigint"
    )
    return each.groupBy("feature").agg(
        F.sum("positive").alias("positive"), F.sum("negative").alias("negative")
    )


def choose_features(counts: DataFrame, positive: int, negative: int) -> list[str]:
    """The ``FEATURES`` features whose frequencies differ most between the labels."""
    a, b = F.col("positive"), F.col("negative")
    odds = F.log((a + 0.5) / (positive - a + 0.5)) - F.log((b + 0.5) / (negative - b + 0.5))
    z = F.abs(odds) / F.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
    best = counts.where(a + b >= SUPPORT).select("feature", z.alias("z")).where("z > 1.5")
    return [r["feature"] for r in best.orderBy(F.desc("z"), "feature").limit(FEATURES).collect()]


def fit(rows: list[list[int]], labels: np.ndarray, size: int) -> tuple[np.ndarray, float]:
    """Weights and constant of an L2-regularised logistic model, by gradient steps."""
    who = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    what = np.array([f for r in rows for f in r], dtype=np.int64)
    share = 1 / np.sqrt(np.maximum(1, np.bincount(what, minlength=size)))
    weights, constant = np.zeros(size), 0.0
    speed = np.zeros(size + 1)
    for step in range(300):
        raw = np.bincount(who, weights=weights[what], minlength=len(rows)) + constant
        error = 1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels
        slope = np.bincount(what, weights=error[who], minlength=size) + 0.5 * weights
        all_slopes = np.append(slope * share, error.sum() / math.sqrt(len(rows)))
        speed = 0.9 * speed - 0.02 * all_slopes
        weights += speed[:-1] * share
        constant += speed[-1] / math.sqrt(len(rows))
    return weights, float(constant)


class Scorer:
    """The fitted model: scores a text between 0 and 1."""

    def __init__(self, model: CharacterModel, weights: dict[str, float], constant: float) -> None:
        self.model, self.weights, self.constant = model, weights, constant
        self.reader: Reader | None = None

    def __getstate__(self):
        return {**vars(self), "reader": None}

    def forget(self) -> None:
        """Give back what was remembered of words, so that a worker's next task has the room."""
        self.reader = None

    def score(self, text: str | None) -> float:
        known = self.weights
        if self.reader is None:
            self.reader = Reader(self.model, {name.partition("#")[0]: 1 for name in known})
        raw = self.constant
        for name, times in self.reader.read(text or "").items():
            raw += known.get(name, 0.0)
            if times > 1:
                raw += known.get(f"{name}#2", 0.0)
            if times > 2:
                raw += known.get(f"{name}#3", 0.0)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, raw))))


def train(
    df: DataFrame, id_column: str, text: str, labels: DataFrame, label_id: str, label: str
) -> Scorer:
    """Count the characters of all texts, and fit the classifier on the rows not held out."""
    spark = df.sparkSession
    texts = df.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    model = CharacterModel(character_counts(texts))
    shared = spark.sparkContext.broadcast(model)
    marks = learnable(labels, label_id, label)  # FIT_ROWS rows at most
    named = texts.join(F.broadcast(marks), "id").groupBy("id", "label", "order")
    rows = stage(
        named.agg(F.min_by("text", F.xxhash64("text")).alias("text")), "labelled-texts"
    )
    by_label = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if not by_label:
        return Scorer(model, {}, -30.0)
    counts = count_features(rows.repartition(F.col("order")), shared)
    names = choose_features(counts, by_label.get(1, 0), by_label.get(0, 0))
    known = spark.sparkContext.broadcast({name: k for k, name in enumerate(names)})

    def numbered(batches):
        base = {name.partition("#")[0]: 1 for name in known.value}
        reader = Reader(shared.value, base)
        for batch in batches:
            lists = [
                sorted(known.value[f] for f in levels(reader.read(t or "")) if f in known.value)
                for t in batch["text"].to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch["order"], batch["label"], pa.array(lists, pa.list_(pa.int32()))],
                ["order", "label", "found"],
            )

    sample = (  # a row for each label, of which there are FIT_ROWS at most
        rows.select("order", "label", "text")
        .mapInArrow(lean(numbered), "order bigint, label int, found array<int>")
        .orderBy("order", "label", "found")
    ).collect()
    weights, constant = fit(
        [list(r["found"]) for r in sample],
        np.array([r["label"] for r in sample], dtype=np.float64),
        len(names),
    )
    kept = {n: w for n, w in zip(names, weights.tolist(), strict=True) if w}
    return Scorer(model, kept, constant)


def score(df: DataFrame, id_column: str, text: str, scorer: Scorer) -> DataFrame:
    """``(id, held_out, score, predicted)`` of every row."""
    shared = df.sparkSession.sparkContext.broadcast(scorer)
    docs = df.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    kind = docs.schema["id"].dataType.simpleString()

    def scored(batches):
        for batch in batches:
            values = [shared.value.score(t) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array(values, pa.float64())], ["id", "score"]
            )
        shared.value.forget()

    return docs.mapInArrow(lean(scored), f"id {kind}, score double").select(
        F.col("id").alias(id_column),
        held_out("id").alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def reject_toxic(df: DataFrame, text: str, scorer: Scorer) -> DataFrame:
    """The rows of ``df`` that score below 0.5, all columns as they were."""
    shared = df.sparkSession.sparkContext.broadcast(scorer)

    def kept(batches):
        for batch in batches:
            keep: Iterable[bool] = (
                shared.value.score(t) < 0.5 for t in batch.column(text).to_pylist()
            )
            yield batch.filter(pa.array(keep, pa.bool_()))
        shared.value.forget()

    return df.mapInArrow(lean(kept), df.schema)
