"""Licence scans by template markup: templates compiled into one automaton over words.

A template is licence wording with optional and replaceable regions (``license_texts``). It is
compiled into a nondeterministic automaton whose steps read one word: a mandatory word is a step
that reads it alone, an optional region can be passed without reading, a replaceable region is a
row of steps of which some may be passed. A stretch of a text is accepted if all its words are read
and every mandatory word of the template is there, exactly and in order. All templates run side by
side in one pass; a state that two starts reach keeps the earlier, so the work for a text is its
words times the states alive, which few words bring to life.

A word that every accepted text must hold, one for each template and phrase (those that serve most
templates are taken), tells texts that can match nothing. Spark finds these and counts words while
it scans; only the other texts go to Python. The words of a text are the runs of ASCII letters and
digits (A-Z lowered) and of characters above 0x7F.

Null and empty texts have no words, no places and no labels. Repeated rows give a row each. Only the
columns named are read, so extra columns of any name do no harm; an empty table gives no rows. A
text is read whole, in time and memory linear in its length.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_strata.llm.license_texts import BASE_PHRASES, TEMPLATES

#: The words of a text that is not lowered, for Spark; and of its lowered UTF-8 bytes.
WORDS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_WORD_BYTES = re.compile(rb"[0-9a-z\x80-\xff]+")
_MARKUP = re.compile(r"<<(.*?)>>", re.DOTALL)
#: A mandatory word of fewer letters tells texts apart only where a template has no other; the
#: words below are in nearly all texts and tell nothing.
TELLING = 6
COMMON = frozenset("a an and by for in is of on or the this to under".split())


def words_of(text: str) -> list[str]:
    return [w.decode() for w in _WORD_BYTES.findall(text.encode().lower())]


@dataclass(frozen=True)
class Word:
    text: str


@dataclass(frozen=True)
class Var:
    """``low`` to ``high`` words that match; ``match`` is a set of words, a pattern or None (any)."""

    match: frozenset[str] | re.Pattern[str] | None
    low: int
    high: int


@dataclass(frozen=True)
class Optional:
    parts: tuple


def parse(markup: str) -> tuple:
    """Words, vars and optional regions of a template. Regions that do not nest are an error."""
    open_parts: list[list] = [[]]
    for k, piece in enumerate(_MARKUP.split(markup)):
        if k % 2 == 0:
            open_parts[-1] += map(Word, words_of(piece))
        elif piece == "beginOptional":
            open_parts.append([])
        elif piece == "endOptional":
            if len(open_parts) < 2:
                raise ValueError("an optional region ends that did not begin")
            inner = tuple(open_parts.pop())
            open_parts[-1].append(Optional(inner))
        elif piece.startswith("var;"):
            given = dict(x.split("=", 1) for x in piece.split(";")[1:])
            low, _, high = given.get("words", "1").partition("-")
            open_parts[-1].append(Var(_matcher(given.get("match")), int(low), int(high or low)))
        else:
            raise ValueError(f"no such markup: {piece!r}")
    if len(open_parts) > 1:
        raise ValueError("an optional region does not end")
    return tuple(open_parts[0])


def _matcher(match: str | None) -> frozenset[str] | re.Pattern[str] | None:
    if match is None:
        return None
    return frozenset(match.split("|")) if re.fullmatch(r"[0-9a-z|]+", match) else re.compile(match)


@dataclass
class Automaton:
    """Steps of all templates. ``reads[s]`` is what step ``s`` reads, ``then[s]`` the place after it.

    A place is passed on to all places reachable without reading (``_closed``), of which those that
    read are steps and those in ``accepts`` end a template.
    """

    reads: list = field(default_factory=list)
    then: list[int] = field(default_factory=list)
    free: list[list[int]] = field(default_factory=list)
    accepts: dict[int, int] = field(default_factory=dict)
    begins: list[int] = field(default_factory=list)

    def _place(self) -> int:
        self.reads.append(False)
        self.then.append(-1)
        self.free.append([])
        return len(self.free) - 1

    def _add(self, at: int, part) -> int:
        if isinstance(part, Optional):
            end = at
            for inner in part.parts:
                end = self._add(end, inner)
            after = self._place()
            self.free[at].append(after)
            self.free[end].append(after)
            return after
        low, high = (1, 1) if isinstance(part, Word) else (part.low, part.high)
        skips, here = [], at
        for k in range(high):
            if k >= low:
                skips.append(here)
            step, after = self._place(), self._place()
            self.free[here].append(step)
            self.reads[step] = frozenset([part.text]) if isinstance(part, Word) else part.match
            self.then[step] = after
            here = after
        end = self._place()
        for place in [*skips, here]:
            self.free[place].append(end)
        return end

    def add(self, template: int, parts: tuple) -> None:
        begin = end = self._place()
        for part in parts:
            end = self._add(end, part)
        self.accepts[end] = template
        self.begins.append(begin)

    def _closed(self, place: int) -> tuple[tuple[int, ...], tuple[int, ...]]:
        """Steps and templates reached from a place without reading."""
        seen, todo = {place}, [place]
        while todo:
            for after in self.free[todo.pop()]:
                if after not in seen:
                    seen.add(after)
                    todo.append(after)
        steps = tuple(p for p in sorted(seen) if self.then[p] >= 0)
        return steps, tuple(self.accepts[p] for p in sorted(seen) if p in self.accepts)

    def close(self) -> Automaton:
        """Work out, once, where each step leads and which words begin a template."""
        self.next = {s: self._closed(t) for s, t in enumerate(self.then) if t >= 0}
        self.first: dict[str, list[int]] = {}
        for begin in self.begins:
            steps, accepted = self._closed(begin)
            if accepted or not all(isinstance(self.reads[s], frozenset) for s in steps):
                raise ValueError("a template has to begin with given words")
            for s in steps:
                for word in self.reads[s]:
                    self.first.setdefault(word, []).append(s)
        return self

    def _reads(self, step: int, word: str) -> bool:
        match = self.reads[step]
        if match is None:
            return True
        return word in match if isinstance(match, frozenset) else match.fullmatch(word) is not None

    def spans(self, words: list[str]) -> dict[tuple[int, int], int]:
        """``(template, start) -> end``: longest accepted stretch from each start, in words."""
        found: dict[tuple[int, int], int] = {}
        alive: dict[int, int] = {}
        for k, word in enumerate(words):
            fresh = self.first.get(word)
            if not alive and not fresh:
                continue
            ready = [(s, start) for s, start in alive.items() if self._reads(s, word)]
            ready += [(s, k) for s in fresh or ()]
            alive = {}
            for step, start in ready:
                steps, accepted = self.next[step]
                for s in steps:
                    if alive.get(s, k + 1) > start:
                        alive[s] = start
                for template in accepted:
                    found[template, start] = k + 1
        return found


def matches(spans: dict[tuple[int, int], int]) -> list[tuple[int, int, int]]:
    """``(template, start, end)``: of a template's stretches that overlap, the first and longest."""
    kept: list[tuple[int, int, int]] = []
    for (template, start), end in sorted(spans.items()):
        if not kept or kept[-1][0] != template or kept[-1][2] <= start:
            kept.append((template, start, end))
    return kept


def telling_words(templates: Iterable[tuple]) -> list[str]:
    """A mandatory word of each template, as few as a greedy choice finds."""
    open_sets = []
    for parts in templates:
        mandatory = {p.text for p in parts if isinstance(p, Word)}
        if not mandatory:
            raise ValueError("a template needs a mandatory word")
        open_sets.append(
            {w for w in mandatory if len(w) >= TELLING} or mandatory - COMMON or mandatory
        )
    chosen: list[str] = []
    while open_sets:
        every = {w for s in open_sets for w in s}
        best = min(every, key=lambda w: (-sum(w in s for s in open_sets), -len(w), w))
        chosen.append(best)
        open_sets = [s for s in open_sets if best not in s]
    return chosen


class Scanner:
    """Base phrases and templates, compiled."""

    def __init__(
        self,
        phrases: Mapping[str, str] = BASE_PHRASES,
        templates: Iterable[tuple[str, str, str]] = tuple(TEMPLATES),
    ) -> None:
        templates = list(templates)
        self.names = [name for name, _, _ in templates]
        self.labels = [label for _, label, _ in templates]
        self.phrases = [(phrase.split(" "), label) for phrase, label in phrases.items()]
        parsed = [parse(markup) for _, _, markup in templates]
        self.automaton = Automaton()
        for k, parts in enumerate(parsed):
            self.automaton.add(k, parts)
        self.automaton.close()
        self.telling = telling_words([*parsed, *(parse(p) for p in phrases)])

    def places(self, words: list[str]) -> Iterator[tuple[int, str]]:
        """Start and label of every place where a base phrase's words stand one after another."""
        for phrase, label in self.phrases:
            at = -1
            while True:
                try:
                    at = words.index(phrase[0], at + 1)
                except ValueError:
                    break
                if words[at : at + len(phrase)] == phrase:
                    yield at, label

    def scan(self, text: str) -> dict:
        words = words_of(text)
        places = list(self.places(words))
        found = matches(self.automaton.spans(words))
        base = {label for _, label in places}
        starts = [start for start, _ in places]
        return {
            "n_base": len(places),
            "first_word": min(starts, default=None),
            "last_word": max(starts, default=None),
            "base_labels": ",".join(sorted(base)),
            "labels": ",".join(sorted(base | {self.labels[t] for t, _, _ in found})),
            "score": max((end - start for _, start, end in found), default=0) / max(1, len(words)),
            "templates": ",".join(f"{self.names[t]}@{s}-{e}" for t, s, e in sorted(found, key=lambda x: (x[1], x[0]))),
        }


_FOUND = {
    "n_base": pa.int64(),
    "first_word": pa.int64(),
    "last_word": pa.int64(),
    "base_labels": pa.string(),
    "labels": pa.string(),
    "score": pa.float64(),
    "templates": pa.string(),
}
_NOTHING = {"n_base": 0, "first_word": None, "last_word": None, "base_labels": "", "labels": "", "score": 0.0, "templates": ""}
_FOUND_SQL = (
    "n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string,"
    " score double, templates string"
)


def scan_licenses(df: DataFrame, key: str, text: str, scanner: Scanner | None = None) -> DataFrame:
    """``(key, n_words, n_base, first_word, last_word, base_labels, labels, score, templates)``.

    ``n_base`` counts all places of base phrases, ``first_word`` and ``last_word`` are the smallest
    and largest word they start at (null without one). ``labels`` are those of the phrases and of
    the accepted templates, ``templates`` the accepted ones as ``name@start-end`` in words, and
    ``score`` the share of the text's words in its longest accepted stretch (0 without one).
    """
    scanner = scanner or Scanner()
    letter = r"0-9A-Za-z\x{80}-\x{10FFFF}"
    some = "|".join(map(re.escape, scanner.telling))
    rows = df.select(
        F.col(key).alias("key"),
        F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("bigint").alias("n_words"),
        F.when(F.col(text).rlike(f"(?i)(?:{some})(?![{letter}])"), F.col(text)).alias("text"),
    )

    def scanned(batches):
        for batch in batches:
            found = [_NOTHING if t is None else scanner.scan(t) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["key"], batch["n_words"]]
                + [pa.array([x[name] for x in found], kind) for name, kind in _FOUND.items()],
                ["key", "n_words", *_FOUND],
            )

    kind = rows.schema["key"].dataType.simpleString()
    schema = f"key {kind}, n_words bigint, {_FOUND_SQL}"
    return rows.mapInArrow(scanned, schema).withColumnRenamed("key", key)
