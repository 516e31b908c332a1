"""Templates against patterns written out by hand, and planted licence texts."""

from __future__ import annotations

import random
import re

import pytest

from retail_strata.llm.license_templates import Scanner, matches, parse, scan_licenses, words_of
from retail_strata.llm.license_texts import TEMPLATES

TOYS = [
    ("t0", "x", "alpha <<beginOptional>>beta <<beginOptional>>gamma<<endOptional>><<endOptional>> delta"),
    ("t1", "y", "alpha <<var;name=v;words=0-2>> delta <<var;name=w;match=beta|gamma>>"),
    ("t2", "z", "<<beginOptional>>beta<<endOptional>> gamma gamma"),
    ("t3", "u", "delta <<var;name=n;match=[a-b].*;words=1-2>> gamma"),
]
TOY_PATTERNS = [
    r"alpha (?:beta (?:gamma )?)?delta ",
    r"alpha (?:\w+ ){0,2}delta (?:beta|gamma) ",
    r"(?:beta )?gamma gamma ",
    r"delta (?:[ab]\w* ){1,2}gamma ",
]


def brute(pattern, words):
    """All accepted stretches by trying every start and end."""
    return {
        (i, j)
        for i in range(len(words))
        for j in range(i + 1, len(words) + 1)
        if re.fullmatch(pattern, "".join(f"{w} " for w in words[i:j]))
    }


def test_automaton_accepts_what_patterns_accept():
    scanner, rng = Scanner({}, TOYS), random.Random(5)
    for _ in range(400):
        words = rng.choices(["alpha", "beta", "gamma", "delta"], k=rng.randint(0, 14))
        found = scanner.automaton.spans(words)
        for k, pattern in enumerate(TOY_PATTERNS):
            every = brute(pattern, words)
            own = {(start, end) for (t, start), end in found.items() if t == k}
            assert own <= every
            assert bool(own) == bool(every)
            kept = [(s, e) for t, s, e in matches(found) if t == k]
            assert all(a[1] <= b[0] for a, b in zip(kept, kept[1:], strict=False))
            if every:
                assert kept[0][0] == min(s for s, _ in every)


def fill(parts, rng):
    """A text that a template accepts."""
    out = []
    for part in parts:
        kind = type(part).__name__
        if kind == "Word":
            out.append(part.text)
        elif kind == "Optional":
            out += fill(part.parts, rng) if rng.random() < 0.5 else []
        else:
            pool = sorted(part.match) if part.match else ["acme", "2024", "jane"]
            out += rng.choices(pool, k=rng.randint(part.low, part.high))
    return out


@pytest.mark.parametrize("name,label,markup", TEMPLATES, ids=[t[0] for t in TEMPLATES])
def test_every_template_accepts_its_own_wording_only(name, label, markup):
    scanner, rng, parts = Scanner(), random.Random(name), parse(markup)
    for _ in range(5):
        words = fill(parts, rng)
        text = " - ".join(["Foo"] + [w.upper() if w.isascii() else w for w in words] + ["bar."])
        found = scanner.scan(text)
        assert label in found["labels"].split(",")
        assert name in [x.split("@")[0] for x in found["templates"].split(",")]
        assert any(t in words for t in scanner.telling)
    mandatory = [p.text for p in parts if type(p).__name__ == "Word"]
    for k in range(len(mandatory)):
        changed = [*mandatory[:k], "zzz", *mandatory[k + 1 :]]
        assert name not in scanner.scan(" ".join(changed))["templates"]


def test_markup_that_does_not_nest_is_refused():
    for wrong in ["a <<endOptional>>", "<<beginOptional>> a", "a <<frob>> b"]:
        with pytest.raises(ValueError, match="region|markup"):
            parse(wrong)
    with pytest.raises(ValueError, match="begin with given words"):
        Scanner({}, [("t", "l", "<<beginOptional>>a<<endOptional>>")])
    with pytest.raises(ValueError, match="begin with given words"):
        Scanner({}, [("t", "l", "<<var;name=v>> mandatory")])


def test_words_follow_the_bytes():
    assert words_of("It's A-Z_é9;İx") == ["it", "s", "a", "z", "é9", "İx"]


def test_rows_of_all_kinds(spark, documents):
    long = "word " * 200_000 + "Released under the MIT License. " + "tail " * 10
    texts = [
        None,
        "",
        "no such thing",
        "Licensed under CC BY-NC 4.0.",
        "CC BY, cc-by; CC BYx aCC BY",
        "the gnu general public license, version 3",
        "Apache License. Apache license",
        "Apache license",
        "Apache license",
        long,
    ]
    docs = documents(list(enumerate(texts)) + [(None, "MIT License")], clash=True)
    found = {r["doc_id"]: r for r in scan_licenses(docs, "doc_id", "text").collect()}
    assert len(found) == len(texts) + 1
    for k in (0, 1, 2):
        assert found[k]["n_base"] == 0 and found[k]["labels"] == "" and found[k]["first_word"] is None
    assert (found[0]["n_words"], found[2]["n_words"]) == (0, 3)
    assert (found[3]["base_labels"], found[3]["labels"]) == ("cc-by", "cc-by,cc-by-nc-4.0")
    assert (found[4]["n_base"], found[4]["first_word"], found[4]["last_word"]) == (2, 0, 2)
    assert found[5]["labels"] == "gpl" and found[5]["score"] == 0  # "under" is mandatory
    assert (found[6]["n_base"], found[6]["last_word"]) == (2, 2)
    assert found[9]["n_words"] == 200_015 and found[9]["first_word"] == 200_003
    assert found[9]["labels"] == "mit" and 0 < found[9]["score"] < 1e-4
    assert found[None]["base_labels"] == "mit"
    assert scan_licenses(docs.limit(0), "doc_id", "text").count() == 0
