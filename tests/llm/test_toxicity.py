"""Deobfuscation, the channel's optimum, and held-out accuracy."""

from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import pytest

from retail_strata.llm import toxicity as t

BAD = ["idiot", "moron", "stupid", "worthless"]
LABELS = "doc_id bigint, toxic int, text string"


@pytest.fixture(scope="module")
def model():
    code = np.zeros(256, dtype=np.int64)
    code[97:123] = np.arange(1, 27)
    text = " ".join([*BAD * 30, *"the cat sat on a mat with all the rest of them".split() * 20])
    letters = np.concatenate([[0, 0, 0], code[np.frombuffer(text.encode(), np.uint8)], [0]])
    counts = np.zeros(t.LETTERS**t.ORDER, dtype=np.int64)
    for k in range(len(letters) - t.ORDER + 1):
        at = 0
        for x in letters[k : k + t.ORDER]:
            at = at * t.LETTERS + int(x)
        counts[at] += 1
    return t.CharacterModel(counts)


@pytest.mark.parametrize(
    ("shown", "meant"),
    [("1d10t", "idiot"), ("m0r0n", "moron"), ("s.t.u.p.i.d", "stupid"), ("stuuuupid", "stupid"),
     ("m o r o n", "moron"), ("w0rthle$s", "worthless"), ("idi-ot", "idiot")],
)
def test_restores(model, shown, meant):
    assert "w" + meant in t.Reader(model)._token(shown)


@pytest.mark.parametrize("shown", ["1d10t", "m0rr", "st.t", "aa1a"])
def test_viterbi_finds_the_best_reading(model, shown):
    def cost(word, choice):
        total, context, last, out = 0.0, 0, "", ""
        for c, (kind, letter) in zip(word, choice, strict=True):
            if kind == "skip":
                total += t.SEPARATED if c in t.SEPARATORS else t.SUBSTITUTED + t.SEPARATED
                continue
            total += t.KEPT if letter == c else t.SUBSTITUTED
            if kind == "again":
                if letter != last:
                    return None
                total += t.REPEATED
                continue
            step, context = model.step(context, ord(letter) - 96)
            total, last, out = total + step, letter, out + letter
        return total + model.step(context, 0)[0], out

    options = []
    for c in shown:
        letters = ([c] if c.isalpha() else []) + list(t.LOOKS.get(c, ""))
        some = [(kind, x) for x in letters for kind in ("read", "again")]
        options.append(some + ([("skip", "")] if not c.isalpha() else []))
    best = max(filter(None, (cost(shown, choice) for choice in itertools.product(*options))))
    assert t.restore(shown, model) == best[1]


def test_plain_words_stay(model):
    assert t.disguised("thing") == [] and t.disguised("well***") == [] and t.disguised("2024") == []
    assert t.Reader(model).read("The CAT sat!")["wcat"] == 1


def corpus(prose):
    rng, rows = random.Random(5), []
    for k in range(300):
        text, toxic = prose(k, 30), k % 3 == 0
        if toxic:
            text += " " + rng.choice(BAD) + " " + rng.choice(BAD)
        rows.append((k, text, int(toxic)))
    return rows


def test_held_out_accuracy(spark, documents, prose):
    rows = corpus(prose)
    disguise = str.maketrans({"o": "0", "i": "1", "s": "$"})
    hidden = [
        (1000 + k, f"{prose(900 + k, 30)} " + f"{BAD[k % 4]} {BAD[k % 3]}".translate(disguise))
        for k in range(20)
    ]  # two words each, as in the rows that are learned from
    df = documents([(k, x) for k, x, _ in rows] + hidden, clash=True)
    labels = spark.createDataFrame([(k, y, "x") for k, _, y in rows], LABELS)
    scorer = t.train(df, "doc_id", "text", labels, "doc_id", "toxic")
    got = {r.doc_id: r for r in t.score(df, "doc_id", "text", scorer).collect()}
    held = [(got[k].predicted, y) for k, _, y in rows if zlib.crc32(str(k).encode()) % 5 == 0]
    assert len(held) > 30 and sum(p == y for p, y in held) >= 0.95 * len(held)
    assert all(got[k].held_out == (zlib.crc32(str(k).encode()) % 5 == 0) for k in got)
    assert sum(got[k].predicted for k, _ in hidden) >= 16
    kept = t.reject_toxic(df, "text", scorer)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {k for k, r in got.items() if r.score < 0.5}


def test_nulls_repeats_and_no_labels(spark, documents, prose):
    rows = [(1, None), (2, ""), (3, "idiot"), (3, "idiot"), (None, "m0ron"), (4, prose(1, 20_000))]
    df = documents(rows)
    none = spark.createDataFrame([], LABELS)
    scorer = t.train(df, "doc_id", "text", none, "doc_id", "toxic")
    got = t.score(df, "doc_id", "text", scorer).collect()
    assert len(got) == 6 and all(0 <= r.score < 1e-9 and r.predicted == 0 for r in got)
    odd = spark.createDataFrame([(None, 1, "x"), (3, None, "x"), (2, 1, "x"), (2, 0, "x")], LABELS)
    scorer = t.train(df, "doc_id", "text", odd, "doc_id", "toxic")
    assert all(0 <= r.score <= 1 for r in t.score(df, "doc_id", "text", scorer).collect())
    empty = documents([])
    scorer = t.train(empty, "doc_id", "text", none, "doc_id", "toxic")
    assert t.score(empty, "doc_id", "text", scorer).collect() == []
