"""Spaced seeds against a search of all alignments."""

from __future__ import annotations

import random
import re
from itertools import combinations

from retail_strata.llm import decontaminate as d

BENCH = "item_id bigint, text string, doc_id string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_masks_survive_any_two_substitutions():
    for wrong in combinations(range(d.WINDOW), d.WINDOW - d.AGREE):
        assert any(
            not {at + p for p in mask} & set(wrong)
            for mask in d.MASKS
            for at in range(d.WINDOW - mask[-1])
        )


def test_masks_of_short_items_survive_the_substitutions_they_allow():
    for n in range(1, d.WINDOW):
        masks = [mask for length, mask in d.all_masks() if length == n]
        assert all(mask[-1] < n for mask in masks)
        for wrong in combinations(range(n), n - d.needed(n)):
            assert any(not set(mask) & set(wrong) for mask in masks)


def test_items_of_every_length(spark, documents, prose):
    rng = random.Random(8)
    items, rows = [], []
    for n in range(1, 16):
        for k in range(2):
            item = [f"w{n}x{k}y{i}" for i in range(n)]
            items.append((100 * n + k, " ".join(item)))
            for wrong in range(4):
                got = list(item)
                for at in rng.sample(range(n), min(wrong, n)):
                    got[at] = "other"
                first, last = prose(n + k, 6), prose(n + wrong, 6)
                around = [("", ""), (first, ""), ("", last), (first, last)][(n + k + wrong) % 4]
                rows.append((1000 * n + 10 * k + wrong, " ".join([around[0], *got, around[1]])))
    benchmark = spark.createDataFrame([(*i, "x") for i in items], BENCH)
    assert run(documents(rows), benchmark) == expected(rows, items)
    sizes = {
        (r.item_id // 100, r.item_words)
        for r in d.find_leaks(documents(rows), "doc_id", "text", benchmark, "item_id", "text").collect()
    }
    assert sizes == {(n, n) for n in range(1, 16)}


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def expected(rows, items):
    out = []
    for doc, text in rows:
        w = words(text)
        for item, other in items:
            x = words(other)
            width = min(d.WINDOW, len(x))
            need = 11 if width == 13 else width - 1 if width >= 8 else width
            if x and any(
                sum(w[i + k] == x[j + k] for k in range(width)) >= need
                for i in range(len(w) - width + 1)
                for j in range(len(x) - width + 1)
            ):
                out.append((doc, item))
    return sorted(out, key=str)


def run(df, benchmark):
    found = d.find_leaks(df, "doc_id", "text", benchmark, "item_id", "text")
    return sorted(((r.doc_id, r.item_id) for r in found.collect()), key=str)


def test_leaks_as_by_all_alignments(spark, documents, prose):
    long = [prose(k, 30) for k in range(4)]
    nine, short = "one two three four five six seven eight nine", "too short"
    items = [(k, t) for k, t in enumerate(long)]
    items += [(10, nine), (11, short), (12, None), (13, ""), (14, long[0].upper()), (0, long[0])]
    rng = random.Random(3)

    def swapped(text, every):
        return " ".join(
            "swap" if k % every == 2 else w for k, w in enumerate(text.split())
        )

    rows = [(1, None), (2, ""), (3, long[0]), (3, long[0]), (4, prose(9, 50) + " " + long[1])]
    rows += [(5, swapped(long[2], 7)), (6, swapped(long[2], 3)), (7, "x " + nine + " y"), (8, short)]
    rows += [(None, long[3] + "\n" + long[1]), (9, prose(10, 5000) + " " + long[3] + " " + long[3])]
    rows += [(20 + k, " ".join(rng.sample(long[0].split(), 25))) for k in range(5)]
    benchmark = spark.createDataFrame([(*i, "x") for i in items], BENCH)
    df = documents(rows, clash=True)
    assert run(df, benchmark) == expected(rows, items)
    leaks = d.find_leaks(df, "doc_id", "text", benchmark, "item_id", "text")
    kept = d.drop_leaked(df, "doc_id", leaks)
    assert kept.columns == df.columns
    leaked = {doc for doc, _ in expected(rows, [i for i in items if i[0] != 11])}
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(
        str(doc) for doc, _ in rows if doc not in leaked
    )


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], BENCH)
    some = spark.createDataFrame([(1, "a b c d e f g h i j k l m n", "x")], BENCH)
    assert run(documents([(1, "a b c")]), none) == []
    assert run(documents([]), some) == []
