"""Totals by deltas against totals counted anew."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from retail_strata.llm.token_rollup import CHANGES, TokenRollup


def totals(rollup):
    return sorted((tuple(r) for r in rollup.totals().collect()), key=str)


def expected(batches):
    docs: dict = {}
    for batch in batches:
        order = sorted(batch, key=lambda c: (c[1], c[0] == "delete", c[6] or 0))
        for op, _, doc, source, lang, tokenizer, n in order:
            docs.pop((doc, tokenizer), None)
            if op != "delete":
                docs[doc, tokenizer] = (source, lang, tokenizer, n or 0)
    counts: Counter = Counter()
    tokens: Counter = Counter()
    for source, lang, tokenizer, n in docs.values():
        counts[source, lang, tokenizer] += 1
        tokens[source, lang, tokenizer] += n
    return sorted(((*g, counts[g], tokens[g]) for g in counts), key=str)


def random_batches(seed):
    rng = random.Random(seed)
    return [
        [
            (rng.choice(["insert", "insert", "revise", "delete"]), k, rng.choice([None, *range(30)]),
             rng.choice(["hot", "hot", "b", None]), rng.choice(["en", None]), rng.choice(["v1", "v2"]),
             rng.choice([None, 0, 7, 100]))
            for k in range(40)
        ]
        for _ in range(4)
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_deltas_add_up(spark, tmp_path, seed):
    rollup, batches = TokenRollup(spark, str(tmp_path / "r")), random_batches(seed)
    assert totals(rollup) == []
    for k, batch in enumerate(batches):
        changes = spark.createDataFrame(batch, CHANGES).selectExpr("*", "1 as n", "'x' as c")
        assert rollup.apply(f"b{k}", changes)
        assert totals(rollup) == expected(batches[: k + 1])
        assert not rollup.apply(f"b{k}", changes)
        assert totals(rollup) == expected(batches[: k + 1])


def test_an_attempt_that_breaks_off_is_never_read(spark, tmp_path):
    root = str(tmp_path / "r")
    rollup, (first, second, *_) = TokenRollup(spark, root), random_batches(3)
    rollup.apply("a", spark.createDataFrame(first, CHANGES))
    broken = spark.createDataFrame(second, CHANGES).selectExpr(
        "*", "assert_true(false) as never"
    )
    with pytest.raises(Exception):  # noqa: B017
        rollup.apply("b", broken.withColumnsRenamed({"seq": "old"}).selectExpr("*", "if(never is null, old, 0L) as seq"))
    assert totals(rollup) == expected([first])
    assert rollup.apply("b", spark.createDataFrame(second, CHANGES))
    assert totals(rollup) == expected([first, second])


def test_what_a_batch_reads_does_not_grow_with_the_batches(spark, tmp_path, monkeypatch):
    rollup = TokenRollup(spark, str(tmp_path / "r"), parts=4, deltas=3)
    rng, batches, read = random.Random(5), [], []
    ledger = TokenRollup._ledger

    def watched(self, paths):
        if paths:
            read.append(len(ledger(self, paths).inputFiles()))
        return ledger(self, paths)

    monkeypatch.setattr(TokenRollup, "_ledger", watched)
    for k in range(20):
        batches.append(
            [(rng.choice(["insert", "delete"]), i, rng.randrange(60), "a", rng.choice("xy"), "v1", i) for i in range(6)]
        )
        # A later reader settles no number of parts of its own.
        TokenRollup(spark, str(tmp_path / "r"), 4 + k, 3).apply(f"b{k}", spark.createDataFrame(batches[-1], CHANGES))
        assert all(len(rollup.part_files(p)) <= 4 for p in range(4))
    assert max(read) <= 4 * (3 + 1 + 1)  # a base, three deltas, and the batch's own
    assert any("/base/" in f for f in rollup.part_files(0))
    assert totals(rollup) == expected(batches)


def test_a_batch_reads_the_parts_of_its_own_documents(spark, tmp_path, monkeypatch):
    rollup = TokenRollup(spark, str(tmp_path / "r"), parts=16)
    rollup.apply("all", spark.createDataFrame([("insert", 0, k, "a", "x", "v", 1) for k in range(200)], CHANGES))
    read = []
    ledger = TokenRollup._ledger
    monkeypatch.setattr(TokenRollup, "_ledger", lambda self, paths: read.append(paths) or ledger(self, paths))
    rollup.apply("one", spark.createDataFrame([("delete", 0, 7, "a", "x", "v", 1)], CHANGES))
    assert [len(paths) for paths in read] == [1, 1]  # the document's part, then what the batch wrote
    assert totals(rollup) == [("a", "x", "v", 199, 199)]


def test_a_commit_that_breaks_off_takes_no_effect(spark, tmp_path):
    root = tmp_path / "r"
    rollup, (first, second, *_) = TokenRollup(spark, str(root)), random_batches(4)
    rollup.apply("a", spark.createDataFrame(first, CHANGES))
    rollup.apply("b", spark.createDataFrame(second, CHANGES))
    (root / "commits" / f"{1:09d}" / "_SUCCESS").unlink()
    assert totals(rollup) == expected([first])
    assert rollup.apply("b", spark.createDataFrame(second, CHANGES))
    assert totals(rollup) == expected([first, second])


def test_empty_batch(spark, tmp_path):
    rollup = TokenRollup(spark, str(tmp_path / "r"))
    assert rollup.apply("a", spark.createDataFrame([], CHANGES))
    assert totals(rollup) == []
