"""Helpers that several operators share."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from retail_strata.llm.common import U64, HashFilter, lean


def test_lean_tasks_give_the_same_rows_and_errors():
    assert list(lean(lambda batches: (2 * b for b in batches))(iter([1, 2]))) == [2, 4]
    assert list(lean(lambda batches: iter(()))(iter([1]))) == []

    def broken(batches):
        yield from batches
        raise ValueError("told")

    rows = lean(broken)(iter([1]))
    assert next(rows) == 1
    with pytest.raises(ValueError, match="told"):
        next(rows)


def test_lean_tasks_can_be_left_early():
    rows = lean(lambda batches: batches)(iter(range(3)))
    assert next(rows) == 0
    rows.close()


def test_a_hash_filter_has_two_bits_for_each_hash_and_no_other(spark):
    hashes = spark.range(3000).select(F.xxhash64("id").alias("h")).union(spark.sql("select cast(null as bigint)"))
    made = HashFilter.of(hashes.union(hashes), "h", spread=8)
    values = np.array([r.h for r in hashes.where("h is not null").collect()]).view(U64)
    expected = np.zeros(1 << made.bits, dtype=bool)
    expected[values >> U64(64 - made.bits)] = True
    expected[(values >> U64(64 - 2 * made.bits)) & U64((1 << made.bits) - 1)] = True
    assert (np.unpackbits(made.words.view(np.uint8), bitorder="little") == expected).all()
    assert made.has(values).all()
    empty = HashFilter.of(spark.range(0).select(F.xxhash64("id").alias("h")), "h")
    assert not empty.has(values).any()


def test_a_hash_filter_comes_to_the_driver_in_few_rows(spark, monkeypatch):
    frame, rows = type(spark.range(0)), []

    def counted(name):
        whole = getattr(frame, name)

        def call(self, *args):
            found = whole(self, *args)
            rows.append(len(found))
            return found

        return call

    for name in ("collect", "toPandas"):
        monkeypatch.setattr(frame, name, counted(name))
    made = HashFilter.of(spark.range(20_000).select(F.xxhash64("id").alias("h")), "h")
    assert sum(rows) <= max(1, made.words.nbytes >> 12)
