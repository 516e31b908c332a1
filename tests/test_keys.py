from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from retail_strata.operators import (
    KeyedBatches,
    advance_mark,
    assign_surrogate_keys,
    high_water_marks,
)
from tests.helpers import rows


def test_ids_continue_from_the_mark_in_order(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("n")).repartition(8)
    keyed = assign_surrogate_keys(df, ["n"], last_id=10000)
    assert keyed.columns == ["id", "n"]
    assert rows(keyed) == {(10001 + n, n): 1 for n in range(1000)}


def test_ties_and_copies_get_contiguous_ids_from_many_tasks(spark, conf):
    conf(adaptive__coalescePartitions__enabled="false")
    # Two thirds of the rows are one identical row.
    df = spark.range(0, 90_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(-1).alias("n")
    )
    keyed = assign_surrogate_keys(df, ["n"], last_id=0, key="key")
    copies, total = 60_000, 90_000
    assert keyed.filter("n = -1").agg(F.min("key"), F.max("key")).first() == (1, copies)
    assert keyed.select("key").distinct().count() == total
    assert keyed.agg(F.min("key"), F.max("key")).first() == (1, total)
    holding = [f for f in keyed.inputFiles() if spark.read.parquet(f).filter("n = -1").count()]
    assert len(holding) > 1


def test_ids_do_not_change_when_read_again(spark):
    df = spark.range(5000).select((F.col("id") % 5).alias("n"), F.rand(1).alias("x")).repartition(4)
    keyed = assign_surrogate_keys(df, ["n"])
    assert rows(keyed) == rows(keyed)


def test_descending_and_compound_order(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3)], "k string, n int")
    keyed = assign_surrogate_keys(df, [F.col("k").desc(), F.col("n")], last_id=5)
    assert rows(keyed) == {(6, "b", 2): 1, (7, "a", 1): 1, (8, "a", 3): 1}


def test_an_empty_batch(spark):
    keyed = assign_surrogate_keys(spark.range(0).toDF("n"), ["n"])
    assert keyed.count() == 0
    marks = advance_mark(high_water_marks(spark), "orders", keyed)
    assert rows(marks)[("orders", 10000)] == 1


def test_marks_move_by_the_batch_size(spark):
    marks = high_water_marks(spark)
    assert rows(marks) == {
        (entity, 10000): 1 for entity in ("customers", "products", "orders", "order_items")
    }
    for size, last in [(500, 10500), (20, 10520)]:
        (start,) = marks.filter("entity = 'orders'").select("last_id").first()
        keyed = assign_surrogate_keys(spark.range(size).toDF("n"), ["n"], last_id=start)
        marks = advance_mark(marks, "orders", keyed)
        assert rows(marks)[("orders", last)] == 1
    saved = marks.filter("entity = 'orders'")
    assert rows(high_water_marks(spark, saved))[("orders", 10520)] == 1
    assert rows(high_water_marks(spark, saved))[("products", 10000)] == 1


def test_a_batch_that_comes_again_keeps_its_ids(spark, tmp_path):
    batches = KeyedBatches(spark, str(tmp_path), "orders")
    assert batches.rows() is None and batches.marks().count() == 0
    first = batches.add("a", spark.range(5).toDF("n"), ["n"])
    assert rows(first) == {(10001 + n, n): 1 for n in range(5)}
    assert rows(batches.add("b", spark.range(3).toDF("n"), [F.col("n").desc()])) == {
        (10006, 2): 1,
        (10007, 1): 1,
        (10008, 0): 1,
    }
    assert rows(batches.add("a", spark.range(50).toDF("n"), ["n"])) == rows(first)
    assert batches.add("none", spark.range(0).toDF("n"), ["n"]).count() == 0
    assert rows(KeyedBatches(spark, str(tmp_path), "orders").marks()) == {("orders", 10008): 1}
    assert rows(high_water_marks(spark, batches.marks()))[("orders", 10008)] == 1
    ids = batches.rows().select("id")
    assert rows(ids) == {(10001 + k,): 1 for k in range(8)}
    assert KeyedBatches(spark, str(tmp_path), "products").add("a", spark.range(1).toDF("n"), ["n"]).first() == (10001, 0)


def test_a_batch_that_breaks_off_leaves_no_mark(spark, tmp_path):
    batches = KeyedBatches(spark, str(tmp_path), "orders", key="key")
    batches.add("a", spark.range(4), ["id"])
    broken = spark.range(100).select(
        F.when(F.col("id") == 99, F.raise_error(F.lit("boom")).cast("bigint")).otherwise(F.col("id")).alias("id")
    )
    with pytest.raises(Exception, match="boom"):
        batches.add("b", broken, ["id"])
    assert rows(batches.marks()) == {("orders", 10004): 1}
    again = batches.add("b", spark.range(2), ["id"])
    assert rows(again) == {(10005, 0): 1, (10006, 1): 1}
    assert batches.rows().count() == 6


def test_a_batch_without_its_commit_is_not_there(spark, tmp_path, monkeypatch):
    """The rows are written, and the attempt breaks off before its commit."""
    batches = KeyedBatches(spark, str(tmp_path), "orders")
    batches.add("a", spark.range(4).toDF("n"), ["n"])
    with monkeypatch.context() as patch:
        patch.setattr("retail_strata.operators.keys._COMMITS", "no schema at all")
        with pytest.raises(Exception):  # noqa: B017
            batches.add("b", spark.range(9).toDF("n"), ["n"])
    assert batches.rows().count() == 4
    assert batches.add("b", spark.range(1).toDF("n"), ["n"]).first() == (10005, 0)
