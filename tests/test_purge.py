from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from retail_strata import storage
from retail_strata.operators import (
    purge_counts,
    purge_layer,
    purge_partition,
    purge_published,
    purge_rows,
)
from retail_strata.sinks import publish, write_layer
from retail_strata.sources import read_layer, read_published
from tests.helpers import rows


@pytest.fixture
def orders(spark):
    data = [("1", "2025-02-07"), ("2", "2025-02-08"), ("3", "2025-02-07"), ("4", None)]
    return spark.createDataFrame(data, "order_id string, order_date string")


SEVENTH = "2025-02-07"


def test_a_null_predicate_keeps_the_row(orders):
    gone = F.col("order_date") == SEVENTH
    assert rows(purge_rows(orders, gone)) == {("2", "2025-02-08"): 1, ("4", None): 1}
    assert purge_counts(orders, gone).first() == (4, 2)


def test_purge_is_a_dry_run_unless_told(spark, orders, tmp_path):
    path = str(tmp_path / "orders")
    publish(orders, path, "v1")
    gone = F.col("order_date") == SEVENTH
    assert purge_published(spark, path, gone, "v2") == 2
    assert read_published(spark, path).count() == 4
    assert purge_published(spark, path, gone, "v2", dry_run=False) == 2
    assert rows(read_published(spark, path)) == {("2", "2025-02-08"): 1, ("4", None): 1}
    assert read_published(spark, path, "v1").count() == 4


def test_purging_everything_leaves_an_empty_table(spark, orders, tmp_path):
    path = str(tmp_path / "orders")
    publish(orders, path, "v1")
    assert purge_published(spark, path, F.lit(True), "v2", dry_run=False) == 4
    assert read_published(spark, path).count() == 0


def test_purging_nothing_publishes_nothing(spark, orders, tmp_path):
    path = str(tmp_path / "orders")
    publish(orders, path, "v1")
    assert purge_published(spark, path, F.lit(False), "v2", dry_run=False) == 0
    assert spark.read.parquet(f"{path}/commits").count() == 1


def test_purging_a_date_leaves_the_others(spark, orders, tmp_path):
    root = str(tmp_path)
    for day in ("2025-02-07", "2025-02-08"):
        write_layer(orders, root, "refined_orders", day)
    assert purge_partition(spark, root, "refined_orders", SEVENTH) == 4
    assert read_layer(spark, root, "refined_orders", SEVENTH).count() == 4
    assert purge_partition(spark, root, "refined_orders", SEVENTH, dry_run=False) == 4
    emptied = read_layer(spark, root, "refined_orders", SEVENTH)
    assert emptied.columns == orders.columns and emptied.count() == 0
    assert read_layer(spark, root, "refined_orders", "2025-02-08").count() == 4


def files_of(folder):
    return {p.name: p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}


def test_a_date_with_runs_is_counted_and_emptied_whole(spark, tmp_path):
    root = str(tmp_path)
    for run_id, n in (("r1", 5), ("r2", 7), ("r3", 0)):
        write_layer(spark.range(n), root, "t", SEVENTH, run_id)
    assert purge_partition(spark, root, "t", SEVENTH) == 12
    assert purge_partition(spark, root, "t", SEVENTH, dry_run=False) == 12
    for run_id in ("r1", "r2", "r3"):
        emptied = read_layer(spark, root, "t", SEVENTH, run_id)
        assert emptied.columns == ["id"] and emptied.count() == 0
    assert purge_partition(spark, root, "t", SEVENTH, dry_run=False) == 0


def test_purging_a_layer_rewrites_only_what_holds_a_match(spark, tmp_path):
    root, table = str(tmp_path / "a b"), tmp_path / "a b" / "t"
    write_layer(spark.range(0, 10), root, "t", "2025-02-06")
    write_layer(spark.range(10, 20), root, "t", "2025-02-07")
    for run_id, first in (("r 1", 10), ("r2", 40)):
        write_layer(spark.range(first, first + 5).toDF("id"), root, "t", "2025-02-08", run_id)
    before = {d.name: files_of(d) for d in table.iterdir() if d.is_dir()}
    gone = F.col("id").between(8, 12) & (F.col("ingest_date") > F.lit("2025-02-06"))
    found = purge_layer(spark, root, "t", gone)
    assert {k.split("/t/")[1]: n for k, n in found.items()} == {
        "ingest_date=2025-02-07": 3,
        "ingest_date=2025-02-08/run_id=r 1": 3,
    }
    assert {d.name: files_of(d) for d in table.iterdir() if d.is_dir()} == before
    assert purge_layer(spark, root, "t", gone, dry_run=False) == found
    after = {d.name: files_of(d) for d in table.iterdir() if d.is_dir()}
    assert set(after) == set(before) and after["ingest_date=2025-02-06"] == before["ingest_date=2025-02-06"]
    assert files_of(table / "ingest_date=2025-02-08" / "run_id=r2").items() <= before["ingest_date=2025-02-08"].items()
    assert rows(read_layer(spark, root, "t", "2025-02-07")) == {(k,): 1 for k in range(13, 20)}
    assert rows(read_layer(spark, root, "t", "2025-02-08", "r 1")) == {(13,): 1, (14,): 1}
    assert read_layer(spark, root, "t", "2025-02-08", "r2").count() == 5


def test_purging_a_whole_layer_leaves_empty_dates(spark, tmp_path):
    root = str(tmp_path)
    for day in ("2025-02-07", "2025-02-08"):
        write_layer(spark.range(3), root, "t", day)
    assert sum(purge_layer(spark, root, "t", dry_run=False).values()) == 6
    for day in ("2025-02-07", "2025-02-08"):
        assert read_layer(spark, root, "t", day).columns == ["id"]
        assert read_layer(spark, root, "t", day).count() == 0
    assert purge_layer(spark, root, "t", dry_run=False) == {}
    assert purge_layer(spark, root, "no_such_table", dry_run=False) == {}


@pytest.mark.parametrize("moves", [0, 1])
def test_a_purge_that_breaks_off_is_finished_by_the_next(spark, tmp_path, monkeypatch, moves):
    root, done = str(tmp_path), []
    write_layer(spark.range(10).repartition(3), root, "t", "2025-02-07")
    write_layer(spark.range(10), root, "t", "2025-02-08", "r1")
    move = storage.move

    def breaking(*args):
        if len(done) == moves:
            raise OSError("lost")
        done.append(args)
        move(*args)

    with monkeypatch.context() as patch:
        patch.setattr(storage, "move", breaking)
        with pytest.raises(OSError, match="lost"):
            purge_layer(spark, root, "t", F.col("id") < 4, dry_run=False)
    assert purge_layer(spark, root, "t", F.col("id") < 4, dry_run=False) == {}
    for day in ("2025-02-07", "2025-02-08"):
        assert rows(read_layer(spark, root, "t", day)) == {(k,): 1 for k in range(4, 10)}
    assert not [d for d in (tmp_path / "t").iterdir() if d.name.startswith("_purge")]
