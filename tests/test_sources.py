from __future__ import annotations

import gzip
import os

import pytest

from retail_strata.schemas import layer_table
from retail_strata import storage
from retail_strata.sinks import publish, write_csv, write_layer
from retail_strata.sources import (
    MissingInputError,
    latest_entry,
    latest_snapshot,
    read_csv,
    read_entities,
    read_entity,
    read_latest,
    read_layer,
    read_partition,
    read_published,
)
from tests.helpers import rows


def put(folder, name, text, modified):
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / name
    path.write_text(text)
    os.utime(path, (modified, modified))
    return path


def test_csv_columns_are_strings_and_empty_is_null(spark, tmp_path):
    put(tmp_path, "a.csv", 'id,price,note\n1,2.50,\n2,,"x, y"\n', 1000)
    df = read_csv(spark, str(tmp_path))
    assert [field.dataType.simpleString() for field in df.schema] == ["string"] * 3
    assert rows(df) == {("1", "2.50", None): 1, ("2", None, "x, y"): 1}


def test_typed_csv_binds_by_name(spark, tmp_path, ansi):
    put(
        tmp_path,
        "orders.csv",
        "order_id,order_date,customer_id,total_amount,ingest_timestamp\n"
        "1,2025-02-07,9,12.5,now\n2,2025-02-07,8,abc,now\n",
        1000,
    )
    df = read_entity(spark, str(tmp_path), "orders")
    assert df.dtypes == [
        ("order_id", "string"),
        ("customer_id", "string"),
        ("order_date", "string"),
        ("total_amount", "double"),
    ]
    assert rows(df) == {("1", "9", "2025-02-07", 12.5): 1, ("2", "8", "2025-02-07", None): 1}


def test_typed_csv_fills_absent_columns_with_null(spark, tmp_path):
    put(tmp_path, "items.csv", "order_item_id,name,value\n1,Item 1,7\n", 1000)
    assert rows(read_entity(spark, str(tmp_path), "order_items")) == {
        ("1", None, None, None, None): 1
    }


@pytest.mark.parametrize("as_list", [True, False])
def test_files_with_other_headers_bind_by_name(spark, tmp_path, as_list):
    put(tmp_path / "a b", "1.csv", "order_id,customer_id,order_date,total_amount\no1,c1,2025-01-01,1.5\n", 1000)
    put(tmp_path / "c", "2.csv", "order_id,order_date,customer_id,total_amount,order_status\no2,2025-01-02,c2,2,X\n", 1000)
    put(tmp_path / "c", "3.csv", "", 1000)
    put(tmp_path / "c", "4.csv", "total_amount,order_id\n4,o4\n", 1000)
    paths = [f"{tmp_path}/a b", f"{tmp_path}/c"] if as_list else f"{tmp_path}/*"
    assert rows(read_entity(spark, paths, "orders")) == {
        ("o1", "c1", "2025-01-01", 1.5): 1,
        ("o2", "c2", "2025-01-02", 2.0): 1,
        ("o4", None, None, 4.0): 1,
    }
    found = read_csv(spark, paths)
    assert set(found.columns) == {"order_id", "customer_id", "order_date", "total_amount", "order_status"}
    assert rows(found.select("order_id", "order_status")) == {("o1", None): 1, ("o2", "X"): 1, ("o4", None): 1}


def test_the_newest_run_is_read_by_default(spark, tmp_path):
    for run_id, n in (("run_1", 3), ("run_2", 5)):
        write_layer(spark.range(n), str(tmp_path), "t", "2025-02-07", run_id)
        path = tmp_path / "t" / "ingest_date=2025-02-07" / f"run_id={run_id}"
        for part in path.iterdir():
            os.utime(part, (1000 * n, 1000 * n))
    newest = read_layer(spark, str(tmp_path), "t", "2025-02-07")
    assert newest.columns == ["id"] and newest.count() == 5
    assert read_layer(spark, str(tmp_path), "t", "2025-02-07", "run_1").count() == 3


def test_a_null_folder_is_a_folder(spark):
    df = spark.createDataFrame(
        [(None, "f1", 5), (None, None, 9), ("d", None, 1), ("d", None, 1)],
        "folder string, file string, modified int",
    )
    assert rows(latest_snapshot(df, ["folder"], "file", "modified")) == {
        (None, None, 9): 1,
        ("d", None, 1): 2,
    }


def test_the_newest_file_wins_whatever_its_name(spark, tmp_path):
    folder = tmp_path / "raw_orders" / "20250207"
    put(folder, "z_old.csv", "id\nold\n", 1000)
    put(folder, "a_new.csv", "id\nnew\n", 2000)
    put(folder, "_SUCCESS", "", 3000)
    put(folder, "notes.txt", "id\nnote\n", 3000)
    put(folder / "_temporary" / "x.csv", "part.csv", "id\nuncommitted\n", 4000)
    put(tmp_path / "raw_orders" / "20250207_temp", "b.csv", "id\nother\n", 5000)
    assert rows(read_latest(spark, str(folder))) == {("new",): 1}
    assert latest_entry(spark, f"file://{folder}/").endswith("/a_new.csv")


def test_equal_times_are_settled_by_name(spark, tmp_path):
    put(tmp_path, "a.csv", "id\na\n", 1000)
    put(tmp_path, "b.csv", "id\nb\n", 1000)
    assert latest_entry(spark, str(tmp_path)).endswith("/b.csv")


def test_a_written_folder_counts_as_one_file(spark, tmp_path):
    put(tmp_path, "first.csv", "id\nfirst\n", 1000)
    write_csv(spark.range(100).selectExpr("id", "'second' AS s"), f"{tmp_path}/second.csv")
    assert read_latest(spark, str(tmp_path)).count() == 100
    put(tmp_path / "unrelated", "part.csv", "id\nx\n", 4_000_000_000)
    assert latest_entry(spark, str(tmp_path)).endswith("/second.csv")


def test_a_folder_of_compressed_parts_counts_too(spark, tmp_path):
    put(tmp_path, "first.csv", "id\nfirst\n", 1000)
    write_csv(spark.range(100, numPartitions=3), f"{tmp_path}/second.csv", compression="gzip")
    assert latest_entry(spark, str(tmp_path)).endswith("/second.csv")
    assert read_latest(spark, str(tmp_path)).count() == 100


def test_no_input_is_none(spark, tmp_path):
    assert read_latest(spark, str(tmp_path / "absent")) is None
    put(tmp_path / "empty", "notes.txt", "x", 1000)
    assert read_latest(spark, str(tmp_path / "empty")) is None


def test_row_level_snapshot(spark):
    df = spark.createDataFrame(
        [("d1", "f1", 5), ("d1", "f2", 9), ("d1", "f2", 1), ("d2", "f1", 3), ("d2", "f0", 3)],
        "folder string, file string, modified int",
    )
    assert rows(latest_snapshot(df, ["folder"], "file", "modified")) == {
        ("d1", "f2", 9): 1,
        ("d1", "f2", 1): 1,
        ("d2", "f1", 3): 1,
    }


def test_missing_entities_are_skipped_or_fail(spark):
    frame = spark.range(1)

    def read(entity):
        if entity == "c":
            raise MissingInputError(entity)
        return frame if entity == "a" else None

    assert read_entities(read, ["a", "b", "c"]) == {"a": frame}
    with pytest.raises(MissingInputError, match="no input for b, c"):
        read_entities(read, ["a", "b", "c"], on_missing="fail")
    with pytest.raises(ValueError, match="on_missing"):
        read_entities(read, ["a"], on_missing="ignore")


def test_partition_comes_back_with_a_date(spark, tmp_path):
    write_layer(spark.range(2), str(tmp_path), "refined_orders", "2025-02-07")
    write_layer(spark.range(5), str(tmp_path), "refined_orders", "2025-02-08")
    day = read_partition(spark, str(tmp_path), "refined_orders", "2025-02-07")
    assert day.dtypes == [("id", "bigint"), ("ingest_date", "date")]
    assert day.count() == 2
    assert read_layer(spark, str(tmp_path), "refined_orders", "2025-02-08").columns == ["id"]
    with pytest.raises(MissingInputError):
        read_partition(spark, str(tmp_path), "refined_orders", "2025-02-09")


def test_unpublished_table_is_missing(spark, tmp_path):
    with pytest.raises(MissingInputError):
        read_published(spark, str(tmp_path / "t"))


def test_a_version_can_be_named(spark, tmp_path):
    path = str(tmp_path / "t")
    publish(spark.range(1), path, "v1")
    publish(spark.range(2), path, "v2")
    assert read_published(spark, path).count() == 2
    assert read_published(spark, path, "v1").count() == 1


def test_layer_names():
    assert layer_table("raw", "orders") == "raw_orders"
    assert layer_table("bronze", "raw_orders") == "refined_orders"
    assert layer_table("silver", "refined_order_items") == "silver_order_items"
    assert layer_table("gold", "silver_customers") == "gold_customers"


PART = "part-00000-{}-c000.csv"
JOB = "0b1c2d3e-0000-4000-8000-00000000000{}"


def jobs_of(spark, group):
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_planning_a_csv_scan_runs_no_job_and_opens_one_part_of_a_job(spark, tmp_path, monkeypatch):
    write_csv(spark.range(1000).selectExpr("id", "id + 1 as n").repartition(6), f"{tmp_path}/a")
    write_csv(spark.range(9).selectExpr("id + 1 as n", "id").repartition(3), f"{tmp_path}/b")
    opened = []
    first_line = storage.first_line
    monkeypatch.setattr(storage, "first_line", lambda *a: opened.append(a) or first_line(*a))
    spark.sparkContext.setJobGroup("plan-csv", "")
    df = read_csv(spark, [f"{tmp_path}/a", f"{tmp_path}/b"])
    assert jobs_of(spark, "plan-csv") == 0 and len(opened) == 2
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert df.count() == 1009
    assert df.filter("cast(n as bigint) - cast(id as bigint) <> 1").isEmpty()


def test_jobs_with_other_headers_in_one_folder_are_bound_by_name(spark, tmp_path):
    put(tmp_path, PART.format(JOB.format(1)), "a,b\n1,2\n", 1000)
    put(tmp_path, PART.format(JOB.format(2)), "b,c\n3,4\n", 1000)
    put(tmp_path, PART.format(JOB.format(2)).replace("00000-", "00001-", 1), "b,c\n5,6\n", 1000)
    put(tmp_path, "loose.csv", "c,a\n7,8\n", 1000)
    df = read_csv(spark, str(tmp_path)).select("a", "b", "c")
    assert rows(df) == {("1", "2", None): 1, (None, "3", "4"): 1, (None, "5", "6"): 1, ("8", None, "7"): 1}


@pytest.mark.parametrize("header", ["b,a", "a", "a,b,c", "a,x"])
def test_a_part_that_is_not_like_its_job_raises(spark, tmp_path, header):
    put(tmp_path, PART.format(JOB.format(1)), "a,b\n1,2\n", 1000)
    values = ",".join("3" for _ in header.split(","))
    put(tmp_path, PART.format(JOB.format(1)).replace("00000-", "00001-", 1), f"{header}\n{values}\n", 1000)
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(tmp_path)).collect()


def test_odd_headers(spark, tmp_path):
    put(tmp_path / "q", "1.csv", '"a b","c,`d"\n1,2\n', 1000)
    assert read_csv(spark, str(tmp_path / "q")).columns == ["a b", "c,`d"]
    assert rows(read_csv(spark, str(tmp_path / "q"))) == {("1", "2"): 1}
    put(tmp_path / "s", "1.csv", "a;b\n1;2\n", 1000)
    assert rows(read_csv(spark, str(tmp_path / "s"), sep=";")) == {("1", "2"): 1}
    put(tmp_path / "r", "1.csv", "a,a,\n1,2,3\n", 1000)
    assert rows(read_csv(spark, str(tmp_path / "r"))) == {("1", "2", "3"): 1}
    put(tmp_path / "bom", "1.csv", "﻿a,b\n1,2\n", 1000)
    assert read_csv(spark, str(tmp_path / "bom")).columns == ["a", "b"]
    packed = tmp_path / "z"
    packed.mkdir()
    (packed / "1.csv.gz").write_bytes(gzip.compress(b"a,b\n1,2\n"))
    assert rows(read_csv(spark, str(packed))) == {("1", "2"): 1}


def test_a_run_that_was_not_completed_is_not_read(spark, tmp_path):
    root = str(tmp_path)
    write_layer(spark.range(3), root, "t", "2025-02-07", "run_1")
    write_layer(spark.range(9), root, "t", "2025-02-07", "run_2")
    (tmp_path / "t" / "ingest_date=2025-02-07" / "run_id=run_2" / "_SUCCESS").unlink()
    assert read_layer(spark, root, "t", "2025-02-07").count() == 3
    with pytest.raises(MissingInputError, match="run_2"):
        read_layer(spark, root, "t", "2025-02-07", "run_2")
    (tmp_path / "t" / "ingest_date=2025-02-07" / "run_id=run_1" / "_SUCCESS").unlink()
    with pytest.raises(MissingInputError):
        read_layer(spark, root, "t", "2025-02-07")


def test_a_write_without_a_run_id_does_not_delete_runs(spark, tmp_path):
    root = str(tmp_path)
    write_layer(spark.range(2), root, "t", "2025-02-07")
    write_layer(spark.range(3), root, "t", "2025-02-07", "r1")
    with pytest.raises(ValueError, match="holds runs"):
        write_layer(spark.range(1), root, "t", "2025-02-07")
    assert read_layer(spark, root, "t", "2025-02-07").count() == 3
