from __future__ import annotations

import datetime as dt
import glob
import time

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from retail_strata import storage
from retail_strata.session import SHUFFLE_CLEANUP, brief_shuffles, scratch_root
from retail_strata.sinks import preview, publish, write_csv, write_dated, write_fanout, write_layer
from retail_strata.sources import read_csv, read_layer, read_partition, read_published
from tests.helpers import rows


def parts(path, suffix="csv"):
    return glob.glob(f"{path}/part-*.{suffix}")


def test_small_frames_compact_to_one_file_with_a_header(spark, tmp_path):
    path = str(tmp_path / "out")
    write_csv(spark.range(0, 5000, 1, 8).selectExpr("id", "id * 2 AS twice"), path, compact=True)
    (part,) = parts(path)
    assert open(part).readline() == "id,twice\n"
    assert read_csv(spark, path).count() == 5000


def test_large_frames_compact_to_several_files(spark, tmp_path, conf):
    conf(adaptive__advisoryPartitionSizeInBytes="64k")
    path = str(tmp_path / "out")
    df = spark.range(0, 400_000, 1, 8).withColumn("x", F.xxhash64("id"))
    write_csv(df, path, compact=True)
    assert len(parts(path)) > 1
    assert read_csv(spark, path).count() == 400_000


@pytest.mark.parametrize("compact", [False, True])
def test_an_empty_frame_is_a_header(spark, tmp_path, compact):
    path = str(tmp_path / "out")
    write_csv(spark.range(0).selectExpr("id", "'x' AS name"), path, compact=compact)
    assert [open(part).read() for part in parts(path)] == ["id,name\n"]
    empty = read_csv(spark, path)
    assert empty.columns == ["id", "name"] and empty.count() == 0


def test_csv_output_is_overwritten(spark, tmp_path):
    path = str(tmp_path / "out")
    write_csv(spark.range(10), path)
    write_csv(spark.range(3), path)
    assert read_csv(spark, path).count() == 3


def test_csv_round_trip_loses_empty_strings_only(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([("a, b", 'say "x"'), ("", None), ("é", "1")], "a string, b string")
    write_csv(df, path)
    assert rows(read_csv(spark, path)) == {("a, b", 'say "x"'): 1, (None, None): 1, ("é", "1"): 1}


def test_a_rerun_replaces_its_date_only_even_when_empty(spark, tmp_path):
    root = str(tmp_path)
    write_layer(spark.range(5), root, "t", "2025-02-07")
    write_layer(spark.range(6), root, "t", "2025-02-08")
    write_layer(spark.range(0), root, "t", dt.date(2025, 2, 7))
    assert read_layer(spark, root, "t", "2025-02-07").count() == 0
    assert read_layer(spark, root, "t", "2025-02-08").count() == 6


def test_runs_accumulate_under_run_ids(spark, tmp_path):
    root = str(tmp_path)
    write_layer(spark.range(5), root, "t", "2025-02-07", run_id="20250207_090000")
    write_layer(spark.range(7), root, "t", "2025-02-07", run_id="20250207_100000")
    assert read_layer(spark, root, "t", "2025-02-07", run_id="20250207_090000").count() == 5
    newest = read_layer(spark, root, "t", "2025-02-07")
    assert newest.columns == ["id"] and newest.count() == 7


def test_dated_write_replaces_the_dates_it_holds(spark, tmp_path):
    path = f"{tmp_path}/t"
    day = F.make_date(F.lit(2025), F.lit(2), F.col("id").cast("int") % 3 + 1)
    write_dated(spark.range(30).withColumn("ingest_date", day), path, "ingest_date")
    again = spark.range(2).withColumn("ingest_date", F.lit(dt.date(2025, 2, 2)))
    write_dated(again, path, "ingest_date")
    counts = {d: read_partition(spark, str(tmp_path), "t", f"2025-02-0{d}").count() for d in (1, 2, 3)}
    assert counts == {1: 10, 2: 2, 3: 10}


def test_a_failed_version_is_never_seen(spark, tmp_path):
    path = str(tmp_path / "t")
    publish(spark.range(3), path, "v1")
    broken = spark.range(100).select(F.raise_error(F.lit("boom")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="boom"):
        publish(broken, path, "v2")
    assert read_published(spark, path).count() == 3
    with pytest.raises(AnalysisException):
        publish(spark.range(9), path, "v1")
    assert read_published(spark, path).count() == 3


def test_a_version_may_be_built_from_the_one_before(spark, tmp_path):
    path = str(tmp_path / "t")
    publish(spark.range(10), path, "v1")
    publish(read_published(spark, path).filter("id > 6"), path, "v2")
    assert read_published(spark, path).count() == 3


def test_fanout_writes_every_output_and_runs_the_plan_once(spark, tmp_path):
    runs = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            runs.add(batch.num_rows)
            yield batch

    df = spark.range(50).mapInArrow(count, "id bigint")
    paths = [f"{tmp_path}/gold_{name}" for name in ("customers", "orders", "products")]
    write_fanout(df, paths)
    assert runs.value == 50
    assert [read_csv(spark, path).count() for path in paths] == [50, 50, 50]


def test_fanout_outputs_are_compressed_unless_told_otherwise(spark, tmp_path):
    df = spark.createDataFrame([("a, b", None), ("", "x\ny")], "name string, note string")
    packed, plain = f"{tmp_path}/packed", f"{tmp_path}/plain"
    write_fanout(df, [packed])
    write_fanout(df, [plain], compression="none")
    assert parts(packed, "csv.gz") and not parts(packed)
    assert parts(plain) and not parts(plain, "csv.gz")
    assert rows(read_csv(spark, packed, multiLine="true")) == rows(read_csv(spark, plain, multiLine="true"))


def shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {name for name in blocks.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in name}


def staged(spark):
    return {e.name for e in storage.entries(spark, scratch_root(spark)) or () if e.name.startswith("fanout-")}


def test_fanout_leaves_no_scratch_behind(spark, tmp_path):
    spark.range(1).write.parquet(f"{scratch_root(spark)}/there")
    before = staged(spark), shuffle_files(spark)
    write_fanout(spark.range(1000).repartition(5, "id"), [f"{tmp_path}/one", f"{tmp_path}/two"])
    assert staged(spark) == before[0]
    until = time.time() + 20  # executors delete on their own time
    while shuffle_files(spark) - before[1] and time.time() < until:
        time.sleep(0.1)
    assert not shuffle_files(spark) - before[1]
    assert [read_csv(spark, f"{tmp_path}/{name}").count() for name in ("one", "two")] == [1000, 1000]


def test_brief_shuffles_restore_the_setting(spark):
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    with pytest.raises(ValueError, match="told"), brief_shuffles(spark):
        assert spark.conf.get(SHUFFLE_CLEANUP) == "true"
        raise ValueError("told")
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == before


def test_layers_and_versions_are_written_with_zstd(spark, tmp_path):
    publish(spark.range(9), f"{tmp_path}/published", "v1")
    write_layer(spark.range(9), str(tmp_path), "t", "2025-02-07")
    write_layer(spark.range(9), str(tmp_path), "u", "2025-02-07", "r1")
    folders = ["published/data/v1", "t/ingest_date=2025-02-07", "u/ingest_date=2025-02-07/run_id=r1"]
    assert all(parts(f"{tmp_path}/{folder}", "zstd.parquet") for folder in folders)


def test_preview(spark):
    assert preview(spark.range(100)).count() == 5
    assert preview(spark.range(3)).count() == 3
