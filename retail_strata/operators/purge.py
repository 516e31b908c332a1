"""Removal of rows; nothing is removed unless asked for."""

from __future__ import annotations

import datetime as dt
import uuid
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_strata import storage
from retail_strata.sinks.tables import publish
from retail_strata.sources.tables import partition_path, read_published


def purge_rows(df: DataFrame, predicate: Column) -> DataFrame:
    """The rows that stay: those where ``predicate`` is false or NULL."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))


def purge_counts(df: DataFrame, predicate: Column) -> DataFrame:
    """One row ``(total, removed)``; reads only the columns the predicate needs."""
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.coalesce(predicate, F.lit(False))).alias("removed"),
    )


def purge_published(
    spark: SparkSession, path: str, predicate: Column, version: str, dry_run: bool = True
) -> int:
    """Number of rows ``predicate`` removes from the table published at ``path``.

    Unless ``dry_run``, the survivors become the table's new ``version``. Earlier versions stay on
    disk, and an empty set of survivors is published like any other.
    """
    current = read_published(spark, path)
    removed = purge_counts(current, predicate).first()["removed"]
    if not dry_run and removed:
        publish(purge_rows(current, predicate), path, version)
    return removed


def _folders(spark: SparkSession, date: str) -> list[str]:
    """The folders that hold a date's files: one for each run, and its own if files lie in it."""
    lying = storage.entries(spark, date) or []
    runs = [e.path for e in lying if e.name.startswith("run_id=") and not e.is_file]
    own = any(e.is_file and not storage.hidden(e.name) for e in lying)
    return runs + [date] * own


def purge_layer(
    spark: SparkSession,
    root: str,
    table: str,
    predicate: Column | None = None,
    dry_run: bool = True,
    run_date: str | dt.date | None = None,
) -> dict[str, int]:
    """Rows that ``predicate`` (all, if None) removes from a layer table, by folder.

    Folders are dates or runs of dates, of all dates or of ``run_date``; only those that hold a
    matching row are named. Unless ``dry_run``, their survivors are written beside them, all in one
    job, and then take their places folder by folder; an emptied folder keeps its columns. Files of
    all other folders stay as they are. ``predicate`` may use ``ingest_date``. A purge that broke
    off is finished by running it again: a folder is either as before, or purged, or its survivors
    lie complete beside it and are moved in first.
    """
    base = f"{root.rstrip('/')}/{table}"
    dates = [e for e in storage.entries(spark, base) or () if e.name.startswith("ingest_date=")]
    if run_date is not None:
        wanted = partition_path(root, table, run_date).rsplit("/", 1)[1]
        dates = [e for e in dates if e.name == wanted]
    _finish_moves(spark, base)
    folders = [f for e in dates for f in _folders(spark, e.path)]
    if not folders:
        return {}
    df = (
        spark.read.option("recursiveFileLookup", True)
        .option("mergeSchema", True)
        .parquet(*[e.path for e in dates])
    )
    names = df.columns
    file = F.col("_metadata.file_path")
    df = df.withColumn("_folder", F.regexp_replace(file, "/[^/]*$", "")).withColumn(
        "ingest_date", F.regexp_extract("_folder", r"/ingest_date=([0-9-]+)", 1).cast("date")
    )
    gone = F.lit(True) if predicate is None else F.coalesce(predicate, F.lit(False))
    counts = (
        df.withColumn("_gone", gone)
        .groupBy("_folder")
        .agg(F.count_if("_gone").alias("removed"))
        .filter("removed > 0")
    )
    removed = {row["_folder"]: row["removed"] for row in counts.collect()}
    if dry_run or not removed:
        return {unquote(folder): n for folder, n in removed.items()}

    purge = f"{base}/_purge-{uuid.uuid4().hex}"
    place = {folder: k for k, folder in enumerate(sorted(removed))}
    dealt = spark.createDataFrame(list(place.items()), "_folder string, _place int")
    (
        df.filter(~gone)
        .join(F.broadcast(dealt), "_folder")  # folders: dates and runs, no rows
        .select(*names, "_place")
        .hint("rebalance", F.col("_place"))
        .write.partitionBy("_place")
        .parquet(purge)
    )
    for folder, k in place.items():
        if not storage.exists(spark, f"{purge}/_place={k}"):
            spark.createDataFrame([], df.select(*names).schema).write.parquet(f"{purge}/_place={k}")
        storage.touch(spark, f"{purge}/_place={k}/{storage.DONE}")

    def survivors(k: int) -> list[str]:
        files = storage.entries(spark, f"{purge}/_place={k}") or []
        return [f.name for f in files if not storage.hidden(f.name)]

    moves = [(unquote(folder), k, survivors(k)) for folder, k in place.items()]
    plan = spark.createDataFrame(moves, "folder string, place int, files array<string>")
    plan.coalesce(1).write.parquet(f"{purge}/_moves")
    _finish_moves(spark, base)
    return {unquote(folder): n for folder, n in removed.items()}


def _finish_moves(spark: SparkSession, base: str) -> None:
    """Bring the survivors of purges whose list of moves is complete to their places."""
    for entry in storage.entries(spark, base) or ():
        if not entry.name.startswith("_purge-"):
            continue
        if storage.exists(spark, f"{entry.path}/_moves/{storage.DONE}"):
            for folder, k, files in spark.read.parquet(f"{entry.path}/_moves").collect():
                survivors = f"{entry.path}/_place={k}"
                if not storage.exists(spark, survivors):
                    continue
                if folder.rsplit("/", 1)[1].startswith("run_id="):
                    storage.remove(spark, folder)
                    storage.move(spark, survivors, folder)
                else:  # a date's own files; its runs lie in the same folder
                    _swap_files(spark, survivors, folder, files)
        storage.remove(spark, entry.path)


def _swap_files(spark: SparkSession, survivors: str, folder: str, files: list[str]) -> None:
    """Replace a folder's data files by ``files``, some of which may have been moved already."""
    for file in storage.entries(spark, folder) or ():
        if file.is_file and not storage.hidden(file.name) and file.name not in files:
            storage.remove(spark, file.path)
    for file in storage.entries(spark, survivors) or ():
        if file.name in files:
            storage.move(spark, file.path, f"{folder}/{file.name}")
    storage.remove(spark, survivors)


def purge_partition(
    spark: SparkSession, root: str, table: str, run_date: str | dt.date, dry_run: bool = True
) -> int:
    """Number of rows in one dated partition, all its runs included; unless ``dry_run``, they go.

    No other date is touched. The date stays, and each of its runs, empty with its columns.
    """
    return sum(purge_layer(spark, root, table, None, dry_run, run_date).values())
