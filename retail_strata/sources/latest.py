"""Newest snapshot of a folder, by modification time."""

from __future__ import annotations

from collections.abc import Sequence
from fnmatch import fnmatch
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_strata import storage
from retail_strata.sources.csv import read_csv


def list_entries(
    spark: SparkSession, folder: str, suffix: str = ".csv", files: str = "*.csv"
) -> list[tuple[int, str]] | None:
    """``(modified, entry)`` of what lies in ``folder`` under a name ending in ``suffix``.

    An entry is a file, or a folder written by Spark, as new as its newest part. Only ``files``
    count, as parts also in gzip, so markers such as ``_SUCCESS`` and uncommitted output never do. The
    folder is listed once and nothing is opened; None if it is missing.
    """
    lying = storage.entries(spark, folder)
    if lying is None:
        return None

    def shown(name: str) -> bool:
        return not storage.hidden(name) and fnmatch(name.removesuffix(".gz"), files)

    found = []
    for entry in lying:
        if not entry.name.endswith(suffix) or storage.hidden(entry.name):
            continue
        parts = [entry] if entry.is_file else storage.entries(spark, entry.path) or []
        times = [p.modified for p in parts if p.is_file and shown(p.name)]
        if times:
            found.append((max(times), entry.name))
    return found


def latest_entry(
    spark: SparkSession, folder: str, suffix: str = ".csv", files: str = "*.csv"
) -> str | None:
    """Path of the newest entry (ties: greatest name); None if the folder is missing or has none."""
    entries = list_entries(spark, folder, suffix, files)
    return f"{folder.rstrip('/')}/{max(entries)[1]}" if entries else None


def read_latest(spark: SparkSession, folder: str, **options: str) -> DataFrame | None:
    """Newest CSV of a folder, all columns strings; None if there is none."""
    path = latest_entry(spark, folder)
    return None if path is None else read_csv(spark, path, **options)


def latest_snapshot(
    df: DataFrame, folder: Sequence[str], file: str, modified: str
) -> DataFrame:
    """Rows of the newest file of every folder, for rows that carry folder, file and file time.

    The newest file per folder comes from one aggregate that is combined before its shuffle; the
    semi join back can be split by adaptive execution where one file holds much of the data. A
    NULL folder is a folder like others, and so is a NULL file.
    """
    newest = (
        df.groupBy(*folder)
        .agg(F.max(F.struct(modified, file)).alias("_newest"))
        .select(
            *[F.col(name).alias(f"_{name}") for name in folder],
            F.col("_newest").getField(file).alias(f"_{file}"),
        )
    )
    same = [df[name].eqNullSafe(newest[f"_{name}"]) for name in [*folder, file]]
    return df.join(newest, reduce(lambda a, b: a & b, same), "left_semi")
