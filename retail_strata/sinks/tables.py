"""Parquet layer tables: dated partitions and published versions."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_strata import storage
from retail_strata.sources.tables import has_runs, partition_path


def new_run_id() -> str:
    """A run id of the time and a random part; later ones sort later."""
    return f"{dt.datetime.now(dt.UTC):%Y%m%d_%H%M%S_%f}_{uuid.uuid4().hex[:8]}"


def write_layer(
    df: DataFrame,
    root: str,
    table: str,
    run_date: str | dt.date,
    run_id: str | None = None,
) -> str:
    """Overwrite one dated partition of a layer table and return its path.

    The partition's folder is written directly: other dates are untouched, and an empty result
    replaces an earlier one instead of leaving it in place. With ``run_id`` runs accumulate; each is
    marked as complete after its last file, and so is the date. Without one the date is overwritten
    in place, which is refused where it holds runs.
    """
    spark = df.sparkSession
    date = partition_path(root, table, run_date)
    if run_id is None:
        if has_runs(spark, root, table, run_date):
            raise ValueError(f"{date} holds runs; a write without a run id would delete them")
        df.write.mode("overwrite").parquet(date, compression=storage.PARQUET_CODEC)
        return date
    path = f"{date}/run_id={run_id}"
    df.write.mode("overwrite").parquet(path, compression=storage.PARQUET_CODEC)
    storage.touch(spark, f"{path}/{storage.DONE}")
    storage.touch(spark, f"{date}/{storage.DONE}")
    return path


def write_dated(df: DataFrame, path: str, date_column: str) -> None:
    """Overwrite the partitions of ``path`` for every date in ``date_column``.

    Rows are first rebalanced by date, so that a date is written by one task, and a date that
    holds much of the data by several. Dates with no rows in ``df`` are left as they are.
    """
    (
        df.hint("rebalance", F.col(date_column))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(date_column)
        .parquet(path)
    )


def publish(df: DataFrame, path: str, version: str) -> None:
    """Write ``df`` as a new version of the table at ``path`` and then make it the current one.

    Readers follow the commit list, so a run that fails half-way is never seen and a version being
    read is never replaced. A version name can be used once.
    """
    path = path.rstrip("/")
    df.write.mode("error").parquet(f"{path}/data/{version}", compression=storage.PARQUET_CODEC)
    commit = df.sparkSession.range(1, numPartitions=1).select(
        F.lit(version).alias("version"), F.current_timestamp().alias("committed_at")
    )
    commit.write.mode("append").parquet(f"{path}/commits")
