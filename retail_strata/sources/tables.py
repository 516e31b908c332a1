"""Reads of layer tables, dated partitions and published versions."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_strata import storage
from retail_strata.functions.dates import parse_run_date


LOG = logging.getLogger(__name__)


class MissingInputError(FileNotFoundError):
    """A required input is not there."""


def partition_path(root: str, table: str, run_date: str | dt.date) -> str:
    """ISO dates, so that Spark reads the partition value back as a date and not as an int."""
    return f"{root.rstrip('/')}/{table}/ingest_date={parse_run_date(run_date).isoformat()}"


def completed_runs(spark: SparkSession, root: str, table: str, run_date: str | dt.date) -> list[str]:
    """Run ids of a date whose output is complete, in the order in which they were completed."""
    lying = storage.entries(spark, partition_path(root, table, run_date)) or []
    found = []
    for entry in lying:
        if entry.name.startswith("run_id=") and not entry.is_file:
            marks = [m for m in storage.entries(spark, entry.path) or () if m.name == storage.DONE]
            found += [(m.modified, entry.name.removeprefix("run_id=")) for m in marks]
    return [run_id for _, run_id in sorted(found)]


def has_runs(spark: SparkSession, root: str, table: str, run_date: str | dt.date) -> bool:
    """Whether runs of a date were written under run ids, complete or not."""
    lying = storage.entries(spark, partition_path(root, table, run_date)) or []
    return any(entry.name.startswith("run_id=") for entry in lying)


def read_partition(
    spark: SparkSession,
    root: str,
    table: str,
    run_date: str | dt.date,
    run_id: str | None = None,
) -> DataFrame:
    """One dated partition of a layer table, with its ``ingest_date``.

    Only that date's folder is listed, however many dates the table holds. For a table written
    with run ids, ``run_id`` picks the run; without it the run completed last is read. A run that
    was not completed counts as missing.
    """
    path = partition_path(root, table, run_date)
    if run_id is not None or has_runs(spark, root, table, run_date):
        runs = completed_runs(spark, root, table, run_date)
        if not runs or (run_id is not None and run_id not in runs):
            raise MissingInputError(path if run_id is None else f"{path}/run_id={run_id}")
        path = f"{path}/run_id={runs[-1] if run_id is None else run_id}"
    try:
        df = spark.read.option("basePath", f"{root.rstrip('/')}/{table}").parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise MissingInputError(path) from error
        raise
    return df.drop("run_id") if "/run_id=" in path else df


def read_layer(
    spark: SparkSession,
    root: str,
    table: str,
    run_date: str | dt.date,
    run_id: str | None = None,
) -> DataFrame:
    """A layer table as it was written: one dated partition without the partition column."""
    return read_partition(spark, root, table, run_date, run_id).drop("ingest_date")


def read_entities(
    read: Callable[[str], DataFrame | None],
    entities: Iterable[str],
    on_missing: str = "skip",
) -> dict[str, DataFrame]:
    """``read(entity)`` for each entity; one that has no input is skipped or fails the run.

    ``read`` reports a missing input by returning None or raising MissingInputError.
    """
    if on_missing not in ("skip", "fail"):
        raise ValueError(f"on_missing must be 'skip' or 'fail', not {on_missing!r}")
    found: dict[str, DataFrame] = {}
    missing: list[str] = []
    for entity in entities:
        try:
            df = read(entity)
        except MissingInputError:
            df = None
        if df is None:
            missing.append(entity)
        else:
            found[entity] = df
    if missing and on_missing == "fail":
        raise MissingInputError(f"no input for {', '.join(missing)}")
    for entity in missing:
        LOG.warning("no input for %s: left out", entity)
    return found


def read_published(spark: SparkSession, path: str, version: str | None = None) -> DataFrame:
    """The version published last at ``path``, or the one named."""
    path = path.rstrip("/")
    if version is None:
        try:
            commits = spark.read.parquet(f"{path}/commits")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                raise MissingInputError(path) from error
            raise
        version = commits.agg(
            F.max_by("version", F.struct("committed_at", "version")).alias("version")
        ).first()["version"]
    return spark.read.parquet(f"{path}/data/{version}")
