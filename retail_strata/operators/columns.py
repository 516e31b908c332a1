"""Column operators: lineage columns, normalisation, tolerant projection."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def add_ingest_metadata(
    df: DataFrame,
    source: str = "generated",
    ingest_ts: Column | dt.datetime | None = None,
) -> DataFrame:
    """Tag every row with its ingestion time and source.

    ``ingest_ts`` fixes the time, so that a replay gives the same rows.
    """
    if ingest_ts is None:
        ingest_ts = F.current_timestamp()
    elif not isinstance(ingest_ts, Column):
        ingest_ts = F.lit(ingest_ts)
    return df.withColumns({"ingest_timestamp": ingest_ts, "source": F.lit(source)})


def label_lineage(df: DataFrame, entity: str) -> DataFrame:
    """Drop ``source`` and prefix the other lineage columns, so that later joins do not collide."""
    return df.drop("source").withColumnsRenamed(
        {
            "ingest_timestamp": f"{entity}_ingest_timestamp",
            "source_system": f"{entity}_source_system",
        }
    )


def clean_entity(df: DataFrame, entity: str) -> DataFrame:
    """Label the lineage and keep one of each set of identical rows (NULLs compare equal).

    The dedupe shuffles on all columns, after copies have collapsed in the map-side aggregate, so
    neither a frequent key nor a row with very many copies gathers in one task.
    """
    return label_lineage(df, entity).dropDuplicates()


def normalise_email(df: DataFrame) -> DataFrame:
    """Lower-case ``email``. Runs after the dedupe: rows that differ in case only both stay."""
    return df.withColumn("email", F.lower("email"))


def select_existing(df: DataFrame, expected: Iterable[str]) -> DataFrame:
    """The expected columns that exist, in the expected order."""
    return df.select(*[name for name in expected if name in df.columns])


def require_columns(df: DataFrame, names: Iterable[str], table: str) -> DataFrame:
    """``df`` itself; raises before anything runs if a column is missing."""
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"{table} lacks {', '.join(missing)}; it has {', '.join(df.columns)}")
    return df
