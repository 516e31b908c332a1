"""Bronze: raw tables plus ingestion metadata."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame

from retail_strata.operators.columns import add_ingest_metadata


def build_bronze(
    raw: dict[str, DataFrame],
    ingest_ts: Column | dt.datetime | None = None,
    source: str = "generated",
) -> dict[str, DataFrame]:
    return {
        entity: add_ingest_metadata(df, source=source, ingest_ts=ingest_ts)
        for entity, df in raw.items()
    }
