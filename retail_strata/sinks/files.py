"""CSV output, fan-out and preview."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from retail_strata import storage
from retail_strata.session import brief_shuffles, scratch_path


def write_csv(df: DataFrame, path: str, compact: bool = False, **options: str) -> None:
    """Overwrite ``path`` with CSV parts, each with a header.

    ``compact`` rebalances the rows first: a frame that fits one advisory partition becomes a
    single file and a larger one as many even files as it needs, never one task for all of it.
    An empty frame gives a file with the header alone.
    """
    if compact:
        df = df.hint("rebalance")
    df.write.mode("overwrite").options(header=True, **options).csv(path)


def write_fanout(df: DataFrame, paths: Sequence[str], **options: str) -> None:
    """The same CSV output at every path, in gzip unless ``compression`` says otherwise.

    The plan runs once, into the shared scratch folder; the outputs are copied from there. Its shuffle
    files go before they are, and the scratch folder after the last one.
    """
    spark = df.sparkSession
    staged = scratch_path(spark, "fanout")
    with brief_shuffles(spark):
        df.write.parquet(staged, compression=storage.PARQUET_CODEC)
    result = spark.read.schema(df.schema).parquet(staged)
    for path in paths:
        write_csv(result, path, **{"compression": "gzip", **options})
    storage.remove(spark, staged)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """Any ``n`` rows; see ``df.schema`` and ``df.columns`` for the rest of the picture."""
    return df.limit(n)
