"""Spark session defaults and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Broadcast a join side by the size its shuffle measured, not by the size of compressed files.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.session.timeZone": "UTC",
}


#: Bytes that a shuffle partition should hold before adaptive execution merges small ones.
PARTITION_BYTES = 256 << 20


def build_session(
    app_name: str = "retail_strata",
    conf: dict[str, str] | None = None,
    input_bytes: int | None = None,
) -> SparkSession:
    """Session with adaptive execution on; master and sizing come from spark-submit or ``conf``.

    Adaptive execution merges shuffle partitions but adds none to an aggregate, so a large run
    says how large its input is, and shuffles start with enough partitions for it (100 TB: some
    400,000). Without it Spark's own number holds, which suits inputs up to some 50 GB.
    """
    builder = SparkSession.builder.appName(app_name)
    sizing = {}
    if input_bytes is not None:
        number = max(200, -(-input_bytes // PARTITION_BYTES))
        sizing["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(number)
    for key, value in {**DEFAULTS, **sizing, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared scratch folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


#: Whether the shuffle files of a query are deleted when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries begun inside delete their shuffle files when they end.

    Otherwise these stay on the executors' disks until the driver happens to collect its garbage.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
