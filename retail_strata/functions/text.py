"""Layer names and object paths held in string columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def refined_name(name: Column) -> Column:
    """Bronze name of a raw table name: ``raw_orders`` -> ``refined_orders``."""
    return F.regexp_replace(name, "^raw_", "refined_")


def object_bucket(uri: Column) -> Column:
    """Bucket of ``scheme://bucket/prefix``."""
    return F.split(uri, "/").getItem(2)


def object_prefix(uri: Column) -> Column:
    """Everything after the bucket of ``scheme://bucket/prefix``."""
    return F.array_join(F.slice(F.split(uri, "/"), 4, F.size(F.split(uri, "/"))), "/")
