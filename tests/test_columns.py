from __future__ import annotations

import datetime as dt

import pytest

from retail_strata.operators import (
    add_ingest_metadata,
    clean_entity,
    label_lineage,
    normalise_email,
    require_columns,
    select_existing,
)
from tests.helpers import rows

NOON = dt.datetime(2025, 2, 7, 12)


def test_metadata_follows_the_raw_columns(spark):
    df = add_ingest_metadata(spark.range(1), ingest_ts=NOON)
    assert df.columns == ["id", "ingest_timestamp", "source"]
    assert rows(df) == {(0, NOON, "generated"): 1}


def test_metadata_defaults_to_now(spark):
    before = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    stamp = add_ingest_metadata(spark.range(3)).select("ingest_timestamp").distinct().collect()
    assert len(stamp) == 1
    assert abs(stamp[0][0] - before) < dt.timedelta(minutes=5)


def test_lineage_is_renamed_where_present(spark):
    full = spark.createDataFrame([(1, 2, 3, 4)], ["id", "ingest_timestamp", "source_system", "source"])
    assert label_lineage(full, "orders").columns == [
        "id",
        "orders_ingest_timestamp",
        "orders_source_system",
    ]
    assert label_lineage(spark.range(1), "orders").columns == ["id"]


def test_identical_rows_collapse_and_nulls_are_equal(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("a", "x"), ("a", "x")], "k string, v string")
    assert rows(clean_entity(df, "orders")) == {("a", None): 1, ("a", "x"): 1}


def test_rows_of_different_ingest_times_are_not_identical(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2)], "k string, ingest_timestamp int")
    assert clean_entity(df, "orders").count() == 2


def test_cleaning_again_changes_nothing(spark):
    df = spark.createDataFrame([("a", "s"), ("a", "s"), ("b", "s")], "k string, source string")
    once = clean_entity(df, "orders")
    assert rows(clean_entity(once, "orders")) == rows(once)


def test_emails_are_lowered_after_the_dedupe(spark):
    df = spark.createDataFrame([("1", "A@x"), ("1", "a@x"), ("1", "a@x")], "id string, email string")
    assert rows(normalise_email(clean_entity(df, "customers"))) == {("1", "a@x"): 2}


def test_projection_keeps_expected_order_and_skips_absent(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["c", "a", "extra"])
    assert select_existing(df, ["a", "b", "c"]).columns == ["a", "c"]


def test_missing_columns_are_named(spark):
    df = spark.range(1)
    assert require_columns(df, ["id"], "t") is df
    with pytest.raises(ValueError, match="orders lacks customer_id"):
        require_columns(df, ["id", "customer_id"], "orders")
