from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from retail_strata import functions as fn


def value(spark, column):
    return spark.range(1).select(column).first()[0]


def test_stamps(spark):
    at = F.lit(dt.datetime(2025, 2, 7, 10, 15, 0))
    assert value(spark, fn.date_folder(at)) == "20250207"
    assert value(spark, fn.run_stamp(at)) == "20250207_101500"


def test_run_date_column(spark, ansi):
    assert value(spark, fn.run_date_column(F.lit("2025-02-07"))) == dt.date(2025, 2, 7)
    assert value(spark, fn.run_date_column(F.lit("07/02/2025"))) is None


def test_run_date_parameter():
    assert fn.parse_run_date("2025-02-07") == dt.date(2025, 2, 7)
    assert fn.parse_run_date(dt.date(2025, 2, 7)) == dt.date(2025, 2, 7)
    assert fn.parse_run_date(dt.datetime(2025, 2, 7, 10, 15)) == dt.date(2025, 2, 7)
    with pytest.raises(ValueError):
        fn.parse_run_date("20250207")


def test_names_and_paths(spark):
    assert value(spark, fn.refined_name(F.lit("raw_orders"))) == "refined_orders"
    assert value(spark, fn.refined_name(F.lit("my_raw_orders"))) == "my_raw_orders"
    uri = F.lit("gs://bucket/data/raw_orders/20250221")
    assert value(spark, fn.object_bucket(uri)) == "bucket"
    assert value(spark, fn.object_prefix(uri)) == "data/raw_orders/20250221"
    assert value(spark, fn.object_prefix(F.lit("gs://bucket"))) == ""
