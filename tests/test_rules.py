from __future__ import annotations

import pytest

from retail_strata.operators import active_orders, valid_items, valid_orders
from tests.helpers import rows


def test_amounts_are_compared_as_decimals(spark, ansi):
    amounts = ["12.50", "0", "-0.50", "-3.25", None, "abc", ""]
    df = spark.createDataFrame([(a,) for a in amounts], "total_amount string")
    assert rows(valid_orders(df)) == {("12.50",): 1, ("0",): 1}


def test_typed_amounts_follow_the_same_rule(spark, ansi):
    df = spark.createDataFrame([(12.5,), (0.0,), (-0.5,), (None,)], "total_amount double")
    assert rows(valid_orders(df)) == {(12.5,): 1, (0.0,): 1}


def test_quantities_are_whole_and_positive(spark, ansi):
    quantities = ["3", "1", "0", "-1", None, "many"]
    df = spark.createDataFrame([(q,) for q in quantities], "quantity string")
    assert rows(valid_items(df)) == {("3",): 1, ("1",): 1}


def test_active_orders_drop_null_keys_cancelled_and_null_status(spark, ansi):
    df = spark.createDataFrame(
        [("1", "SHIPPED"), ("2", "CANCELLED"), ("3", None), (None, "PENDING")],
        "customer_id string, order_status string",
    )
    assert rows(active_orders(df)) == {("1", "SHIPPED"): 1}
    assert rows(active_orders(df, if_present=True)) == {("1", "SHIPPED"): 1}


def test_without_a_status_everything_passes_when_allowed(spark):
    df = spark.createDataFrame([("1",), (None,)], "customer_id string")
    assert rows(active_orders(df, if_present=True)) == {("1",): 1, (None,): 1}
    with pytest.raises(Exception, match="order_status"):
        active_orders(df)
