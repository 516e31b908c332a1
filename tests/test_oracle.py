"""Every registered query against its SQL, and row counts known from elsewhere."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_module
from checks.compare import check, connect, difference
from checks.oracle import ORACLE_SQL
from checks.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the given tables")


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    assert check(spark, duck, name, SMALL) is None


def test_the_comparison_sees_a_difference(duck):
    result = duck.execute(ORACLE_SQL["gold_final_orders"]).df()
    changed = result.copy()
    changed.loc[0, "quantity"] = "999"
    assert difference(result, result) is None
    assert difference(changed, result) is not None
    assert difference(result.head(5), result) is not None
    assert difference(result.drop(columns="city"), result) is not None


COUNTS = {
    "silver_customers": 1500,
    "silver_orders_valid": 14113,
    "silver_items_valid": 57663,
    "silver_order_items": 49434,
    "silver_orders": 11696,
    "silver_products": 45735,
    "gold_final_orders": 38829,
    "items_with_customer_key": 57663,
    "gold_cloud_orders": 57663,
    "active_orders_optional": 38829,
    "gold_sales_by_city": 126,
    "latest_snapshot": 416,
    "surrogate_keys": 1500,
}


@pytest.mark.parametrize("name", sorted(COUNTS))
def test_known_row_counts(spark, name):
    assert QUERIES[name](spark, MEDIUM).count() == COUNTS[name]


def test_entry_points(spark):
    assert entry_module.entry(spark).count() > 0
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
    assert set(QUERIES) == set(ORACLE_SQL) and set(QUERIES) <= set(entry_module.queries())


def test_gold_properties(spark):
    gold = QUERIES["gold_final_orders"](spark, MEDIUM)
    items = QUERIES["silver_order_items"](spark, MEDIUM)
    assert gold.count() <= items.count()
    assert gold.filter("order_status = 'CANCELLED' OR order_status IS NULL").count() == 0
    assert gold.filter("customer_id IS NULL").count() == 0
