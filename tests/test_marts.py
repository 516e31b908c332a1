from __future__ import annotations

from decimal import Decimal

import pytest

from retail_strata import plans
from tests.helpers import rows


@pytest.fixture
def gold(spark):
    return spark.createDataFrame(
        [
            ("i1", "o1", "p1", "c1", "2", "5.00", "2025-02-07", "Ohio", "OH"),
            ("i2", "o1", "p2", "c1", "1", "0.10", "2025-02-07", "Ohio", "OH"),
            ("i3", "o2", "p1", "c9", "3", "5.00", "2025-02-08", None, None),
            ("i4", "o3", "p1", "c8", "1", "bad", "2025-02-09", None, None),
        ],
        "order_item_id string, order_id string, product_id string, customer_id string, "
        "quantity string, unit_price string, order_date string, city string, state string",
    )


def test_unknown_places_form_one_group(gold, ansi):
    assert rows(plans.sales_by_city(gold)) == {
        ("Ohio", "OH", Decimal("10.10"), 1): 1,
        (None, None, Decimal("15.00"), 2): 1,
    }


def test_per_customer_order_and_item(gold):
    customers = {row["customer_id"]: row for row in plans.gold_customers(gold).collect()}
    assert customers["c1"][1:] == (1, 2, 3, Decimal("10.10"), "2025-02-07", "2025-02-07")
    orders = {row["order_id"]: row for row in plans.gold_orders(gold).collect()}
    assert orders["o1"][1:] == (2, 2, 3, Decimal("10.10"))
    items = {row["order_item_id"]: row["revenue"] for row in plans.gold_order_items(gold).collect()}
    assert items == {
        "i1": Decimal("10.00"),
        "i2": Decimal("0.10"),
        "i3": Decimal("15.00"),
        "i4": None,
    }


def test_products_with_and_without_a_category(spark, gold):
    products = spark.createDataFrame(
        [("p1", "Kitchen", "1"), ("p1", "Kitchen", "2"), ("p3", "Sports", "1")],
        "product_id string, category string, price string",
    )
    assert rows(plans.gold_products(gold, products)) == {
        ("p1", 3, 6, Decimal("25.00"), "Kitchen"): 1,
        ("p2", 1, 1, Decimal("0.10"), None): 1,
    }
