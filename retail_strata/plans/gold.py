"""Gold: active order lines with the customer's city and state."""

from __future__ import annotations

from pyspark.sql import DataFrame

from retail_strata.operators.columns import require_columns, select_existing
from retail_strata.operators.joins import enrich_with_customer, silver_order_items
from retail_strata.operators.rules import active_orders
from retail_strata.schemas import GOLD_COLUMNS


def build_gold(order_items: DataFrame, customers: DataFrame) -> DataFrame:
    """Order lines from silver order_items and silver customers.

    The status rule is written after the join and runs before it, at the scan of the items.
    """
    require_columns(order_items, ["customer_id", "order_status"], "silver order_items")
    require_columns(customers, ["customer_id", "city", "state"], "silver customers")
    lines = enrich_with_customer(order_items, customers, ["city", "state"])
    return select_existing(active_orders(lines), GOLD_COLUMNS)


def build_gold_from_clean(clean: dict[str, DataFrame]) -> DataFrame:
    """The same order lines from cleaned items, orders and customers, where no silver is written.

    The orders take up the geography before the items meet them, so that the items, which are many
    more and wider then, are not shuffled by customer. The joins give the same rows in either order.
    """
    require_columns(clean["orders"], ["customer_id", "order_status"], "orders")
    require_columns(clean["customers"], ["customer_id", "city", "state"], "customers")
    known = enrich_with_customer(clean["orders"], clean["customers"], ["city", "state"])
    lines = silver_order_items(clean["order_items"], known)
    return select_existing(active_orders(lines), GOLD_COLUMNS)
