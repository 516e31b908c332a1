"""Silver: cleaned entities, restricted to and widened by the rows they refer to."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from retail_strata.operators.columns import clean_entity, normalise_email
from retail_strata.operators.joins import silver_order_items, silver_orders, silver_products
from retail_strata.operators.rules import valid_items, valid_orders

ENTITY_RULES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "customers": normalise_email,
    "orders": valid_orders,
    "order_items": valid_items,
}


def clean_entities(bronze: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Each entity deduplicated, then put through its own rule."""
    return {
        entity: ENTITY_RULES.get(entity, lambda df: df)(clean_entity(df, entity))
        for entity, df in bronze.items()
    }


def join_entities(clean: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Referential joins of cleaned entities; a join with a missing partner is left out.

    Items meet the orders before those are restricted to known customers, so items of an unknown
    customer's order stay; products meet the already joined items.
    """
    silver = dict(clean)
    if "order_items" in clean and "orders" in clean:
        silver["order_items"] = silver_order_items(clean["order_items"], clean["orders"])
    if "orders" in clean and "customers" in clean:
        silver["orders"] = silver_orders(clean["orders"], clean["customers"])
    if "products" in clean and "order_items" in clean:
        silver["products"] = silver_products(clean["products"], silver["order_items"])
    return silver


def build_silver(bronze: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return join_entities(clean_entities(bronze))
