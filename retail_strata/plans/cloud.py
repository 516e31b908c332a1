"""The cloud variant: silver without joins, gold joined from its parts."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession

from retail_strata.operators.columns import clean_entity, require_columns
from retail_strata.operators.joins import attach_customer_key, enrich_with_customer
from retail_strata.operators.rules import active_orders, valid_items, valid_orders
from retail_strata.plans.pipeline import together
from retail_strata.schemas import ENTITIES, layer_table
from retail_strata.session import brief_shuffles
from retail_strata.sinks.files import write_fanout
from retail_strata.sinks.tables import publish
from retail_strata.sources.csv import read_entity
from retail_strata.sources.latest import latest_entry
from retail_strata.sources.tables import read_entities, read_published


def build_cloud_silver(bronze: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Each entity deduplicated; orders and items validated; e-mails as they are, no joins."""
    rules = {"orders": valid_orders, "order_items": valid_items}
    return {
        entity: rules.get(entity, lambda df: df)(clean_entity(df, entity))
        for entity, df in bronze.items()
    }


def build_gold_from_parts(
    order_items: DataFrame, orders: DataFrame, customers: DataFrame
) -> DataFrame:
    """Every item with its order's customer; the status rule applies where there is a status.

    The orders take up their customers before the items meet them, so that the items, which are many
    more, are shuffled once only. Left joins on equal keys give the same rows in either order.
    """
    require_columns(orders, ["order_id", "customer_id"], "orders")
    require_columns(customers, ["customer_id"], "customers")
    known = enrich_with_customer(orders.select("order_id", "customer_id"), customers)
    return active_orders(attach_customer_key(order_items, known, known.columns[1:]), if_present=True)


def published_path(warehouse: str, entity: str) -> str:
    return f"{warehouse.rstrip('/')}/{layer_table('silver', entity)}"


def run_cloud_silver(
    spark: SparkSession, landing: str, warehouse: str, version: str, on_missing: str = "skip"
) -> dict[str, DataFrame]:
    """Newest CSV of every ``<landing>/raw_<entity>``, typed, cleaned and published as a version."""

    def newest(entity: str) -> DataFrame | None:
        path = latest_entry(spark, f"{landing.rstrip('/')}/{layer_table('raw', entity)}")
        return None if path is None else read_entity(spark, path, entity)

    silver = build_cloud_silver(read_entities(newest, ENTITIES, on_missing))
    with brief_shuffles(spark):
        together(
            spark,
            [
                partial(publish, df, published_path(warehouse, entity), version)
                for entity, df in silver.items()
            ],
        )
    return {
        entity: read_published(spark, published_path(warehouse, entity), version)
        for entity in silver
    }


def run_cloud_gold(spark: SparkSession, warehouse: str) -> list[str]:
    """The published parts joined and written, the same to each entity's gold folder.

    Items, orders and customers must be published. Returns the folders.
    """
    silver = read_entities(
        lambda entity: read_published(spark, published_path(warehouse, entity)),
        ["order_items", "orders", "customers"],
        "fail",
    )
    gold = build_gold_from_parts(silver["order_items"], silver["orders"], silver["customers"])
    paths = [f"{warehouse.rstrip('/')}/{layer_table('gold', entity)}" for entity in ENTITIES]
    write_fanout(gold, paths)
    return paths
