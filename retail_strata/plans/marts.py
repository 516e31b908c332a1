"""Aggregates over gold order lines. Money is summed as decimal.

Every aggregate is combined before its shuffle. A distinct count is first grouped together with
the counted column, so a frequent group is spread over many tasks before it is brought together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retail_strata.operators.joins import left_join
from retail_strata.schemas import MONEY


def _units() -> Column:
    return F.col("quantity").try_cast("int")


def _revenue() -> Column:
    return _units() * F.col("unit_price").try_cast(MONEY)


def sales_by_city(gold: DataFrame) -> DataFrame:
    """Revenue and orders per city and state; lines of unknown customers form one group."""
    return gold.groupBy("city", "state").agg(
        F.sum(_revenue()).alias("revenue"),
        F.countDistinct("order_id").alias("orders"),
    )


def gold_customers(gold: DataFrame) -> DataFrame:
    return gold.groupBy("customer_id").agg(
        F.countDistinct("order_id").alias("orders"),
        F.count(F.lit(1)).alias("lines"),
        F.sum(_units()).alias("units"),
        F.sum(_revenue()).alias("revenue"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    )


def gold_orders(gold: DataFrame) -> DataFrame:
    return gold.groupBy("order_id").agg(
        F.countDistinct("product_id").alias("products"),
        F.count(F.lit(1)).alias("lines"),
        F.sum(_units()).alias("units"),
        F.sum(_revenue()).alias("revenue"),
    )


def gold_order_items(gold: DataFrame) -> DataFrame:
    """Item grain, with the line's revenue."""
    return gold.select(
        "order_item_id",
        "order_id",
        "product_id",
        "customer_id",
        _units().alias("units"),
        F.col("unit_price").try_cast(MONEY).alias("unit_price"),
        _revenue().alias("revenue"),
    )


def gold_products(gold: DataFrame, products: DataFrame) -> DataFrame:
    """Sales per product and category; products that are not known have no category.

    The lines are summed per product before they meet the categories.
    """
    sales = gold.groupBy("product_id").agg(
        F.countDistinct("order_id").alias("orders"),
        F.sum(_units()).alias("units"),
        F.sum(_revenue()).alias("revenue"),
    )
    categories = products.select("product_id", "category").distinct()
    return left_join(sales, categories, "product_id", ["category"])
