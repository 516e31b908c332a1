"""Joins of the four entities.

The entities carry no broadcast hint: Spark broadcasts a side when its size, estimated or measured by
adaptive execution, is below the session's threshold. A frequent key on either side of an inner
join, or on the left of a left join, is split by adaptive execution's skew handling, because each
join reads straight from its own shuffle. What adaptive execution cannot split is a frequent key
on the right of a left join; ``left_join`` splits that one itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of one key on the right of a left join that one task may take.
ROWS_PER_SPLIT = 2_000_000


def silver_order_items(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Items of known orders, widened by the order. Pass orders not yet restricted to customers."""
    return items.join(orders, "order_id", "inner")


def silver_orders(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders of known customers, widened by the customer."""
    return orders.join(customers, "customer_id", "inner")


def silver_products(products: DataFrame, items: DataFrame) -> DataFrame:
    """One row per sold item of a known product; ``items`` may already be widened by orders."""
    return products.join(items, "product_id", "inner")


def enrich_with_customer(
    items: DataFrame, customers: DataFrame, keep: Sequence[str] | None = None
) -> DataFrame:
    """Every item, with its customer's columns (``keep``, or all) or NULLs."""
    if keep is None:
        keep = [name for name in customers.columns if name != "customer_id"]
    return left_join(items, customers, "customer_id", keep).select(*items.columns, *keep)


def attach_customer_key(
    items: DataFrame, orders: DataFrame, keep: Sequence[str] = ("customer_id",)
) -> DataFrame:
    """Every item, with ``customer_id`` (or the columns ``keep``) of its order or NULL."""
    return left_join(items, orders, "order_id", keep)


def left_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    keep: Sequence[str],
    rows_per_split: int = ROWS_PER_SPLIT,
) -> DataFrame:
    """``left`` left-joined to ``right[key, keep]`` on ``key``, whatever the key frequencies.

    The keys with more than ``rows_per_split`` rows in ``right`` are counted as part of the plan
    and joined to both sides. The right rows of such a key are dealt to several splits, by a hash
    of the whole row that a retried task repeats, and its left rows are copied to every split, so
    that each pair meets exactly once. The left rows of a split key have a match in some split, so
    their unmatched copies are dropped; the rows of other keys, and of a NULL key, are in one
    split and see a plain left join.

    There are fewer such keys than ``right`` has rows over ``rows_per_split``: half a million, or
    some 15 MB, for 10**12 rows. That is what bounds the broadcast of them, which spares both sides
    a shuffle on the bare key that would bring a frequent one together after all.
    """
    splits = F.broadcast(
        right.groupBy(key)
        .agg(F.ceil(F.count(F.lit(1)) / rows_per_split).cast("int").alias("_splits"))
        .filter((F.col("_splits") > 1) & F.col(key).isNotNull())
    )
    n_splits = F.coalesce("_splits", F.lit(1))
    whole_row = F.xxhash64(*[F.col(f"`{name}`") for name in right.columns])
    dealt = right.join(splits, key, "left").select(
        key, *keep, F.pmod(whole_row, n_splits).cast("int").alias("_split"), F.lit(True).alias("_hit")
    )
    copied = (
        left.join(splits, key, "left")
        .withColumn("_splits", n_splits)
        .withColumn("_split", F.explode(F.sequence(F.lit(0), F.col("_splits") - 1)))
    )
    return (
        copied.join(dealt, [key, "_split"], "left")
        .filter((F.col("_splits") == 1) | F.col("_hit"))
        .drop("_split", "_splits", "_hit")
    )
