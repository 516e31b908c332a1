"""Row rules. A NULL in a tested column drops the row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_strata.schemas import MONEY


def valid_orders(df: DataFrame) -> DataFrame:
    """Orders whose ``total_amount`` is a number of at least zero.

    The column may hold text: what does not parse is NULL and the order goes, under ANSI or not.
    """
    return df.filter(F.col("total_amount").try_cast(MONEY) >= 0)


def valid_items(df: DataFrame) -> DataFrame:
    """Items whose ``quantity`` is a whole number above zero."""
    return df.filter(F.col("quantity").try_cast("int") > 0)


def active_orders(df: DataFrame, if_present: bool = False) -> DataFrame:
    """Rows with a customer key and a status other than CANCELLED.

    With ``if_present`` a frame without ``order_status`` passes through whole, NULL keys included.
    """
    if if_present and "order_status" not in df.columns:
        return df
    return df.filter(F.col("customer_id").isNotNull() & (F.col("order_status") != "CANCELLED"))
