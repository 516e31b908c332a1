"""Raw retail tables with known dirt, derived from the clean benchmark tables.

The moduli below plant dirt on part of the keys. Every source row is kept, and each rule of the
pipeline has rows to remove: some customers, orders and products have an id that nothing refers to
(their own, negated), which leaves the references to them dangling, and keys divisible by COPY_KEY
appear twice. Columns are all strings, as in a CSV landing zone. ``RAW_SQL`` says the same for the
SQL engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_strata.schemas import MONEY

COPY_KEY = 20


def _text(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def _money(column: Column | str) -> Column:
    return _text((F.col(column) if isinstance(column, str) else column).cast(MONEY))


def _id(key: Column, lost: int) -> Column:
    """The key as text; negated where it is divisible by ``lost``."""
    return _text(F.when(key % lost == 0, -key).otherwise(key))


def _with_copies(df: DataFrame, key: Column, columns: dict[str, Column]) -> DataFrame:
    """Map the columns, giving rows whose key is divisible by COPY_KEY twice, in one scan."""
    copies = F.sequence(F.lit(1), F.when(key % COPY_KEY == 0, 2).otherwise(1))
    return df.select(
        *[column.alias(name) for name, column in columns.items()],
        F.explode(copies).alias("_copy"),
    ).drop("_copy")


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return _with_copies(
        spark.read.parquet(f"{sf_dir}/customer.parquet"),
        key,
        {
            "customer_id": _id(key, 7),
            "full_name": F.col("c_name"),
            "email": F.concat(
                F.when(key % 2 == 0, "USER").otherwise("user"), _text(key), F.lit("@Example.com")
            ),
            "address": F.concat(_text(key % 9999 + 1), F.lit(" Main St")),
            "city": F.col("c_mktsegment"),
            "state": _text("c_nationkey"),
        },
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    return _with_copies(
        spark.read.parquet(f"{sf_dir}/part.parquet"),
        key,
        {
            "product_id": _id(key, 13),
            "product_name": F.col("p_name"),
            "category": F.col("p_brand"),
            "price": _money("p_retailprice"),
        },
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    status = F.col("o_orderstatus")
    return _with_copies(
        spark.read.parquet(f"{sf_dir}/orders.parquet"),
        key,
        {
            "order_id": _id(key, 11),
            "order_date": _text(F.col("o_orderdate").cast("date")),
            "customer_id": F.when(key % 31 != 0, _text("o_custkey")),
            "total_amount": F.when(key % 97 == 0, F.lit(None))
            .when(key % 101 == 0, "abc")
            .otherwise(_money(F.col("o_totalprice") - 20000)),
            "order_status": F.when(key % 53 == 0, F.lit(None))
            .when(status == "F", "DELIVERED")
            .when(status == "O", "SHIPPED")
            .when(key % 2 == 0, "PENDING")
            .otherwise("CANCELLED"),
        },
    )


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("l_orderkey")
    parts = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return _with_copies(
        spark.read.parquet(f"{sf_dir}/lineitem.parquet"),
        key,
        {
            "order_item_id": F.concat_ws("-", *[_text(part) for part in parts]),
            "order_id": _text(key),
            "product_id": _text("l_partkey"),
            "quantity": _text(F.col("l_quantity").cast("int") - 2),
            "unit_price": _money("l_extendedprice"),
        },
    )


RAW_TABLES = {
    "customers": raw_customers,
    "products": raw_products,
    "orders": raw_orders,
    "order_items": raw_order_items,
}


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {entity: table(spark, sf_dir) for entity, table in RAW_TABLES.items()}


def _sql_with_copies(name: str, key: str, select: str) -> str:
    return (
        f"{name}_once AS ({select}),\n"
        f"{name} AS (SELECT * FROM {name}_once\n"
        f"  UNION ALL SELECT * FROM {name}_once WHERE CAST({key} AS BIGINT) % {COPY_KEY} = 0)"
    )


RAW_SQL = {
    "raw_customers": _sql_with_copies(
        "raw_customers",
        "customer_id",
        """
  SELECT CAST(CASE WHEN c_custkey % 7 = 0 THEN -c_custkey ELSE c_custkey END AS VARCHAR)
             AS customer_id,
         c_name AS full_name,
         concat(CASE WHEN c_custkey % 2 = 0 THEN 'USER' ELSE 'user' END,
                CAST(c_custkey AS VARCHAR), '@Example.com') AS email,
         concat(CAST(c_custkey % 9999 + 1 AS VARCHAR), ' Main St') AS address,
         c_mktsegment AS city,
         CAST(c_nationkey AS VARCHAR) AS state
  FROM customer""",
    ),
    "raw_products": _sql_with_copies(
        "raw_products",
        "product_id",
        """
  SELECT CAST(CASE WHEN p_partkey % 13 = 0 THEN -p_partkey ELSE p_partkey END AS VARCHAR)
             AS product_id,
         p_name AS product_name,
         p_brand AS category,
         CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) AS price
  FROM part""",
    ),
    "raw_orders": _sql_with_copies(
        "raw_orders",
        "order_id",
        """
  SELECT CAST(CASE WHEN o_orderkey % 11 = 0 THEN -o_orderkey ELSE o_orderkey END AS VARCHAR)
             AS order_id,
         CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date,
         CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
         CASE WHEN o_orderkey % 97 = 0 THEN NULL
              WHEN o_orderkey % 101 = 0 THEN 'abc'
              ELSE CAST(CAST(o_totalprice - 20000 AS DECIMAL(18,2)) AS VARCHAR) END AS total_amount,
         CASE WHEN o_orderkey % 53 = 0 THEN NULL
              WHEN o_orderstatus = 'F' THEN 'DELIVERED'
              WHEN o_orderstatus = 'O' THEN 'SHIPPED'
              WHEN o_orderkey % 2 = 0 THEN 'PENDING'
              ELSE 'CANCELLED' END AS order_status
  FROM orders""",
    ),
    "raw_order_items": _sql_with_copies(
        "raw_order_items",
        "order_id",
        """
  SELECT concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
                   CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR)) AS order_item_id,
         CAST(l_orderkey AS VARCHAR) AS order_id,
         CAST(l_partkey AS VARCHAR) AS product_id,
         CAST(CAST(l_quantity AS INT) - 2 AS VARCHAR) AS quantity,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS unit_price
  FROM lineitem""",
    ),
}
