"""Run registered queries next to their SQL and report where they differ.

    python -m checks.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import tempfile
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from checks.oracle import ORACLE_SQL
from checks.queries import QUERIES

TABLES = [
    "customer",
    "orders",
    "lineitem",
    "part",
    "events",
    "pages",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    """In-process engine with the given tables as views."""
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
        )
    return connection


def difference(actual: pd.DataFrame, expected: pd.DataFrame) -> str | None:
    """What separates two results as multisets of rows; None if nothing does."""
    columns = sorted(expected.columns)
    if sorted(actual.columns) != columns:
        return f"columns {sorted(actual.columns)} != {columns}"
    if len(actual) != len(expected):
        return f"{len(actual)} rows != {len(expected)}"

    def rows(df: pd.DataFrame) -> pd.Series:
        text = df[columns].astype(object).where(df[columns].notna(), None)
        return text.apply(lambda row: tuple(map(str, row)), axis=1).value_counts()

    left, right = rows(actual), rows(expected)
    if not left.sort_index().equals(right.sort_index()):
        only = left.sub(right, fill_value=0)
        return f"rows differ, e.g. {only[only != 0].head(3).to_dict()}"
    return None


def check(
    spark: SparkSession, connection: duckdb.DuckDBPyConnection, name: str, sf_dir: str
) -> str | None:
    actual = QUERIES[name](spark, sf_dir).toPandas()
    if name not in ORACLE_SQL:
        return None if len(actual) else "no rows"
    return difference(actual, connection.execute(ORACLE_SQL[name]).df())


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="checks-"))
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failed = 0
    for name in names:
        start = time.perf_counter()
        problem = check(spark, connection, name, sf_dir)
        failed += problem is not None
        print(f"{name:28s} {time.perf_counter() - start:6.2f}s  {problem or 'ok'}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    sys.exit(failed > 0)


if __name__ == "__main__":
    main()
