from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame


def rows(df: DataFrame) -> Counter:
    """The rows of a small frame as a multiset."""
    return Counter(tuple(row) for row in df.collect())


def plan(df: DataFrame, mode: str = "formatted") -> str:
    jvm = df.sparkSession._jvm
    explain = jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    return df._jdf.queryExecution().explainString(explain)


def final_plan(df: DataFrame) -> str:
    """The physical plan as adaptive execution left it after running ``df`` itself."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
