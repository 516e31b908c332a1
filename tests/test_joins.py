from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from retail_strata import plans
from retail_strata.operators import attach_customer_key, enrich_with_customer, left_join
from tests.helpers import rows

CUSTOMERS = "customer_id string, full_name string, email string, city string, state string"


@pytest.fixture
def bronze(spark):
    frames = {
        "customers": ([("c1", "One", "One@X", "Ohio", "OH")], CUSTOMERS),
        "products": ([("p1", "Pan"), ("p9", "Unsold")], "product_id string, product_name string"),
        "orders": (
            [
                ("o1", "2025-02-07", "c1", "10.00", "SHIPPED"),
                ("o2", "2025-02-07", "unknown", "5.00", "PENDING"),
                ("o3", "2025-02-07", "c1", "-1.00", "SHIPPED"),
                ("o4", "2025-02-07", None, "7.00", "SHIPPED"),
                ("o5", "2025-02-07", "c1", "3.00", "CANCELLED"),
            ],
            "order_id string, order_date string, customer_id string, total_amount string, "
            "order_status string",
        ),
        "order_items": (
            [
                ("i1", "o1", "p1", "2", "5.00"),
                ("i2", "o2", "p1", "1", "5.00"),
                ("i3", "o3", "p1", "1", "1.00"),
                ("i4", "o4", "p8", "1", "7.00"),
                ("i5", "o5", "p1", "1", "3.00"),
                ("i6", "lost", "p1", "1", "3.00"),
                ("i7", "o1", "p1", "0", "3.00"),
            ],
            "order_item_id string, order_id string, product_id string, quantity string, "
            "unit_price string",
        ),
    }
    raw = {name: spark.createDataFrame(data, schema) for name, (data, schema) in frames.items()}
    return plans.build_bronze(raw, ingest_ts=F.lit("now"))


def ids(df, column="order_item_id"):
    return sorted(row[0] for row in df.select(column).collect())


def test_items_keep_orders_of_unknown_customers(bronze):
    silver = plans.build_silver(bronze)
    assert ids(silver["order_items"]) == ["i1", "i2", "i4", "i5"]
    assert ids(silver["orders"], "order_id") == ["o1", "o5"]
    assert silver["order_items"].columns == [
        "order_id",
        "order_item_id",
        "product_id",
        "quantity",
        "unit_price",
        "order_items_ingest_timestamp",
        "order_date",
        "customer_id",
        "total_amount",
        "order_status",
        "orders_ingest_timestamp",
    ]


def test_products_fan_out_to_sold_items(bronze):
    products = plans.build_silver(bronze)["products"]
    assert ids(products) == ["i1", "i2", "i5"]
    assert products.columns[:3] == ["product_id", "product_name", "products_ingest_timestamp"]


def test_gold_has_active_lines_and_null_geography_for_unknown_customers(bronze):
    silver = plans.build_silver(bronze)
    gold = plans.build_gold(silver["order_items"], silver["customers"])
    assert rows(gold.select("order_item_id", "customer_id", "city", "state")) == {
        ("i1", "c1", "Ohio", "OH"): 1,
        ("i2", "unknown", None, None): 1,
    }
    assert "orders_source_system" not in gold.columns
    assert gold.columns[:4] == ["customer_id", "product_id", "order_id", "order_item_id"]


def test_gold_from_cleaned_entities_has_the_rows_of_gold_from_silver(spark, bronze):
    columns = bronze["customers"].columns
    more = spark.createDataFrame(
        [("c1", "Two", "Two@X", "Ohio", "OH"), ("c1", "One", "One@X", "Rome", None), (None, "N", "n@X", "Nil", "NI")],
        CUSTOMERS,
    )
    more = more.withColumns({"ingest_timestamp": F.lit("now"), "source": F.lit("generated")})
    bronze["customers"] = bronze["customers"].union(more.select(columns))
    for entity in ("orders", "order_items"):
        bronze[entity] = bronze[entity].union(bronze[entity].limit(2))
    orders = bronze["orders"]
    bronze["orders"] = orders.union(orders.where("order_id = 'o1'").withColumn("order_status", F.lit("PENDING")))
    clean = plans.clean_entities(bronze)
    silver = plans.build_silver(bronze)
    expected = plans.build_gold(silver["order_items"], silver["customers"])
    gold = plans.build_gold_from_clean(clean)
    assert gold.columns == expected.columns
    assert rows(gold) == rows(expected)
    assert gold.count() == 7
    with pytest.raises(ValueError, match="customers lacks city"):
        plans.build_gold_from_clean({**clean, "customers": clean["customers"].drop("city")})


@pytest.mark.parametrize("absent", ["customers", "products", "orders", "order_items"])
def test_a_missing_entity_leaves_its_joins_out(bronze, absent):
    del bronze[absent]
    silver = plans.build_silver(bronze)
    assert set(silver) == {"customers", "products", "orders", "order_items"} - {absent}
    if absent == "orders":
        assert "customer_id" not in silver["order_items"].columns
        assert ids(silver["products"]) == ["i1", "i2", "i3", "i5", "i6"]
        with pytest.raises(ValueError, match="silver order_items lacks customer_id"):
            plans.build_gold(silver["order_items"], silver["customers"])
    if absent == "customers":
        assert ids(silver["orders"], "order_id") == ["o1", "o2", "o4", "o5"]


def test_cloud_gold_without_a_status_keeps_every_valid_item(bronze):
    silver = plans.build_cloud_silver(bronze)
    orders = silver["orders"].drop("order_status")
    gold = plans.build_gold_from_parts(silver["order_items"], orders, silver["customers"])
    assert rows(gold.select("order_item_id", "customer_id", "full_name")) == {
        ("i1", "c1", "One"): 1,
        ("i2", "unknown", None): 1,
        ("i3", None, None): 1,
        ("i4", None, None): 1,
        ("i5", "c1", "One"): 1,
        ("i6", None, None): 1,
    }
    assert silver["customers"].first()["email"] == "One@X"


def test_cloud_gold_pairs_repeated_orders_and_customers(spark):
    items = spark.createDataFrame(
        [("i1", "o1"), ("i2", "o2"), ("i3", None), ("i4", "lost")], "order_item_id string, order_id string"
    )
    orders = spark.createDataFrame(
        [("o1", "c1"), ("o1", "c2"), ("o1", "c1"), ("o2", None), (None, "c1")], "order_id string, customer_id string"
    )
    customers = spark.createDataFrame(
        [("c1", "A"), ("c1", "B"), (None, "N")], "customer_id string, name string"
    )
    gold = plans.build_gold_from_parts(items, orders, customers)
    assert gold.columns == ["order_id", "order_item_id", "customer_id", "name"]
    keyed = items.join(orders, "order_id", "left")
    assert rows(gold) == rows(keyed.join(customers, "customer_id", "left").select(*gold.columns))


def test_cloud_gold_with_a_status_drops_null_keys_and_cancelled(bronze):
    silver = plans.build_cloud_silver(bronze)
    status = F.when(F.col("order_item_id") == "i5", "CANCELLED").otherwise("SHIPPED")
    items = silver["order_items"].withColumn("order_status", status)
    gold = plans.build_gold_from_parts(items, silver["orders"], silver["customers"])
    assert ids(gold) == ["i1", "i2"]


def test_cloud_gold_names_the_missing_key(bronze):
    silver = plans.build_cloud_silver(bronze)
    with pytest.raises(ValueError, match="orders lacks customer_id"):
        plans.build_gold_from_parts(
            silver["order_items"], silver["orders"].drop("customer_id"), silver["customers"]
        )


def test_columns_follow_the_left_side(spark):
    items = spark.createDataFrame([("i1", "c1")], "order_item_id string, customer_id string")
    customers = spark.createDataFrame([("Ohio", "c1")], "city string, customer_id string")
    assert enrich_with_customer(items, customers).columns == ["order_item_id", "customer_id", "city"]
    orders = spark.createDataFrame([("o1", "c1", 1)], "order_id string, customer_id string, x int")
    keyed = attach_customer_key(items.withColumnRenamed("customer_id", "order_id"), orders)
    assert keyed.columns == ["order_id", "order_item_id", "customer_id"]


KEYS = st.one_of(st.none(), st.sampled_from("aaabc"))


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    left=st.lists(KEYS, max_size=12),
    right=st.lists(KEYS, max_size=25),
    rows_per_split=st.integers(1, 4),
)
def test_split_keys_give_the_plain_left_join(spark, left, right, rows_per_split):
    lefts = spark.createDataFrame(list(enumerate(left)), "l int, k string")
    # Some right rows are identical, so the hash deals them to one split.
    rights = spark.createDataFrame([(i % 7, k) for i, k in enumerate(right)], "r int, k string")
    actual = left_join(lefts, rights, "k", ["r"], rows_per_split=rows_per_split)
    assert rows(actual) == rows(lefts.join(rights, "k", "left"))


def test_every_frequent_key_is_split_and_no_job_runs_before(spark, conf):
    conf(adaptive__enabled="false", shuffle__partitions="32")
    # 600 keys of 40 rows each, one of 1/5,000 of the rows with 40 too, and others with one row.
    n = 200_000
    key = (
        F.when(F.col("id") < 24_000, F.col("id") % 600)
        .when(F.col("id") < 24_040, F.lit(-1))
        .otherwise(F.col("id"))
    )
    right = spark.range(0, n, 1, 8).select(key.alias("k"), F.col("id").alias("r"))
    left = right.select("k").distinct()
    context = spark.sparkContext
    context.setJobGroup("plan", "building a plan")
    joined = left_join(left, right, "k", ["r"], rows_per_split=20)
    assert not context.statusTracker().getJobIdsForGroup("plan")
    placed = joined.select("k", F.spark_partition_id().alias("task"))
    tasks = placed.groupBy("k").agg(
        F.count("*").alias("rows"), F.countDistinct("task").alias("tasks")
    )
    found = {r["k"]: r for r in tasks.filter("rows > 1").collect()}
    assert set(found) == {*range(600), -1}
    assert all(r["rows"] == 40 for r in found.values())
    # Two splits of a key meet in one of 32 partitions by chance.
    assert sum(r["tasks"] > 1 for r in found.values()) > 550
    assert joined.count() == n
