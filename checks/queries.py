"""One query per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.dirty import raw_orders, raw_products, raw_tables
from retail_strata import operators as ops
from retail_strata import plans, sinks, sources
from retail_strata.functions import (
    date_folder,
    object_bucket,
    object_prefix,
    refined_name,
    run_date_column,
    run_stamp,
)
from retail_strata.plans.pipeline import landing_folder
from retail_strata.schemas import CLOUD_SCHEMAS, ENTITIES, GOLD_COLUMNS, GOLD_SALES_BY_CITY
from retail_strata.session import scratch_path
from retail_strata.sources.csv import bind_schema

RUN_DATE = "2025-02-07"
ONE_DATE = "1995-03-15"
EVENT_DATE = "2024-01-12"
PURGED_DATE = "2024-01-15"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def ingest_ts() -> Column:
    return F.expr("timestamp'2025-02-07 10:00:00'")


def text_times(df: DataFrame) -> DataFrame:
    """Timestamps as text, so that no session time zone enters the comparison."""
    return df.select(
        *[
            F.col(field.name).cast("string").alias(field.name)
            if isinstance(field.dataType, T.TimestampType)
            else F.col(field.name)
            for field in df.schema.fields
        ]
    )


def bronze(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return plans.build_bronze(raw_tables(spark, sf_dir), ingest_ts())


def clean(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return plans.clean_entities(bronze(spark, sf_dir))


def silver(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return plans.build_silver(bronze(spark, sf_dir))


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = silver(spark, sf_dir)
    return plans.build_gold(tables["order_items"], tables["customers"])


def cloud_raw(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The raw tables under the cloud variant's column names and types."""
    renames = {
        "full_name": "name",
        "product_name": "name",
        "unit_price": "price",
    }
    return {
        entity: bind_schema(df.withColumnsRenamed(renames), CLOUD_SCHEMAS[entity])
        for entity, df in raw_tables(spark, sf_dir).items()
    }


def cloud_silver(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return plans.build_cloud_silver(cloud_raw(spark, sf_dir))


# Sources and sinks


@query
def csv_scan_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv-strings")
    sinks.write_csv(raw_orders(spark, sf_dir), path, compact=True)
    return sources.read_csv(spark, path)


def typed_csv(spark: SparkSession, sf_dir: str) -> str:
    """Path of the orders as CSV."""
    path = scratch_path(spark, "csv-typed")
    sinks.write_csv(raw_orders(spark, sf_dir), path)
    return path


def read_typed_csv(spark: SparkSession, path: str) -> DataFrame:
    return sources.read_entity(spark, path, "orders")


@query
def csv_scan_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_typed_csv(spark, typed_csv(spark, sf_dir))


@query
def csv_scan_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the orders under one header, the others in another order with one column more."""
    path = scratch_path(spark, "csv-mixed")
    orders = raw_orders(spark, sf_dir)
    even = F.col("order_id").cast("bigint") % 2 == 0
    narrow = orders.filter(even).select("order_id", "customer_id", "order_date", "total_amount")
    wide = orders.filter(~even).select(
        "order_status", "total_amount", "order_date", "order_id", "customer_id"
    )
    sinks.write_csv(narrow, f"{path}/narrow")
    sinks.write_csv(wide, f"{path}/wide")
    return sources.read_entity(spark, [f"{path}/narrow", f"{path}/wide"], "orders")


@query
def newest_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "batches")
    products = raw_products(spark, sf_dir)
    sinks.write_csv(products, f"{folder}/raw_products_20250207_090000.csv")
    sinks.write_csv(
        ops.clean_entity(products, "products"), f"{folder}/raw_products_20250207_100000.csv"
    )
    return sources.read_latest(spark, folder)


@query
def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id",
        "user_id",
        "value",
        F.col("event_type").alias("entity"),
        F.col("ts").cast("date").cast("string").alias("folder"),
        F.hour("ts").alias("file"),
        "ts",
    )
    newest = sources.latest_snapshot(events, ["entity", "folder"], file="file", modified="ts")
    return newest.drop("ts")


@query
def latest_snapshot_null_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by priority and month, where some have no folder and some no file."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("folder"),
        F.when(F.col("o_custkey") % 3 != 0, F.col("o_orderpriority")).alias("file"),
        F.col("o_orderdate").cast("date").alias("modified"),
    )
    newest = sources.latest_snapshot(orders, ["folder"], file="file", modified="modified")
    return newest.withColumn("modified", F.col("modified").cast("string"))


def dated_events(spark: SparkSession, sf_dir: str) -> str:
    """Root of a layer holding ``events`` as one partition per day."""
    root = scratch_path(spark, "dated")
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id", "user_id", "event_type", "value", F.col("ts").cast("date").alias("ingest_date")
    )
    sinks.write_dated(events, f"{root}/events", "ingest_date")
    return root


def read_dated(spark: SparkSession, root: str) -> DataFrame:
    return sources.read_partition(spark, root, "events", EVENT_DATE).withColumn(
        "ingest_date", date_folder(F.col("ingest_date"))
    )


@query
def dated_partition_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_dated(spark, dated_events(spark, sf_dir))


#: Of queries that write their own input first: what writes it, and what reads it.
READS = {
    "csv_scan_typed": (typed_csv, read_typed_csv),
    "dated_partition_read": (dated_events, read_dated),
}


@query
def published_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "published")
    orders = clean(spark, sf_dir)["orders"]
    sinks.publish(raw_orders(spark, sf_dir), path, "20250207_090000")
    sinks.publish(text_times(orders), path, "20250207_100000")
    return sources.read_published(spark, path)


@query
def fanout_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "fanout-out")
    paths = [f"{root}/gold_{entity}" for entity in ENTITIES]
    sinks.write_fanout(text_times(plans.build_gold_from_clean(clean(spark, sf_dir))), paths)
    outputs = [
        sources.read_csv(spark, path).withColumn("output", F.lit(entity))
        for entity, path in zip(ENTITIES, paths, strict=True)
    ]
    return reduce(DataFrame.unionByName, outputs)


@query
def preview_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows the preview has, and how many of them are the table's."""
    table = clean(spark, sf_dir)["order_items"].drop("order_items_ingest_timestamp")
    path = scratch_path(spark, "preview")
    sinks.preview(table).write.parquet(path)
    shown = spark.read.parquet(path)
    known = table.select("order_item_id").distinct().withColumn("known", F.lit(1))
    return shown.join(known, "order_item_id", "left").agg(
        F.count(F.lit(1)).alias("shown"), F.count("known").alias("found")
    )


@query
def object_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select(
        "page_id", object_bucket(url).alias("bucket"), object_prefix(url).alias("prefix")
    )


@query
def refined_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw table names of the orders, by status, as bronze calls them; others stay as they are."""
    status = F.lower("order_status")
    name = F.when(F.col("order_id").cast("bigint") % 5 == 0, F.concat(F.lit("old_raw_"), status))
    return raw_orders(spark, sf_dir).select(
        "order_id", refined_name(F.coalesce(name, F.concat(F.lit("raw_"), status))).alias("table_name")
    )


@query
def skipped_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the entities that have a file, when those without one are left out."""
    found = sources.read_entities(landed(spark, sf_dir, ["customers", "products"]), ENTITIES)
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(entity).alias("entity"), "rows")
        for entity, df in found.items()
    ]
    return reduce(DataFrame.unionByName, counts)


@query
def missing_input_fails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the error names, beside the entities that have a file."""
    read = landed(spark, sf_dir, ["orders"])
    try:
        sources.read_entities(read, ENTITIES, on_missing="fail")
        message = "no error"
    except sources.MissingInputError as error:
        message = str(error)
    return read("orders").select("order_id", F.lit(message).alias("message"))


@query
def missing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the column check says of a table without its status, beside the rows of that table."""
    orders = raw_orders(spark, sf_dir).drop("order_status")
    try:
        ops.require_columns(orders, ["order_id", "order_status"], "orders")
        message = "no error"
    except ValueError as error:
        message = str(error)
    checked = ops.require_columns(orders, ["order_id"], "orders")
    return checked.select("order_id", F.lit(message).alias("message"))


def landed(
    spark: SparkSession, sf_dir: str, entities: list[str]
) -> Callable[[str], DataFrame | None]:
    """Reads an entity's newest landed file, of which only some entities have one."""
    landing = scratch_path(spark, "landed")
    for entity in entities:
        table = raw_tables(spark, sf_dir)[entity]
        sinks.write_csv(table, f"{landing}/raw_{entity}/raw_{entity}.csv")
    return lambda entity: sources.read_latest(spark, f"{landing}/raw_{entity}")


# Bronze


@query
def bronze_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_times(bronze(spark, sf_dir)["customers"])


@query
def bronze_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_times(bronze(spark, sf_dir)["products"])


@query
def bronze_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_times(bronze(spark, sf_dir)["orders"])


@query
def bronze_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_times(bronze(spark, sf_dir)["order_items"])


@query
def ingest_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of a table has the same ingestion time, and each has one."""
    tables = plans.build_bronze(raw_tables(spark, sf_dir))
    counts = [
        df.groupBy("ingest_timestamp")
        .agg(F.count(F.lit(1)).alias("rows"))
        .agg(
            F.count("ingest_timestamp").alias("times"),
            F.count_if(F.col("ingest_timestamp").isNull()).alias("nulls"),
            F.sum("rows").alias("rows"),
        )
        .withColumn("entity", F.lit(entity))
        for entity, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


# Silver


@query
def clean_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = bronze(spark, sf_dir)["orders"].withColumn("source_system", F.col("source"))
    return text_times(ops.clean_entity(tagged, "orders"))


@query
def dedupe_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.clean_entity(raw_tables(spark, sf_dir)["order_items"], "order_items")


@query
def silver_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_times(silver(spark, sf_dir)["customers"])


@query
def customer_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(spark, sf_dir)["customers"].select("customer_id", "city", "state")


@query
def silver_orders_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_times(clean(spark, sf_dir)["orders"])


@query
def silver_items_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_times(clean(spark, sf_dir)["order_items"])


@query
def silver_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_times(silver(spark, sf_dir)["order_items"])


@query
def silver_order_items_one_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dedupe and join from the parts: the join shuffles by itself, so that it can be split."""
    tables = plans.clean_entities(bronze(spark, sf_dir))
    return text_times(ops.silver_order_items(tables["order_items"], tables["orders"]))


@query
def silver_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_times(silver(spark, sf_dir)["orders"])


@query
def silver_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_times(silver(spark, sf_dir)["products"])


@query
def silver_missing_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = bronze(spark, sf_dir)
    del tables["orders"]
    return text_times(plans.build_silver(tables)["products"])


@query
def select_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_times(ops.select_existing(silver(spark, sf_dir)["order_items"], GOLD_COLUMNS))


# Gold


@query
def gold_final_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_times(gold(spark, sf_dir))


@query
def gold_sales_by_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _float_money(plans.sales_by_city(gold(spark, sf_dir)))


@query
def gold_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _float_money(plans.gold_customers(gold(spark, sf_dir)))


@query
def gold_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _float_money(plans.gold_orders(gold(spark, sf_dir)))


@query
def gold_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _float_money(plans.gold_order_items(gold(spark, sf_dir)))


@query
def gold_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = clean(spark, sf_dir)["products"]
    return _float_money(plans.gold_products(gold(spark, sf_dir), products))


def _float_money(df: DataFrame) -> DataFrame:
    """Exact decimal sums, shown as doubles: the engines agree on those in any result format."""
    return df.select(
        *[
            F.col(field.name).cast("double").alias(field.name)
            if isinstance(field.dataType, T.DecimalType)
            else F.col(field.name)
            for field in df.schema.fields
        ]
    )


# Cloud variant


@query
def silver_cloud_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cloud_silver(spark, sf_dir)["customers"]


@query
def silver_cloud_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cloud_silver(spark, sf_dir)["products"]


@query
def silver_cloud_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cloud_silver(spark, sf_dir)["orders"]


@query
def silver_cloud_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cloud_silver(spark, sf_dir)["order_items"]


@query
def items_with_customer_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = cloud_silver(spark, sf_dir)
    return ops.attach_customer_key(tables["order_items"], tables["orders"])


@query
def gold_cloud_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = cloud_silver(spark, sf_dir)
    return plans.build_gold_from_parts(
        tables["order_items"], tables["orders"], tables["customers"]
    )


@query
def active_orders_optional(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = cloud_silver(spark, sf_dir)
    orders = clean(spark, sf_dir)["orders"]
    keyed = ops.left_join(tables["order_items"], orders, "order_id", ["customer_id", "order_status"])
    return ops.active_orders(
        ops.enrich_with_customer(keyed, tables["customers"]), if_present=True
    )


@query
def cloud_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing, warehouse = scratch_path(spark, "cloud-landing"), scratch_path(spark, "cloud")
    for entity, df in cloud_raw(spark, sf_dir).items():
        path = f"{landing}/raw_{entity}/raw_{entity}_20250207_100000.csv"
        sinks.write_csv(df, path, compression="gzip")
    plans.run_cloud_silver(spark, landing, warehouse, "20250207_100000", on_missing="fail")
    paths = plans.run_cloud_gold(spark, warehouse)
    schema = {**CLOUD_SCHEMAS["order_items"], **CLOUD_SCHEMAS["customers"]}
    outputs = [
        bind_schema(sources.read_csv(spark, path), schema).withColumn("output", F.lit(entity))
        for entity, path in zip(ENTITIES, paths, strict=True)
    ]
    return reduce(DataFrame.unionByName, outputs)


# Functions, keys, purge


@query
def run_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = run_date_column(F.col("order_date"))
    return raw_orders(spark, sf_dir).select(
        "order_id",
        date_folder(day).alias("folder"),
        run_stamp(day.cast("timestamp_ntz") + F.expr("interval 10 hours 15 minutes")).alias(
            "stamp"
        ),
        run_date_column(F.col("total_amount")).cast("string").alias("not_a_date"),
    )


@query
def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return ops.assign_surrogate_keys(customers, ["c_custkey"], last_id=10000)


@query
def surrogate_keys_with_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipped = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.col("l_shipdate").cast("date").cast("string").alias("ship_date")
    )
    return ops.assign_surrogate_keys(shipped, ["ship_date"], last_id=0)


@query
def surrogate_keys_two_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches of customers, the first of which comes again in another order."""
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    odd = customers.filter("c_custkey % 2 = 1")
    batches = ops.KeyedBatches(spark, scratch_path(spark, "keyed"), "customers")
    batches.add("odd", odd, ["c_custkey"])
    batches.add("even", customers.filter("c_custkey % 2 = 0"), ["c_name", "c_custkey"])
    batches.add("odd", odd, ["c_name"])
    (mark,) = ops.high_water_marks(spark, batches.marks()).filter("entity = 'customers'").select("last_id").first()
    return batches.rows().withColumn("mark", F.lit(mark))


@query
def high_water_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = ops.high_water_marks(spark)
    for entity, table, key in [
        ("customers", "customer", "c_custkey"),
        ("products", "part", "p_partkey"),
    ]:
        batch = spark.read.parquet(f"{sf_dir}/{table}.parquet").select(key)
        keyed = ops.assign_surrogate_keys(batch, [key])
        marks = ops.advance_mark(marks, entity, keyed)
    return marks


def _purged() -> Column:
    return (F.col("order_date") == ONE_DATE) | (F.col("order_status") == "CANCELLED")


@query
def purge_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.purge_rows(raw_orders(spark, sf_dir), _purged())


@query
def purge_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.purge_counts(raw_orders(spark, sf_dir), _purged())


@query
def purge_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "purge")
    sinks.publish(raw_orders(spark, sf_dir), path, "20250207_090000")
    ops.purge_published(spark, path, _purged(), "20250207_100000", dry_run=False)
    return sources.read_published(spark, path)


@query
def purge_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = dated_events(spark, sf_dir)
    ops.purge_partition(spark, root, "events", EVENT_DATE, dry_run=False)
    return spark.read.parquet(f"{root}/events").withColumn(
        "ingest_date", date_folder(F.col("ingest_date"))
    )


@query
def purge_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some users' events go from all dates, one date goes whole; one date has a run besides."""
    root = scratch_path(spark, "purge-layer")
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id", "user_id", "event_type", "value", F.col("ts").cast("date").alias("ingest_date")
    )
    sinks.write_dated(events, f"{root}/events", "ingest_date")
    again = sources.read_partition(spark, root, "events", EVENT_DATE).drop("ingest_date")
    sinks.write_layer(again.withColumn("value", F.col("value") + 1), root, "events", EVENT_DATE, "r1")
    gone = (F.col("user_id") % 7 == 0) | (F.col("ingest_date") == F.lit(PURGED_DATE).cast("date"))
    ops.purge_layer(spark, root, "events", gone, dry_run=False)
    files = spark.read.option("recursiveFileLookup", True).parquet(f"{root}/events")
    return files.withColumn(
        "folder", F.regexp_extract(F.col("_metadata.file_path"), "/ingest_date=(.*)/[^/]*$", 1)
    )


# Whole pipeline


def land(spark: SparkSession, sf_dir: str, landing: str) -> None:
    for entity, df in raw_tables(spark, sf_dir).items():
        folder = landing_folder(landing, entity, RUN_DATE)
        sinks.write_csv(df, f"{folder}/raw_{entity}_20250207_100000.csv", compression="gzip")


@query
def pipeline_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing, warehouse = scratch_path(spark, "landing"), scratch_path(spark, "warehouse")
    land(spark, sf_dir, landing)
    return text_times(
        plans.run_pipeline(spark, landing, warehouse, RUN_DATE, ingest_ts(), on_missing="fail")
    )


@query
def rerun_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of a date: the newest is read, and the first is still there."""
    landing, warehouse = scratch_path(spark, "landing"), scratch_path(spark, "warehouse")
    land(spark, sf_dir, landing)
    earlier = F.expr("timestamp'2025-02-07 09:00:00'")
    for run_id, time in (("run_1", earlier), ("run_2", ingest_ts())):
        plans.run_bronze(spark, landing, warehouse, RUN_DATE, time, "fail", run_id)
    runs = {
        name: sources.read_layer(spark, warehouse, "refined_orders", RUN_DATE, run_id)
        for name, run_id in (("newest", None), ("first", "run_1"))
    }
    return reduce(
        DataFrame.unionByName,
        [text_times(df).withColumn("run", F.lit(name)) for name, df in runs.items()],
    )


@query
def written_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales by city as the whole run wrote them."""
    landing, warehouse = scratch_path(spark, "landing"), scratch_path(spark, "warehouse")
    land(spark, sf_dir, landing)
    plans.run_pipeline(
        spark, landing, warehouse, RUN_DATE, ingest_ts(), on_missing="fail", run_id="run_1"
    )
    return _float_money(sources.read_layer(spark, warehouse, GOLD_SALES_BY_CITY, RUN_DATE))
