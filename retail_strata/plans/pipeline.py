"""The whole run: newest raw CSV -> bronze -> silver -> gold, each table written once.

A layer's tables are written before the next layer starts; those that do not depend on each other
are written at the same time. Later steps read what was written, so no plan is computed twice and
a lost executor costs a task, not a recomputation from raw. Any failure is raised and stops the
run. Each table is written under the run's id, beside those of earlier runs of the date, which stay
as they were. A run that failed is taken up again under its id: layers that it completed are not
run again. Layers that are run by themselves, without an id, read the run completed last.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession

from retail_strata import storage
from retail_strata.functions.dates import parse_run_date
from retail_strata.operators.joins import silver_products
from retail_strata.plans.bronze import build_bronze
from retail_strata.plans.gold import build_gold
from retail_strata.plans.marts import (
    gold_customers,
    gold_order_items,
    gold_orders,
    gold_products,
    sales_by_city,
)
from retail_strata.plans.silver import clean_entities, join_entities
from retail_strata.schemas import ENTITIES, GOLD_ORDER_LINES, GOLD_SALES_BY_CITY, layer_table
from retail_strata.session import scratch_path
from retail_strata.sinks.tables import new_run_id, write_layer
from retail_strata.sources.latest import read_latest
from retail_strata.sources.tables import read_entities, read_layer

LOG = logging.getLogger(__name__)


def landing_folder(landing: str, entity: str, run_date: str | dt.date) -> str:
    """``<landing>/raw_<entity>/<yyyymmdd>``."""
    day = parse_run_date(run_date).strftime("%Y%m%d")
    return f"{landing.rstrip('/')}/{layer_table('raw', entity)}/{day}"


def run_bronze(
    spark: SparkSession,
    landing: str,
    warehouse: str,
    run_date: str | dt.date,
    ingest_ts: Column | dt.datetime | None = None,
    on_missing: str = "skip",
    run_id: str | None = None,
) -> dict[str, DataFrame]:
    run_id = run_id or new_run_id()
    raw = read_entities(
        lambda entity: read_latest(spark, landing_folder(landing, entity, run_date)),
        ENTITIES,
        on_missing,
    )
    tables = build_bronze(raw, ingest_ts)
    return _write_entities(spark, tables, warehouse, "bronze", run_date, run_id)


def run_silver(
    spark: SparkSession,
    warehouse: str,
    run_date: str | dt.date,
    on_missing: str = "skip",
    run_id: str | None = None,
) -> dict[str, DataFrame]:
    """The referential joins, each fed from tables already written.

    Valid orders feed two joins and are no output themselves, so they go to the scratch folder.
    """
    bronze = _read_entities(spark, warehouse, "bronze", run_date, on_missing, run_id=run_id)
    run_id = run_id or new_run_id()
    clean = clean_entities(bronze)

    silver: dict[str, DataFrame] = {}

    def write(tables: dict[str, DataFrame]) -> None:
        silver.update(_write_entities(spark, tables, warehouse, "silver", run_date, run_id))

    def stage_orders() -> None:
        if "orders" in clean:
            path = scratch_path(spark, "valid-orders")
            clean["orders"].write.parquet(path, compression=storage.PARQUET_CODEC)
            clean["orders"] = spark.read.parquet(path)

    customers = {entity: df for entity, df in clean.items() if entity == "customers"}
    together(spark, [partial(write, customers), stage_orders])

    joined = join_entities({**clean, **silver})
    write({entity: joined[entity] for entity in ("orders", "order_items") if entity in joined})
    if "products" in clean:
        products = clean["products"]
        if "order_items" in silver:
            products = silver_products(products, silver["order_items"])
        write({"products": products})
    return silver


def run_gold(
    spark: SparkSession, warehouse: str, run_date: str | dt.date, run_id: str | None = None
) -> DataFrame:
    """Gold order lines, and the marts made of them. Items and customers must exist.

    The mart of products needs the products as well and is left out without them.
    """
    silver = _read_entities(
        spark, warehouse, "silver", run_date, "fail", ["customers", "order_items"], run_id
    )
    products = _read_entities(spark, warehouse, "silver", run_date, "skip", ["products"], run_id)
    run_id = run_id or new_run_id()
    write_layer(
        build_gold(silver["order_items"], silver["customers"]),
        warehouse,
        GOLD_ORDER_LINES,
        run_date,
        run_id,
    )
    gold = read_layer(spark, warehouse, GOLD_ORDER_LINES, run_date, run_id)
    marts = {
        GOLD_SALES_BY_CITY: sales_by_city(gold),
        layer_table("gold", "customers"): gold_customers(gold),
        layer_table("gold", "orders"): gold_orders(gold),
        layer_table("gold", "order_items"): gold_order_items(gold),
    }
    if "products" in products:
        marts[layer_table("gold", "products")] = gold_products(gold, products["products"])
    together(
        spark,
        [
            partial(write_layer, df, warehouse, table, run_date, run_id)
            for table, df in marts.items()
        ],
    )
    return gold


def run_pipeline(
    spark: SparkSession,
    landing: str,
    warehouse: str,
    run_date: str | dt.date,
    ingest_ts: Column | dt.datetime | None = None,
    on_missing: str = "skip",
    run_id: str | None = None,
) -> DataFrame:
    """All layers in order; returns the gold order lines.

    A run that broke off is continued by giving its ``run_id`` again (it is in the log).
    """
    run_id = run_id or new_run_id()
    LOG.info("run %s of %s", run_id, run_date)
    layers: list[tuple[str, Callable[[], object]]] = [
        ("bronze", partial(run_bronze, spark, landing, warehouse, run_date, ingest_ts, on_missing, run_id)),
        ("silver", partial(run_silver, spark, warehouse, run_date, on_missing, run_id)),
        ("gold", partial(run_gold, spark, warehouse, run_date, run_id)),
    ]
    for layer, run in layers:
        done = layer_marker(warehouse, run_date, run_id, layer)
        if storage.exists(spark, done):
            LOG.info("run %s: %s is complete", run_id, layer)
            continue
        try:
            run()
        except Exception:
            LOG.error("run %s stopped in %s; run it again under this id", run_id, layer)
            raise
        storage.touch(spark, done)
    return read_layer(spark, warehouse, GOLD_ORDER_LINES, run_date, run_id)


def layer_marker(warehouse: str, run_date: str | dt.date, run_id: str, layer: str) -> str:
    """The file that says that a run has completed a layer."""
    day = parse_run_date(run_date).isoformat()
    return f"{warehouse.rstrip('/')}/_runs/{day}/{run_id}/{layer}"


def together(spark: SparkSession, actions: Sequence[Callable[[], object]]) -> None:
    """Run independent Spark actions at the same time; the first failure is raised."""
    inherit = inheritable_thread_target(spark)
    if inherit is spark:  # Python threads are not pinned to JVM threads: nothing to inherit.
        inherit = partial
    with ThreadPoolExecutor(max_workers=max(len(actions), 1)) as pool:
        for done in [pool.submit(inherit(action)) for action in actions]:
            done.result()


def _read_entities(
    spark: SparkSession,
    warehouse: str,
    layer: str,
    run_date: str | dt.date,
    on_missing: str = "skip",
    entities: Sequence[str] = ENTITIES,
    run_id: str | None = None,
) -> dict[str, DataFrame]:
    return read_entities(
        lambda entity: read_layer(spark, warehouse, layer_table(layer, entity), run_date, run_id),
        entities,
        on_missing,
    )


def _write_entities(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    warehouse: str,
    layer: str,
    run_date: str | dt.date,
    run_id: str | None = None,
) -> dict[str, DataFrame]:
    """Write a layer's tables side by side and return them as read back."""
    together(
        spark,
        [
            partial(write_layer, df, warehouse, layer_table(layer, entity), run_date, run_id)
            for entity, df in tables.items()
        ],
    )
    return _read_entities(spark, warehouse, layer, run_date, "fail", list(tables), run_id)
