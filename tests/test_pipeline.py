from __future__ import annotations

import datetime as dt

import pytest

from retail_strata import plans
from retail_strata.schemas import GOLD_ORDER_LINES
from retail_strata.sources import MissingInputError, read_layer
from tests.helpers import rows

NOON = dt.datetime(2025, 2, 7, 12)
DAY = "2025-02-07"

# The raw CSV headers.
RAW_COLUMNS = {
    "customers": ["customer_id", "full_name", "email", "address", "city", "state"],
    "products": ["product_id", "product_name", "category", "price"],
    "orders": ["order_id", "order_date", "customer_id", "total_amount", "order_status"],
    "order_items": ["order_item_id", "order_id", "product_id", "quantity", "unit_price"],
}

ROWS = {
    "customers": ["1,Ann,Ann@X.com,1 Main St,Ohio,OH", "1,Ann,Ann@X.com,1 Main St,Ohio,OH"],
    "products": ["7,Pan,Kitchen,9.99"],
    "orders": [
        "100,2025-02-07,1,20.00,SHIPPED",
        "101,2025-02-07,2,5.00,PENDING",
        "102,2025-02-07,1,5.00,CANCELLED",
        "103,2025-02-07,1,-5.00,SHIPPED",
    ],
    "order_items": ["1,100,7,2,10.00", "2,101,7,1,5.00", "3,102,7,1,5.00", "4,103,7,1,5.00", "5,100,7,0,1.00"],
}


@pytest.fixture
def landing(tmp_path):
    for entity, lines in ROWS.items():
        folder = tmp_path / "landing" / f"raw_{entity}" / "20250207"
        folder.mkdir(parents=True)
        text = "\n".join([",".join(RAW_COLUMNS[entity]), *lines]) + "\n"
        (folder / f"raw_{entity}_20250207_100000.csv").write_text(text)
    return tmp_path / "landing"


def test_raw_to_gold(spark, landing, tmp_path):
    warehouse = str(tmp_path / "warehouse")
    gold = plans.run_pipeline(spark, str(landing), warehouse, DAY, NOON, on_missing="fail")
    assert gold.columns == [
        "customer_id",
        "product_id",
        "order_id",
        "order_item_id",
        "quantity",
        "unit_price",
        "orders_ingest_timestamp",
        "order_items_ingest_timestamp",
        "order_date",
        "total_amount",
        "order_status",
        "city",
        "state",
    ]
    assert rows(gold) == {
        ("1", "7", "100", "1", "2", "10.00", NOON, NOON, DAY, "20.00", "SHIPPED", "Ohio", "OH"): 1,
        ("2", "7", "101", "2", "1", "5.00", NOON, NOON, DAY, "5.00", "PENDING", None, None): 1,
    }
    counts = {
        table: read_layer(spark, warehouse, table, DAY).count()
        for table in ("refined_customers", "silver_customers", "silver_orders", "silver_order_items", "silver_products")
    }
    assert counts == {
        "refined_customers": 2,
        "silver_customers": 1,
        "silver_orders": 2,
        "silver_order_items": 3,
        "silver_products": 3,
    }


def test_a_rerun_gives_the_same_tables(spark, landing, tmp_path):
    warehouse = str(tmp_path / "warehouse")
    once = rows(plans.run_pipeline(spark, str(landing), warehouse, DAY, NOON))
    assert rows(plans.run_pipeline(spark, str(landing), warehouse, DAY, NOON)) == once


def test_silver_tables_match_the_lazy_plan(spark, landing, tmp_path):
    warehouse = str(tmp_path / "warehouse")
    bronze = plans.run_bronze(spark, str(landing), warehouse, DAY, NOON)
    lazy = plans.build_silver(bronze)
    for entity, df in plans.run_silver(spark, warehouse, DAY).items():
        assert df.columns == lazy[entity].columns
        assert rows(df) == rows(lazy[entity])


@pytest.mark.parametrize("absent", ["orders", "customers", "products"])
def test_missing_raw_input(spark, landing, tmp_path, absent):
    day = landing / f"raw_{absent}" / "20250207"
    day.rename(landing / f"raw_{absent}" / "20250206")
    warehouse = str(tmp_path / "warehouse")
    with pytest.raises(MissingInputError, match=absent):
        plans.run_pipeline(spark, str(landing), warehouse, DAY, NOON, on_missing="fail")
    bronze = plans.run_bronze(spark, str(landing), warehouse, DAY, NOON)
    silver = plans.run_silver(spark, warehouse, DAY)
    assert set(bronze) == set(silver) == set(ROWS) - {absent}
    if absent == "products":
        assert plans.run_gold(spark, warehouse, DAY).count() == 2
    elif absent == "customers":
        with pytest.raises(MissingInputError, match="customers"):
            plans.run_gold(spark, warehouse, DAY)
    else:
        with pytest.raises(ValueError, match="silver order_items lacks customer_id"):
            plans.run_gold(spark, warehouse, DAY)


def test_gold_lands_in_its_table(spark, landing, tmp_path):
    warehouse = str(tmp_path / "warehouse")
    plans.run_pipeline(spark, str(landing), warehouse, DAY, NOON)
    assert (tmp_path / "warehouse" / GOLD_ORDER_LINES / f"ingest_date={DAY}" / "_SUCCESS").exists()


def parts(warehouse, prefix):
    return {p: p.stat().st_mtime_ns for p in warehouse.rglob("*.parquet") if prefix in str(p)}


def test_a_run_goes_on_where_it_stopped(spark, landing, tmp_path, monkeypatch):
    warehouse = tmp_path / "warehouse"
    args = (spark, str(landing), str(warehouse), DAY, NOON, "fail", "r1")

    def broken(*_):
        raise RuntimeError("silver broke")

    with monkeypatch.context() as patch:
        patch.setattr("retail_strata.plans.pipeline.join_entities", broken)
        with pytest.raises(RuntimeError, match="silver broke"):
            plans.run_pipeline(*args)
    bronze = parts(warehouse, "refined_")
    assert bronze and not parts(warehouse, "gold_")

    began = []
    run_bronze = plans.pipeline.run_bronze
    monkeypatch.setattr("retail_strata.plans.pipeline.run_bronze", lambda *a: began.append(a) or run_bronze(*a))
    assert plans.run_pipeline(*args).count() == 2
    assert not began and parts(warehouse, "refined_") == bronze
    silver = parts(warehouse, "silver_")
    assert plans.run_pipeline(*args).count() == 2  # complete: nothing is run again
    assert parts(warehouse, "silver_") == silver
    plans.run_pipeline(*args[:-1], "r2")
    assert began and read_layer(spark, str(warehouse), "silver_orders", DAY, "r1").count() == 2


def test_a_broken_run_hides_nothing(spark, landing, tmp_path, monkeypatch):
    """Readers stay with the run before one that stopped half-way."""
    warehouse = str(tmp_path / "warehouse")
    whole = rows(plans.run_pipeline(spark, str(landing), warehouse, DAY, NOON))
    with monkeypatch.context() as patch:
        patch.setattr("retail_strata.plans.pipeline.build_gold", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            plans.run_pipeline(spark, str(landing), warehouse, DAY, NOON)
    assert rows(read_layer(spark, warehouse, GOLD_ORDER_LINES, DAY)) == whole
