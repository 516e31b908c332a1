from retail_strata.plans.bronze import build_bronze
from retail_strata.plans.cloud import (
    build_cloud_silver,
    build_gold_from_parts,
    run_cloud_gold,
    run_cloud_silver,
)
from retail_strata.plans.gold import build_gold, build_gold_from_clean
from retail_strata.plans.marts import (
    gold_customers,
    gold_order_items,
    gold_orders,
    gold_products,
    sales_by_city,
)
from retail_strata.plans.pipeline import run_bronze, run_gold, run_pipeline, run_silver
from retail_strata.plans.silver import build_silver, clean_entities

__all__ = [
    "build_bronze",
    "build_cloud_silver",
    "build_gold",
    "build_gold_from_clean",
    "build_gold_from_parts",
    "build_silver",
    "clean_entities",
    "gold_customers",
    "gold_order_items",
    "gold_orders",
    "gold_products",
    "run_bronze",
    "run_cloud_gold",
    "run_cloud_silver",
    "run_gold",
    "run_pipeline",
    "run_silver",
    "sales_by_city",
]
