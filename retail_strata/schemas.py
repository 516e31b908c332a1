"""Entities, their columns, and the names of the layers they pass through."""

from __future__ import annotations

# The entity set.
ENTITIES = ("customers", "products", "orders", "order_items")

# The cloud variant's declared columns and types.
CLOUD_SCHEMAS = {
    "customers": {
        "customer_id": "string",
        "name": "string",
        "email": "string",
        "phone": "string",
        "address": "string",
    },
    "orders": {
        "order_id": "string",
        "customer_id": "string",
        "order_date": "string",
        "total_amount": "double",
    },
    "order_items": {
        "order_item_id": "string",
        "order_id": "string",
        "product_id": "string",
        "quantity": "int",
        "price": "double",
    },
    "products": {
        "product_id": "string",
        "name": "string",
        "category": "string",
        "price": "double",
    },
}

# The gold table's columns, in order. Those that are absent are left out.
GOLD_COLUMNS = [
    "customer_id",
    "product_id",
    "order_id",
    "order_item_id",
    "quantity",
    "unit_price",
    "orders_ingest_timestamp",
    "orders_source_system",
    "order_items_ingest_timestamp",
    "order_items_source_system",
    "order_date",
    "total_amount",
    "order_status",
    "city",
    "state",
]

# Table name prefix of each layer, and the gold order-line table.
LAYER_PREFIXES = {"raw": "raw_", "bronze": "refined_", "silver": "silver_", "gold": "gold_"}
GOLD_ORDER_LINES = "gold_final_orders_data"
GOLD_SALES_BY_CITY = "gold_sales_by_city"

# Fixed value: the id every table starts counting from.
FIRST_HIGH_WATER_MARK = 10000

MONEY = "decimal(18,2)"


def layer_table(layer: str, entity: str) -> str:
    """Table name of ``entity`` in ``layer``; ``entity`` may carry another layer's prefix."""
    for prefix in LAYER_PREFIXES.values():
        entity = entity.removeprefix(prefix)
    return LAYER_PREFIXES[layer] + entity
