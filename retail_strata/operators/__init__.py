from retail_strata.operators.columns import (
    add_ingest_metadata,
    clean_entity,
    label_lineage,
    normalise_email,
    require_columns,
    select_existing,
)
from retail_strata.operators.joins import (
    attach_customer_key,
    enrich_with_customer,
    left_join,
    silver_order_items,
    silver_orders,
    silver_products,
)
from retail_strata.operators.keys import (
    KeyedBatches,
    advance_mark,
    assign_surrogate_keys,
    high_water_marks,
)
from retail_strata.operators.purge import (
    purge_counts,
    purge_layer,
    purge_partition,
    purge_published,
    purge_rows,
)
from retail_strata.operators.rules import active_orders, valid_items, valid_orders

__all__ = [
    "KeyedBatches",
    "active_orders",
    "add_ingest_metadata",
    "advance_mark",
    "assign_surrogate_keys",
    "attach_customer_key",
    "clean_entity",
    "enrich_with_customer",
    "high_water_marks",
    "label_lineage",
    "left_join",
    "normalise_email",
    "purge_counts",
    "purge_layer",
    "purge_partition",
    "purge_published",
    "purge_rows",
    "require_columns",
    "select_existing",
    "silver_order_items",
    "silver_orders",
    "silver_products",
    "valid_items",
    "valid_orders",
]
