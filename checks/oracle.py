"""The SQL a second engine runs on the same tables."""

from __future__ import annotations

import re

from checks.dirty import RAW_SQL
from checks.queries import EVENT_DATE, ONE_DATE, PURGED_DATE

INGEST_TS = "'2025-02-07 10:00:00'"

# Named building blocks, each usable by those after it.
VIEWS: dict[str, str] = dict(RAW_SQL)


def _view(name: str, select: str) -> None:
    VIEWS[name] = f"{name} AS ({select})"


_view(
    "customers",
    f"""
  SELECT customer_id, full_name, lower(email) AS email, address, city, state,
         {INGEST_TS} AS customers_ingest_timestamp
  FROM (SELECT DISTINCT * FROM raw_customers)""",
)
_view(
    "products",
    f"SELECT DISTINCT *, {INGEST_TS} AS products_ingest_timestamp FROM raw_products",
)
_view(
    "valid_orders",
    f"""
  SELECT *, {INGEST_TS} AS orders_ingest_timestamp FROM (SELECT DISTINCT * FROM raw_orders)
  WHERE TRY_CAST(total_amount AS DECIMAL(18,2)) >= 0""",
)
_view(
    "valid_items",
    f"""
  SELECT *, {INGEST_TS} AS order_items_ingest_timestamp
  FROM (SELECT DISTINCT * FROM raw_order_items)
  WHERE TRY_CAST(quantity AS INT) > 0""",
)
_view(
    "joined_items",
    """
  SELECT order_id, order_item_id, product_id, quantity, unit_price, order_items_ingest_timestamp,
         order_date, customer_id, total_amount, order_status, orders_ingest_timestamp
  FROM valid_items JOIN valid_orders USING (order_id)""",
)
_view(
    "gold",
    """
  SELECT i.customer_id, product_id, order_id, order_item_id, quantity, unit_price,
         orders_ingest_timestamp, order_items_ingest_timestamp, order_date, total_amount,
         order_status, city, state
  FROM joined_items i LEFT JOIN customers c ON i.customer_id = c.customer_id
  WHERE i.customer_id IS NOT NULL AND order_status <> 'CANCELLED'""",
)
_view(
    "priced",
    """
  SELECT *, TRY_CAST(quantity AS INT) AS units,
         TRY_CAST(quantity AS INT) * TRY_CAST(unit_price AS DECIMAL(18,2)) AS amount
  FROM gold""",
)
_view(
    "cloud_customers",
    """
  SELECT DISTINCT customer_id, full_name AS name, email, CAST(NULL AS VARCHAR) AS phone, address
  FROM raw_customers""",
)
_view(
    "cloud_products",
    """
  SELECT DISTINCT product_id, product_name AS name, category, TRY_CAST(price AS DOUBLE) AS price
  FROM raw_products""",
)
_view(
    "cloud_orders",
    """
  SELECT * FROM (SELECT DISTINCT order_id, customer_id, order_date,
                        TRY_CAST(total_amount AS DOUBLE) AS total_amount FROM raw_orders)
  WHERE total_amount >= 0""",
)
_view(
    "cloud_items",
    """
  SELECT * FROM (SELECT DISTINCT order_item_id, order_id, product_id,
                        TRY_CAST(quantity AS INT) AS quantity,
                        TRY_CAST(unit_price AS DOUBLE) AS price FROM raw_order_items)
  WHERE quantity > 0""",
)
_view(
    "keyed_items",
    """
  SELECT i.*, o.customer_id FROM cloud_items i LEFT JOIN cloud_orders o ON i.order_id = o.order_id""",
)

PURGED = f"(order_date = '{ONE_DATE}' OR order_status = 'CANCELLED')"

SELECTS = {
    "csv_scan_strings": "SELECT * FROM raw_orders",
    "csv_scan_typed": """
SELECT order_id, customer_id, order_date, TRY_CAST(total_amount AS DOUBLE) AS total_amount
FROM raw_orders""",
    "csv_scan_mixed_headers": """
SELECT order_id, customer_id, order_date, TRY_CAST(total_amount AS DOUBLE) AS total_amount
FROM raw_orders""",
    "newest_batch": "SELECT DISTINCT * FROM raw_products",
    "latest_snapshot": """
WITH files AS (
  SELECT event_id, user_id, value, event_type AS entity,
         CAST(CAST(ts AS DATE) AS VARCHAR) AS folder, CAST(hour(ts) AS INT) AS file, ts
  FROM events),
modified AS (SELECT entity, folder, file, max(ts) AS modified FROM files GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY entity, folder ORDER BY modified DESC, file DESC) AS r
  FROM modified)
SELECT event_id, user_id, value, entity, folder, file
FROM files JOIN (SELECT entity, folder, file FROM ranked WHERE r = 1) USING (entity, folder, file)""",
    "latest_snapshot_null_folder": """
WITH files AS (
  SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS folder,
         CASE WHEN o_custkey % 3 <> 0 THEN o_orderpriority END AS file,
         CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS modified
  FROM orders),
ranked AS (
  SELECT folder, file,
         row_number() OVER (PARTITION BY folder ORDER BY modified DESC, file DESC NULLS LAST) AS r
  FROM files)
SELECT f.* FROM files f JOIN ranked n
ON n.r = 1 AND f.folder IS NOT DISTINCT FROM n.folder AND f.file IS NOT DISTINCT FROM n.file""",
    "object_paths": """
SELECT page_id, split_part(url, '/', 3) AS bucket,
       array_to_string(string_split(url, '/')[4:], '/') AS prefix
FROM pages""",
    "skipped_inputs": """
SELECT 'customers' AS entity, count(*) AS rows FROM raw_customers
UNION ALL SELECT 'products', count(*) FROM raw_products""",
    "missing_input_fails": """
SELECT order_id, 'no input for customers, products, order_items' AS message FROM raw_orders""",
    "missing_columns": """
SELECT order_id, 'orders lacks order_status; it has order_id, order_date, customer_id, total_amount'
    AS message
FROM raw_orders""",
    "preview_limit": """
SELECT least(5, count(*)) AS shown, least(5, count(*)) AS found FROM valid_items""",
    "ingest_times": """
SELECT 'customers' AS entity, 1 AS times, 0 AS nulls, count(*) AS rows FROM raw_customers
UNION ALL SELECT 'products', 1, 0, count(*) FROM raw_products
UNION ALL SELECT 'orders', 1, 0, count(*) FROM raw_orders
UNION ALL SELECT 'order_items', 1, 0, count(*) FROM raw_order_items""",
    "dated_partition_read": f"""
SELECT event_id, user_id, event_type, value, strftime(CAST(ts AS DATE), '%Y%m%d') AS ingest_date
FROM events WHERE CAST(ts AS DATE) = DATE '{EVENT_DATE}'""",
    "published_orders": "SELECT * FROM valid_orders",
    "fanout_order_lines": """
SELECT * FROM gold
CROSS JOIN (VALUES ('customers'), ('products'), ('orders'), ('order_items')) AS o(output)""",
    "bronze_customers": f"""
SELECT *, {INGEST_TS} AS ingest_timestamp, 'generated' AS source FROM raw_customers""",
    "bronze_products": f"""
SELECT *, {INGEST_TS} AS ingest_timestamp, 'generated' AS source FROM raw_products""",
    "bronze_orders": f"""
SELECT *, {INGEST_TS} AS ingest_timestamp, 'generated' AS source FROM raw_orders""",
    "bronze_order_items": f"""
SELECT *, {INGEST_TS} AS ingest_timestamp, 'generated' AS source FROM raw_order_items""",
    "clean_entity": f"""
SELECT DISTINCT *, {INGEST_TS} AS orders_ingest_timestamp, 'generated' AS orders_source_system
FROM raw_orders""",
    "dedupe_rows": "SELECT DISTINCT * FROM raw_order_items",
    "silver_customers": "SELECT * FROM customers",
    "customer_geo": "SELECT customer_id, city, state FROM customers",
    "silver_orders_valid": "SELECT * FROM valid_orders",
    "silver_items_valid": "SELECT * FROM valid_items",
    "silver_order_items": "SELECT * FROM joined_items",
    "silver_order_items_one_shuffle": "SELECT * FROM joined_items",
    "silver_orders": "SELECT * FROM valid_orders JOIN customers USING (customer_id)",
    "silver_products": "SELECT * FROM products JOIN joined_items USING (product_id)",
    "silver_missing_orders": "SELECT * FROM products JOIN valid_items USING (product_id)",
    "select_existing": """
SELECT customer_id, product_id, order_id, order_item_id, quantity, unit_price,
       orders_ingest_timestamp, order_items_ingest_timestamp, order_date, total_amount,
       order_status
FROM joined_items""",
    "gold_final_orders": "SELECT * FROM gold",
    "gold_sales_by_city": """
SELECT city, state, CAST(sum(amount) AS DOUBLE) AS revenue, count(DISTINCT order_id) AS orders
FROM priced GROUP BY city, state""",
    "gold_customers": """
SELECT customer_id, count(DISTINCT order_id) AS orders, count(*) AS lines,
       CAST(sum(units) AS BIGINT) AS units, CAST(sum(amount) AS DOUBLE) AS revenue,
       min(order_date) AS first_order_date, max(order_date) AS last_order_date
FROM priced GROUP BY customer_id""",
    "gold_orders": """
SELECT order_id, count(DISTINCT product_id) AS products, count(*) AS lines,
       CAST(sum(units) AS BIGINT) AS units, CAST(sum(amount) AS DOUBLE) AS revenue
FROM priced GROUP BY order_id""",
    "gold_order_items": """
SELECT order_item_id, order_id, product_id, customer_id, units,
       CAST(TRY_CAST(unit_price AS DECIMAL(18,2)) AS DOUBLE) AS unit_price,
       CAST(amount AS DOUBLE) AS revenue
FROM priced""",
    "gold_products": """
SELECT p.product_id, c.category, count(DISTINCT order_id) AS orders,
       CAST(sum(units) AS BIGINT) AS units, CAST(sum(amount) AS DOUBLE) AS revenue
FROM priced p
LEFT JOIN (SELECT DISTINCT product_id, category FROM products) c ON p.product_id = c.product_id
GROUP BY p.product_id, c.category""",
    "silver_cloud_customers": "SELECT * FROM cloud_customers",
    "silver_cloud_products": "SELECT * FROM cloud_products",
    "silver_cloud_orders": "SELECT * FROM cloud_orders",
    "silver_cloud_items": "SELECT * FROM cloud_items",
    "items_with_customer_key": "SELECT * FROM keyed_items",
    "gold_cloud_orders": """
SELECT i.*, c.name, c.email, c.phone, c.address
FROM keyed_items i LEFT JOIN cloud_customers c ON i.customer_id = c.customer_id""",
    "active_orders_optional": """
SELECT i.*, s.customer_id, s.order_status, c.name, c.email, c.phone, c.address
FROM cloud_items i
LEFT JOIN (SELECT order_id, customer_id, order_status FROM valid_orders) s
    ON i.order_id = s.order_id
LEFT JOIN cloud_customers c ON s.customer_id = c.customer_id
WHERE s.customer_id IS NOT NULL AND s.order_status <> 'CANCELLED'""",
    "cloud_end_to_end": """
SELECT i.*, c.name, c.email, c.phone, c.address, output
FROM keyed_items i LEFT JOIN cloud_customers c ON i.customer_id = c.customer_id
CROSS JOIN (VALUES ('customers'), ('products'), ('orders'), ('order_items')) AS o(output)""",
    "run_dates": """
SELECT order_id, strftime(CAST(order_date AS DATE), '%Y%m%d') AS folder,
       strftime(CAST(order_date AS TIMESTAMP) + INTERVAL '10 hours 15 minutes',
                '%Y%m%d_%H%M%S') AS stamp,
       CAST(try_strptime(total_amount, '%Y-%m-%d') AS VARCHAR) AS not_a_date
FROM raw_orders""",
    "surrogate_keys": """
SELECT *, 10000 + row_number() OVER (ORDER BY c_custkey) AS id FROM customer""",
    "surrogate_keys_with_ties": """
SELECT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS ship_date,
       row_number() OVER (ORDER BY CAST(l_shipdate AS DATE)) AS id
FROM lineitem""",
    "surrogate_keys_two_batches": """
SELECT *, 10000 + row_number() OVER (ORDER BY c_custkey % 2 = 0, c_custkey % 2,
           CASE WHEN c_custkey % 2 = 0 THEN c_name END, c_custkey) AS id,
       10000 + count(*) OVER () AS mark
FROM customer""",
    "high_water_marks": """
SELECT 'customers' AS entity, 10000 + count(*) AS last_id FROM customer
UNION ALL SELECT 'products', 10000 + count(*) FROM part
UNION ALL SELECT 'orders', 10000
UNION ALL SELECT 'order_items', 10000""",
    "purge_rows": f"SELECT * FROM raw_orders WHERE NOT coalesce({PURGED}, false)",
    "purge_counts": f"""
SELECT count(*) AS total, count(*) FILTER (WHERE {PURGED}) AS removed FROM raw_orders""",
    "purge_published": f"SELECT * FROM raw_orders WHERE NOT coalesce({PURGED}, false)",
    "purge_partition": f"""
SELECT event_id, user_id, event_type, value, strftime(CAST(ts AS DATE), '%Y%m%d') AS ingest_date
FROM events WHERE CAST(ts AS DATE) <> DATE '{EVENT_DATE}'""",
    "purge_layer": f"""
SELECT event_id, user_id, event_type, value, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS folder
FROM events WHERE coalesce(user_id % 7, 1) <> 0 AND CAST(ts AS DATE) <> DATE '{PURGED_DATE}'
UNION ALL
SELECT event_id, user_id, event_type, value + 1, '{EVENT_DATE}/run_id=r1'
FROM events WHERE coalesce(user_id % 7, 1) <> 0 AND CAST(ts AS DATE) = DATE '{EVENT_DATE}'""",
    "refined_names": """
SELECT order_id, CASE WHEN CAST(order_id AS BIGINT) % 5 = 0 THEN 'old_raw_' ELSE 'refined_' END
           || lower(order_status) AS table_name
FROM raw_orders""",
    "pipeline_end_to_end": "SELECT * FROM gold",
    "rerun_newest": f"""
SELECT *, {INGEST_TS} AS ingest_timestamp, 'generated' AS source, 'newest' AS run FROM raw_orders
UNION ALL SELECT *, '2025-02-07 09:00:00', 'generated', 'first' FROM raw_orders""",
    "written_mart": """
SELECT city, state, CAST(sum(amount) AS DOUBLE) AS revenue, count(DISTINCT order_id) AS orders
FROM priced GROUP BY city, state""",
}


def _with_views(select: str) -> str:
    """``select`` preceded by the views it needs, directly or through another view."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, view in VIEWS.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                body = view.split(" AS (", 1)[1]
                needed.append(name)
                visit(body)

    own = re.match(r"\s*WITH\s+", select)
    visit(select)
    ordered = [VIEWS[name] for name in VIEWS if name in needed]
    if not ordered:
        return select.strip()
    if own:
        return "WITH " + ",\n".join(ordered) + ",\n" + select[own.end() :].strip()
    return "WITH " + ",\n".join(ordered) + "\n" + select.strip()


ORACLE_SQL = {name: _with_views(select) for name, select in SELECTS.items()}
