"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores, BENCH_REPEATS the timed runs per query
(their median is reported, after one run that is not timed).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.queries import QUERIES, READS  # noqa: E402
from retail_strata.session import build_session  # noqa: E402

HEADLINE = [
    "csv_scan_typed",
    "latest_snapshot",
    "dated_partition_read",
    "bronze_order_items",
    "dedupe_rows",
    "silver_customers",
    "silver_orders",
    "silver_order_items",
    "silver_products",
    "gold_final_orders",
    "gold_sales_by_city",
    "gold_customers",
    "gold_products",
    "items_with_customer_key",
    "gold_cloud_orders",
    "surrogate_keys_with_ties",
    "purge_published",
    "pipeline_end_to_end",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = build_session(
        "bench",
        {
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(name: str) -> float:
        # Reads that write their own input first are timed from before the reader is built.
        write, read = READS.get(name, (None, QUERIES[name]))
        given = sf_dir if write is None else write(spark, sf_dir)
        start = time.perf_counter()
        read(spark, given).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    timings = {}
    for name in sys.argv[1:] or HEADLINE:
        seconds(name)
        timings[name] = round(statistics.median(seconds(name) for _ in range(repeats)), 3)
        print(f"{name:28s} {timings[name]:7.3f}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": sf_dir.rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
