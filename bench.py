"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores,
``BENCH_QUERIES`` an optional comma list of catalog names. Every query runs to the
end into the no-op sink.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from chronomart.plans.catalog import CATALOG

HEADLINE = [
    "envelope_roundtrip", "change_stats", "snapshot_diff", "latest_state", "stage_order_items", "stg_order_items",
    "scd2_events", "scd2_prices", "scd2_incremental", "dim_customers_scd2", "dim_products_scd2", "version_delta",
    "pit_join", "asof_join", "pit_items", "asof_items", "fk_violations", "fct_orders", "daily_sales", "kpis",
    "status_breakdown", "top_days", "conditional_aggregates", "source_suite", "suite_on_tables", "quarantine",
    "no_overlap", "stream_ingest", "stream_daily", "stream_maintain", "purchases_by_last_state",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    times = {}
    for name in names:
        start = time.perf_counter()
        CATALOG[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                "queries": times, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
