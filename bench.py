"""Benchmark: headline queries and the full batch run at one scale factor.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 3). Prints ONE JSON line:
{"metric": "batch_from_csv_sec", "value": <median sec of the full batch run from
the CSV raw zone>, "unit": "sec", "queries": {name: median sec}, "sf": ...}

Each query is timed to completion with Spark's no-op sink (the whole result is
computed, nothing is collected to the driver). Timings are medians over
BENCH_REPEAT runs after one warm-up pass of the session. The views that the
queries read are derived from the driver tables once; that cold run is the entry
``views_staging``.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from basketry.plans import catalog  # noqa: E402
from basketry.plans.batch import export_sources, run_batch_from_csv  # noqa: E402
from basketry.session import get_spark, scratch_dir  # noqa: E402
from basketry.sources.views import DriverViews  # noqa: E402

HEADLINE = [
    # the sixteen metric tables of a run (+ the unwired revenue ranking)
    "top_spenders", "recurring_customers", "average_ticket", "top_products_by_quantity",
    "top_products_by_revenue", "monthly_sales", "promotion_usage_rate", "status_funnel",
    "cancellation_rate", "delivery_rate", "backlog_in_progress", "inventory_health",
    "low_stock_items", "warehouse_utilization", "reviews_overview", "reviews_by_product",
    "reviews_monthly",
    # cleaned / enriched tables and core operators
    "clean_orders", "enrich_orders", "enrich_inventory", "enrich_reviews",
    "dedup_keep_last", "fill_median", "exact_quantiles", "check_orders_rules", "profile_table",
]


def timed(fn) -> float:
    t = time.perf_counter()
    fn()
    return time.perf_counter() - t


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=cpus)
    qs = catalog.queries()

    def run_query(name):
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    results: dict[str, float] = {}
    # the queries read views that are derived once for each application; that has its own entry
    results["views_staging"] = round(timed(lambda: DriverViews(spark, sf_dir).all()), 3)

    # warm-up: JIT and codegen caches of the session
    run_query("monthly_sales")

    for name in HEADLINE:
        results[name] = round(statistics.median(timed(lambda: run_query(name)) for _ in range(repeat)), 3)

    # full batch: export the driver tables as the CSV raw zone once (untimed),
    # then time extract -> clean -> enrich -> metrics -> load from CSV.
    src = scratch_dir(spark, "bench-src")
    export_sources(DriverViews(spark, sf_dir).all(), src)
    batch = []
    for i in range(repeat):
        out = scratch_dir(spark, f"bench-run{i}")
        batch.append(timed(lambda: run_batch_from_csv(spark, src, out)))
    results["batch_from_csv"] = round(statistics.median(batch), 3)
    print("batch runs:", [round(b, 2) for b in batch], file=sys.stderr)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "batch_from_csv_sec",
        "value": results["batch_from_csv"],
        "unit": "sec",
        "queries": results,
        "query_sum_sec": round(sum(v for k, v in results.items() if k != "batch_from_csv"), 3),
        "batch_runs_sec": [round(b, 3) for b in batch],
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
