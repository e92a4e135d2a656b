"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the tables and the local cores. Every query runs once to warm
up, then BENCH_RUNS times, twice unless set; the best run counts. Results go to Spark's noop sink, so all rows and
columns are computed and none are collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerlane.session import local_session  # noqa: E402
from workload import views  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

HEADLINE = [
    "profit_by_year",
    "profit_by_year_category",
    "profit_by_customer",
    "profit_by_customer_year",
    "profit_by_year_cat_sub_customer",
    "profit_all_grains",
    "profit_by_year_sql",
    "wide_fact",
    "wide_fact_salted",
    "order_measures",
    "customer_metrics",
    "product_metrics",
    "enriched_table",
    "order_info",
    "orders_clean",
    "orders_quarantine",
    "duplicate_order_lines",
    "null_counts",
    "orphans_by_customer",
    "json_orders",
    "xlsx_customers",
]


def timed(run) -> float:
    started = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session("bench", cores)
    seconds = {}
    if len(sys.argv) == 1:
        # The queries share these measures, so their cost is listed on its own.
        for measure in (views.run_statistics, views.run_hot_keys):
            measure(spark, folder)
        started = time.perf_counter()
        for measure in (views.run_statistics, views.run_hot_keys):
            measure(spark, folder)
        seconds["dimension_statistics"] = round(time.perf_counter() - started, 3)
    for name in sys.argv[1:] or HEADLINE:
        timed(lambda: QUERIES[name](spark, folder))
        seconds[name] = round(min(timed(lambda: QUERIES[name](spark, folder)) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall-clock",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
