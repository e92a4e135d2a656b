"""Times plain formulations of the headline results, as a yardstick for the planned queries.

Each is one SQL statement or window over the wide fact and leaves all planning to Spark. Same tables, same
session settings and same sink as `bench.py`.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from ledgerlane.functions import decimals_as_double  # noqa: E402
from ledgerlane.operators import customer_metrics, order_info, order_measures, product_metrics, wide_fact  # noqa: E402
from ledgerlane.plans import PROFIT_TABLES  # noqa: E402
from ledgerlane.session import local_session  # noqa: E402
from workload import views  # noqa: E402


def _wide(spark: SparkSession, folder: str) -> DataFrame:
    return wide_fact(
        views.orders(spark, folder), views.clean_customers(spark, folder), views.clean_products(spark, folder)
    )


def _profit(name: str):
    keys, alias, _ = PROFIT_TABLES[name]
    names = ", ".join(keys)

    def run(spark: SparkSession, folder: str) -> DataFrame:
        _wide(spark, folder).createOrReplaceTempView("direct_wide")
        return spark.sql(
            f"SELECT {names}, round(sum(profit), 2) AS {alias} FROM direct_wide GROUP BY {names} ORDER BY {names}"
        )

    return run


def _duplicates(spark: SparkSession, folder: str) -> DataFrame:
    same_key = Window.partitionBy("order_id", "product_id")
    return views.orders(spark, folder).withColumn("rows", F.count(F.lit(1)).over(same_key)).where("rows > 1")


def _orphans(spark: SparkSession, folder: str) -> DataFrame:
    views.orders(spark, folder).createOrReplaceTempView("direct_lines")
    views.clean_customers(spark, folder).createOrReplaceTempView("direct_customers")
    return spark.sql(
        "SELECT * FROM direct_lines l WHERE NOT EXISTS "
        "(SELECT 1 FROM direct_customers c WHERE c.customer_id = l.customer_id)"
    )


def _enriched(spark: SparkSession, folder: str) -> DataFrame:
    """Metrics joined back to the wide fact."""
    measured = order_measures(_wide(spark, folder))
    by_customer, by_product = customer_metrics(measured), product_metrics(measured)
    return measured.join(by_product, "product_id", "left").join(by_customer, "customer_id", "left")


DIRECT = {
    **{name: _profit(name) for name in PROFIT_TABLES},
    "wide_fact": _wide,
    "order_measures": lambda spark, folder: order_measures(views.orders(spark, folder)),
    "customer_metrics": lambda spark, folder: customer_metrics(order_measures(_wide(spark, folder))),
    "product_metrics": lambda spark, folder: product_metrics(order_measures(_wide(spark, folder))),
    "enriched_table": _enriched,
    "order_info": lambda spark, folder: order_info(_wide(spark, folder)),
    "duplicate_order_lines": _duplicates,
    "orphans_by_customer": _orphans,
}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = local_session("bench direct", int(os.environ.get("BENCH_CPUS", "8")))
    seconds = {}
    for name, build in DIRECT.items():
        best = None
        for attempt in range(runs + 1):
            started = time.perf_counter()
            decimals_as_double(build(spark, folder)).write.format("noop").mode("overwrite").save()
            taken = time.perf_counter() - started
            if attempt:
                best = taken if best is None else min(best, taken)
        seconds[name] = round(best, 3)
    spark.stop()
    print(json.dumps({"metric": "direct formulations", "unit": "sec", "queries": seconds}))


if __name__ == "__main__":
    main()
