"""The whole job: ingest the files, enrich the orders, report the profits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlane.operators.lookups import run_measure_unique
from ledgerlane.operators.measures import order_info, order_measures, wide_fact
from ledgerlane.plans.enrichment import customer_table, fully_enriched, product_table
from ledgerlane.plans.ingest import Store, run_ingest
from ledgerlane.plans.profit import FINEST, PROFIT_TABLES, cell_totals, profit_table, profit_totals
from ledgerlane.plans.sql_texts import register_view
from ledgerlane.settings import Settings
from ledgerlane.sinks import stage, staging_folder, write_table


def run_enrichment(spark: SparkSession, store: Store, settings: Settings) -> dict[str, DataFrame]:
    """Writes the wide fact and the two metric tables, registers the SQL view, and returns every
    dataset by name. What is returned reads those tables or is planned from the clean orders."""
    customers, products = store.dimensions()
    orders = store.orders.clean

    def written(name: str, df: DataFrame) -> DataFrame:
        write_table(df, settings.table(name), path=settings.path(name))
        return spark.table(settings.table(name))

    wide = written("wide_orders", wide_fact(orders, customers, products))
    by_customer = written("customer_metrics", customer_table(orders, customers, products))
    by_product = written("product_metrics", product_table(orders, customers, products))
    # Every profit table is a sum of these cells, so the orders are read once for all five.
    cells = stage(profit_totals(orders, customers, products, FINEST), f"{staging_folder(spark)}/profit_cells")
    register_view(wide)
    outputs = {
        "wide_fact": wide,
        "enriched_orders": order_measures(wide),
        "customer_metrics": by_customer,
        "product_metrics": by_product,
        "fully_enriched": fully_enriched(
            orders,
            customers,
            products,
            run_measure_unique(by_customer, "customer_id"),
            run_measure_unique(by_product, "product_id"),
            store.orders.hot,
        ),
        "order_info": order_info(wide),
    }
    for name, (keys, _, _) in PROFIT_TABLES.items():
        outputs[name] = profit_table(name, cell_totals(cells, keys))
    return outputs


def run_pipeline(spark: SparkSession, settings: Settings) -> tuple[Store, dict[str, DataFrame]]:
    store = run_ingest(spark, settings)
    return store, run_enrichment(spark, store, settings)
