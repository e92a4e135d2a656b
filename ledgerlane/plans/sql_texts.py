"""The profit reports as SQL over the registered wide-fact view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VIEW = "orders_customers_products"

# Names, columns and sort orders of the published reports.
PROFIT_SQL = {
    "profit_by_year": """
        SELECT order_year, CAST(ROUND(SUM(profit), 2) AS DOUBLE) AS profit_per_year
        FROM {wide}
        GROUP BY order_year
        ORDER BY order_year
    """,
    "profit_by_year_category": """
        SELECT order_year, category, CAST(ROUND(SUM(profit), 2) AS DOUBLE) AS profit_per_year_category
        FROM {wide}
        GROUP BY order_year, category
        ORDER BY order_year ASC, profit_per_year_category DESC
    """,
    "profit_by_customer": """
        SELECT customer_name, CAST(ROUND(SUM(profit), 2) AS DOUBLE) AS profit_per_customer
        FROM {wide}
        GROUP BY customer_name
        ORDER BY profit_per_customer DESC
    """,
    "profit_by_customer_year": """
        SELECT customer_name, order_year, CAST(ROUND(SUM(profit), 2) AS DOUBLE) AS profit_per_customer_year
        FROM {wide}
        GROUP BY customer_name, order_year
        ORDER BY order_year ASC, profit_per_customer_year DESC
    """,
}


def register_view(wide: DataFrame, name: str = VIEW) -> str:
    wide.createOrReplaceTempView(name)
    return name


def profit_sql(spark: SparkSession, report: str, wide: DataFrame | None = None) -> DataFrame:
    """Runs a report over `wide`, or over the registered view when none is given."""
    if wide is not None:
        return spark.sql(PROFIT_SQL[report], wide=wide)
    return spark.sql(PROFIT_SQL[report].format(wide=VIEW))
