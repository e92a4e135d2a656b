"""Per-line order measures and the wide fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlane.functions import ref, rounded_difference, rounded_product, rounded_ratio
from ledgerlane.operators.lookups import Dimension, dimension, left_lookup


# The names of the measures, here and in the metrics, are those of the published tables.
def order_measures(lines: DataFrame) -> DataFrame:
    """Adds the five line measures; each amount is rounded before the next one uses it.

    `discount_amount` is price x discount, per line and not per unit, while `total_sales` is
    price x quantity. That is how the figures are defined.
    """
    amounts = lines.withColumns(
        {
            "total_sales": rounded_product(lines, "price", "quantity"),
            "discount_amount": rounded_product(lines, "price", "discount"),
        }
    )
    final = amounts.withColumn("final_price", rounded_difference("total_sales", "discount_amount"))
    return final.withColumns(
        {
            "unit_selling_price": rounded_ratio(final, "final_price", "quantity"),
            "days_to_ship": F.datediff("ship_date", "order_date"),
        }
    )


def customer_lookup(customers: DataFrame | Dimension) -> Dimension:
    table = dimension(customers, "customer_id")
    return table.of(table.df.withColumnsRenamed({"state": "customer_state"}))


def product_lookup(products: DataFrame | Dimension) -> Dimension:
    table = dimension(products, "product_id")
    return table.of(table.df.withColumnsRenamed({"state": "product_state"}))


def wide_fact(
    orders: DataFrame, customers: DataFrame | Dimension, products: DataFrame | Dimension
) -> DataFrame:
    """Orders with customer and product attributes; unmatched orders keep null attributes."""
    customers, products = customer_lookup(customers), product_lookup(products)
    lines = orders.withColumn("order_year", F.year("order_date"))
    joined = left_lookup(left_lookup(lines, customers), products)
    keys = ["product_id", "customer_id"]
    columns = (
        keys
        + [c for c in orders.columns if c not in keys]
        + [c for c in customers.df.columns if c != "customer_id"]
        + ["order_year"]
        + [c for c in products.df.columns if c != "product_id"]
    )
    return joined.select(*[ref(c) for c in columns])


# The published columns of the order info, in their order.
ORDER_INFO = (
    "order_id",
    "customer_name",
    "country",
    "category",
    "sub_category",
    "quantity",
    "price",
    "discount",
    "profit",
)


def order_info(wide: DataFrame) -> DataFrame:
    return wide.select(*[F.round(c, 2).alias(c) if c == "profit" else c for c in ORDER_INFO])
