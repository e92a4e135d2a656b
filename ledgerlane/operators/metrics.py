"""Aggregates: customer and product metrics and the general group-aggregate-round-sort."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlane.functions import ref, rounded_avg, rounded_sum


# The result names of both metric tables are the published ones.
def customer_metrics(measured: DataFrame, copies: str | None = None) -> DataFrame:
    """One row per customer over measured order lines, each counted `copies` times.

    The distinct count shuffles on (customer, order) first, so a customer with a third of all
    lines is spread over many tasks and arrives pre-aggregated at the second exchange.
    """
    return measured.groupBy("customer_id").agg(
        rounded_sum(measured, "final_price", 2, copies).alias("customer_lifetime_value"),
        rounded_sum(measured, "profit", 2, copies).alias("customer_lifetime_profit"),
        F.count_distinct("order_id").alias("total_orders"),
        rounded_avg(measured, "quantity", 2, copies).alias("avg_bag_size"),
        rounded_avg(measured, "final_price", 2, copies).alias("avg_order_value"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("latest_order_date"),
    )


def product_metrics(measured: DataFrame, copies: str | None = None) -> DataFrame:
    """One row per product; null customers are not counted as buyers."""
    units = ref("quantity") if copies is None else ref("quantity") * ref(copies)
    return measured.groupBy("product_id").agg(
        F.sum(units).alias("total_units_sold"),
        rounded_sum(measured, "final_price", 2, copies).alias("total_revenue_generated"),
        rounded_avg(measured, "discount_amount", 2, copies).alias("avg_discount"),
        F.count_distinct("customer_id").alias("distinct_customers_bought"),
    )


def ordering(order: Sequence[tuple[str, str]]) -> list[Column]:
    """("column", "asc" | "desc") pairs; ascending puts nulls first, descending last."""
    return [
        ref(name).desc_nulls_last() if direction.lower() == "desc" else ref(name).asc_nulls_first()
        for name, direction in order
    ]


def summarize(
    df: DataFrame,
    keys: Sequence[str],
    measure: str,
    aggregate: Callable[[Column], Column],
    digits: int,
    alias: str,
    order: Sequence[tuple[str, str]] = (),
) -> DataFrame:
    """Groups by `keys`, aggregates one measure, rounds it and sorts the result.

    `aggregate` is any one-column aggregate of `pyspark.sql.functions`; sums and averages take
    the exact-decimal path.
    """
    if aggregate is F.sum:
        value = rounded_sum(df, measure, digits)
    elif aggregate in (F.avg, F.mean):
        value = rounded_avg(df, measure, digits)
    else:
        value = F.round(aggregate(ref(measure)), digits)
    result = df.groupBy(*[ref(k) for k in keys]).agg(value.alias(alias))
    return result.orderBy(*ordering(order)) if order else result
