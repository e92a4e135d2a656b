"""Enriched tables, planned so the order lines are shuffled as rarely and as narrow as possible."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlane.functions import ref
from ledgerlane.operators.lookups import (
    Dimension,
    can_meet,
    dimension,
    left_lookup,
    left_lookup_met,
    meeting,
    rows_met,
    run_hot_keys,
    with_copies,
)
from ledgerlane.operators.measures import customer_lookup, order_measures, product_lookup
from ledgerlane.operators.metrics import customer_metrics, product_metrics

Table = DataFrame | Dimension


def counted_lines(orders: DataFrame, customers: Table, products: Table) -> tuple[DataFrame, str | None]:
    """Measured order lines and the column saying how often the wide fact would repeat them."""
    tables = [dimension(customers, "customer_id"), dimension(products, "product_id")]
    repeating = [table for table in tables if not table.unique]
    measured = order_measures(orders)
    return (with_copies(measured, repeating), "copies") if repeating else (measured, None)


def customer_table(orders: DataFrame, customers: Table, products: Table) -> DataFrame:
    """Customer metrics over the wide fact, computed without building it."""
    return customer_metrics(*counted_lines(orders, customers, products))


def product_table(orders: DataFrame, customers: Table, products: Table) -> DataFrame:
    """Product metrics over the wide fact, computed without building it."""
    return product_metrics(*counted_lines(orders, customers, products))


def fully_enriched(
    orders: DataFrame,
    customers: Table,
    products: Table,
    by_customer: Table | None = None,
    by_product: Table | None = None,
    hot: Mapping[str, Mapping[Any, int]] | None = None,
) -> DataFrame:
    """Enriched lines with product and customer metrics.

    Metrics are joined to their dimension first, so the lines meet one lookup per key instead of
    two; rows without a key keep null attributes and null metrics. Pass metrics that were already
    written as tables, with their measured size, to spare the lines a second reading and, where they
    fit a broadcast with their dimension, a shuffle. Otherwise hot keys of the lines must be salted;
    unless given, a job finds them. Where a key has no hot ones, the shuffle that brings its lines to the
    lookup also brings them to its metrics. The measures follow from a line alone, so they are added when it has
    been through the shuffles.
    """
    customer_info, product_info = customer_lookup(customers), product_lookup(products)
    ways = [(by_customer, customer_info, customer_table), (by_product, product_info, product_table)]
    # Metrics still to be summed: here of all lines, below of lines that have come together by their key.
    known = [
        (dimension(summed(orders, customers, products) if metrics is None else metrics, info.key), info, summed if metrics is None else None)
        for metrics, info, summed in ways
    ]
    large = [info.key for metrics, info, _ in known if not (metrics.small and info.small)]
    if large and hot is None:
        hot = run_hot_keys(orders, large)
    joined, fanned = orders, False
    # The lines carry what they found through the next shuffle: the narrower of two shuffled tables comes
    # first, broadcast ones last.
    widths = {info.key: len(metrics.df.columns) + len(info.df.columns) for metrics, info, _ in known}
    for metrics, info, summed in sorted(known, key=lambda side: (side[1].key not in large, widths[side[1].key])):
        if summed and not (hot[info.key] or fanned) and can_meet(joined, info.key):
            met = meeting(joined, info.key)
            lines = rows_met(met, info.key).select(*[ref(c) for c in orders.columns])
            by_key = dimension(summed(lines, customers, products), info.key)
            joined = left_lookup_met(met, Dimension(left_lookup(by_key.df, info), info.key))
        else:
            side = Dimension(left_lookup(metrics.df, info), info.key, small=info.key not in large)
            joined = left_lookup(joined, replace(side, hot=hot[info.key]) if info.key in large else side)
        # Lines that a lookup has repeated are no longer those that metrics are summed of.
        fanned = fanned or not info.unique or not (summed or metrics.unique)
    joined = order_measures(joined).withColumn("order_year", F.year("order_date"))
    by_customer, by_product = (metrics.df for metrics, *_ in known)

    keys = ["customer_id", "product_id"]
    measures = ["total_sales", "discount_amount", "final_price", "unit_selling_price", "days_to_ship"]
    columns = (
        keys
        + [c for c in orders.columns if c not in keys]
        + [c for c in customer_info.df.columns if c != "customer_id"]
        + ["order_year"]
        + [c for c in product_info.df.columns if c != "product_id"]
        + measures
        + [c for c in by_product.columns if c != "product_id"]
        + [c for c in by_customer.columns if c != "customer_id"]
    )
    return joined.select(*[ref(c) for c in columns])
