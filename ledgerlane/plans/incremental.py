"""Metrics that are kept up load by load: each load adds its own partial results, and a rerun replaces them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlane.functions import ref
from ledgerlane.functions.money import addends, finished_avg, finished_sum
from ledgerlane.operators.distinct_parts import distinct_counts, distinct_parts, merge_parts
from ledgerlane.sinks import all_batches, write_batch


@dataclass(frozen=True)
class Metric:
    """An aggregate of one column: sum, total (a sum that is not rounded), avg, min, max or distinct."""

    name: str
    kind: str
    column: str
    digits: int = 2


# Names and definitions of the published metrics.
CUSTOMER_METRICS = (
    Metric("customer_lifetime_value", "sum", "final_price"),
    Metric("customer_lifetime_profit", "sum", "profit"),
    Metric("total_orders", "distinct", "order_id"),
    Metric("avg_bag_size", "avg", "quantity"),
    Metric("avg_order_value", "avg", "final_price"),
    Metric("first_order_date", "min", "order_date"),
    Metric("latest_order_date", "max", "order_date"),
)
PRODUCT_METRICS = (
    Metric("total_units_sold", "total", "quantity"),
    Metric("total_revenue_generated", "sum", "final_price"),
    Metric("avg_discount", "avg", "discount_amount"),
    Metric("distinct_customers_bought", "distinct", "customer_id"),
)


@dataclass(frozen=True)
class MetricStore:
    """Where the partial results of a set of metrics are: tables whose names begin with `table`."""

    table: str
    key: str
    metrics: tuple[Metric, ...]
    path: str | None = None  # folder for external tables

    def part(self, name: str) -> tuple[str, str | None]:
        return f"{self.table}_{name}", None if self.path is None else f"{self.path}/{name}"


def partials(lines: DataFrame, key: str, metrics: Sequence[Metric]) -> DataFrame:
    """One row per key with everything that adds up: exact sums, sums of doubles, counts, least and greatest."""
    columns: list[Column] = []
    for metric in metrics:
        value = ref(metric.column)
        if metric.kind in ("sum", "total", "avg"):
            exact, rest = addends(lines, metric.column)
            columns.append(F.sum(exact).alias(f"{metric.name}_exact"))
            columns.append((F.lit(None).cast("double") if rest is None else F.sum(rest)).alias(f"{metric.name}_rest"))
            columns.append(F.count(value).alias(f"{metric.name}_rows"))
        elif metric.kind in ("min", "max"):
            columns.append((F.min if metric.kind == "min" else F.max)(value).alias(metric.name))
        elif metric.kind != "distinct":
            raise ValueError(f"{metric.name} is of the unknown kind {metric.kind}")
    return lines.groupBy(ref(key)).agg(*columns, F.count(F.lit(1)).alias("lines"))


def write_load(lines: DataFrame, store: MetricStore, batch: str) -> None:
    """Writes the partial results of one load of measured lines; a load of the same name is replaced."""
    table, path = store.part("partials")
    write_batch(partials(lines, store.key, store.metrics), table, batch, path=path)
    for metric in store.metrics:
        if metric.kind == "distinct":
            table, path = store.part(metric.name)
            write_batch(distinct_parts(lines, store.key, metric.column), table, batch, path=path)


def _kinds(lines_schema: T.StructType, metrics: Sequence[Metric]) -> dict[str, T.DataType]:
    return {m.name: lines_schema[m.column].dataType for m in metrics}


def read_totals(spark: SparkSession, store: MetricStore, lines_schema: T.StructType) -> DataFrame:
    """The metrics over all loads; equal to those over all their lines at once."""
    kinds = _kinds(lines_schema, store.metrics)
    floating = (T.DoubleType, T.FloatType)
    held = all_batches(spark, store.part("partials")[0])
    columns: list[Column] = []
    for metric in store.metrics:
        if metric.kind in ("sum", "total", "avg"):
            exact, rows = F.sum(f"{metric.name}_exact"), F.sum(f"{metric.name}_rows")
            leftover = F.sum(f"{metric.name}_rest") if isinstance(kinds[metric.name], floating) else None
            if metric.kind == "avg":
                value = finished_avg(exact, leftover, rows, kinds[metric.name], metric.digits)
            elif metric.kind == "sum":
                value = finished_sum(exact, leftover, metric.digits)
            else:
                value = exact if leftover is None else F.coalesce(exact.cast("double"), F.lit(0.0)) + F.coalesce(leftover, F.lit(0.0))
            columns.append(value.alias(metric.name))
        elif metric.kind in ("min", "max"):
            columns.append((F.min if metric.kind == "min" else F.max)(metric.name).alias(metric.name))
    found = held.groupBy(ref(store.key)).agg(*columns)
    for metric in store.metrics:
        if metric.kind == "distinct":
            parts = merge_parts(all_batches(spark, store.part(metric.name)[0]))
            counts = distinct_counts(parts, metric.name).withColumnRenamed(store.key, "__key")
            found = found.join(counts, ref(store.key).eqNullSafe(F.col("__key")), "left").drop("__key")
            found = found.withColumn(metric.name, F.coalesce(metric.name, F.lit(0)))
    return found.select(ref(store.key), *(m.name for m in store.metrics))
