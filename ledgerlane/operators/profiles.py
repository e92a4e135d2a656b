"""Profiles of columns: exact counts of rows and nulls, and sketches of distinct values, quantiles and frequent values.

All columns take one pass. A sketch has a fixed size however many rows there are, and sketches of
several loads merge into that of all their rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlane.functions import ref

#: Logarithm of the registers for distinct values; their count is off by 0.8 % in the usual case.
DISTINCT_LOG = 14
DISTINCT_ERROR = 3 * 1.04 / 2 ** (DISTINCT_LOG / 2)
#: Items of a quantile sketch; a rank is off by a third of a percent of the rows.
QUANTILE_ITEMS = 800
RANK_ERROR = 0.01
#: Values counted to find frequent ones; a count is off by at most this share of the rows.
VALUES_COUNTED = 20_000
COUNT_ERROR = 3.5 / VALUES_COUNTED
VALUES_KEPT = 100


def measure(df: DataFrame, name: str) -> Column:
    """What quantiles of a column are of: its number, days since 1970, seconds since then, or the length of its text."""
    kind = next(f.dataType for f in df.schema if f.name == name)
    if isinstance(kind, T.DateType):
        return F.unix_date(ref(name)).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return ref(name).cast("timestamp").cast("double")
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return ref(name).cast("double")
    return F.length(_text(df, name)).cast("double")


def _text(df: DataFrame, name: str) -> Column:
    kind = next(f.dataType for f in df.schema if f.name == name)
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(ref(name))
    return ref(name).cast("string")


def profile_parts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: column_name, row_count, null_count and three sketches, to be stored or merged.

    NaN has no place among quantiles and is left out there.
    """
    names = list(columns or df.columns)
    found = []
    for name in names:
        value, text = measure(df, name), _text(df, name)
        found.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.count(F.lit(1)).alias("row_count"),
                F.count_if(ref(name).isNull()).alias("null_count"),
                F.hll_sketch_agg(text, F.lit(DISTINCT_LOG)).alias("distinct"),
                F.kll_sketch_agg_double(F.when(~F.isnan(value), value), F.lit(QUANTILE_ITEMS)).alias("quantiles"),
                F.call_function("approx_top_k_accumulate", text, F.lit(VALUES_COUNTED)).alias("frequent"),
            )
        )
    return df.agg(F.array(*found).alias("parts")).select(F.inline("parts"))


def merge_profiles(*parts: DataFrame) -> DataFrame:
    """The parts of all rows together."""
    rows = reduce(DataFrame.unionByName, parts)
    return rows.groupBy("column_name").agg(
        F.sum("row_count").alias("row_count"),
        F.sum("null_count").alias("null_count"),
        F.hll_union_agg("distinct").alias("distinct"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"),
        F.call_function("approx_top_k_combine", F.col("frequent"), F.lit(VALUES_COUNTED)).alias("frequent"),
    )


def profile(parts: DataFrame, ranks: Sequence[float] = (0.0, 0.25, 0.5, 0.75, 1.0), top: int = 10) -> DataFrame:
    """(column_name, row_count, null_count, distinct_estimate, quantiles, frequent) of merged parts.

    `frequent` holds (item, count) with values as text, the most frequent first. Errors are at most
    DISTINCT_ERROR of the count, RANK_ERROR of the rows in rank, and COUNT_ERROR of the rows in a count, in
    all but a few of a thousand cases for the first two. Least and greatest, ranks 0 and 1, are exact. Where no
    value is certain to be more frequent than that error, `frequent` is empty.
    """
    some = F.kll_sketch_get_n_double("quantiles") > 0
    at = F.array(*[F.kll_sketch_get_quantile_double("quantiles", F.lit(r)) for r in ranks])
    return parts.select(
        "column_name",
        "row_count",
        "null_count",
        F.hll_sketch_estimate("distinct").alias("distinct_estimate"),
        F.when(some, at).alias("quantiles"),
        F.call_function("approx_top_k_estimate", F.col("frequent"), F.lit(top)).alias("frequent"),
    )


def run_most_frequent(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """Exact: how many rows hold the most frequent value of each column, nulls left out. One job; counts combine on the map side."""
    held = F.array(*[F.struct(F.lit(c).alias("column_name"), _text(df, c).alias("item")) for c in columns])
    counted = df.select(F.inline(held)).where("item is not null").groupBy("column_name", "item").count()
    found = {r["column_name"]: r["rows"] for r in counted.groupBy("column_name").agg(F.max("count").alias("rows")).collect()}
    return {c: found.get(c, 0) for c in columns}
