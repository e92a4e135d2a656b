"""Lookups by key and time: the version of a row that is valid at a date, or the last one before it.

Time is cut into ranges. An interval is repeated for each range it touches, a date lies in one, so
the join is one on key and range; the dates are compared only within it. A range is as long as the
intervals are on average, so that these are repeated once or twice. Only keys with very many lines or
versions have shorter ranges, and are spread over them.
"""

from __future__ import annotations

import math
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlane.functions import ref
from ledgerlane.operators.lookups import BROADCAST_BYTES, ROWS_PER_TASK, heavy_hitters, hot_keys, row_bytes

#: Ranges that the dates of the lines are cut into; no interval is repeated more often.
RANGES = 64
#: Kinds of keys that a sketch counts.
COUNTED = (T.IntegralType, T.DecimalType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _day(column: Column) -> Column:
    """Days since 1970 of a date or time; never falls as time goes on."""
    return F.unix_date(column.cast("date"))


def _hitters(df: DataFrame, key: str) -> Column:
    kind = next(f.dataType for f in df.schema if f.name == key)
    return heavy_hitters(key) if isinstance(kind, COUNTED) else F.lit(None)


def _run_lines(fact: DataFrame, key: str, at: str, rows_per_task: int) -> tuple[tuple[date, date] | None, list]:
    """First and last date of the lines, and the keys that have more of them than a task should read."""
    day = ref(at).cast("date")
    first, last, hitters = fact.agg(F.min(day), F.max(day), _hitters(fact, key)).first()
    return None if first is None else (first, last), list(hot_keys(hitters, rows_per_task))


def run_interval_lookup(
    fact: DataFrame,
    table: DataFrame,
    key: str,
    at: str,
    start: str,
    end: str,
    how: str = "left",
    end_included: bool = True,
    span: tuple[date, date] | None = None,
    ranges: int = RANGES,
    limit: int = BROADCAST_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Lines with the rows of `table` that have their key and whose interval holds their date.

    A null start or end is open. Intervals may overlap, and then repeat lines, as BETWEEN does; a line
    without a match, a key or a date keeps nulls ("left") or goes ("inner"). Dates or times of one type.
    The columns of the table but its key come after those of the lines. `span` holds the first and last
    date of the lines; a job finds it and the keys with many lines, another one measures the intervals. Spark
    can't estimate how often these are repeated, so beyond `limit` bytes it is kept from a broadcast.
    """
    found, crowded = _run_lines(fact, key, at, rows_per_task)
    span = span or found
    if span is None:
        span = (date(1970, 1, 1), date(1970, 1, 1))
    epoch = date(1970, 1, 1)
    low, high = ((d - epoch).days for d in span)
    least = max(1, math.ceil((high - low + 1) / ranges))
    begin = F.greatest(F.coalesce(_day(ref(start)), F.lit(low)), F.lit(low))
    over = F.least(F.coalesce(_day(ref(end)), F.lit(high)), F.lit(high))
    inside = table.where(ref(key).isNotNull() & (begin <= over))
    length, size, hitters = inside.agg(F.avg(over - begin + 1), F.sum(row_bytes(table)), _hitters(table, key)).first()
    days = max(least, math.ceil(length or 0))
    # A key with more versions than there are ranges.
    crowded = [*{*crowded, *hot_keys(hitters, ranges)}] if days > least else []

    def place(day: Column) -> Column:
        width = F.when(ref(key).isin(crowded), least).otherwise(days) if crowded else F.lit(days)
        return F.floor((day - low) / width).cast("int")

    touching = inside.withColumns({"__from": place(begin), "__to": place(over)})
    others = [c for c in table.columns if c != key]
    names = {c: f"__c{i}" for i, c in enumerate(others)}
    repeated = touching.select(
        ref(key).alias("__key"), *[ref(c).alias(n) for c, n in names.items()], F.explode(F.sequence("__from", "__to")).alias("__range")
    )
    placed = fact.withColumn("__place", place(_day(ref(at))))
    begins, ends = F.col(names[start]), F.col(names[end])
    until = ref(at) <= ends if end_included else ref(at) < ends
    within = (begins.isNull() | (begins <= ref(at))) & (ends.isNull() | until)
    same = (ref(key) == F.col("__key")) & (F.col("__place") == F.col("__range")) & within
    # An interval of average length touches two ranges at most.
    joined = placed.join(repeated if 2 * (size or 0) <= limit else repeated.hint("merge"), same, how)
    return joined.select(*map(ref, fact.columns), *[F.col(n).alias(c) for c, n in names.items()])


def as_intervals(versions: DataFrame, key: str, since: str, until: str) -> DataFrame:
    """Adds the date at which the next version of a key begins, null for its last one.

    Of versions that begin together the greatest row, column by column, counts.
    """
    columns = [c for c in versions.columns if c not in (key, since)]
    whole = F.struct(*map(ref, columns)) if columns else F.struct(F.lit(1))
    latest = versions.where(ref(since).isNotNull()).groupBy(ref(key), ref(since)).agg(F.max(whole).alias("__row"))
    following = F.lead(ref(since)).over(Window.partitionBy(ref(key)).orderBy(ref(since)))
    return latest.withColumn("__next", following).select(
        ref(key), ref(since), *[F.col("__row").getField(c).alias(c) for c in columns], F.col("__next").alias(until)
    )


def run_as_of_lookup(
    fact: DataFrame, versions: DataFrame, key: str, at: str, since: str, how: str = "left", span: tuple[date, date] | None = None
) -> DataFrame:
    """Lines with the version of their key that began last, on their date or before.

    Each line matches one version at most. Otherwise as `run_interval_lookup`.
    """
    until = "__until"
    found = run_interval_lookup(
        fact, as_intervals(versions, key, since, until), key, at, since, until, how, end_included=False, span=span
    )
    return found.drop(until)
