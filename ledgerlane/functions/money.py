"""Money arithmetic that rounds half up on the decimal value, not on binary noise.

Inputs may be decimals, whole numbers or doubles. Decimals and whole numbers are kept exact at the
widths of their own types. A double is read as a decimal only where that decimal is the same double
again; all others (NaN, infinities, more digits than fit) take double arithmetic, so no value is cut
off or lost from a product, a sum or an average.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlane.functions.names import ref

# Widths for doubles, chosen so that products and weighted sums keep all their digits within 38.
# They limit nothing: what does not fit them is calculated in doubles.
FACTOR = "decimal(24,8)"
RATE = "decimal(13,8)"
ADDEND = T.DecimalType(28, 8)
COUNT_BESIDE_FACTOR = "decimal(12,0)"
COPIES_BESIDE_ADDEND = "decimal(9,0)"
# Holds every bigint.
WHOLE = "decimal(20,0)"


def is_floating(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))


def is_decimal(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.DecimalType)


def lossless(value: Column, kind: str | T.DecimalType) -> Column:
    """A double as a decimal, or null where the decimal is another number."""
    exact = value.try_cast(kind)
    return F.when(exact.cast("double") == value, exact)


def _exact(df: DataFrame, name: str, beside_floating: bool, floating: str = FACTOR) -> Column:
    if is_floating(df, name):
        return lossless(ref(name), floating)
    if is_decimal(df, name):
        return ref(name)
    return ref(name).try_cast(COUNT_BESIDE_FACTOR) if beside_floating else ref(name).cast(WHOLE)


def _or_double(exact: Column, fallback: Column, floating: bool) -> Column:
    """Exact values where there are any, else the double result, in the type of the inputs."""
    if floating:
        return F.coalesce(exact.cast("double"), fallback)
    return F.coalesce(exact, fallback.try_cast("decimal(38,2)"))


def rounded_product(df: DataFrame, left: str, right: str, digits: int = 2) -> Column:
    floating = is_floating(df, left) or is_floating(df, right)
    factors = _exact(df, left, floating), _exact(df, right, floating, RATE)
    exact = F.round(F.try_multiply(*factors), digits)
    return _or_double(exact, F.round(ref(left).cast("double") * ref(right).cast("double"), digits), floating)


def rounded_difference(left: str, right: str, digits: int = 2) -> Column:
    """Of amounts that are already rounded, so even a double difference is within noise of the answer."""
    return F.round(ref(left) - ref(right), digits)


def rounded_ratio(df: DataFrame, amount: str, divisor: str, digits: int = 2) -> Column:
    """`amount / divisor`; null for a zero divisor."""
    floating = is_floating(df, amount) or is_floating(df, divisor)
    by = F.nullif(ref(divisor), F.lit(0))
    exact_by = F.nullif(_exact(df, divisor, floating), F.lit(0).cast(WHOLE))
    exact = F.round(F.try_divide(_exact(df, amount, floating), exact_by), digits)
    return _or_double(exact, F.round(ref(amount).cast("double") / by.cast("double"), digits), floating)


def exact_and_rest(value: Column, floating: bool, copies: Column | None = None) -> tuple[Column, Column | None]:
    """What of an addend can be summed exactly, each row counted `copies` times, and what can't, as doubles.

    One of the two is null for every row. Without floating values there is no second part.
    """
    if not floating:
        return (value if copies is None else value * copies.cast(WHOLE)), None
    exact = lossless(value, ADDEND)
    if copies is None:
        return exact, F.when(exact.isNull(), value)
    exact = exact * copies.try_cast(COPIES_BESIDE_ADDEND)
    return exact, F.when(exact.isNull(), value * copies.cast("double"))


def _split(df: DataFrame, name: str, copies: str | None) -> tuple[Column, Column | None]:
    weight = None if copies is None else ref(copies)
    if isinstance(df.schema[name].dataType, T.IntegralType):
        value = ref(name) if weight is None else ref(name).cast(WHOLE) * weight.cast(WHOLE)
        return value, None
    return exact_and_rest(ref(name), is_floating(df, name), weight)


def rounded_sum(df: DataFrame, name: str, digits: int = 2, copies: str | None = None) -> Column:
    """Aggregate: sum of a column, each row counted `copies` times."""
    exact, rest = _split(df, name, copies)
    return finished_sum(F.sum(exact), None if rest is None else F.sum(rest), digits)


def finished_sum(exact: Column, leftover: Column | None, digits: int) -> Column:
    """The rounded total of an exact sum and a sum of doubles, null where there were none."""
    total = F.round(exact, digits)
    if leftover is None:
        return total
    return F.when(leftover.isNull(), total.cast("double")).otherwise(
        F.round(F.coalesce(exact.cast("double"), F.lit(0.0)) + leftover, digits)
    )


def rounded_avg(df: DataFrame, name: str, digits: int = 2, copies: str | None = None) -> Column:
    """Aggregate: average of the non-null values, each row counted `copies` times."""
    exact, rest = _split(df, name, copies)
    rows = F.count(ref(name)) if copies is None else F.sum(F.when(ref(name).isNotNull(), ref(copies).cast(WHOLE)))
    leftover = None if rest is None else F.sum(rest)
    return finished_avg(F.sum(exact), leftover, rows, df.schema[name].dataType, digits)


def finished_avg(exact: Column, leftover: Column | None, rows: Column, kind: T.DataType, digits: int) -> Column:
    """The rounded average of values of a type, from their sums and their number.

    Divides an exact sum by an exact count, which keeps at least 15 digits for two-digit money;
    averaging decimals directly would round to six digits first and can turn 0.1249996 into 0.13.
    """
    decimal = isinstance(kind, T.DecimalType)
    scale = kind.scale if decimal else ADDEND.scale if leftover is not None else 0
    some_rows = F.nullif(rows.cast(WHOLE), F.lit(0).cast(WHOLE))
    # A sum too large for this width has no decimal places left to lose in a double.
    total = exact.try_cast(T.DecimalType(20 + scale, scale))
    in_doubles = F.coalesce(exact.cast("double"), F.when(rows > 0, F.lit(0.0)))
    mean = F.round(F.try_divide(total, some_rows), digits)
    if leftover is None:
        mean = F.coalesce(mean, F.round(exact.cast("double") / some_rows.cast("double"), digits).try_cast("decimal(38,6)"))
        return mean if decimal else mean.cast("double")
    return F.when(leftover.isNull() & total.isNotNull(), mean.cast("double")).otherwise(
        F.round((in_doubles + F.coalesce(leftover, F.lit(0.0))) / some_rows.cast("double"), digits)
    )


def addends(df: DataFrame, name: str) -> tuple[Column, Column | None]:
    """What of a column can be summed exactly, and what can't, as doubles; the second is None if all can."""
    return _split(df, name, None)


def decimals_as_double(df: DataFrame) -> DataFrame:
    """Decimal columns leave the engine as doubles, the type the published schemas use."""
    return df.select(
        *[
            ref(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else ref(f.name)
            for f in df.schema
        ]
    )
