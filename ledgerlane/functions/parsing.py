"""Text to typed values; anything unparsable becomes null instead of an ANSI error."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Accepted date layouts, tried in this order, day first.
DATE_FORMATS = ("d/M/yyyy", "yyyy-MM-dd")

# Texts of one of the layouts with plain digits, and those of them whose month and day can be meant.
# A year 0 is left to the layouts.
_DAY_FIRST = r"^(0?[1-9]|[12]\d|3[01])/(0?[1-9]|1[0-2])/(?!0000)\d{4}\z"
_YEAR_FIRST = r"^(?!0000)\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])\z"
_PLAIN = r"^(\d{1,2}/\d{1,2}/(?!0000)\d{4}|(?!0000)\d{4}-\d{2}-\d{2})\z"
# No whole number holds a printable character of ASCII but digits and signs; each holds a digit.
_MAY_BE_WHOLE = r"^[^!-*,./:-~]*[0-9][^!-*,./:-~]*\z"
_WHOLE_TYPES = ("tinyint", "byte", "smallint", "short", "int", "integer", "bigint", "long")


def parse_date(column: Column, source: T.DataType | None = None) -> Column:
    """First layout that fits; columns that already hold a date or timestamp are only cast.

    A layout is tried only on texts that hold its separator. It could not fit others, and a failed
    parse costs an exception, which would dominate the scan of a feed in the second layout. Texts of
    plain digits are cast, or known to be no date, without either.
    """
    if isinstance(source, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return column.cast("date")
    text = column if source is None or isinstance(source, T.StringType) else column.cast("string")
    by_layout = F.coalesce(
        *[
            F.when(F.contains(text, F.lit(re.search(r"\W", layout).group())), F.try_to_date(text, layout))
            for layout in DATE_FORMATS
        ]
    )
    turned = F.concat_ws("-", *[F.split_part(text, F.lit("/"), F.lit(part)) for part in (3, 2, 1)])
    return (
        F.when(text.rlike(_YEAR_FIRST), text.try_cast("date"))
        .when(text.rlike(_DAY_FIRST), turned.try_cast("date"))
        .when(text.rlike(_PLAIN), F.lit(None).cast("date"))
        .otherwise(by_layout)
    )


def parse_as(column: Column, type_name: str, source: T.DataType | None = None) -> Column:
    """`column` as a SQL type name ("string", "long", "double", "date", ...), null if impossible.

    Texts that can't be whole numbers are not cast to one: a failed cast costs an exception too.
    """
    kind = type_name.strip().lower()
    if kind == "date":
        return parse_date(column, source)
    if kind in _WHOLE_TYPES and isinstance(source, T.StringType):
        return F.when(column.rlike(_MAY_BE_WHOLE), column.try_cast(type_name))
    return column.try_cast(type_name)
