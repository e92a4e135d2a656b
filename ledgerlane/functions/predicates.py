"""Row predicates as unevaluated, three-valued Columns."""

from __future__ import annotations

import operator
import re
from decimal import Decimal
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlane.functions.names import ref

COMPARISONS = {
    ">": operator.gt,
    "<": operator.lt,
    ">=": operator.ge,
    "<=": operator.le,
    "==": operator.eq,
    "!=": operator.ne,
}

NUMBER = re.compile(r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d{1,3})?")

# Fixed value: what counts as an email address.
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"


def _comparison(symbol: str):
    if symbol not in COMPARISONS:
        raise ValueError(f"Unknown comparison {symbol!r}; expected one of {', '.join(COMPARISONS)}")
    return COMPARISONS[symbol]


def compare(column: str, symbol: str, value: Any, kind: T.DataType | None = None) -> Column:
    """Column against a literal.

    A text is compared as Spark does with a column of that type: as text with texts, as a date with dates.
    Only with a number column a text that reads as a number is that number: "0.5" against whole
    numbers is 0.5, not an error. Without `kind`, the column's type, the plan itself asks for it; the answer
    is known before the plan runs, but the numbers then pass through their texts and reach no scan filter.
    """
    chosen = _comparison(symbol)
    plain = chosen(ref(column), F.lit(value))
    if not isinstance(value, str) or not NUMBER.fullmatch(value.strip()):
        return plain
    number = Decimal(value.strip())
    wide = len(number.as_tuple().digits) > 30 or abs(number.adjusted()) > 15
    if kind is not None:
        return chosen(ref(column), F.lit(float(number) if wide else number)) if isinstance(kind, T.NumericType) else plain
    text = ref(column).cast("string")
    as_double = chosen(text.try_cast("double"), F.lit(float(number)))
    exact = as_double if wide else F.coalesce(chosen(text.try_cast("decimal(38,18)"), F.lit(number)), as_double)
    type_name = F.typeof(ref(column))
    whole = type_name.isin("tinyint", "smallint", "int", "bigint") | type_name.startswith("decimal")
    return F.when(type_name.isin("double", "float"), as_double).when(whole, exact).otherwise(plain)


def compare_columns(left: str, symbol: str, right: str) -> Column:
    return _comparison(symbol)(ref(left), ref(right))


def is_email(column: str, strict: bool = False) -> Column:
    """Null stays null. `strict` also refuses the one trailing newline that `$` lets through."""
    pattern = EMAIL_PATTERN[:-1] + r"\z" if strict else EMAIL_PATTERN
    return ref(column).rlike(pattern)
