from ledgerlane.functions.money import (
    decimals_as_double,
    rounded_avg,
    rounded_difference,
    rounded_product,
    rounded_ratio,
    rounded_sum,
)
from ledgerlane.functions.names import quoted, ref
from ledgerlane.functions.parsing import parse_as, parse_date
from ledgerlane.functions.predicates import compare, compare_columns, is_email

__all__ = [
    "compare",
    "compare_columns",
    "decimals_as_double",
    "is_email",
    "parse_as",
    "parse_date",
    "quoted",
    "ref",
    "rounded_avg",
    "rounded_difference",
    "rounded_product",
    "rounded_ratio",
    "rounded_sum",
]
