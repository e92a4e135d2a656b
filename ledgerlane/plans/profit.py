"""Profit totals at several grains, aggregated before the dimensions are joined."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import mul

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlane.functions import ref
from ledgerlane.functions.money import COPIES_BESIDE_ADDEND, WHOLE, exact_and_rest, is_floating
from ledgerlane.operators.lookups import Dimension, dimension, left_lookup, with_copies
from ledgerlane.operators.metrics import ordering

CUSTOMER_LABELS = ("customer_name",)
PRODUCT_LABELS = ("category", "sub_category")

# The published profit tables as (keys, result column, sort order).
PROFIT_TABLES = {
    "profit_by_year_cat_sub_customer": (
        ("order_year", "category", "sub_category", "customer_name"),
        "total_profit",
        (("order_year", "asc"), ("category", "asc"), ("sub_category", "asc"), ("customer_name", "asc")),
    ),
    "profit_by_year": (
        ("order_year",),
        "profit_per_year",
        (("order_year", "asc"),),
    ),
    "profit_by_year_category": (
        ("order_year", "category"),
        "profit_per_year_category",
        (("order_year", "asc"), ("profit_per_year_category", "desc")),
    ),
    "profit_by_customer": (
        ("customer_name",),
        "profit_per_customer",
        (("profit_per_customer", "desc"),),
    ),
    "profit_by_customer_year": (
        ("customer_name", "order_year"),
        "profit_per_customer_year",
        (("order_year", "asc"), ("profit_per_customer_year", "desc")),
    ),
}


# The keys of the finest table, from which all others can be summed.
FINEST = PROFIT_TABLES["profit_by_year_cat_sub_customer"][0]


def cell_totals(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Unrounded profit by some of the keys, from unrounded profit by the finest ones."""
    return _add_up(cells, keys)


def _add_up(df: DataFrame, keys: Sequence[str], copies: Sequence[str] = ()) -> DataFrame:
    """Partial sums stay exact decimals until the last step rounds them.

    With doubles in the fact there is a second sum, of what has no exact form; rows that occur too
    often for an exact product go there.
    """
    if not copies:
        sums = [_narrow(F.sum("profit"), df).alias("profit")]
        return df.groupBy(*keys).agg(*sums, *(F.sum(c).alias(c) for c in df.columns if c == "profit_rest"))
    weight = reduce(mul, [ref(name).cast(WHOLE) for name in copies])
    if "profit_rest" not in df.columns:
        return df.groupBy(*keys).agg(_narrow(F.sum(ref("profit") * weight), df).alias("profit"))
    exact = ref("profit") * weight.try_cast(COPIES_BESIDE_ADDEND)
    in_doubles = F.when(exact.isNull(), ref("profit").cast("double"))
    rest = F.coalesce(ref("profit_rest") + F.coalesce(in_doubles, F.lit(0.0)), in_doubles) * weight.cast("double")
    return df.groupBy(*keys).agg(_narrow(F.sum(exact), df).alias("profit"), F.sum(rest).alias("profit_rest"))


def _narrow(total: Column, df: DataFrame) -> Column:
    """Back to a width that leaves room for the next product; sums of profit have at most 20 whole digits."""
    return total.cast(T.DecimalType(28, df.schema["profit"].dataType.scale))


def _look_up(rows: DataFrame, table: Dimension, labels: Sequence[str], copies: str) -> DataFrame:
    """Adds labels and, for a table with repeated keys, how many of its rows carry them."""
    if table.unique:
        return left_lookup(rows, table.of(table.df.select(table.key, *labels)))
    counted = table.df.groupBy(table.key, *labels).agg(F.count(F.lit(1)).alias(copies))
    return left_lookup(rows, table.of(counted)).fillna(1, [copies])


def profit_totals(
    orders: DataFrame,
    customers: DataFrame | Dimension,
    products: DataFrame | Dimension,
    keys: Sequence[str],
) -> DataFrame:
    """Unrounded profit by any of order_year, category, sub_category and customer_name.

    Equal to summing over the wide fact, but the fact never travels through a join it does not
    need. A dimension without a wanted label matters only through its duplicate keys, and not at
    all when it is known to be unique. Unless a broadcast makes it pointless, labels of one dimension are
    looked up on partial sums, so a key that holds a third of the fact is a few rows when it is joined.
    With labels of both, sums by customer and product hardly have fewer rows than the fact: narrow lines
    go through both lookups, which spread hot keys, and are summed once.
    """
    customers, products = dimension(customers, "customer_id"), dimension(products, "product_id")
    customer_labels = [k for k in keys if k in CUSTOMER_LABELS]
    product_labels = [k for k in keys if k in PRODUCT_LABELS]
    year = ["order_year"] if "order_year" in keys else []
    silent = []
    if not customer_labels and not customers.unique:
        silent.append(customers)
    if not product_labels and not products.unique:
        silent.append(products)
    ids = [
        *(["customer_id"] if customer_labels or customers in silent else []),
        *(["product_id"] if product_labels or products in silent else []),
    ]

    columns = [*ids, *([F.year("order_date").alias("order_year")] if year else [])]
    exact, rest = exact_and_rest(ref("profit"), is_floating(orders, "profit"))
    columns.append(exact.alias("profit"))
    if rest is not None:
        columns.append(rest.alias("profit_rest"))
    rows, copies = orders.select(*columns), []

    if silent:
        if not all(table.small or table.few_repeated for table in silent):
            # Without a broadcast the fact would travel: its sums do instead.
            rows = _add_up(rows, [*ids, *year])
        rows, copies = with_copies(rows, silent, "__copies"), ["__copies"]
    if product_labels:
        if not products.small and not customer_labels:
            rows, copies = _add_up(rows, ["product_id", *year], copies), []
        rows = _look_up(rows, products, product_labels, "__products")
        copies += ["__products"] if not products.unique else []
    if customer_labels:
        if not customers.small and not product_labels:
            rows, copies = _add_up(rows, ["customer_id", *year], copies), []
        rows = _look_up(rows, customers, customer_labels, "__customers")
        copies += ["__customers"] if not customers.unique else []
    return _add_up(rows, keys, copies)


def _rounded(totals: DataFrame) -> Column:
    exact = F.round("profit", 2).cast("double")
    if "profit_rest" not in totals.columns:
        return exact
    return F.when(ref("profit_rest").isNull(), exact).otherwise(
        F.round(F.coalesce(ref("profit").cast("double"), F.lit(0.0)) + ref("profit_rest"), 2)
    )


def profit_table(name: str, totals: DataFrame) -> DataFrame:
    """One published profit table from totals at its own grain, rounded and sorted."""
    keys, alias, order = PROFIT_TABLES[name]
    return totals.select(*keys, _rounded(totals).alias(alias)).orderBy(*ordering(order))


def profit_grains(cells: DataFrame) -> DataFrame:
    """All five tables in one pass over the finest totals.

    `grain` names the table; keys that are not part of it are null. It comes from the grouping
    bits, so a genuinely null key is never mistaken for a subtotal.
    """
    finest = list(FINEST)
    grouping_sets = [[ref(k) for k in keys] for keys, _, _ in PROFIT_TABLES.values()]
    bits = F.grouping_id(*[ref(k) for k in finest])
    sums = [F.sum(c).alias(c) for c in ("profit", "profit_rest") if c in cells.columns]
    totals = cells.groupingSets(grouping_sets, *[ref(k) for k in finest]).agg(bits.alias("__bits"), *sums)
    grain = F.lit(None).cast("string")
    for name, (keys, _, _) in PROFIT_TABLES.items():
        code = sum(1 << (len(finest) - 1 - i) for i, k in enumerate(finest) if k not in keys)
        grain = F.when(F.col("__bits") == code, name).otherwise(grain)
    return totals.select(grain.alias("grain"), *finest, _rounded(totals).alias("profit"))
