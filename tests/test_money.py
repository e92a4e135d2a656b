"""Amounts, weights and counts beyond the widths that doubles get in decimals."""

import math

import pytest
from pyspark.sql import functions as F

from ledgerlane.functions import rounded_avg, rounded_product, rounded_ratio, rounded_sum
from ledgerlane.operators.lookups import Dimension
from ledgerlane.operators.measures import order_measures
from ledgerlane.plans.profit import PROFIT_TABLES, profit_table, profit_totals


def value(spark, rows, schema, column):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(column(df).alias("v")).collect()]


@pytest.mark.parametrize(
    "left, right, product",
    [
        (1e9, 0.1234567890123, 123456789.01),
        (1.005, 1.0, 1.01),
        (1.005, 2.5, 2.51),
        (12345.678901234, 3.0, 37037.04),
        (1e20, 0.5, 5e19),
        (float("inf"), 2.0, float("inf")),
        (None, 2.0, None),
    ],
)
def test_products_of_doubles(spark, left, right, product):
    found = value(spark, [(left, right)], "a double, b double", lambda df: rounded_product(df, "a", "b"))
    assert found == [product]


def test_large_counts(spark):
    rows = [(2.5, 4 * 10**12), (0.01, 9 * 10**18), (1.0, 3)]
    products = value(spark, rows, "p double, q long", lambda df: rounded_product(df, "p", "q"))
    assert products == [1e13, 9e16, 3.0]
    rows = spark.createDataFrame(rows, "p double, q long").selectExpr("cast(p as decimal(10,2)) p", "q")
    found = rows.select(rounded_product(rows, "p", "q").alias("v"), rounded_ratio(rows, "p", "q").alias("r")).collect()
    assert [float(r.v) for r in found] == [1e13, 9e16, 3.0]
    assert [float(r.r) for r in found] == [0.0, 0.0, 0.33]
    ratio = value(spark, [(1e13, 3 * 10**12), (5.0, 0)], "a double, q long", lambda df: rounded_ratio(df, "a", "q"))
    assert ratio == [3.33, None]


def test_measures_of_large_quantities(spark):
    lines = spark.sql(
        "select cast(2.50 as decimal(10,2)) price, cast(2000000000000 as bigint) quantity, cast(0.1 as decimal(4,2)) discount, "
        "date'2024-01-03' ship_date, date'2024-01-01' order_date"
    )
    row = order_measures(lines).first()
    assert (float(row.total_sales), float(row.final_price), float(row.unit_selling_price)) == (5e12, 4999999999999.75, 2.5)


def test_sums_and_averages_keep_every_digit(spark):
    df = spark.range(100_000).select(F.lit(4e-9).alias("x"), F.lit(10**10).alias("n"))
    row = df.agg(rounded_sum(df, "x", 6).alias("s"), rounded_avg(df, "x", 9).alias("a"), rounded_sum(df, "x", 2, "n").alias("w")).first()
    assert row.s == pytest.approx(0.0004, abs=1e-9) and row.a == pytest.approx(4e-9) and row.w == pytest.approx(4e6)
    df = spark.createDataFrame([(0.125, 10**13), (0.375, 3 * 10**13), (None, 5)], "x double, n long")
    row = df.agg(rounded_avg(df, "x", 4, "n").alias("a"), rounded_sum(df, "x", 2, "n").alias("s")).first()
    assert (row.a, row.s) == (0.3125, 12.5e12)
    df = spark.createDataFrame([(10**18, 10**13)] * 3, "x long, n long")
    row = df.agg(rounded_avg(df, "x", 2, "n").alias("a"), rounded_sum(df, "x", 2, "n").alias("s")).first()
    assert float(row.a) == 1e18 and float(row.s) == 3e31
    assert df.where("false").agg(rounded_avg(df, "x").alias("a")).first().a is None


def test_copies_beyond_a_billion(spark):
    orders = spark.sql(
        "select 1L customer_id, 1L product_id, date'2024-02-01' order_date, explode(array(0.25D, 1.123456789012D)) profit"
    )
    many = spark.range(1).select(F.lit(1).cast("long").alias("product_id"), F.lit("c").alias("category"), F.lit("s").alias("sub_category"))
    customers = spark.createDataFrame([(1, "x")] * 3, "customer_id long, customer_name string")
    found = profit_table("profit_by_year", profit_totals(orders, Dimension(customers, "customer_id"), Dimension(many, "product_id", unique=True), PROFIT_TABLES["profit_by_year"][0]))
    assert found.first()[1] == pytest.approx(round(3 * 1.373456789012, 2))
    from ledgerlane.plans.profit import _add_up

    rows = spark.sql("select 'k' k, cast(0.25 as decimal(28,8)) profit, cast(null as double) profit_rest, 5000000000L c")
    row = _add_up(rows.union(spark.sql("select 'k', null, 1.5D, 2L")), ["k"], ["c"]).first()
    assert row.profit is None and math.isclose(row.profit_rest, 1.25e9 + 3)
