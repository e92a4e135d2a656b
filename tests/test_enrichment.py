import math
from datetime import date
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlane.operators import (
    Dimension,
    customer_metrics,
    left_lookup,
    order_info,
    order_measures,
    product_metrics,
    run_hot_keys,
    run_measure,
    summarize,
    wide_fact,
)
from ledgerlane.operators.lookups import heavy_hashes, hot_keys, run_hot_keys_by_hash, run_keys_of_hashes
from ledgerlane.plans import (
    PROFIT_TABLES,
    customer_table,
    fully_enriched,
    product_table,
    profit_grains,
    profit_sql,
    profit_table,
    profit_totals,
    register_view,
)

ORDER = (
    "customer_id string, discount double, order_date date, order_id string, price double, product_id string, "
    "profit double, quantity long, row_id long, ship_date date, ship_mode string"
)
CUSTOMER = "customer_id string, customer_name string, country string, state string"
PRODUCT = "product_id string, category string, sub_category string, state string"


def order(row, customer, product, price=10.0, quantity=2, discount=0.1, profit=1.0, day=date(2023, 1, 1)):
    return (customer, discount, day, f"o{row // 2}", price, product, profit, quantity, row, date(2023, 12, 31), "Slow")


LINES = [
    order(0, "c1", "p1", price=2.675, quantity=1, discount=0.0, profit=1.005),
    order(1, "c1", "p2", price=1.005, quantity=0, profit=-2.5, day=date(2022, 5, 5)),
    order(2, "c2", "p1", price=99.99, quantity=3, discount=0.25, profit=10.01),
    order(3, "c9", "p9", profit=0.335),
    order(4, None, None, profit=4.0),
    order(5, "c3", "p3", profit=7.125, day=date(2021, 7, 1)),
    order(6, "c1", "p1", profit=0.01),
]
PEOPLE = [("c1", "Ann", "X", "S1"), ("c2", "Ann", "Y", "S2"), ("c3", "Cid", "X", "S1"), ("c3", "Cid II", "Z", "S3")]
GOODS = [("p1", "A", "a1", "T1"), ("p2", "A", "a2", "T1"), ("p3", "B", "b1", "T2"), ("p3", "B", "b1", "T3")]


@pytest.fixture(scope="module")
def tables(spark):
    return (
        spark.createDataFrame(LINES, ORDER),
        spark.createDataFrame(PEOPLE, CUSTOMER),
        spark.createDataFrame(GOODS, PRODUCT),
    )


def contents(df):
    columns = sorted(df.columns)
    return sorted(repr([r[c] for c in columns]) for r in df.collect())


def test_wide_fact_keeps_orders_and_fans_out(tables):
    wide = wide_fact(*tables)
    assert wide.columns[:2] == ["product_id", "customer_id"]
    assert [c for c in wide.columns if "state" in c] == ["customer_state", "product_state"]
    counts = {r.row_id: r["count"] for r in wide.groupBy("row_id").count().collect()}
    assert counts == {0: 1, 1: 1, 2: 1, 3: 1, 4: 1, 5: 4, 6: 1}
    unmatched = wide.filter("row_id = 3").first()
    assert (unmatched.customer_name, unmatched.category, unmatched.order_year) == (None, None, 2023)


def test_salted_and_broadcast_lookups_give_the_plain_result(spark, tables):
    orders, customers, _ = tables
    plain = contents(left_lookup(orders, Dimension(customers, "customer_id")))
    hot = {"c1": 3, "c3": 2}
    assert contents(left_lookup(orders, Dimension(customers, "customer_id", hot=hot))) == plain
    assert contents(left_lookup(orders, Dimension(customers, "customer_id", small=True))) == plain


def test_hot_keys_get_a_salt_per_task_of_rows(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 10).alias("k"))
    hot = run_hot_keys(df, ["k"], rows_per_task=150)["k"]
    assert hot == {7: 7}


def test_all_of_many_hot_keys_get_salts(spark):
    df = spark.range(50_000).select((F.col("id") % 250).alias("k"), F.lit(None).cast("string").alias("none"))
    hot = run_hot_keys(df, ["k", "none"], rows_per_task=100)
    assert hot == {"k": {k: 2 for k in range(250)}, "none": {}}


def test_salted_lookup_of_rows_with_maps_and_copies(spark):
    fact = spark.sql("select explode(array(1, 1, 1, 2, null)) k, map('a', 1) m, array(struct(1 x)) a from range(40)")
    table = spark.createDataFrame([(1, "one"), (2, "two")], "k int, v string")
    plain = contents(fact.join(table, "k", "left"))
    assert contents(left_lookup(fact, Dimension(table, "k", hot={1: 5}))) == plain


def test_nested_columns_are_measured(spark):
    wide = spark.range(10).select("id", F.array_repeat(F.lit(123456789), 5000).alias("numbers"))
    assert not run_measure((wide, "id"), limit=400_000)[0].small
    assert run_measure((wide.select("id"), "id"), limit=400_000)[0].small


def test_measured_dimensions(spark, tables):
    _, customers, products = tables
    unknown = spark.createDataFrame([("a", None), (None, "x"), (None, "y")], "k string, v string")
    people, goods, unique = run_measure((customers, "customer_id"), (products, "product_id"), (unknown, "k"))
    assert (people.unique, goods.unique, unique.unique) == (False, False, True)
    assert people.small and goods.small
    large = run_measure((customers, "customer_id"), fact=tables[0], limit=10, rows_per_task=1)[0]
    assert not large.small
    assert large.hot == {"c1": 3}


def test_measures_round_half_up_on_the_decimal_value(tables):
    rows = {r.row_id: r for r in order_measures(tables[0]).collect()}
    assert rows[0].total_sales == 2.68
    assert rows[1].unit_selling_price is None
    assert rows[1].discount_amount == 0.1
    assert (rows[2].total_sales, rows[2].discount_amount, rows[2].final_price) == (299.97, 25.0, 274.97)
    assert rows[2].unit_selling_price == 91.66
    assert rows[5].days_to_ship == (date(2023, 12, 31) - date(2021, 7, 1)).days


def test_measures_of_values_without_a_decimal_form(spark):
    odd = [
        order(0, "c", "p", price=math.nan, profit=math.nan),
        order(1, "c", "p", price=1e300, profit=math.inf),
        order(2, "c", "p", profit=2.5),
    ]
    df = order_measures(spark.createDataFrame(odd, ORDER))
    rows = {r.row_id: r for r in df.collect()}
    assert math.isnan(rows[0].total_sales)
    assert rows[1].total_sales == 2e300
    metrics = customer_metrics(df).first()
    assert math.isnan(metrics.customer_lifetime_value) and math.isnan(metrics.avg_order_value)
    people = spark.createDataFrame([("c", "N", "X", "S")], CUSTOMER)
    goods = spark.createDataFrame([("p", "A", "a", "T")], PRODUCT)
    finite = df.filter("row_id > 0")
    for name in ("profit_by_year", "profit_by_customer"):
        totals = profit_totals(finite, people, goods, PROFIT_TABLES[name][0])
        assert profit_table(name, totals).first()[1] == math.inf


def test_metrics_equal_those_of_the_wide_fact(tables):
    measured = order_measures(wide_fact(*tables))
    assert contents(customer_table(*tables)) == contents(customer_metrics(measured))
    assert contents(product_table(*tables)) == contents(product_metrics(measured))
    ann = customer_table(*tables).filter("customer_id = 'c1'").first()
    assert (ann.total_orders, ann.avg_bag_size, str(ann.first_order_date)) == (2, 1.0, "2022-05-05")


def test_fully_enriched_equals_the_chain_of_joins(tables):
    measured = order_measures(wide_fact(*tables))
    chained = measured.join(product_metrics(measured), "product_id", "left")
    chained = chained.join(customer_metrics(measured), "customer_id", "left")
    enriched = fully_enriched(*tables)
    assert sorted(enriched.columns) == sorted(chained.columns)
    assert contents(enriched) == contents(chained)
    lone = enriched.filter("row_id = 4").first()
    assert lone.total_orders is None and lone.total_units_sold is None


def test_order_info(tables):
    info = order_info(wide_fact(*tables))
    assert info.columns == [
        "order_id", "customer_name", "country", "category", "sub_category", "quantity", "price", "discount", "profit",
    ]
    assert info.filter("customer_name is null and profit = 0.34").count() == 1


@pytest.mark.parametrize("name", PROFIT_TABLES)
@pytest.mark.parametrize("known", ["nothing", "measured", "hot"])
def test_profit_tables_equal_totals_of_the_wide_fact(tables, name, known):
    orders, customers, products = tables
    dimensions = (customers, products)
    if known == "measured":
        dimensions = run_measure((customers, "customer_id"), (products, "product_id"))
    if known == "hot":
        dimensions = (
            Dimension(customers, "customer_id", hot={"c1": 3, "c3": 2}),
            Dimension(products, "product_id", hot={"p1": 4, "p3": 2}),
        )
    keys, alias, sort = PROFIT_TABLES[name]
    planned = profit_table(name, profit_totals(orders, *dimensions, keys))
    direct = summarize(wide_fact(*tables), keys, "profit", F.sum, 2, alias, sort)
    assert contents(planned) == contents(direct)
    assert planned.schema[alias].dataType.simpleString() == "double"


@pytest.mark.parametrize("name", PROFIT_TABLES)
def test_unique_dimensions_are_left_out_without_changing_totals(tables, name):
    orders, customers, products = tables
    customers, products = customers.dropDuplicates(["customer_id"]), products.dropDuplicates(["product_id"])
    customers, products = customers.cache(), products.cache()
    keys, alias, _ = PROFIT_TABLES[name]
    planned = profit_totals(
        orders,
        Dimension(customers, "customer_id", unique=True),
        Dimension(products, "product_id", unique=True),
        keys,
    )
    direct = summarize(wide_fact(orders, customers, products), keys, "profit", F.sum, 2, alias)
    assert contents(profit_table(name, planned)) == contents(direct)


def test_grains_hold_every_table(tables):
    finest = PROFIT_TABLES["profit_by_year_cat_sub_customer"][0]
    grains = profit_grains(profit_totals(*tables, finest)).cache()
    for name, (keys, alias, _) in PROFIT_TABLES.items():
        part = grains.filter(F.col("grain") == name).select(*keys, F.col("profit").alias(alias))
        assert contents(part) == contents(profit_table(name, profit_totals(*tables, keys)))


def test_sql_reports_equal_the_tables(spark, tables):
    orders, customers, products = tables
    orders = orders.withColumn("profit", F.col("profit").cast("decimal(12,3)"))
    wide = wide_fact(orders, customers, products)
    register_view(wide)
    for name in ("profit_by_year", "profit_by_year_category", "profit_by_customer", "profit_by_customer_year"):
        planned = profit_table(name, profit_totals(orders, customers, products, PROFIT_TABLES[name][0]))
        assert contents(profit_sql(spark, name)) == contents(planned)
        assert contents(profit_sql(spark, name, wide)) == contents(planned)


def test_summarize(spark):
    rows = [("north", 12.25), ("north", 7.75), ("south", 31.0), ("south", 9.5), ("south", 0.5), (None, 6.0)]
    df = spark.createDataFrame(rows, "area string, weight double")
    total = summarize(df, ["area"], "weight", F.sum, 2, "total", [("total", "DESC")])
    assert [tuple(r) for r in total.collect()] == [("south", 41.0), ("north", 20.0), (None, 6.0)]
    assert total.dtypes == [("area", "string"), ("total", "double")]
    mean = summarize(df, ["area"], "weight", F.avg, 2, "mean", [("mean", "asc")])
    assert [tuple(r) for r in mean.collect()] == [(None, 6.0), ("north", 10.0), ("south", 13.67)]
    assert summarize(df, ["area"], "weight", F.max, 0, "m").count() == 3


def test_no_fact_row_travels_for_repeated_keys(tables, spark):
    """Beyond broadcasts, the fact is summed before it meets the repeated keys of silent dimensions."""
    orders, customers, products = tables
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keys = PROFIT_TABLES["profit_by_year"][0]
        totals = profit_totals(orders, customers, products, keys)
        plan = spark._jvm.PythonSQLUtils.explainString(totals._jdf.queryExecution(), "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    above_scan = [line for line in plan.split("\n") if "Exchange" in line or "Aggregate" in line or "Scan" in line]
    scan = max(i for i, line in enumerate(above_scan) if "Scan" in line and "profit" in line)
    assert "Aggregate" in above_scan[scan - 1] and "partial_sum" in above_scan[scan - 1]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.decimals(min_value=-1000, max_value=1000, places=3), min_size=1, max_size=40))
def test_sums_and_averages_are_exact(spark, values):
    df = spark.createDataFrame([("k", float(v)) for v in values], "k string, x double")
    total, mean = sum(values), sum(values) / len(values)
    two = Decimal("0.01")
    assert summarize(df, ["k"], "x", F.sum, 2, "s").first().s == float(total.quantize(two, "ROUND_HALF_UP"))
    assert summarize(df, ["k"], "x", F.avg, 2, "s").first().s == float(mean.quantize(two, "ROUND_HALF_UP"))


def test_measures_are_added_behind_the_lookups(spark, tables):
    """Five decimals a line need not travel through the shuffles of both lookups."""
    orders, customers, products = tables
    by_customer = customers.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))
    by_product = products.groupBy("product_id").agg(F.count(F.lit(1)).alias("m"))
    found = fully_enriched(orders, customers, products, by_customer, by_product, hot={"customer_id": {}, "product_id": {}})
    plan = found._jdf.queryExecution().analyzed().toString().split("\n")
    first_join = next(i for i, line in enumerate(plan) if "Join" in line)
    made = [i for i, line in enumerate(plan) if "total_sales" in line]
    assert made and max(made) < first_join


@pytest.mark.parametrize("small, last", [((), "customer_id"), (("customer_id",), "customer_id"), (("product_id",), "product_id")])
def test_lines_carry_the_narrower_table_through_the_next_shuffle(spark, tables, small, last):
    orders, customers, products = tables
    customers = customers.withColumn("note", F.lit("n"))
    metrics = [t.groupBy(k).agg(F.count(F.lit(1)).alias(n)) for t, k, n in ((customers, "customer_id", "n"), (products, "product_id", "m"))]
    known = [Dimension(t, k, small=k in small) for t, k in zip((customers, products, *metrics), ("customer_id", "product_id") * 2)]
    found = fully_enriched(orders, *known, hot={"customer_id": {}, "product_id": {}})
    plan = found._jdf.queryExecution().analyzed().toString().split("\n")
    assert last in next(line for line in plan if "Join" in line)
    assert found.count() == wide_fact(orders, customers, products).count()


def test_keys_behind_hot_hashes(spark):
    """A sketch of hashes finds the keys that one of the keys themselves finds."""
    df = spark.createDataFrame([(k,) for k in ["a"] * 900 + ["b"] * 350 + [None] * 500 + [f"x{i}" for i in range(300)]], "k string")
    seen = df.agg(heavy_hashes("k").alias("k")).first()["k"]
    assert run_keys_of_hashes(df, "k", hot_keys(seen, 300)) == run_hot_keys(df, ["k"], 300)["k"] == {"a": 3, "b": 2}
    assert run_keys_of_hashes(df.where("k = 'b'"), "k", hot_keys(seen, 300)) == {"b": 2}
    assert run_keys_of_hashes(df, "k", {}) == {}


def test_hot_keys_by_hash(spark):
    keys = ["a"] * 900 + ["b"] * 350 + [None] * 500 + [f"x{i}" for i in range(300)]
    df = spark.createDataFrame([(k, "one") for k in keys], "k string, n string")
    assert run_hot_keys_by_hash(df, ["k", "n"], 300) == {"k": {"a": 3, "b": 2}, "n": {"one": 7}}
    assert run_hot_keys_by_hash(df, ["k"]) == {"k": {}} and run_hot_keys_by_hash(df, []) == {}


def test_few_repeated_keys_of_a_large_table_are_broadcast(spark):
    orders = spark.range(4000).select(
        (F.col("id") % 50).alias("customer_id"), (F.col("id") % 40).alias("product_id"), F.lit(date(2020, 1, 1)).alias("order_date"),
        F.col("id").cast("decimal(12,2)").alias("profit"),
    )
    people = spark.range(50).select(F.col("id").alias("customer_id"), F.repeat(F.lit("x"), F.lit(1000)).alias("customer_name"))
    customers = people.union(people.where("customer_id in (3, 4)"))
    goods = spark.range(40).select(F.col("id").alias("product_id"), F.lit("c").alias("category"), F.lit("s").alias("sub_category"))
    known = run_measure((customers, "customer_id"), (goods, "product_id"), limit=2000)
    assert [(t.unique, t.small, t.few_repeated) for t in known] == [(False, False, True), (True, True, True)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        totals = profit_totals(orders, *known, PROFIT_TABLES["profit_by_year"][0])
        plan = totals._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        direct = wide_fact(orders, customers, goods).agg(F.sum("profit")).first()[0]
        assert totals.first()["profit"] == direct
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_cells_are_summed_once(tables, spark):
    """Sums by customer and product labels have hardly fewer rows than the lines, so only the cells are summed."""
    orders, customers, products = tables
    known = Dimension(customers, "customer_id", unique=True), Dimension(products, "product_id", unique=True)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        totals = profit_totals(orders, *known, PROFIT_TABLES["profit_by_year_cat_sub_customer"][0])
        plan = spark._jvm.PythonSQLUtils.explainString(totals._jdf.queryExecution(), "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum("Aggregate" in line and "partial_sum" in line for line in plan.split("\n")) == 1


def few_lines(spark, kind):
    """Lines without a customer, a product or both, with unknown ones and with keys that stand in for missing ones."""
    rows = [(n % 7 if n % 11 else None, n % 5 - 1 if n % 13 else None, n // 3, n % 3, n % 4 + 1, n) for n in range(200)]
    lines = spark.createDataFrame(rows, "customer_id long, product_id long, order_id long, row_id long, quantity long, cents long")
    lines = lines.union(spark.range(1 << 12).selectExpr("null", "id * 256", "id", "1", "1", "id"))
    day = F.date_add(F.lit(date(2020, 1, 1)), F.col("cents").cast("int") % 300)
    orders = lines.select(
        F.col("customer_id").cast(kind), F.lit(0.1).cast("decimal(4,2)").alias("discount"), day.alias("order_date"), "order_id",
        (F.col("cents") / 4).cast("decimal(12,2)").alias("price"), F.col("product_id").cast(kind),
        F.col("cents").cast("decimal(18,4)").alias("profit"), "quantity", "row_id", F.date_add(day, 3).alias("ship_date"),
    )
    customers = spark.range(1 << 12).select((F.col("id") * 256).cast(kind).alias("customer_id"), F.lit("c").alias("segment"))
    customers = customers.union(spark.range(5).select(F.col("id").cast(kind) + F.lit(1).cast(kind), F.lit("d"))) if kind == "bigint" else customers
    products = spark.range(-1, 3).select(F.col("id").cast(kind).alias("product_id"), F.lit("p").alias("category"))
    return orders, customers, products


@pytest.mark.parametrize("kind", ["bigint", "string"])
@pytest.mark.parametrize("repeated", [False, True])
def test_lines_meet_their_metrics_and_dimensions(spark, kind, repeated):
    """Where keys are hot, metrics are summed of a reading of their own; both ways give the same rows."""
    orders, customers, products = few_lines(spark, kind)
    products = products.union(products.limit(2)) if repeated else products
    known = Dimension(customers, "customer_id", unique=True), Dimension(products, "product_id", unique=not repeated)
    hot = {key: {orders.schema[key].dataType.typeName() == "string" and "2" or 2: 3} for key in ("customer_id", "product_id")}
    together = fully_enriched(orders, *known, hot={key: {} for key in hot})
    apart = fully_enriched(orders, *known, hot=hot)
    assert together.dtypes == apart.dtypes
    assert sorted(map(repr, together.collect())) == sorted(map(repr, apart.collect()))


def test_metrics_and_lookup_share_a_shuffle(spark):
    """Lines are shuffled once by each key, not once more for the metrics of it."""
    orders, customers, products = few_lines(spark, "bigint")
    known = Dimension(customers, "customer_id", unique=True), Dimension(products, "product_id", unique=True)
    changed = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for name, value in changed.items():
        spark.conf.set(name, value)
    try:
        found = fully_enriched(orders, *known, hot={"customer_id": {}, "product_id": {}})
        plan = spark._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "simple")
    finally:
        for name in changed:
            spark.conf.unset(name)
    made = [line for line in plan.split("\n") if "Exchange" in line and "Reused" not in line]
    # Lines by each key, and each dimension.
    assert len(made) == 4 and plan.count("ReusedExchange") == 2
