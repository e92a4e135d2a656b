"""One query per operator. Each takes a session and a table folder and returns a DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import timedelta
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlane import operators as ops
from ledgerlane.contracts import CUSTOMERS, ORDERS, PRODUCTS
from ledgerlane.functions import compare, compare_columns, decimals_as_double, is_email
from ledgerlane.operators.differences import key_changes, row_differences
from ledgerlane.operators.intervals import run_as_of_lookup, run_interval_lookup
from ledgerlane.operators.profiles import (
    COUNT_ERROR,
    DISTINCT_ERROR,
    RANK_ERROR,
    measure,
    merge_profiles,
    profile,
    profile_parts,
    run_most_frequent,
)
from ledgerlane.operators.quality import FAILED_RULES, FIRST_FAILED
from ledgerlane.operators.sessions import run_sessions
from ledgerlane.operators.top import run_top
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
from ledgerlane.plans.incremental import CUSTOMER_METRICS, PRODUCT_METRICS, MetricStore, read_totals, write_load
from ledgerlane.plans.ingest import Store, run_ingest
from ledgerlane.session import changed_settings
from ledgerlane.settings import Settings
from ledgerlane.sinks import BATCH, stage, staging_folder, write_table
from ledgerlane.sources import decode_workbooks, read_dataset
from ledgerlane.sources.files import CORRUPT
from ledgerlane.streaming import run_drops
from workload import views
from workload.workbooks import as_workbooks, write_workbooks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

OPERATORS = {"gt": ">", "lt": "<", "ge": ">=", "le": "<=", "eq": "==", "ne": "!="}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


# Profit tables ------------------------------------------------------------------------------


def _profit(spark: SparkSession, folder: str, name: str) -> DataFrame:
    orders, customers, products = views.measured(spark, folder)
    return profit_table(name, profit_totals(orders, customers, products, PROFIT_TABLES[name][0]))


def _profit_sql(spark: SparkSession, folder: str, name: str) -> DataFrame:
    register_view(
        ops.wide_fact(
            views.orders(spark, folder),
            views.clean_customers(spark, folder),
            views.clean_products(spark, folder),
        )
    )
    return profit_sql(spark, name)


for _name in PROFIT_TABLES:
    QUERIES[_name] = partial(_profit, name=_name)
for _name in ("profit_by_year", "profit_by_year_category", "profit_by_customer", "profit_by_customer_year"):
    QUERIES[f"{_name}_sql"] = partial(_profit_sql, name=_name)


@query
def profit_all_grains(spark: SparkSession, folder: str) -> DataFrame:
    orders, customers, products = views.measured(spark, folder)
    finest = PROFIT_TABLES["profit_by_year_cat_sub_customer"][0]
    return profit_grains(profit_totals(orders, customers, products, finest))


@query
def profit_by_year_category_fan_out(spark: SparkSession, folder: str) -> DataFrame:
    """Both dimensions hold repeated keys."""
    name = "profit_by_year_category"
    totals = profit_totals(*views.measured(spark, folder, repeated=True), PROFIT_TABLES[name][0])
    return profit_table(name, totals)


@query
def profit_cells_fan_out(spark: SparkSession, folder: str) -> DataFrame:
    name = "profit_by_year_cat_sub_customer"
    totals = profit_totals(*views.measured(spark, folder, repeated=True), PROFIT_TABLES[name][0])
    return profit_table(name, totals)


# Enrichment ---------------------------------------------------------------------------------


@query
def wide_fact(spark: SparkSession, folder: str) -> DataFrame:
    return decimals_as_double(ops.wide_fact(*views.measured(spark, folder)))


@query
def wide_fact_salted(spark: SparkSession, folder: str) -> DataFrame:
    """The path for large dimensions: frequent keys found by a sketch and salted."""
    orders = views.orders(spark, folder)
    hot = ops.run_hot_keys(orders, ["customer_id", "product_id"], rows_per_task=25)
    customers = ops.Dimension(views.repeated_customers(spark, folder), "customer_id", hot=hot["customer_id"])
    products = ops.Dimension(views.repeated_products(spark, folder), "product_id", hot=hot["product_id"])
    return decimals_as_double(ops.wide_fact(orders, customers, products))


@query
def order_measures(spark: SparkSession, folder: str) -> DataFrame:
    return decimals_as_double(ops.order_measures(views.orders(spark, folder)))


@query
def order_measures_double(spark: SparkSession, folder: str) -> DataFrame:
    return ops.order_measures(views.double_orders(spark, folder))


@query
def customer_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return decimals_as_double(customer_table(*views.measured(spark, folder)))


@query
def customer_metrics_double(spark: SparkSession, folder: str) -> DataFrame:
    _, customers, products = views.measured(spark, folder)
    return customer_table(views.double_orders(spark, folder), customers, products)


@query
def customer_metrics_fan_out(spark: SparkSession, folder: str) -> DataFrame:
    return decimals_as_double(customer_table(*views.measured(spark, folder, repeated=True)))


@query
def product_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return decimals_as_double(product_table(*views.measured(spark, folder)))


@query
def product_metrics_fan_out(spark: SparkSession, folder: str) -> DataFrame:
    return decimals_as_double(product_table(*views.measured(spark, folder, repeated=True)))


@query
def enriched_table(spark: SparkSession, folder: str) -> DataFrame:
    """Metrics planned with the lines; what is hot among the keys is known, so nothing has to be written between."""
    orders, customers, products = views.measured(spark, folder)
    return decimals_as_double(fully_enriched(orders, customers, products, hot=views.hot_keys(spark, folder)))


@query
def enriched_table_from_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Metrics as written and measured tables, as the whole job has them, then one more reading of the lines."""
    orders, customers, products = views.measured(spark, folder)
    root = staging_folder(spark)
    lines = stage(orders, f"{root}/lines")
    by_customer = stage(customer_table(lines, customers, products), f"{root}/customer_metrics")
    by_product = stage(product_table(lines, customers, products), f"{root}/product_metrics")
    metrics = ops.run_measure_unique(by_customer, "customer_id"), ops.run_measure_unique(by_product, "product_id")
    return decimals_as_double(fully_enriched(lines, customers, products, *metrics))


@query
def order_info(spark: SparkSession, folder: str) -> DataFrame:
    return decimals_as_double(ops.order_info(ops.wide_fact(*views.measured(spark, folder))))


@query
def average_quantity_by_segment(spark: SparkSession, folder: str) -> DataFrame:
    wide = ops.wide_fact(*views.measured(spark, folder))
    result = ops.summarize(
        wide, ["segment"], "quantity", F.avg, 2, "avg_quantity", [("avg_quantity", "desc")]
    )
    return decimals_as_double(result)


@query
def largest_discount_by_region(spark: SparkSession, folder: str) -> DataFrame:
    wide = ops.wide_fact(*views.measured(spark, folder))
    result = ops.summarize(wide, ["region", "category"], "discount", F.max, 1, "discount", [("region", "asc")])
    return decimals_as_double(result)


def _metrics_by_loads(spark: SparkSession, folder: str, key: str, metrics) -> DataFrame:
    """Three loads by year, the last one run twice, the first time with lines of another load."""
    lines = ops.order_measures(views.orders(spark, folder))
    root = staging_folder(spark)
    # Eight readings by loads: what they need is written once.
    needed = dict.fromkeys([key, "order_date", *(m.column for m in metrics)])
    lines = stage(lines.select(*needed), f"{root}/lines")
    store = MetricStore(f"spark_catalog.default.metrics_{uuid.uuid4().hex}", key, metrics, root)
    year = F.year("order_date") % 3
    for load, part in ((0, 0), (2, 0), (1, 1), (2, 2)):
        write_load(lines.where(year == part), store, f"load {load}")
    return decimals_as_double(read_totals(spark, store, lines.schema))


@query
def customer_metrics_by_loads(spark: SparkSession, folder: str) -> DataFrame:
    return _metrics_by_loads(spark, folder, "customer_id", CUSTOMER_METRICS)


@query
def product_metrics_by_loads(spark: SparkSession, folder: str) -> DataFrame:
    return _metrics_by_loads(spark, folder, "product_id", PRODUCT_METRICS)


def _dated_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines, a third of them of one product."""
    lines = views.orders(spark, folder)
    hot = F.when(F.col("order_id") % 3 == 0, F.lit(1).cast("bigint")).otherwise(F.col("product_id"))
    return lines.select("order_id", "row_id", hot.alias("product_id"), "order_date")


@query
def list_price_at_order(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with the list price that was valid when they were ordered, if any was."""
    prices = views.price_list(spark, folder)
    return run_interval_lookup(_dated_lines(spark, folder), prices, "product_id", "order_date", "valid_from", "valid_to")


@query
def last_price_before_order(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with the list price that was set last before they were ordered."""
    prices = views.price_list(spark, folder).drop("valid_to")
    return run_as_of_lookup(_dated_lines(spark, folder), prices, "product_id", "order_date", "valid_from")


# Rules and quarantine -----------------------------------------------------------------------


def _reasons(rejected: DataFrame) -> DataFrame:
    return rejected.withColumn(FAILED_RULES, F.concat_ws("; ", FAILED_RULES))


@query
def type_rules_valid(spark: SparkSession, folder: str) -> DataFrame:
    rules = [ops.TypeRule("quantity", "long"), ops.TypeRule("profit", "double")]
    kept = ops.valid(ops.evaluate(views.landed_orders(spark, folder), rules))
    return kept.select("order_id", "row_id", "product_id", "quantity", "profit")


@query
def type_rules_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    rules = [ops.TypeRule("quantity", "long"), ops.TypeRule("profit", "double")]
    lost = ops.rejected(ops.evaluate(views.landed_orders(spark, folder), rules))
    return _reasons(lost.select("order_id", "row_id", "product_id", "quantity", "profit", FIRST_FAILED, FAILED_RULES))


@query
def date_rule_valid(spark: SparkSession, folder: str) -> DataFrame:
    kept = ops.valid(ops.evaluate(views.landed_orders(spark, folder), [ops.TypeRule("order_date", "date")]))
    return kept.select("order_id", "row_id", "product_id", "order_date")


@query
def date_rule_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    lost = ops.rejected(ops.evaluate(views.landed_orders(spark, folder), [ops.TypeRule("order_date", "date")]))
    return lost.select("order_id", "row_id", "product_id", "order_date")


@query
def orders_clean(spark: SparkSession, folder: str) -> DataFrame:
    flagged = ops.evaluate(views.landed_orders(spark, folder), ORDERS.rules)
    return ops.conform(ops.valid(flagged), ORDERS.schema)


@query
def orders_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    return _reasons(ops.rejected(ops.evaluate(views.landed_orders(spark, folder), ORDERS.rules)))


@query
def customers_clean(spark: SparkSession, folder: str) -> DataFrame:
    flagged = ops.evaluate(views.text_customers(spark, folder), CUSTOMERS.rules)
    return ops.conform(ops.valid(flagged), CUSTOMERS.schema).select(
        "customer_id", "customer_name", "email", "segment", "postal_code"
    )


@query
def customers_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    lost = ops.rejected(ops.evaluate(views.text_customers(spark, folder), CUSTOMERS.rules))
    return _reasons(lost.select("customer_id", "email", "postal_code", FIRST_FAILED, FAILED_RULES))


@query
def products_clean(spark: SparkSession, folder: str) -> DataFrame:
    flagged = ops.evaluate(views.text_products(spark, folder), PRODUCTS.rules)
    return ops.conform(ops.valid(flagged), PRODUCTS.schema).drop("state")


@query
def products_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    lost = ops.rejected(ops.evaluate(views.text_products(spark, folder), PRODUCTS.rules))
    return _reasons(lost.drop("state"))


@query
def quarantine_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The common quarantine layout of all datasets, counted by reason."""
    sets = [
        ops.quarantine(ops.evaluate(view(spark, folder), contract.rules), contract.name)
        for contract, view in (
            (ORDERS, views.landed_orders),
            (CUSTOMERS, views.text_customers),
            (PRODUCTS, views.text_products),
        )
    ]
    everything = sets[0].union(sets[1]).union(sets[2])
    return everything.groupBy("dataset", FIRST_FAILED).agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(F.size("raw") > 0).alias("with_raw_values")
    )


def _compare_literal(spark: SparkSession, folder: str, symbol: str) -> DataFrame:
    everyone = views.customers(spark, folder)
    flag = compare("balance", symbol, "1000.5", everyone.schema["balance"].dataType)
    return everyone.select("customer_id", flag.alias("flag"))


def _compare_text(spark: SparkSession, folder: str, symbol: str) -> DataFrame:
    """A text column against a text that reads as a number."""
    placed = views.table(spark, folder, "orders")
    return placed.select("o_orderkey", compare("o_orderpriority", symbol, "3").alias("flag"))


def _compare_date(spark: SparkSession, folder: str, symbol: str) -> DataFrame:
    """A date column against a text that reads as a number."""
    lines = views.orders(spark, folder)
    return lines.select("order_id", "row_id", compare("order_date", symbol, "1995").alias("flag"))


def _compare_columns(spark: SparkSession, folder: str, symbol: str) -> DataFrame:
    lines = views.orders(spark, folder)
    return lines.select("order_id", "row_id", compare_columns("ship_date", symbol, "order_date").alias("flag"))


for _word, _symbol in OPERATORS.items():
    QUERIES[f"compare_literal_{_word}"] = partial(_compare_literal, symbol=_symbol)
    QUERIES[f"compare_text_{_word}"] = partial(_compare_text, symbol=_symbol)
    QUERIES[f"compare_date_{_word}"] = partial(_compare_date, symbol=_symbol)
    QUERIES[f"compare_columns_{_word}"] = partial(_compare_columns, symbol=_symbol)


@query
def ship_before_order_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    _, lost = ops.split(views.orders(spark, folder), compare_columns("ship_date", ">=", "order_date"))
    return lost.select("order_id", "row_id", "product_id", "order_date", "ship_date")


@query
def email_flag(spark: SparkSession, folder: str) -> DataFrame:
    everyone = views.text_customers(spark, folder)
    return everyone.select("customer_id", "email", is_email("email").alias("flag"))


@query
def email_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Every token with an @ in the documents, and whether it is an email address."""
    documents = views.table(spark, folder, "documents")
    tokens = documents.select("doc_id", F.explode(F.split("text", r"[ \t\r\n\f]+")).alias("token"))
    found = tokens.filter(F.contains("token", F.lit("@")))
    return found.withColumn("flag", is_email("token", strict=True))


# Key, null and reference reports ------------------------------------------------------------


@query
def duplicate_order_lines(spark: SparkSession, folder: str) -> DataFrame:
    repeated = ops.duplicate_rows(views.orders(spark, folder), ["order_id", "product_id"])
    return decimals_as_double(repeated.select("order_id", "product_id", "row_id", "quantity", "price"))


@query
def duplicate_key_counts(spark: SparkSession, folder: str) -> DataFrame:
    return ops.duplicate_keys(views.orders(spark, folder), ["order_id", "row_id"])


@query
def null_counts(spark: SparkSession, folder: str) -> DataFrame:
    return ops.null_counts(ops.wide_fact(*views.measured(spark, folder)))


@query
def null_counts_wide(spark: SparkSession, folder: str) -> DataFrame:
    return ops.null_counts_wide(views.text_orders(spark, folder))


@query
def null_report(spark: SparkSession, folder: str) -> DataFrame:
    return ops.run_null_report(views.landed_orders(spark, folder))


@query
def orphans_by_customer(spark: SparkSession, folder: str) -> DataFrame:
    orders, customers, _ = views.measured(spark, folder)
    missing = ops.orphans(orders, customers, "customer_id")
    return decimals_as_double(missing)


@query
def orphans_by_product(spark: SparkSession, folder: str) -> DataFrame:
    orders, _, products = views.measured(spark, folder)
    missing = ops.orphans(orders, products, "product_id")
    return missing.select("order_id", "row_id", "product_id", "customer_id")


@query
def orphans_by_customer_and_product(spark: SparkSession, folder: str) -> DataFrame:
    """Lines whose customer never got that product by mode N: two keys, and a reference as long as the lines."""
    lines = views.orders(spark, folder)
    reference = lines.where(F.col("ship_mode") == "N").select("customer_id", "product_id")
    missing = ops.run_orphans(lines, reference, ["customer_id", "product_id"])
    return missing.select("order_id", "row_id", "customer_id", "product_id")


@query
def orphans_by_stored_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Lines without a customer of positive balance, by the merged filters of two loads of customers."""
    people = views.clean_customers(spark, folder).select("customer_id")
    table = f"spark_catalog.default.key_filters_{uuid.uuid4().hex}"
    path = f"{staging_folder(spark)}/key_filters"
    loads = {"first load": F.col("customer_id") % 2 == 0, "second load": F.col("customer_id") % 2 == 1}
    blocks = ops.blocks_for(people.count())
    for batch, part in loads.items():
        ops.write_key_filter(ops.key_filter(people.where(part), "customer_id", blocks), table, batch, path)
    known = ops.read_key_filter(spark, table)
    missing = ops.run_orphans(views.orders(spark, folder), people, "customer_id", known)
    return missing.select("order_id", "row_id", "customer_id", "product_id")


@query
def conform_types(spark: SparkSession, folder: str) -> DataFrame:
    return ops.conform(views.text_orders(spark, folder), ORDERS.schema)


# Profiles, sessions, differences and greatest rows -------------------------------------------


@query
def line_profile(spark: SparkSession, folder: str) -> DataFrame:
    """A profile of the lines from two loads, and whether its estimates are as close to the truth as it says."""
    lines = views.orders(spark, folder).select("customer_id", "product_id", "quantity", "price", "ship_mode", "order_date")
    root = staging_folder(spark)
    odd = F.col("product_id") % 2
    loads = [stage(profile_parts(lines.where(odd == n)), f"{root}/profile_{n}") for n in range(2)]
    found = profile(merge_profiles(*loads), ranks=(0.5,), top=1)
    # Of each column the exact numbers, in one pass, with the estimates they are compared with.
    estimates = {r["column_name"]: r for r in found.collect()}
    # Where the sketch names no value, none may be more frequent than its error.
    unnamed = [name for name, row in estimates.items() if not row["frequent"]]
    most = run_most_frequent(lines, unnamed) if unnamed else {}
    checks = []
    for name in lines.columns:
        row, value = estimates[name], measure(lines, name)
        median = F.lit(row["quantiles"][0])
        distinct, total = F.count_distinct(name), F.count(F.lit(1))
        if name in most:
            often, estimate = F.lit(most[name]), 0
        else:
            often = F.count_if(F.col(name).cast("string") == F.lit(row["frequent"][0]["item"]))
            estimate = row["frequent"][0]["count"]
        checks.append(
            F.struct(
                F.lit(name).alias("column_name"),
                (F.abs(distinct - row["distinct_estimate"]) <= DISTINCT_ERROR * distinct).alias("distinct_close"),
                (
                    (F.count_if(value < median) <= (0.5 + RANK_ERROR) * total) & (F.count_if(value <= median) >= (0.5 - RANK_ERROR) * total)
                ).alias("median_close"),
                (F.abs(often - estimate) <= COUNT_ERROR * total + 1).alias("frequent_close"),
            )
        )
    close = lines.agg(F.array(*checks).alias("checks")).select(F.inline("checks"))
    return found.select("column_name", "row_count", "null_count").join(close, "column_name")


@query
def event_sessions(spark: SparkSession, folder: str) -> DataFrame:
    """Sessions of users, one of whom has a third of the events, with gaps of at most six hours."""
    events = views.table(spark, folder, "events")
    user = F.when(F.col("event_id") % 3 == 0, F.lit(0).cast("bigint")).otherwise(F.col("user_id"))
    rows = events.select(user.alias("user_id"), "ts", F.col("value").cast("decimal(12,2)").alias("value"), "event_id")
    measures = {"total_value": ("sum", "value"), "first_event": ("min", "event_id"), "last_event": ("max", "event_id")}
    return decimals_as_double(run_sessions(rows, "user_id", "ts", timedelta(hours=6), measures))


def _next_load(lines: DataFrame) -> DataFrame:
    """The lines as a later load might hold them: some gone, some changed, some twice."""
    order, product = F.col("order_id"), F.col("product_id")
    price = F.when(product % 50 == 0, F.col("price") + 1).otherwise(F.col("price")).cast("decimal(12,2)")
    mode = F.when(order % 40 != 1, F.col("ship_mode"))
    kept = lines.where(F.col("row_id") != 7).withColumns({"price": price, "ship_mode": mode})
    return kept.union(kept.where(order % 30 == 2)).union(kept.where(order % 30 == 2))


def _line_loads(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    lines = views.orders(spark, folder).select("order_id", "row_id", "product_id", "price", "ship_mode")
    return lines, _next_load(lines)


@query
def line_differences(spark: SparkSession, folder: str) -> DataFrame:
    """Lines that one of two loads has more often."""
    return decimals_as_double(row_differences(*_line_loads(spark, folder)))


@query
def line_changes(spark: SparkSession, folder: str) -> DataFrame:
    """What became of each line between two loads."""
    changes = key_changes(*_line_loads(spark, folder), ["order_id", "row_id"])
    return changes.withColumn("columns", F.array_join("columns", ","))


@query
def top_lines_by_customer(spark: SparkSession, folder: str) -> DataFrame:
    """The three lines of each customer with the highest quantity, ties included; one customer has a third of all."""
    lines = views.orders(spark, folder)
    customer = F.when(F.col("order_id") % 3 == 0, F.lit(1).cast("bigint")).otherwise(F.col("customer_id"))
    rows = lines.select(customer.alias("customer_id"), "order_id", "row_id", "quantity")
    return run_top(rows, "customer_id", "quantity", 3)


# Sources and sinks --------------------------------------------------------------------------


def _with_headers(df: DataFrame, contract) -> DataFrame:
    return df.withColumnsRenamed({column: header for header, column in contract.renames.items()})


@query
def csv_products(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{staging_folder(spark)}/products_csv"
    _with_headers(views.text_products(spark, folder), PRODUCTS).write.option("header", "true").csv(path)
    return read_dataset(spark, path, PRODUCTS, fmt="csv").drop("state", CORRUPT)


@query
def json_orders(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{staging_folder(spark)}/orders_json"
    _with_headers(views.text_orders(spark, folder), ORDERS).write.json(path)
    feed = read_dataset(spark, path, ORDERS, fmt="json", multiLine="false")
    return feed.select(*ORDERS.schema.names)


@query
def xlsx_customers(spark: SparkSession, folder: str) -> DataFrame:
    books = as_workbooks(_with_headers(views.text_customers(spark, folder), CUSTOMERS))
    decoded = decode_workbooks(books, CUSTOMERS.headers, sheet="Worksheet", header_rows=1)
    renamed = decoded.withColumnsRenamed(CUSTOMERS.renames)
    return renamed.select("customer_id", "customer_name", "email", "segment", "postal_code")


@query
def table_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    name = "spark_catalog.default.ledgerlane_orders"
    orders = decimals_as_double(views.orders(spark, folder))
    write_table(orders, name, path=f"{staging_folder(spark)}/orders")
    return spark.table(name)


#: Feeds of lines are packed fast, in files of so many records that one task can read several.
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": "500000"}


def _write_feeds(spark: SparkSession, folder: str, root: str, part: Column | None = None) -> dict[str, str]:
    """Feeds as files; of the orders all rows or a part of them."""
    orders = views.text_orders(spark, folder)
    orders = orders if part is None else orders.where(part)
    _with_headers(orders, ORDERS).write.options(**PACKED).json(f"{root}/orders")
    for contract, view in ((PRODUCTS, views.text_products), (CUSTOMERS, views.text_customers)):
        feed = _with_headers(view(spark, folder), contract)
        feed.write.option("header", "true").csv(f"{root}/{contract.name}")
    return {name: f"{root}/{name}" for name in ("orders", "products", "customers")}


_FEED_FORMATS = {
    "formats": {"orders": "json", "products": "csv", "customers": "csv"},
    "read_options": {"orders": {"multiLine": "false"}},
}


def _ingest_feeds(spark: SparkSession, folder: str) -> tuple[Store, Settings]:
    """Feeds as files, then everything ingestion does with them."""
    root = staging_folder(spark)
    sources = _write_feeds(spark, folder, root)
    settings = Settings(sources=sources, schema="ledgerlane_raw", location=f"{root}/tables", **_FEED_FORMATS)
    return run_ingest(spark, settings), settings


def _ingest_batches(spark: SparkSession, folder: str) -> tuple[Store, Settings]:
    """Two loads of halves of the orders, and one more run of the first, which had read the other half."""
    root = staging_folder(spark)
    even = F.col("order_id").cast("long") % 2 == 0
    halves = {
        name: _write_feeds(spark, folder, f"{root}/{name}", part) for name, part in (("even", even), ("odd", ~even))
    }
    loads = (("first load", "odd"), ("second load", "odd"), ("first load", "even"))
    # Tables of batches stay, so each call has a schema of its own.
    fixed = {"schema": f"ledgerlane_{uuid.uuid4().hex}", "location": f"{root}/tables", **_FEED_FORMATS}
    for batch, half in loads:
        settings = Settings(sources=halves[half], batch=batch, **fixed)
        store = run_ingest(spark, settings)
    return store, settings


@query
def ingested_profit_by_year_category(spark: SparkSession, folder: str) -> DataFrame:
    """From files through quarantine and clean tables to a profit table."""
    store, _ = _ingest_feeds(spark, folder)
    name = "profit_by_year_category"
    return profit_table(name, profit_totals(store.orders.clean, *store.dimensions(), PROFIT_TABLES[name][0]))


@query
def ingested_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """The written quarantine table, counted by reason."""
    _, settings = _ingest_feeds(spark, folder)
    return (
        spark.table(settings.quarantine_table)
        .groupBy("dataset", FIRST_FAILED)
        .agg(F.count(F.lit(1)).alias("row_count"), F.count_if(F.size("raw") > 0).alias("with_raw_values"))
    )


@query
def ingested_counts(spark: SparkSession, folder: str) -> DataFrame:
    """What ingestion counted on its way: rows, rows kept, and rows that each rule caught first."""
    store, _ = _ingest_feeds(spark, folder)
    counted = [
        (found.contract.name, name, number)
        for found in (store.orders, store.customers, store.products)
        for name, number in found.counts.items()
        if number
    ]
    return spark.createDataFrame(counted, "dataset string, counter string, row_count long")


@query
def batched_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """The quarantine after two loads and a rerun, counted by load and reason."""
    _, settings = _ingest_batches(spark, folder)
    return (
        spark.table(settings.quarantine_table)
        .groupBy(BATCH, "dataset", FIRST_FAILED)
        .agg(F.count(F.lit(1)).alias("row_count"), F.count_if(F.size("raw") > 0).alias("with_raw_values"))
    )


@query
def batched_orders(spark: SparkSession, folder: str) -> DataFrame:
    """The clean orders of all loads."""
    store, _ = _ingest_batches(spark, folder)
    return store.orders.clean.select("order_id", "row_id", "product_id", "order_date")


DELIVERY_KEYS = ("order_id", "row_id", "product_id", "price")


@query
def streamed_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Three drops of order files, each with rows that came before, taken up call by call."""
    root = staging_folder(spark)
    lines = _with_headers(views.text_orders(spark, folder), ORDERS)
    third = F.col("Order ID").cast("long") % 3
    # A drop brings its own orders and once more half of those of the drop before.
    again = F.col("Product ID").cast("long") % 2 == 0
    drops = [lines.where((third == n) | ((third == n - 1) & again)) for n in range(3)]
    for number, drop in enumerate(drops):
        drop.write.mode("append").options(**PACKED).json(f"{root}/arrived/drop={number}")
        run = run_drops(spark, f"{root}/arrived/*", f"{root}/taken", ORDERS, DELIVERY_KEYS)
    return run.clean.select("order_id", "row_id", "product_id", "order_date")


@query
def streamed_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The quarantine that the drops leave, counted by reason."""
    root = staging_folder(spark)
    lines = _with_headers(views.text_orders(spark, folder), ORDERS)
    half = F.col("Order ID").cast("long") % 2
    for number in range(2):
        lines.where(half <= number).write.options(**PACKED).json(f"{root}/arrived/drop={number}")
        run = run_drops(spark, f"{root}/arrived/*", f"{root}/taken", ORDERS, DELIVERY_KEYS)
    return run.quarantine.groupBy("dataset", FIRST_FAILED).agg(F.count(F.lit(1)).alias("row_count"))


@query
def staged_orders(spark: SparkSession, folder: str) -> DataFrame:
    """The pipeline's middle step: verdicts written once, clean rows read back."""
    flagged = ops.evaluate(views.landed_orders(spark, folder), ORDERS.rules)
    staged = stage(flagged, f"{staging_folder(spark)}/orders")
    return ops.conform(ops.valid(staged), ORDERS.schema).select("order_id", "row_id", "product_id", "order_date")


# Layouts that files really have, and reports over them ---------------------------------------


def _array_feed(spark: SparkSession, folder: str, orders_in_file: int) -> DataFrame:
    path = f"{staging_folder(spark)}/orders_arrays"
    # The lines of a file meet in the shuffle that joins them, so their texts are not shuffled.
    rows = _with_headers(views.text_orders(spark, folder, together=orders_in_file), ORDERS)
    record = F.struct(*[c for c in rows.columns if c != "block"])
    arrays = rows.groupBy("block").agg(F.to_json(F.collect_list(record)).alias("value"))
    arrays = arrays.withColumn("value", F.regexp_replace("value", r"\},\{", "},\n{"))
    # Both sides of the join lie by the block, which is enough to tell where a key is.
    with changed_settings(spark, {"spark.sql.requireAllClusterKeysForCoPartition": "false"}):
        arrays.write.partitionBy("block").text(path)
    return read_dataset(spark, f"{path}/block=*/", ORDERS, fmt="json").select(*ORDERS.schema.names)


@query
def json_array_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Files with one JSON array each, over several lines."""
    return _array_feed(spark, folder, 4000)


@query
def json_array_divided_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Files with one JSON array each that are large enough for several tasks to read each of them."""
    return _array_feed(spark, folder, 40_000)


@query
def xlsx_folder_customers(spark: SparkSession, folder: str) -> DataFrame:
    """A folder of workbooks, found and read as files."""
    path = f"{staging_folder(spark)}/customers_xlsx"
    books = as_workbooks(_with_headers(views.text_customers(spark, folder), CUSTOMERS))
    write_workbooks(books, path)
    found = read_dataset(spark, path, CUSTOMERS, fmt="excel")
    return found.select("customer_id", "customer_name", "email", "segment", "postal_code")


@query
def xlsx_mixed_headers(spark: SparkSession, folder: str) -> DataFrame:
    """A folder of workbooks whose headers are spelled in different cases; some lack a header."""
    path = staging_folder(spark)
    rows = _with_headers(views.text_customers(spark, folder), CUSTOMERS)
    spelled = (rows.toDF(*map(str.upper, rows.columns)), rows.toDF(*map(str.lower, rows.columns)), rows.drop("Segment"))
    for number, part in enumerate(spelled):
        write_workbooks(as_workbooks(part.where(F.col(part.columns[0]).cast("long") % 3 == number)), f"{path}/{number}")
    found = read_dataset(spark, f"{path}/*", CUSTOMERS, fmt="excel")
    return found.select("customer_id", "email", "segment", "postal_code", F.col(CORRUPT).isNull().alias("readable"))


@query
def csv_malformed_products(spark: SparkSession, folder: str) -> DataFrame:
    """Records with too many and too few fields, and what becomes of every record."""
    path = f"{staging_folder(spark)}/products_csv"
    rows = _with_headers(views.text_products(spark, folder), PRODUCTS).na.fill("")
    key = F.col("Product ID").cast("long")
    whole = F.concat_ws(",", *rows.columns)
    line = F.when(key % 13 == 0, F.concat(whole, F.lit(",surplus"))).when(
        key % 17 == 0, F.concat_ws(",", *rows.columns[:3])
    ).otherwise(whole)
    # A separator that no text holds leaves the lines as they are.
    lines = rows.select(line.alias(",".join(rows.columns)))
    lines.write.options(header="true", sep="\u0001", quote="", escape="").csv(path)
    rules = [ops.ReadableRule(CORRUPT), *PRODUCTS.rules]
    flagged = ops.evaluate(read_dataset(spark, path, PRODUCTS, fmt="csv"), rules)
    return flagged.select("product_id", FIRST_FAILED)


@query
def long_decimal_measures(spark: SparkSession, folder: str) -> DataFrame:
    """Prices and discounts with more digits than any fixed scale."""
    lines = views.double_orders(spark, folder)
    lines = lines.withColumns({"price": F.col("price") / 7.31, "discount": F.col("discount") / 3.7})
    return ops.order_measures(lines).select("order_id", "row_id", "total_sales", "discount_amount")


@query
def enriched_orders(spark: SparkSession, folder: str) -> DataFrame:
    """The wide fact with its line measures."""
    return decimals_as_double(ops.order_measures(ops.wide_fact(*views.measured(spark, folder))))


@query
def orders_key_report(spark: SparkSession, folder: str) -> DataFrame:
    """Repeated keys, among rows that fail no rule but that of the dates."""
    flagged = ops.evaluate(views.landed_orders(spark, folder), ORDERS.rules)
    keyed = ops.conform(ops.valid(flagged, ORDERS.rules_after_key_report), ORDERS.schema)
    return ops.duplicate_rows(keyed, ORDERS.keys).select("order_id", "product_id", "row_id", "order_date", "ship_date")


@query
def products_key_report(spark: SparkSession, folder: str) -> DataFrame:
    repeated = ops.duplicate_rows(views.repeated_products(spark, folder), PRODUCTS.keys)
    return repeated.select("product_id", "category", "sub_category")


@query
def customers_key_report(spark: SparkSession, folder: str) -> DataFrame:
    return ops.duplicate_rows(views.repeated_customers(spark, folder), CUSTOMERS.keys).select("customer_id", "segment")


@query
def products_null_counts(spark: SparkSession, folder: str) -> DataFrame:
    flagged = ops.evaluate(views.text_products(spark, folder), PRODUCTS.rules)
    return ops.null_counts(ops.conform(flagged, PRODUCTS.schema))


@query
def has_missing_references(spark: SparkSession, folder: str) -> DataFrame:
    """Whether any line lacks its customer or its product, and how many do."""
    orders, customers, products = views.measured(spark, folder)
    counts = [
        ops.orphans(orders, table, key).agg(F.lit(key).alias("key"), F.count(F.lit(1)).alias("lines"))
        for table, key in ((customers, "customer_id"), (products, "product_id"))
    ]
    return counts[0].union(counts[1]).select("key", "lines", (F.col("lines") > 0).alias("missing"))
