"""The test tables seen as the retail datasets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlane import operators as ops
from ledgerlane.operators import CompareRule, Dimension, evaluate, valid
from ledgerlane.sinks import stage, staging_folder

_LANDED: dict[tuple, DataFrame] = {}
_STATISTICS: dict[tuple, list[Dimension]] = {}
_HOT: dict[tuple, dict[str, dict]] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def money(name: str) -> Column:
    return F.col(name).cast("decimal(12,2)")


def rate(name: str) -> Column:
    return F.col(name).cast("decimal(4,2)")


def orders(spark: SparkSession, folder: str, together: int | None = None) -> DataFrame:
    """Order lines. Amounts are decimals, read once from doubles that hold two digits.

    With `together` the lines of so many orders that follow each other come together in the shuffle that joins
    them, and have a column `block` that tells which.
    """
    lines, placed, number = table(spark, folder, "lineitem"), table(spark, folder, "orders"), []
    same = F.col("l_orderkey") == F.col("o_orderkey")
    if together is not None:
        lines = lines.withColumn("block", F.floor(F.col("l_orderkey") / together)).repartition("block")
        placed = placed.withColumn("o_block", F.floor(F.col("o_orderkey") / together)).repartition("o_block")
        same, number = same & (F.col("block") == F.col("o_block")), ["block"]
    lines = lines.join(placed, same)
    return lines.select(
        F.col("o_custkey").alias("customer_id"),
        rate("l_discount").alias("discount"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("l_orderkey").alias("order_id"),
        money("l_extendedprice").alias("price"),
        F.col("l_partkey").alias("product_id"),
        (money("l_extendedprice") * (rate("l_tax") - rate("l_discount"))).alias("profit"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.col("l_linenumber").cast("bigint").alias("row_id"),
        F.col("l_shipdate").cast("date").alias("ship_date"),
        F.col("l_returnflag").alias("ship_mode"),
        *number,
    )


def double_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with the doubles of the published schema."""
    lines = orders(spark, folder)
    return lines.withColumns({c: F.col(c).cast("double") for c in ("discount", "price", "profit")})


def customers(spark: SparkSession, folder: str) -> DataFrame:
    nations = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left"
    )
    return (
        table(spark, folder, "customer")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.col("c_mktsegment").alias("segment"),
            F.col("n_name").alias("country"),
            F.col("c_nationkey").cast("string").alias("state"),
            F.col("r_name").alias("region"),
            money("c_acctbal").alias("balance"),
        )
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("sub_category"),
        F.col("p_name").alias("product_name"),
        F.col("p_size").cast("string").alias("state"),
        money("p_retailprice").alias("price_per_product"),
    )


def price_list(spark: SparkSession, folder: str) -> DataFrame:
    """Six list prices of each product, one after the other with gaps; the last one is still valid."""
    versions = table(spark, folder, "part").select("*", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("version"))
    begins = F.date_add(F.lit("1992-01-01").cast("date"), (F.col("version") * 420 + F.col("p_partkey") % 90).cast("int"))
    return versions.select(
        F.col("p_partkey").alias("product_id"),
        begins.alias("valid_from"),
        F.when(F.col("version") < 5, F.date_add(begins, 379)).alias("valid_to"),
        F.col("version").alias("version"),
    )


def clean_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customers that meet a rule; orders of the others find no match."""
    kept = valid(evaluate(customers(spark, folder), [CompareRule("balance", ">=", "0")]))
    return kept.drop("balance")


def clean_products(spark: SparkSession, folder: str) -> DataFrame:
    return valid(evaluate(products(spark, folder), [CompareRule("price_per_product", ">=", "910")]))


def repeated_customers(spark: SparkSession, folder: str) -> DataFrame:
    """All customers, those below zero twice, so that lookups fan out."""
    everyone = customers(spark, folder)
    return everyone.union(everyone.filter(F.col("balance") < 0)).drop("balance")


def repeated_products(spark: SparkSession, folder: str) -> DataFrame:
    """All products, small ones once more under another sub-category."""
    everything = products(spark, folder)
    again = everything.filter(F.col("state").cast("int") <= 10)
    return everything.union(again.withColumn("sub_category", F.lit("Brand#0")))


def run_statistics(spark: SparkSession, folder: str, repeated: bool = False) -> list[Dimension]:
    people, goods = (repeated_customers, repeated_products) if repeated else (clean_customers, clean_products)
    return ops.run_measure(
        (people(spark, folder), "customer_id"),
        (goods(spark, folder), "product_id"),
        fact=orders(spark, folder),
    )


def table_state(spark: SparkSession, folder: str) -> tuple:
    """What tells one version of the tables from another: their files, sizes and times, from a listing."""
    paths = [f"{folder}/{name}.parquet" for name in ("customer", "lineitem", "nation", "orders", "part", "region")]
    files = spark.read.format("binaryFile").load(paths).select("path", "length", "modificationTime")
    return (spark.sparkContext.applicationId, *sorted(map(tuple, files.collect())))


def measured(
    spark: SparkSession, folder: str, repeated: bool = False
) -> tuple[DataFrame, Dimension, Dimension]:
    """Orders with clean or repeated dimensions whose size, uniqueness and hot keys are known.

    Like table statistics after a load, the measures are taken once per version of the tables.
    """
    key = (table_state(spark, folder), repeated)
    if key not in _STATISTICS:
        _STATISTICS[key] = run_statistics(spark, folder, repeated)
    customers, products = _STATISTICS[key]
    return orders(spark, folder), customers, products


def run_hot_keys(spark: SparkSession, folder: str) -> dict[str, dict]:
    """Those that measuring the dimensions found already are not looked for again."""
    _, *tables = measured(spark, folder)
    known = {table.key: table.hot for table in tables if not table.small}
    others = [table.key for table in tables if table.small]
    return {**known, **(ops.run_hot_keys(orders(spark, folder), others) if others else {})}


def hot_keys(spark: SparkSession, folder: str) -> dict[str, dict]:
    """The hot keys of the lines, known like the measures of the dimensions once per version of the tables."""
    key = table_state(spark, folder)
    if key not in _HOT:
        _HOT[key] = run_hot_keys(spark, folder)
    return _HOT[key]


def text_orders(spark: SparkSession, folder: str, together: int | None = None) -> DataFrame:
    """Order lines as a feed would deliver them: texts, two date layouts and some bad values.

    With `together` also the column `block` of `orders`.
    """
    line, key = F.col("row_id"), F.col("order_id")
    iso = F.col("order_date").cast("string")
    day_first = F.concat_ws("/", F.day("order_date"), F.month("order_date"), F.year("order_date"))
    no_such_month = F.concat(F.substring(iso, 1, 5), F.lit("13"), F.substring(iso, 8, 3))
    layout = F.when(key % 10 == 0, no_such_month).when(key % 2 == 0, day_first).otherwise(iso)
    return orders(spark, folder, together).select(
        F.col("customer_id").cast("string").alias("customer_id"),
        F.col("discount").cast("string").alias("discount"),
        layout.alias("order_date"),
        key.cast("string").alias("order_id"),
        F.when(line == 6, F.concat(F.lit("-"), F.col("price").cast("string")))
        .otherwise(F.col("price").cast("string"))
        .alias("price"),
        F.col("product_id").cast("string").alias("product_id"),
        F.when(line == 5, F.lit(None)).otherwise(F.col("profit").cast("string")).alias("profit"),
        F.when(line == 7, "abc").otherwise(F.col("quantity").cast("string")).alias("quantity"),
        line.cast("string").alias("row_id"),
        F.col("ship_date").cast("string").alias("ship_date"),
        F.col("ship_mode"),
        *([] if together is None else ["block"]),
    )


def landed_orders(spark: SparkSession, folder: str) -> DataFrame:
    """The order feed as a landed table of texts, written once per version of the tables."""
    key = table_state(spark, folder)
    if key not in _LANDED:
        _LANDED[key] = stage(text_orders(spark, folder), f"{staging_folder(spark)}/orders_feed")
    return _LANDED[key]


def text_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as texts with good, bad and missing emails and postal codes."""
    key = F.col("c_custkey")
    email = (
        F.when(key % 5 == 0, F.concat(F.lit("buyer."), key.cast("string"), F.lit("@shop.example.com")))
        .when(key % 5 == 1, F.concat(F.lit("buyer"), key.cast("string"), F.lit(" at example.com")))
        .when(key % 5 == 2, F.lit(None))
        .when(key % 5 == 3, F.concat(F.col("c_name"), F.lit("@example.com")))
        .otherwise(F.concat(F.lit("b"), key.cast("string"), F.lit("@-x.co")))
    )
    code = (
        F.when(key % 7 == 0, "12.5")
        .when(key % 7 == 1, "0")
        .when(key % 7 == 2, F.concat(F.lit("00"), key.cast("string")))
        .otherwise((key + 1000).cast("string"))
    )
    return table(spark, folder, "customer").select(
        key.cast("string").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        email.alias("email"),
        F.lit(None).cast("string").alias("phone"),
        F.lit(None).cast("string").alias("address"),
        F.col("c_mktsegment").alias("segment"),
        F.lit(None).cast("string").alias("country"),
        F.lit(None).cast("string").alias("city"),
        F.lit(None).cast("string").alias("state"),
        code.alias("postal_code"),
        F.lit(None).cast("string").alias("region"),
    )


def text_products(spark: SparkSession, folder: str) -> DataFrame:
    """Products as texts; some prices are unreadable or below zero."""
    key = F.col("p_partkey")
    price = money("p_retailprice").cast("string")
    return table(spark, folder, "part").select(
        key.cast("string").alias("product_id"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("sub_category"),
        F.col("p_name").alias("product_name"),
        F.lit(None).cast("string").alias("state"),
        F.when(key % 11 == 0, F.concat(price, F.lit(" EUR")))
        .when(key % 11 == 1, F.concat(F.lit("-"), price))
        .otherwise(price)
        .alias("price_per_product"),
    )
