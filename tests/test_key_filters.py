"""Orphans of references too large to broadcast, and the filters that spare most lines the question."""

import pytest
from pyspark.sql import functions as F

from ledgerlane.operators.key_filters import (
    KeyFilter,
    blocks_for,
    key_filter,
    merge_filters,
    read_key_filter,
    run_orphans,
    with_maybe_known,
    write_key_filter,
)
from ledgerlane.sinks import stage, staging_folder


@pytest.fixture
def fact(spark):
    return spark.range(20_000).select(
        F.when(F.col("id") % 50 == 0, None).otherwise(F.col("id") % 900).alias("a.b"),
        F.when(F.col("id") % 70 == 0, None).otherwise((F.col("id") % 11).cast("string")).alias("c"),
        F.col("id").alias("line"),
    )


@pytest.fixture
def reference(spark):
    pairs = spark.range(900).select(F.col("id").alias("a.b"), F.explode(F.split(F.lit("0 1 2 3 4 5"), " ")).alias("c"))
    return pairs.where(F.col("`a.b`") % 3 > 0).union(spark.sql("SELECT CAST(NULL AS BIGINT), '1'"))


def wanted(fact, reference):
    known = {tuple(r) for r in reference.collect()}
    return sorted(r["line"] for r in fact.collect() if None in tuple(r)[:2] or tuple(r)[:2] not in known)


@pytest.mark.parametrize("blocks", [None, 1, 7])
def test_composite_keys(spark, fact, reference, blocks):
    """A filter that is far too small is asked in vain, and results stay exact."""
    known = None if blocks is None else key_filter(reference, ["a.b", "c"], blocks)
    found = run_orphans(fact, reference, ["a.b", "c"], known)
    assert found.columns == fact.columns
    assert sorted(r["line"] for r in found.collect()) == wanted(fact, reference)


def test_lacking_keys_beyond_the_limit_are_joined(spark, fact, reference):
    found = run_orphans(fact, reference, ["a.b", "c"], key_filter(reference, ["a.b", "c"], 1), limit=0)
    assert sorted(r["line"] for r in found.collect()) == wanted(fact, reference)


def test_lines_are_not_shuffled(spark, fact, reference):
    folder = staging_folder(spark)
    lines, known = stage(fact, f"{folder}/lines"), stage(reference, f"{folder}/reference")
    plan = run_orphans(lines, known, ["a.b", "c"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_certain_orphans_are_most_orphans(spark, reference):
    strangers = spark.range(10_000).select((F.col("id") + 10**6).alias("a.b"), F.lit("1").alias("c"))
    known = key_filter(reference, ["a.b", "c"], blocks_for(3600))
    asked = with_maybe_known(strangers, ["a.b", "c"], known, "maybe")
    assert asked.where("maybe").count() < 150
    own = with_maybe_known(reference, ["a.b", "c"], known, "maybe")
    assert own.where("not maybe").count() == 1  # the row that lacks a key


def test_filters_of_loads_merge(spark, fact, reference):
    keys, table = ["a.b", "c"], "spark_catalog.default.key_filters"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    halves = [reference.where(F.col("`a.b`") % 2 == k) for k in (0, 1)]
    path = f"{staging_folder(spark)}/filters"
    write_key_filter(key_filter(fact.select(*[f"`{k}`" for k in keys]), keys, 64), table, "even", path)  # a wrong load, run again
    for name, half in zip(("even", "odd"), halves):
        write_key_filter(key_filter(half, keys, 64), table, name, path)
    stored = read_key_filter(spark, table)
    whole = key_filter(reference, keys, 64)
    merged = merge_filters(*(key_filter(h, keys, 64) for h in halves))
    assert sorted(map(tuple, stored.blocks.collect())) == sorted(map(tuple, whole.blocks.collect()))
    assert sorted(map(tuple, merged.blocks.collect())) == sorted(map(tuple, whole.blocks.collect()))
    found = run_orphans(fact, reference, keys, stored)
    assert sorted(r["line"] for r in found.collect()) == wanted(fact, reference)
    with pytest.raises(ValueError, match="can't be merged"):
        merge_filters(whole, KeyFilter(whole.blocks, 65, whole.kinds))
    spark.sql(f"DROP TABLE {table}")


def test_keys_of_other_types_are_refused(spark, reference):
    narrow = spark.sql("SELECT CAST(1 AS INT) AS a, '1' AS c")
    with pytest.raises(ValueError, match="Keys are int"):
        run_orphans(narrow, reference.withColumnRenamed("a.b", "a"), ["a", "c"])
    with pytest.raises(ValueError, match="no plain key"):
        key_filter(spark.sql("SELECT map(1, 2) AS m"), "m", 1)


def test_zeros_and_empty_sides(spark):
    doubles = spark.sql("SELECT * FROM VALUES (0.0D), (-0.0D), (1.5D), (NULL) AS t(x)")
    zero = spark.sql("SELECT -0.0D AS x")
    assert sorted(str(r["x"]) for r in run_orphans(doubles, zero, "x").collect()) == ["1.5", "None"]
    assert run_orphans(doubles, zero.where("false"), "x").count() == 4
    assert run_orphans(doubles.where("false"), zero, "x").count() == 0
