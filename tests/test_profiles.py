"""Sketches of columns inside their stated errors, for one load and for several merged."""

import pytest
from pyspark.sql import functions as F

from ledgerlane.operators.profiles import COUNT_ERROR, DISTINCT_ERROR, RANK_ERROR, measure, merge_profiles, profile, profile_parts, run_most_frequent
from ledgerlane.sinks import stage, staging_folder


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(60_000).select(
        (F.col("id") * 7919 % 50_021).alias("a.b"),
        F.when(F.col("id") % 3 == 0, "often").when(F.col("id") % 5 > 0, F.concat(F.lit("v"), F.col("id") % 4000)).alias("s"),
        F.when(F.col("id") % 11 == 0, F.lit(float("nan"))).otherwise(F.col("id") / 7).alias("d"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 900).cast("int")).alias("day"),
        (F.col("id") % 2 == 0).alias("flag"),
        F.array(F.col("id") % 10).alias("list"),
        F.lit(None).cast("decimal(10,2)").alias("nothing"),
    )


def check(spark, rows, parts):
    found = {r["column_name"]: r for r in profile(parts).collect()}
    assert list(found) and set(found) == set(rows.columns)
    total = rows.count()
    for name in rows.columns:
        row, column = found[name], F.col(f"`{name}`")
        text = column.cast("string") if name != "list" else F.to_json(column)
        exact = rows.agg(F.countDistinct(text).alias("n"), F.count_if(column.isNull()).alias("nulls")).first()
        assert row["row_count"] == total and row["null_count"] == exact["nulls"]
        assert abs(row["distinct_estimate"] - exact["n"]) <= max(1, DISTINCT_ERROR * exact["n"])
        value = measure(rows, name)
        plain = rows.select(value.alias("v")).where("v IS NOT NULL AND NOT isnan(v)")
        if row["quantiles"] is None:
            assert plain.count() == 0
        else:
            ends = plain.agg(F.min("v"), F.max("v")).first()
            assert (row["quantiles"][0], row["quantiles"][-1]) == tuple(ends)
            for rank, q in zip((0.25, 0.5, 0.75), row["quantiles"][1:4]):
                below, upto, n = plain.agg(F.count_if(F.col("v") < q), F.count_if(F.col("v") <= q), F.count("v")).first()
                assert below / n - RANK_ERROR <= rank <= upto / n + RANK_ERROR
        for item in row["frequent"]:
            held = rows.where(text.eqNullSafe(F.lit(item["item"]))).count()
            assert abs(item["count"] - held) <= COUNT_ERROR * total + 1
    assert (found["s"]["frequent"][0]["item"], found["s"]["frequent"][0]["count"]) == ("often", 20_000)


def test_one_pass(spark, rows):
    parts = profile_parts(rows)
    check(spark, rows, parts)
    plan = parts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1


def test_loads_that_are_stored_and_merged(spark, rows):
    folder = staging_folder(spark)
    loads = [stage(profile_parts(rows.where(F.col("`a.b`") % 3 == n)), f"{folder}/{n}") for n in range(3)]
    check(spark, rows, merge_profiles(*loads))


def test_chosen_columns_and_no_rows(spark, rows):
    found = profile(merge_profiles(profile_parts(rows.where("false"), ["s", "d"]))).collect()
    assert {(r["column_name"], r["row_count"], r["null_count"], r["distinct_estimate"], r["quantiles"]) for r in found} == {
        ("s", 0, 0, 0, None),
        ("d", 0, 0, 0, None),
    }


def test_no_value_is_frequent(spark):
    """Of values that are all as rare as each other the sketch names none; the exact count says so too."""
    rows = spark.range(0, 300_000, numPartitions=4).select((F.col("id") % 100_000).alias("rare"), (F.col("id") % 2).alias("often"), F.lit(None).cast("int").alias("no"))
    found = {r["column_name"]: r for r in profile(profile_parts(rows), top=1).collect()}
    assert not found["rare"]["frequent"] and found["often"]["frequent"][0]["count"] == 150_000
    most = run_most_frequent(rows, ["rare", "often", "no"])
    assert most == {"rare": 3, "often": 150_000, "no": 0} and most["rare"] <= COUNT_ERROR * 300_000
