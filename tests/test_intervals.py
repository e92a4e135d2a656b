"""Versions by key and date against a comparison of every line with every version."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerlane.operators.intervals import as_intervals, run_as_of_lookup, run_interval_lookup


def lines(spark, kind="date"):
    pick = random.Random(1)
    rows = []
    for i in range(800):
        key = 1 if pick.random() < 0.4 else pick.choice([2, 3, 4, None])
        rows.append((i, key, pick.choice([None, *[date(2021, 1, 1) + timedelta(pick.randrange(700)) for _ in range(20)]])))
    return spark.createDataFrame(rows, "line int, k long, d date").withColumn("d", F.col("d").cast(kind))


def versions(spark, kind="date"):
    pick = random.Random(2)
    rows = [(1, None, None, "all"), (None, None, None, "no key"), (2, date(2022, 1, 1), date(2021, 1, 1), "backwards")]
    for key in (1, 2, 3):
        for v in range(6):
            start = date(2020, 11, 1) + timedelta(pick.randrange(800))
            rows.append((key, pick.choice([start, start, start, None]), pick.choice([start + timedelta(pick.randrange(300)), None]), f"v{v}"))
    df = spark.createDataFrame(rows, "k long, `a.b` date, e date, d string")
    return df.withColumns({"a.b": F.col("`a.b`").cast(kind), "e": F.col("e").cast(kind)})


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz"])
@pytest.mark.parametrize("ranges", [1, 5, 1000])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_intervals(spark, kind, ranges, how):
    fact, table = lines(spark, kind), versions(spark, kind)
    found = run_interval_lookup(fact, table, "k", "d", "a.b", "e", how=how, ranges=ranges)
    expected = []
    known = table.collect()
    for f in fact.collect():
        hits = [
            (*f, v["a.b"], v["e"], v["d"])
            for v in known
            if f["k"] is not None and f["d"] is not None and v["k"] == f["k"]
            and (v["a.b"] is None or v["a.b"] <= f["d"]) and (v["e"] is None or f["d"] <= v["e"])
        ]
        expected += hits or ([(*f, None, None, None)] if how == "left" else [])
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)


def test_lines_at_the_very_ends(spark):
    fact = spark.sql("SELECT * FROM VALUES (1, DATE'2020-01-01'), (2, DATE'2020-01-31'), (3, DATE'1969-12-31') AS t(line, d)").withColumn("k", F.lit("x"))
    table = spark.sql("SELECT 'x' AS k, DATE'1969-12-31' AS a, DATE'2020-01-01' AS b UNION ALL SELECT 'x', DATE'2020-01-31', DATE'2020-01-31'")
    found = run_interval_lookup(fact, table, "k", "d", "a", "b", how="inner")
    assert sorted(r["line"] for r in found.collect()) == [1, 2, 3]
    open_end = run_interval_lookup(fact, table, "k", "d", "a", "b", how="inner", end_included=False)
    assert sorted(r["line"] for r in open_end.collect()) == [3]


def test_last_version_before_a_date(spark):
    fact = lines(spark)
    pick = random.Random(4)
    table = [(k, date(2020, 12, 1) + timedelta(pick.randrange(700)), pick.choice(["x", "y", None]), i) for i, k in enumerate([1, 1, 1, 2, 2, 3, None] * 4)]
    table += [(1, date(2021, 5, 5), "tie", 1), (1, date(2021, 5, 5), "tie", 2), (1, None, "no date", 9)]
    df = spark.createDataFrame(table, "k long, since date, name string, n int")
    found = run_as_of_lookup(fact, df, "k", "d", "since")
    expected = []
    for f in fact.collect():
        hits = [v for v in table if v[0] is not None and v[0] == f["k"] and f["d"] is not None and v[1] is not None and v[1] <= f["d"]]
        best = max(hits, key=lambda v: (v[1], v[2] is not None, v[2] or "", v[3])) if hits else (None,) * 4
        expected.append((*f, *best[1:]))
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)
    assert found.count() == fact.count()


def test_no_comparison_of_all_lines_with_all_versions(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = run_interval_lookup(lines(spark), versions(spark), "k", "d", "a.b", "e")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_empty_sides(spark):
    fact, table = lines(spark), versions(spark)
    assert run_interval_lookup(fact.where("false"), table, "k", "d", "a.b", "e").count() == 0
    assert run_interval_lookup(fact, table.where("false"), "k", "d", "a.b", "e").count() == fact.count()
    assert run_interval_lookup(fact.withColumn("d", F.lit(None).cast("date")), table, "k", "d", "a.b", "e", how="inner").count() == 0
    assert as_intervals(table.select("k", F.col("`a.b`").alias("s")), "k", "s", "u").columns == ["k", "s", "u"]
    assert run_interval_lookup(fact, table, "k", "d", "a.b", "e", span=(date(2021, 1, 1), datetime(2022, 12, 1).date())).count() > 0


def test_long_intervals_are_not_repeated_for_every_range(spark):
    """Spark takes the repeated intervals for as small as their file, and would broadcast them."""
    fact = spark.range(20_000).select("id", (F.col("id") % 500).alias("k"), F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 640).cast("int")).alias("d"))
    start = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("v") * 160).cast("int"))
    table = spark.range(2000).select((F.col("id") % 500).alias("k"), F.floor(F.col("id") / 500).alias("v")).select("k", start.alias("a"), F.date_add(start, 159).alias("b"), "v")
    found = run_interval_lookup(fact, table, "k", "d", "a", "b", limit=1000)
    assert "BroadcastHashJoin" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 20_000 and found.where("v is null or v != floor(datediff(d, date'2020-01-01') / 160)").isEmpty()


def test_crowded_keys_keep_short_ranges(spark):
    fact, table = lines(spark), versions(spark)
    found = run_interval_lookup(fact, table, "k", "d", "a.b", "e", rows_per_task=100)
    whole = run_interval_lookup(fact, table, "k", "d", "a.b", "e", ranges=1)
    assert "CASE WHEN" in found._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)
