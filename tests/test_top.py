"""The greatest rows of each group against sorting the group."""

import random
from collections import defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlane.operators import top
from ledgerlane.operators.top import greatest, run_top


def some_rows(seed):
    pick = random.Random(seed)
    return [("hot" if pick.random() < 0.4 else pick.choice([None, "a", "b", *map(str, range(60))]), pick.choice([None, *range(25)]), i) for i in range(2000)]


def expected(rows, k):
    groups = defaultdict(list)
    for row in rows:
        groups[row[0]].append(row)
    found = []
    for group in groups.values():
        known = sorted((r[1] for r in group if r[1] is not None), reverse=True)
        found += [r for r in group if (len(known) < k if r[1] is None else sum(v > r[1] for v in known) < k)]
    return sorted(r[2] for r in found)


@pytest.mark.parametrize("k", [1, 3, 40])
@pytest.mark.parametrize("held", [8, 1 << 18])
def test_equals_sorting(spark, monkeypatch, k, held):
    monkeypatch.setattr(top, "VALUES_HELD", held)
    rows = some_rows(k)
    df = spark.createDataFrame(rows, "`g.p` string, v int, i int").repartition(5)
    found = run_top(df, "g.p", "v", k)
    assert found.columns == df.columns
    assert sorted(r["i"] for r in found.collect()) == expected(rows, k)


def test_hot_groups_are_salted(spark):
    rows = some_rows(9)
    df = spark.createDataFrame(rows, "g string, v int, i int")
    assert sorted(r["i"] for r in run_top(df, "g", "v", 3, rows_per_task=100).collect()) == expected(rows, 3)


@pytest.mark.parametrize("kind", ["decimal(9,2)", "double", "date", "string", "timestamp"])
def test_values_of_any_ordered_type(spark, kind):
    df = spark.range(500).select((F.col("id") % 7).alias("g"), F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") * 37 % 101).cast("int")).alias("d"), "id")
    value = F.unix_date("d").cast(kind) if kind in ("decimal(9,2)", "double") else F.col("d").cast(kind)
    df = df.withColumn("v", value)
    rows = [(r["g"], r["v"], r["id"]) for r in df.collect()]
    assert sorted(r["id"] for r in run_top(df, "g", "v", 4).collect()) == expected(rows, 4)


def test_no_rows_and_no_k(spark):
    df = spark.createDataFrame([], "g string, v int")
    assert run_top(df, "g", "v", 2).count() == 0
    assert greatest(pa.table({"key": pa.array([], pa.string()), "value": pa.array([], pa.int64())}), 2).num_rows == 0
    with pytest.raises(ValueError):
        run_top(df, "g", "v", 0)
