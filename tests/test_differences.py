"""Differences of two loads against counting rows in Python."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerlane.operators.differences import key_changes, row_differences

SCHEMA = "k long, `a.b` string, c double, d date"


def some_rows(seed, size):
    pick = random.Random(seed)
    return [(pick.choice([None, 1, 2, *range(3, 30)]), pick.choice([None, "x", "y"]), pick.choice([None, 0.5, 1.5]), None) for _ in range(size)]


def frames(spark, seed):
    old = some_rows(seed, 120)
    new = old[30:] + some_rows(seed + 1, 30) + old[40:50]
    return old, new, spark.createDataFrame(old, SCHEMA), spark.createDataFrame(new, SCHEMA)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_rows_and_copies(spark, seed):
    old, new, a, b = frames(spark, seed)
    counts = Counter(new)
    counts.subtract(Counter(old))
    expected = sorted(((*row, n) for row, n in counts.items() if n), key=repr)
    found = row_differences(a, b.select("d", "c", "`a.b`", "k"))
    assert sorted(map(tuple, found.collect()), key=repr) == expected
    both = a.exceptAll(b).count() + b.exceptAll(a).count()
    assert found.agg(F.sum(F.abs("copies"))).first()[0] == both


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_columns_by_key(spark, seed):
    old, new, a, b = frames(spark, seed)
    counts = Counter(new)
    counts.subtract(Counter(old))
    by_key = defaultdict(list)
    for row, n in counts.items():
        if n:
            by_key[row[0]].append((row, n))
    expected = []
    for key, rows in by_key.items():
        change = "added" if all(r[0] != key for r in old) else "removed" if all(r[0] != key for r in new) else "changed"
        columns = []
        for place, name in ((1, "a.b"), (2, "c"), (3, "d")):
            values = Counter()
            for row, n in rows:
                values[row[place]] += n
            if any(values.values()):
                columns.append(name)
        expected.append((key, change, -sum(n for _, n in rows if n < 0), sum(n for _, n in rows if n > 0), columns))
    found = [tuple(r) for r in key_changes(a, b, "k").collect()]
    assert sorted(found, key=repr) == sorted(expected, key=repr)


def test_nested_columns_and_nulls_in_other_places(spark):
    a = spark.sql("SELECT * FROM VALUES (NULL, 1, map('x', 1), array(1)), (1, NULL, map('x', 1), array(1)) AS t(a, b, m, l)")
    b = spark.sql("SELECT * FROM VALUES (1, NULL, map('x', 1), array(1)), (NULL, 1, map('x', 2), array(1)) AS t(a, b, m, l)")
    assert sorted((r["m"]["x"], r["copies"]) for r in row_differences(a, b).collect()) == [(1, -1), (2, 1)]
    changes = key_changes(a, b, ["a", "b"]).collect()
    assert [(r["change"], r["removed"], r["added"], r["columns"]) for r in changes] == [("changed", 1, 1, ["m"])]


def test_equal_empty_and_unlike_loads(spark):
    _, _, a, b = frames(spark, 1)
    assert row_differences(a, a).count() == 0 and key_changes(a, a, "k").count() == 0
    assert row_differences(a.where("false"), a).agg(F.sum("copies")).first()[0] == 120
    assert {r["change"] for r in key_changes(a, a.where("false"), "k").collect()} == {"removed"}
    with pytest.raises(ValueError, match="same columns"):
        row_differences(a, b.drop("c"))
    with pytest.raises(ValueError, match="can't have"):
        row_differences(a.withColumn("copies", F.lit(1)), b.withColumn("copies", F.lit(1)))
