import pytest
from pyspark.sql import types as T

from ledgerlane.operators import (
    Dimension,
    conform,
    duplicate_keys,
    duplicate_rows,
    keys_are_unique,
    null_counts,
    null_counts_wide,
    orphans,
    run_has_rows,
    run_null_report,
)


def test_duplicate_rows(spark):
    rows = [(31, "oak"), (44, "elm"), (31, "ash"), (58, "fir"), (31, "yew"), (60, "elm")]
    df = spark.createDataFrame(rows, "plot long, tree string")
    assert sorted(r.tree for r in duplicate_rows(df, "plot").collect()) == ["ash", "oak", "yew"]
    assert sorted(r.plot for r in duplicate_rows(df, "tree").collect()) == [44, 60]
    assert duplicate_rows(df, ["plot", "tree"]).isEmpty()
    assert not keys_are_unique(df, ["plot"])
    assert keys_are_unique(df, ["plot", "tree"])


def test_duplicates_with_null_and_awkward_keys(spark):
    df = spark.createDataFrame([(None, "a", 1), (None, "a", 2), (1, None, 3), (1, "a", 4)], "count long, `x.y` string, n int")
    assert sorted(r.n for r in duplicate_rows(df, "count").collect()) == [1, 2, 3, 4]
    assert sorted(r.n for r in duplicate_rows(df, ["count", "x.y"]).collect()) == [1, 2]
    assert [(r["count"], r.copies) for r in duplicate_keys(df, ["count", "x.y"]).collect()] == [(None, 2)]


def test_hot_keys_are_reported_with_the_others(spark):
    rows = [(7, i) for i in range(5)] + [(None, i) for i in range(4)] + [(8, 0), (8, 1), (9, 0)]
    df = spark.createDataFrame(rows, "k int, n int")
    expected = sorted(map(str, duplicate_rows(df, "k").collect()))
    assert len(expected) == 11
    for hot_rows in (2, 4, 5):
        assert sorted(map(str, duplicate_rows(df, "k", hot_rows).collect())) == expected


def test_null_reports(spark):
    df = spark.createDataFrame(
        [(7, "red", 1.5), (8, None, 0.0), (9, None, None), (10, None, 2.0), (11, "blue", 3.5)],
        "lot long, colour string, `net.kg` double",
    )
    assert {r.column_name: r.null_count for r in null_counts(df).collect()} == {"colour": 3, "net.kg": 1}
    assert null_counts_wide(df).first().asDict() == {"lot": 0, "colour": 3, "net.kg": 1}
    report = run_null_report(df)
    assert report.count() == 1
    assert report.first().asDict() == {"colour": 3, "net.kg": 1}


def test_null_reports_without_nulls(spark):
    df = spark.createDataFrame([(1, float("nan"))], "id long, x double")
    assert null_counts(df).isEmpty()
    assert run_null_report(df).columns == []
    assert null_counts_wide(df.filter("id < 0")).first().asDict() == {"id": 0, "x": 0}


def test_orphans(spark):
    fact = spark.createDataFrame([("B7", 4), ("C1", 9), ("B7", 5), ("D4", 2), (None, 6)], "bin string, units int")
    known = spark.createDataFrame([("B7", "left"), ("D4", "right"), ("D4", "back"), (None, "lost")], "bin string, side string")
    missing = orphans(fact, known, "bin")
    assert sorted((r.bin or "", r.units) for r in missing.collect()) == [("", 6), ("C1", 9)]
    assert missing.columns == ["bin", "units"]
    assert run_has_rows(missing) and not run_has_rows(orphans(fact.where("units < 6 and bin <> 'C1'"), known, "bin"))
    for knowledge in ({"small": True}, {"hot": {"D4": 3, "C1": 2}}):
        again = orphans(fact, Dimension(known, "bin", **knowledge), "bin")
        assert again.columns == missing.columns
        assert sorted(map(str, again.collect())) == sorted(map(str, missing.collect()))
    two = orphans(fact, spark.createDataFrame([("B7", 5)], "bin string, units int"), ["bin", "units"])
    assert two.count() == 4


def test_conform(spark):
    df = spark.createDataFrame([("12", "0.25", "k"), ("twelve", "8", "m")], "shelf string, width string, unit string")
    fields = [
        T.StructField("width", T.DoubleType()),
        T.StructField("shelf", T.IntegerType()),
    ]
    shaped = conform(df, fields)
    assert shaped.dtypes == [("width", "double"), ("shelf", "int")]
    assert [r.shelf for r in shaped.collect()] == [12, None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        conform(df, fields, strict=True).collect()
