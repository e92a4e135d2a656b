"""Loads that can be run again, and tables that keep all others."""

import pytest

from ledgerlane.sinks import BATCH, all_batches, batch_rows, staging_folder, write_batch, write_table


@pytest.fixture(params=[False, True], ids=["managed", "external"])
def table(spark, request):
    name = f"spark_catalog.default.batches_{request.node.name.split('[')[0]}_{request.param}".lower()
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    yield name, f"{staging_folder(spark)}/batches" if request.param else None
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def rows(spark, *values):
    return spark.createDataFrame(list(values), "`a.b` long, c string")


def held(spark, name):
    return sorted(tuple(r) for r in spark.table(name).collect())


def test_a_rerun_replaces_its_own_batch_only(spark, table):
    name, path = table
    odd = "it's \\ a/b=c %"
    write_batch(rows(spark, (1, "x"), (2, "y")), name, "one", path=path)
    write_batch(rows(spark, (3, "x")), name, odd, path=path)
    assert held(spark, name) == [(1, "x", "one"), (2, "y", "one"), (3, "x", odd)]
    write_batch(rows(spark, (9, "z")).select("c", "`a.b`"), name, "one", path=path)
    assert held(spark, name) == [(3, "x", odd), (9, "z", "one")]
    assert [tuple(r) for r in batch_rows(spark, name, odd).collect()] == [(3, "x")]
    assert sorted(tuple(r) for r in all_batches(spark, name).collect()) == [(3, "x"), (9, "z")]


def test_a_rerun_without_rows_empties_its_batch(spark, table):
    name, path = table
    write_batch(rows(spark, (1, "x")), name, "one", path=path)
    write_batch(rows(spark, (2, "x")), name, "two", path=path)
    write_batch(rows(spark, (1, "x")).where("false"), name, "one", path=path)
    assert held(spark, name) == [(2, "x", "two")]
    spark.catalog.refreshTable(name)
    assert held(spark, name) == [(2, "x", "two")]


def test_reading_a_batch_reads_its_partition(spark, table):
    name, path = table
    for batch in "abc":
        write_batch(rows(spark, (1, batch)), name, batch, path=path)
    plan = batch_rows(spark, name, "b")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(load_batch" in plan
    assert len(batch_rows(spark, name, "b").inputFiles()) < len(spark.table(name).inputFiles())


def test_other_columns_and_tables_are_refused(spark, table):
    name, path = table
    write_batch(rows(spark, (1, "x")), name, "one", path=path)
    with pytest.raises(ValueError, match="has the columns"):
        write_batch(rows(spark, (1, "x")).withColumnRenamed("c", "d"), name, "two", path=path)
    with pytest.raises(ValueError, match="tells batches apart"):
        write_batch(rows(spark, (1, "x")).withColumnRenamed("c", BATCH), name, "two", path=path)
    with pytest.raises(ValueError, match="name"):
        write_batch(rows(spark, (1, "x")), name, "", path=path)
    write_table(rows(spark, (1, "x")), f"{name}_plain")
    with pytest.raises(ValueError, match="not divided"):
        write_batch(rows(spark, (1, "x")), f"{name}_plain", "one")
    spark.sql(f"DROP TABLE {name}_plain")
    assert held(spark, name) == [(1, "x", "one")]
