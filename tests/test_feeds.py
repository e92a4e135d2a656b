"""Feeds as files: packed, in files of a bounded number of records, with every row."""

import os
from datetime import datetime

from ledgerlane.contracts import ORDERS
from ledgerlane.session import changed_settings
from ledgerlane.sources import read_dataset
from workload import queries, views


def tables(spark, folder):
    def save(name, schema, *rows):
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")

    line = "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double"
    day = datetime(2020, 1, 2)
    lines = [(n // 3, n % 5, n % 3, 2.0, 10.25 + n, 0.05, 0.02, None if n == 7 else "N", day) for n in range(20)]
    save("lineitem", f"{line}, l_tax double, l_returnflag string, l_shipdate timestamp", *lines)
    save("orders", "o_orderkey long, o_custkey long, o_orderdate timestamp", *[(n, n % 2, day) for n in range(7)])
    save("customer", "c_custkey long, c_name string, c_mktsegment string", (0, "a", "s"), (1, "b", "s"))
    save("part", "p_partkey long, p_type string, p_brand string, p_name string, p_retailprice double", (0, "t", "b", "n", 1.0))


def test_line_feeds_are_packed_and_whole(spark, tmp_path, monkeypatch):
    tables(spark, tmp_path)
    monkeypatch.setitem(queries.PACKED, "maxRecordsPerFile", "4")
    paths = queries._write_feeds(spark, str(tmp_path), f"{tmp_path}/feeds")
    files = [name for name in os.listdir(paths["orders"]) if name.startswith("part-")]
    assert len(files) >= 5 and all(name.endswith(".json.gz") for name in files)
    feed = read_dataset(spark, paths["orders"], ORDERS, fmt="json", multiLine="false").select(*ORDERS.schema.names)
    assert sorted(map(repr, feed.collect())) == sorted(map(repr, views.text_orders(spark, str(tmp_path)).collect()))
    assert feed.count() == 20


def test_lines_of_a_file_meet_where_they_are_joined(spark, tmp_path):
    tables(spark, tmp_path)
    folder, setting = str(tmp_path), "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(setting, None)
    found = queries._array_feed(spark, folder, 2)
    assert spark.conf.get(setting, None) == before
    assert sorted(map(repr, found.collect())) == sorted(map(repr, views.text_orders(spark, folder).collect()))
    together = views.text_orders(spark, folder, together=2)
    assert {(int(r.order_id) // 2, r.block) for r in together.collect()} == {(n, n) for n in range(4)}
    with changed_settings(spark, {setting: "false", "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}):
        grouped = together.groupBy("block").count()
        plan = spark._jvm.PythonSQLUtils.explainString(grouped._jdf.queryExecution(), "simple")
    # The lines and the orders, and not the lines again as texts.
    assert plan.count("Exchange") == 2
