"""Drops of files taken up one call after the other against one reading of all of them."""

import json

import pytest

from ledgerlane.contracts import ORDERS, PRODUCTS
from ledgerlane.operators.quality import FIRST_FAILED, evaluate, quarantine, valid
from ledgerlane.operators.rules import ReadableRule
from ledgerlane.operators.shape import conform
from ledgerlane.session import CLUSTER_CONF
from ledgerlane.sources import read_dataset
from ledgerlane.sources.files import CORRUPT
from ledgerlane.streaming import run_drops


def order(row, order_id="o1", **changed):
    known = {
        "Customer ID": "c1", "Discount": "0.1", "Order Date": "1/2/2023", "Order ID": order_id, "Price": "10.0", "Product ID": "p1",
        "Profit": "1", "Quantity": "2", "Row ID": str(row), "Ship Date": "2023-02-03", "Ship Mode": "Air",
    }
    return {**known, **changed}


def write(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows) + "\n")


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("horizon", [None, "30 days"])
def test_three_drops_equal_one_batch(spark, tmp_path, horizon):
    source, target = tmp_path / "in", str(tmp_path / "out")
    keys = ["order_id", "row_id"]

    def call():
        return run_drops(spark, str(source), target, ORDERS, keys, files_per_batch=1, horizon=horizon)

    write(source, "a.json", [order(1), order(2, Price="-1"), order(3, Quantity="x"), "{broken", order(4, **{"Row ID": None}), ""])
    first = call()
    assert first.counts["rows"] == 5 and first.counts["kept"] == 1 and first.counts["readable record"] == 1
    write(source, "b.json", [order(1), order(5), order(4, **{"Row ID": None}), {k.upper(): v for k, v in order(6).items()}])
    write(source, "c.json", [order(5, Price="99"), order(7, "o2"), "{broken"])
    second = call()
    assert second.counts["rows"] == 3 and second.micro_batches >= 2
    third = call()
    assert third.counts.get("rows", 0) == 0
    write(source, "d.json", [order(1, "o2"), order(8, **{"Ship Date": "2023-01-01"}), order(7, "o2")])
    last = call()
    assert last.counts["rows"] == 2 and last.counts["ship_date >= order_date"] == 1

    whole = read_dataset(spark, str(source), ORDERS, fmt="json", multiLine="false")
    whole = whole.where("order_id IS NOT NULL AND row_id IS NOT NULL AND price <> '99'").dropDuplicates(keys).union(
        whole.where("order_id IS NULL OR row_id IS NULL").dropDuplicates()
    )
    # The record spelled in capitals is read by the stream only.
    flagged = evaluate(whole.where(f"order_id IS NOT NULL OR {CORRUPT} IS NOT NULL"), [ReadableRule(CORRUPT), *ORDERS.rules])
    upper = last.clean.where("row_id = 6")
    assert upper.count() == 1
    assert sorted_rows(last.clean.where("row_id <> 6")) == sorted_rows(conform(valid(flagged), ORDERS.schema).where("row_id <> 6"))
    reasons = [sorted(r[FIRST_FAILED] for r in q.collect()) for q in (last.quarantine, quarantine(flagged, "orders"))]
    assert reasons[0] == [r for r in reasons[1] if r] and len(reasons[0]) == 5


def test_keys_seen_are_kept_on_disk(spark, tmp_path):
    """With the state store that clusters should use."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, CLUSTER_CONF[name])
    try:
        source, target = tmp_path / "in", str(tmp_path / "out")
        for number, rows in enumerate(([order(1), order(2)], [order(2), order(3)], [order(1), order(3)])):
            write(source, f"{number}.json", rows)
            found = run_drops(spark, str(source), target, ORDERS, ["order_id", "row_id"])
        assert sorted(r["row_id"] for r in found.clean.collect()) == [1, 2, 3] and found.counts["rows"] == 0
    finally:
        spark.conf.set(name, before)


def test_csv_drops(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    header = ",".join(PRODUCTS.headers)
    write(source, "a.csv", [header, "P1,c,s,n,t,2.5", "P2,c,s,n,t,bad"])
    run_drops(spark, str(source), target, PRODUCTS, ["product_id"], fmt="csv")
    write(source, "b.csv", [header, "P1,c,s,n,t,2.5", "P3,c,s,n,t,1,more", "P4,c,s,n,t,-1", "P5,c,s,n,t,0"])
    found = run_drops(spark, str(source), target, PRODUCTS, ["product_id"], fmt="csv")
    assert sorted(r["product_id"] for r in found.clean.collect()) == ["P1", "P5"]
    assert found.quarantine.count() == 3 and found.counts["rows"] == 3


def test_no_files_yet(spark, tmp_path):
    (tmp_path / "in").mkdir()
    found = run_drops(spark, str(tmp_path / "in"), str(tmp_path / "out"), ORDERS, ["row_id"])
    assert found.clean.count() == 0 and found.counts == {}
    with pytest.raises(ValueError, match="can't be streamed"):
        run_drops(spark, str(tmp_path / "in"), str(tmp_path / "out"), ORDERS, ["row_id"], fmt="excel")


def test_keys_are_shuffled_and_kept_once(spark, tmp_path):
    """The state is told apart by the key columns, not by one more text of them, and files are packed tightly."""
    source, target = tmp_path / "in", tmp_path / "out"
    write(source, "a.json", [order(1), order(1), order(2), order(1, **{"Order ID": None}), order(1, **{"Order ID": None})])
    found = run_drops(spark, str(source), str(target), ORDERS, ["order_id", "row_id"])
    assert found.counts["rows"] == 3
    files = [f for f in (target / "progress" / "state").rglob("*") if f.is_file() and not f.name.endswith(".crc")]
    schemas = [f.read_bytes() for f in files if "schema" in str(f)]
    assert schemas and all(b"order_id" in s and b"row_id" in s for s in schemas)
    assert list((target / "staged").glob("*.zstd.parquet"))


def test_keys_seen_live_on_disk(spark, tmp_path):
    """In memory the keys of 6 GB of tables take 75 GB; the session's own settings stay."""
    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting, None)
    target = tmp_path / "out"
    write(tmp_path / "in", "a.json", [order(1), order(1), order(2)])
    assert run_drops(spark, str(tmp_path / "in"), str(target), ORDERS, ["order_id", "row_id"]).clean.count() == 2
    write(tmp_path / "in", "b.json", [order(2), order(3)])
    assert run_drops(spark, str(tmp_path / "in"), str(target), ORDERS, ["order_id", "row_id"]).clean.count() == 3
    assert list((target / "progress" / "state").rglob("*.changelog"))
    assert spark.conf.get(setting, None) == before
