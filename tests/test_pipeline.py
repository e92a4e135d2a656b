import io
import json
import zipfile

import pytest

from ledgerlane.contracts import CUSTOMERS, ORDERS, PRODUCTS
from ledgerlane.plans import PROFIT_SQL, profit_sql
from ledgerlane.plans.ingest import ingest
from ledgerlane.plans.pipeline import run_pipeline
from ledgerlane.settings import Settings
from ledgerlane.sinks import stage, staging_folder, table_format, write_table
from ledgerlane.operators.quality import FIRST_FAILED, evaluate, rejected, valid
from ledgerlane.operators.rules import ReadableRule
from ledgerlane.sources import read_dataset, read_files, read_workbooks
from ledgerlane.sources.files import CORRUPT
from ledgerlane.sources.workbooks import sheet_rows
from workload.workbooks import workbook_bytes

PRODUCT_LINES = """Product ID,Category,Sub-Category,Product Name,State,Price per product
P1,Furniture,Chairs,"Chair, oak",Texas,12.5
P2,Office,Paper,Paper,Ohio,abc
P3,Office,Paper,Pens,Ohio,-1
P4,Office,Binders,,Ohio,3.25
P4,Office,Binders,Binder,Utah,3.50
"""

# Customer, product, price, quantity, discount, profit, order date, ship date.
ORDER_ROWS = [
    ("00017", "P1", 10.0, 2, 0.1, 1.255, "1/2/2023", "2023-02-05"),
    ("00017", "P4", 5.0, 1, 0.0, 2.0, "2023-02-01", "3/2/2023"),
    ("C2", "P4", 1.0, 1, 0.0, 1.0, "5/5/2022", "6/5/2022"),
    ("C2", "P2", 4.0, 0, 0.0, 0.5, "5/5/2022", "6/5/2022"),
    ("C9", "P1", 4.0, 1, 0.0, 0.25, "5/5/2022", "6/5/2022"),
    ("C2", "P1", 4.0, 1, 0.0, 9.0, "2022-13-05", "6/5/2022"),
    ("C2", "P1", -4.0, 1, 0.0, 9.0, "5/5/2022", "6/5/2022"),
    ("C2", "P1", 4.0, -1, 0.0, 9.0, "5/5/2022", "6/5/2022"),
    ("C2", "P1", 4.0, 1.5, 0.0, 9.0, "5/5/2022", "6/5/2022"),
    ("C2", "P1", 4.0, 1, 0.0, 9.0, "5/5/2022", "4/5/2022"),
    ("C2", "P1", 4.0, 1, 0.0, None, "5/5/2022", "6/5/2022"),
]

CUSTOMER_ROWS = [
    ["00017", "Ann", "ann@shop.com", "1", "a", "Consumer", "US", "Austin", "Texas", 78701, "Central"],
    ["C2", "Bob", "bob@shop.com", "2", "b", "Corporate", "US", "Salem", "Ohio", 97301.0, "West"],
    ["C3", "Cid", "not an email", "3", "c", "Corporate", "US", "Salem", "Ohio", 97301, "West"],
    ["C4", "Dee", None, "4", "d", "Corporate", "US", "Salem", "Ohio", 97301, "West"],
    ["C5", "Eve", "eve@shop.com", "5", "e", "Corporate", "US", "Salem", "Ohio", 0, "West"],
    ["C6", "Fay", "fay@shop.com", "6", "f", "Corporate", "US", "Salem", "Ohio", "n/a", "West"],
]


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("files")
    (folder / "Products.csv").write_text(PRODUCT_LINES)
    orders = [
        {
            "Customer ID": c, "Discount": d, "Order Date": o, "Order ID": f"O{i // 2}", "Price": p, "Product ID": x,
            "Profit": g, "Quantity": q, "Row ID": i, "Ship Date": s, "Ship Mode": "Slow",
        }
        for i, (c, x, p, q, d, g, o, s) in enumerate(ORDER_ROWS)
    ]
    (folder / "Orders.json").write_text(json.dumps(orders, indent=2))
    (folder / "Customer.xlsx").write_bytes(workbook_bytes([CUSTOMERS.headers, *CUSTOMER_ROWS]))
    return folder


def test_csv_is_read_as_text(spark, files):
    df = read_dataset(spark, str(files / "Products.csv"), PRODUCTS)
    assert df.columns == [*PRODUCTS.schema.names, CORRUPT]
    assert {t for _, t in df.dtypes} == {"string"}
    assert df.first().product_name == "Chair, oak"
    inferred = read_files(spark, str(files / "Products.csv"), {"State": "state", "Absent": "x"}, infer=True)
    assert "state" in inferred.columns and "Product ID" in inferred.columns


def test_csv_folder_with_another_header_order_is_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("A,B\n1,2\n")
    (tmp_path / "b.csv").write_text("B,A\n2,1\n")
    with pytest.raises(Exception):
        read_files(spark, str(tmp_path), fmt="csv").collect()


def test_options_override_defaults(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1;2\n3;4\n")
    df = read_files(spark, str(tmp_path / "a.csv"), header="false", sep=";")
    assert [tuple(r) for r in df.collect()] == [("1", "2"), ("3", "4")]


def test_json_array_and_lines(spark, files, tmp_path):
    df = read_dataset(spark, str(files / "Orders.json"), ORDERS)
    assert df.count() == len(ORDER_ROWS)
    assert df.first().customer_id == "00017"
    (tmp_path / "lines.json").write_text('{"Row ID": 7, "Price": 12.50}\n{broken\n')
    rows = read_dataset(spark, str(tmp_path / "lines.json"), ORDERS, multiLine="false").collect()
    assert [(r.row_id, r.price) for r in rows] == [("7", "12.50"), (None, None)]
    assert rows[1]._corrupt_record == "{broken"
    guessed = read_files(spark, str(files / "Orders.json"), ORDERS.renames, multiLine="true")
    assert dict(guessed.dtypes)["quantity"] == "string"
    assert dict(read_files(spark, str(files / "Orders.json"), infer=True, multiLine="true").dtypes)["Row ID"] == "bigint"


def test_unknown_suffix(spark):
    for path in ("data/input.parquet", "data/INPUT.CSV"):
        with pytest.raises(ValueError, match="Unsupported file format"):
            read_files(spark, path)


def test_workbook_folder(spark, files, tmp_path):
    for part in range(3):
        rows = [["Id", "Name"], [part, f"n{part}"], [None, None], [part + 0.5, "x < y & z"]]
        (tmp_path / f"{part}.xlsx").write_bytes(workbook_bytes(rows))
    (tmp_path / "notes.txt").write_text("not a workbook")
    df = read_workbooks(spark, str(tmp_path), sheet="Worksheet")
    assert sorted(map(tuple, df.collect())) == sorted(
        (value, name) for p in range(3) for value, name in ((str(p), f"n{p}"), (str(p + 0.5), "x < y & z"))
    )
    with pytest.raises(Exception, match="no sheet"):
        read_workbooks(spark, str(tmp_path), sheet="Absent", headers=["Id"]).collect()
    missing = read_workbooks(spark, str(tmp_path), sheet="Worksheet", headers=["Name", "Absent"])
    assert {r.Absent for r in missing.collect()} == {None}


def test_workbook_cells():
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    relation = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as book:
        book.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="{relation}"><sheets><sheet name="S" r:id="a"/></sheets></workbook>')
        book.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="a" Target="/xl/s.xml"/></Relationships>')
        book.writestr("xl/sharedStrings.xml", f"<sst {main}><si><t>one</t></si><si><r><t>two</t></r><r><t> three</t></r><rPh><t>no</t></rPh></si></sst>")
        book.writestr("xl/styles.xml", f'<styleSheet {main}><numFmts><numFmt numFmtId="170" formatCode="dd.mm.yyyy"/><numFmt numFmtId="171" formatCode="0.0&quot;d&quot;"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="170"/><xf numFmtId="171"/></cellXfs></styleSheet>')
        book.writestr("xl/s.xml", f"""<worksheet {main}><sheetData>
            <row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1" t="s"><v>1</v></c></row>
            <row r="2"/>
            <row r="3"><c r="A3" s="1"><v>45000</v></c><c r="B3" s="2"><v>45000.5</v></c><c r="C3" s="3"><v>1.5</v></c>
                       <c r="D3" t="b"><v>1</v></c><c r="E3" t="str"><v>f</v></c><c r="AA3"><v>1E3</v></c></row>
            </sheetData></worksheet>""")
    rows = list(sheet_rows(out.getvalue(), "S"))
    assert rows[0] == ["one", None, "two three"]
    assert rows[1][:5] == ["2023-03-15", "2023-03-15 12:00:00", "1.5", "true", "f"]
    assert rows[1][26] == "1000"


def test_tables_are_replaced(spark):
    assert table_format(spark) == "parquet"
    write_table(spark.range(3), "spark_catalog.default.numbers")
    write_table(spark.range(2).withColumnRenamed("id", "n"), "spark_catalog.default.numbers")
    assert [r.n for r in spark.table("numbers").orderBy("n").collect()] == [0, 1]


def test_staging_uses_the_configured_folder(spark):
    folder = staging_folder(spark)
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert stage(spark.range(5), folder).count() == 5


@pytest.fixture(scope="module")
def run(spark, files):
    settings = Settings(
        sources={
            "products": str(files / "Products.csv"),
            "orders": str(files / "Orders.json"),
            "customers": str(files / "Customer.xlsx"),
        }
    )
    return (*run_pipeline(spark, settings), settings)


def test_pipeline_tables_and_counts(spark, run):
    store, _, settings = run
    assert spark.table(settings.table("orders")).schema.simpleString() == ORDERS.schema.simpleString()
    assert sorted(r.row_id for r in store.orders.clean.collect()) == [0, 1, 2, 3, 4]
    assert sorted(r.customer_id for r in store.customers.clean.collect()) == ["00017", "C2"]
    assert {r.postal_code for r in store.customers.clean.collect()} == {78701, 97301}
    assert sorted(r.product_id for r in store.products.clean.collect()) == ["P1", "P4", "P4"]
    counts = {k: v for k, v in store.orders.counts.items() if v}
    assert counts == {
        "rows": 11, "kept": 5, "order_date as date": 1, "profit as double": 1, "quantity as long": 1,
        "price >= 0": 1, "quantity >= 0": 1, "ship_date >= order_date": 1,
    }


def test_pipeline_quarantine(spark, run):
    _, _, settings = run
    found = spark.table(settings.quarantine_table)
    per_set = {r.dataset: r["count"] for r in found.groupBy("dataset").count().collect()}
    assert per_set == {"orders": 6, "customers": 4, "products": 2}
    bad = found.filter("first_failed_rule = 'quantity as long'").first()
    assert bad.raw["quantity"] == "1.5"
    emails = found.filter("first_failed_rule = 'email is an email'").collect()
    assert {r.raw["customer_id"] for r in emails} == {"C3", "C4"}


def test_pipeline_reports(run):
    store, _, _ = run
    assert sorted(r.state for r in store.products.duplicates.collect()) == ["Ohio", "Utah"]
    assert {r.column_name: r.null_count for r in store.products.nulls.collect()} == {"product_name": 1}
    # Row 9 fails only the date order, so it takes part in the key report, but its key is its own.
    assert store.orders.duplicates.isEmpty()
    assert [r.row_id for r in store.missing_products().collect()] == [3]
    assert [r.row_id for r in store.missing_customers().collect()] == [4]


def test_pipeline_outputs(spark, run):
    _, outputs, _ = run
    assert {r.order_year: r.profit_per_year for r in outputs["profit_by_year"].collect()} == {2022: 2.75, 2023: 5.26}
    assert len(outputs["wide_fact"].columns) == 27
    assert len(outputs["enriched_orders"].columns) == 32
    assert len(outputs["fully_enriched"].columns) == 43
    assert outputs["fully_enriched"].count() == outputs["wide_fact"].count() == 7
    for name in PROFIT_SQL:
        assert sorted(map(str, profit_sql(spark, name).collect())) == sorted(
            map(str, outputs[name].select(*profit_sql(spark, name).columns).collect())
        )


def test_csv_records_of_another_width_are_quarantined(spark, tmp_path):
    header = ",".join(PRODUCTS.headers)
    (tmp_path / "p.csv").write_text(f"{header}\n1,c,s,n,t,2.5\n2,c,s,n,t,2.5,more\n3,c,s\n")
    rows = {r.product_id: r for r in read_dataset(spark, str(tmp_path / "p.csv"), PRODUCTS).collect()}
    assert rows["1"][CORRUPT] is None
    assert rows["2"][CORRUPT] == "2,c,s,n,t,2.5,more" and rows["3"][CORRUPT] == "3,c,s"
    flagged = evaluate(read_dataset(spark, str(tmp_path / "p.csv"), PRODUCTS), [ReadableRule(CORRUPT), *PRODUCTS.rules])
    assert [r.product_id for r in valid(flagged).collect()] == ["1"]
    assert {r[FIRST_FAILED] for r in rejected(flagged).collect()} == {"readable record"}
    (tmp_path / "q.csv").write_text("Product ID,Category\n1,c\n")
    with pytest.raises(ValueError, match="lacks the headers Sub-Category"):
        read_dataset(spark, str(tmp_path / "q.csv"), PRODUCTS)


def test_headers_match_in_any_case(spark, tmp_path):
    (tmp_path / "lines.json").write_text('{"row id": "7", "PRICE": "2"}\n{"row id": "8"}\n')
    rows = read_dataset(spark, str(tmp_path / "lines.json"), ORDERS, multiLine="false").collect()
    assert sorted((r.row_id, r.price) for r in rows) == [("7", "2"), ("8", None)]
    rows = read_dataset(spark, str(tmp_path / "lines.json"), ORDERS, multiLine="false", headersAsSpelled="true").collect()
    assert [(r.row_id, r.price) for r in rows] == [(None, None)] * 2
    (tmp_path / "c.csv").write_text(",".join(h.upper() for h in PRODUCTS.headers) + "\n1,c,s,n,t,2.5\n")
    assert read_dataset(spark, str(tmp_path / "c.csv"), PRODUCTS).first().price_per_product == "2.5"


def test_workbooks_with_other_headers_and_suffixes(spark, tmp_path):
    from workload.workbooks import as_workbooks

    for name, row in (("a.xlsx", [("1", "x")]), ("b.XLSX", [("2", "y")])):
        columns = "Id string, Name string" if name[0] == "a" else "Id string, Town string"
        book = as_workbooks(spark.createDataFrame(row, columns)).first()["content"]
        (tmp_path / name).write_bytes(bytes(book))
    found = read_workbooks(spark, str(tmp_path), sheet="Worksheet")
    assert found.columns == ["Id", "Name", "Town"]
    assert sorted(map(tuple, found.collect())) == [("1", "x", None), ("2", None, "y")]


def test_workbooks_that_lack_a_header_are_quarantined(spark, tmp_path):
    for name, headers in (("a", ["CUSTOMER id", "Name"]), ("b", ["customer ID", "Name", "Missing"])):
        (tmp_path / f"{name}.xlsx").write_bytes(workbook_bytes([headers, [name, "n", "m"][: len(headers)]]))
    (tmp_path / "c.xlsx").write_bytes(workbook_bytes([["name", "NAME", "Name", "missing", "Customer ID"], ["x", "y", "z", "m", "c"]]))
    wanted = ["Customer ID", "Name", "Missing"]
    found = read_files(spark, str(tmp_path), fmt="excel", headers=wanted, sheetName="Worksheet").orderBy("Customer ID")
    rows = [tuple(r) for r in found.collect()]
    assert rows[0][:3] == ("a", "n", None) and json.loads(rows[0][3]) == {"lacks": ["Missing"], "row": {"CUSTOMER id": "a", "Name": "n"}}
    assert rows[1:] == [("b", "n", "m", None), ("c", "z", "m", None)]


def test_sketches_of_keys_do_not_go_through_the_driver(spark, tmp_path, monkeypatch):
    """What is observed goes to the driver from each task: counters only, however many keys there are."""
    from pyspark.sql.classic.dataframe import DataFrame

    seen, observe = [], DataFrame.observe
    monkeypatch.setattr(DataFrame, "observe", lambda df, name, *exprs: seen.append(exprs) or observe(df, name, *exprs))
    lines = [json.dumps({h: "1" for h in ORDERS.headers} | {"Customer ID": f"C{i}", "Order Date": "2023-01-01", "Ship Date": "2023-01-02"}) for i in range(50)]
    (tmp_path / "orders").mkdir()
    (tmp_path / "orders" / "part.json").write_text("\n".join([*lines, "{"]))
    settings = Settings(
        sources={"orders": str(tmp_path / "orders")}, schema="default", location=str(tmp_path / "tables"),
        formats={"orders": "json"}, read_options={"orders": {"multiLine": "false"}},
    )
    found = ingest(spark, ORDERS, settings)
    spark.sql(f"DROP TABLE {found.table}")
    assert (found.counts["rows"], found.counts["kept"], found.hot) == (51, 50, {"customer_id": {}, "product_id": {}})
    assert len(seen) == 1 and "approx_top_k" not in str(seen)
