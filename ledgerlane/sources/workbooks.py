"""Excel workbooks: one Spark task decodes one workbook, every value comes out as text.

A worksheet holds at most 1,048,576 rows, so a task's work is bounded by the format; scale comes
from the number of workbooks.
"""

from __future__ import annotations

import io
import json
import re
import sys
import zipfile
from collections.abc import Iterator, Sequence
from datetime import datetime, timedelta
from xml.etree import ElementTree

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlane.functions import quoted

# The decoder travels with its tasks, so workers need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
RELATION_ID = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
ROWS_PER_BATCH = 8192

# Built-in number formats that show a date or time.
DATE_FORMAT_IDS = frozenset([*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)])


def _shows_date(code: str) -> bool:
    """Whether a custom number format has date parts outside quotes, brackets and escapes."""
    return bool(re.search(r"[dmyhs]", re.sub(r'"[^"]*"|\[[^\]]*\]|\\.|_.', "", code.lower()).replace("general", "")))


def _xml(book: zipfile.ZipFile, name: str) -> ElementTree.Element | None:
    return ElementTree.fromstring(book.read(name)) if name in book.namelist() else None


def _text(node: ElementTree.Element) -> str:
    """Text of a plain or rich string, without phonetic hints."""
    parts = node.findall(f"{MAIN}t") + node.findall(f"{MAIN}r/{MAIN}t")
    return "".join(part.text or "" for part in parts)


def _sheet_part(book: zipfile.ZipFile, sheet: str | None) -> tuple[str, bool]:
    """Archive name of the sheet (the first one if not named) and whether dates count from 1904."""
    workbook = _xml(book, "xl/workbook.xml")
    targets = {r.get("Id"): r.get("Target") for r in _xml(book, "xl/_rels/workbook.xml.rels")}
    sheets = {s.get("name"): targets[s.get(RELATION_ID)] for s in workbook.iter(f"{MAIN}sheet")}
    name = sheet if sheet is not None else next(iter(sheets))
    if name not in sheets:
        raise ValueError(f"Workbook has no sheet {name!r}; it has {', '.join(sheets)}")
    target = sheets[name]
    properties = workbook.find(f"{MAIN}workbookPr")
    from_1904 = properties is not None and properties.get("date1904") in ("1", "true")
    return target.lstrip("/") if target.startswith("/") else f"xl/{target}", from_1904


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    styles = _xml(book, "xl/styles.xml")
    if styles is None:
        return set()
    custom = {int(f.get("numFmtId")): f.get("formatCode", "") for f in styles.iter(f"{MAIN}numFmt")}
    cell_formats = styles.find(f"{MAIN}cellXfs")
    found = set()
    for index, xf in enumerate(cell_formats if cell_formats is not None else []):
        number = int(xf.get("numFmtId", 0))
        if number in DATE_FORMAT_IDS or (number in custom and _shows_date(custom[number])):
            found.add(index)
    return found


def _number(text: str, is_date: bool, from_1904: bool) -> str:
    value = float(text)
    if is_date:
        epoch = datetime(1904, 1, 1) if from_1904 else datetime(1899, 12, 30)
        moment = epoch + timedelta(seconds=round(value * 86400))
        return moment.strftime("%Y-%m-%d" if value.is_integer() else "%Y-%m-%d %H:%M:%S")
    return str(int(value)) if value.is_integer() and abs(value) < 1e15 else repr(value)


def _column_index(reference: str) -> int:
    index = 0
    for letter in reference:
        if not letter.isalpha():
            break
        index = index * 26 + ord(letter.upper()) - 64
    return index - 1


def sheet_rows(content: bytes, sheet: str | None = None) -> Iterator[list[str | None]]:
    """The rows of one sheet that hold any value, as texts."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        part, from_1904 = _sheet_part(book, sheet)
        shared_xml = _xml(book, "xl/sharedStrings.xml")
        shared = [] if shared_xml is None else [_text(item) for item in shared_xml.iter(f"{MAIN}si")]
        date_styles = _date_styles(book)
        with book.open(part) as stream:
            for _, node in ElementTree.iterparse(stream):
                if node.tag != f"{MAIN}row":
                    continue
                row: list[str | None] = []
                for cell in node.iter(f"{MAIN}c"):
                    at = _column_index(cell.get("r", "")) if cell.get("r") else len(row)
                    row.extend([None] * (at + 1 - len(row)))
                    kind, value = cell.get("t", "n"), cell.findtext(f"{MAIN}v")
                    if kind == "inlineStr":
                        inline = cell.find(f"{MAIN}is")
                        row[at] = None if inline is None else _text(inline)
                    elif value is None:
                        continue
                    elif kind == "s":
                        row[at] = shared[int(value)]
                    elif kind == "b":
                        row[at] = "true" if value == "1" else "false"
                    elif kind == "n":
                        row[at] = _number(value, int(cell.get("s", 0)) in date_styles, from_1904)
                    else:
                        row[at] = value
                node.clear()
                if any(value not in (None, "") for value in row):
                    yield row


def decode_workbooks(
    files: DataFrame,
    headers: Sequence[str],
    sheet: str | None = None,
    header_rows: int = 1,
    unreadable: str | None = None,
) -> DataFrame:
    """Rows of workbooks held in a binary `content` column, one text column per header.

    Columns are matched by header within each workbook, in any case; one spelled as asked goes first.
    Headers a workbook lacks are null. With `unreadable`, a column of that name says for every row of such
    a workbook what it lacks and what the row holds, as JSON, and is null for all others.
    """
    wanted = list(headers)
    names = [*wanted, unreadable] if unreadable else wanted

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                rows = sheet_rows(content, sheet)
                found = [next(rows, []) for _ in range(header_rows)][-1]
                folded = [None if h is None else h.lower() for h in found]
                places = [
                    found.index(h) if h in found else folded.index(h.lower()) if h.lower() in folded else None for h in wanted
                ]
                absent = [h for h, p in zip(wanted, places) if p is None]
                pending = []
                for row in rows:
                    values = [row[p] if p is not None and p < len(row) else None for p in places]
                    if unreadable:
                        held = {"lacks": absent, "row": {str(h): v for h, v in zip(found, row)}}
                        values.append(json.dumps(held, ensure_ascii=False) if absent else None)
                    pending.append(values)
                    if len(pending) == ROWS_PER_BATCH:
                        yield pd.DataFrame(pending, columns=names, dtype=object)
                        pending = []
                if pending:
                    yield pd.DataFrame(pending, columns=names, dtype=object)

    schema = T.StructType.fromDDL(", ".join(f"{quoted(h)} string" for h in names))
    return files.select("content").mapInPandas(decode, schema)


def _run_headers(files: DataFrame, sheet: str | None, header_rows: int) -> list[str]:
    """Runs a job that reads the header of every workbook: all names, in the order of the first paths."""

    def headers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                rows = sheet_rows(content, sheet)
                found = [h for h in [next(rows, []) for _ in range(header_rows)][-1] if h]
                yield pd.DataFrame({"path": path, "place": range(len(found)), "name": found})

    named = files.select("path", "content").mapInPandas(headers, "path string, place int, name string")
    first = named.groupBy("name").agg(F.min(F.struct("path", "place")).alias("first"))
    return [row["name"] for row in first.orderBy("first").collect()]


def read_workbooks(
    spark: SparkSession,
    path: str,
    sheet: str | None = None,
    header_rows: int = 1,
    headers: Sequence[str] | None = None,
    unreadable: str | None = None,
) -> DataFrame:
    """All workbooks of a folder, glob or file, whatever the case of their suffix.

    Without `headers` there is a column for every header that any workbook has; with them, `unreadable`
    names a column that tells which rows come from workbooks that lack some.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.[xX][lL][sS][xX]")
    files = reader.load(path)
    if headers is None:
        headers = _run_headers(files, sheet, header_rows)
    return decode_workbooks(files, headers, sheet, header_rows, unreadable)
