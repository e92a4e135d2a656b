"""Test helper: packs rows of a DataFrame into small Excel workbooks, as bytes, inside tasks."""

from __future__ import annotations

import io
import sys
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pandas as pd
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark import cloudpickle
from pyspark.sql import DataFrame

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
_RELATIONS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006/relationships"


def _cell(value) -> str:
    if value is None or value != value:
        return "<c/>"
    if isinstance(value, str):
        return f'<c t="inlineStr"><is><t>{escape(value)}</t></is></c>'
    return f"<c><v>{value}</v></c>"


def workbook_bytes(rows: list[list], sheet: str = "Worksheet") -> bytes:
    """A minimal workbook; texts become text cells, numbers numeric cells, None empty cells."""
    lines = "".join(f"<row>{''.join(_cell(v) for v in row)}</row>" for row in rows)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        book.writestr(
            "xl/workbook.xml",
            f'<workbook {_MAIN} xmlns:r="{_RELATIONS}"><sheets>'
            f'<sheet name="Other" sheetId="1" r:id="rId1"/><sheet name="{escape(sheet)}" sheetId="2" r:id="rId2"/>'
            "</sheets></workbook>",
        )
        book.writestr(
            "xl/_rels/workbook.xml.rels",
            f'<Relationships xmlns="{_PACKAGE}">'
            f'<Relationship Id="rId1" Type="{_RELATIONS}/worksheet" Target="worksheets/sheet1.xml"/>'
            f'<Relationship Id="rId2" Type="{_RELATIONS}/worksheet" Target="worksheets/sheet2.xml"/>'
            "</Relationships>",
        )
        book.writestr("xl/worksheets/sheet1.xml", f"<worksheet {_MAIN}><sheetData/></worksheet>")
        book.writestr("xl/worksheets/sheet2.xml", f"<worksheet {_MAIN}><sheetData>{lines}</sheetData></worksheet>")
    return out.getvalue()


def as_workbooks(df: DataFrame) -> DataFrame:
    """One workbook per Arrow batch, so their size is bounded and nothing is shuffled."""
    headers = df.columns

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = batch.astype(object).where(batch.notna(), None).values.tolist()
            yield pd.DataFrame({"content": [workbook_bytes([headers, *rows])]})

    return df.mapInPandas(pack, "content binary")


def write_workbooks(books: DataFrame, folder: str) -> None:
    """Runs a job that writes each workbook of a `content` column as a file, in the tasks that made them.

    Every other one has its suffix in capitals, as feeds do.
    """
    target = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, number = TaskContext.get().partitionId(), 0
        system, path = FileSystem.from_uri(target.replace("file:/", "file:///") if "://" not in target else target)
        system.create_dir(path, recursive=True)
        for batch in batches:
            for content in batch["content"]:
                suffix = "xlsx" if (part + number) % 2 else "XLSX"
                with system.open_output_stream(f"{path}/part-{part:05d}-{number}.{suffix}") as out:
                    out.write(bytes(content))
                number += 1
        yield pd.DataFrame({"written": [number]})

    books.mapInPandas(write, "written long").agg({"written": "sum"}).collect()
