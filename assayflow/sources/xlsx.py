"""Spreadsheet source: the cells of .xlsx workbooks as rows.

Workbooks come through Spark's own binaryFile source, so that they may lie wherever Spark reads; executors parse them.  A file that can't be
read gives no cells but a row of ``failures``.  Only the standard library is needed.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import base_name

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def column_index(reference: str) -> int:
    """0 for A, 26 for AA."""
    n = 0
    for letter in re.match(r"[A-Z]+", reference)[0]:
        n = n * 26 + ord(letter) - 64
    return n - 1


def _plain(number: str) -> str:
    try:
        x = float(number)
    except ValueError:
        return number
    return str(int(x)) if x.is_integer() and abs(x) < 1e15 else repr(x)


def workbook_cells(content: bytes, max_rows: int | None = None) -> Iterator[tuple[str, int, int, str, bool]]:
    """(sheet, row, column, value, whether it's text) of every non-empty cell, in order."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        names = set(book.namelist())
        shared: list[str] = []
        if "xl/sharedStrings.xml" in names:
            for item in ElementTree.fromstring(book.read("xl/sharedStrings.xml")).iter(f"{_MAIN}si"):
                shared.append("".join(t.text or "" for t in item.iter(f"{_MAIN}t")))
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
        for sheet in ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{_MAIN}sheet"):
            target = targets[sheet.get(f"{_REL}id")].lstrip("/")
            path = target if target.startswith("xl/") else f"xl/{target}"
            for r, row in enumerate(ElementTree.fromstring(book.read(path)).iter(f"{_MAIN}row")):
                at = int(row.get("r", r + 1)) - 1
                if max_rows is not None and at >= max_rows:
                    break
                for c, cell in enumerate(row.iter(f"{_MAIN}c")):
                    kind, value = cell.get("t"), cell.find(f"{_MAIN}v")
                    if kind == "inlineStr":
                        text, is_text = "".join(t.text or "" for t in cell.iter(f"{_MAIN}t")), True
                    elif value is None or value.text is None:
                        continue
                    elif kind == "s":
                        text, is_text = shared[int(value.text)], True
                    else:
                        text, is_text = (value.text, True) if kind in ("str", "e") else (_plain(value.text), False)
                    yield sheet.get("name"), at, column_index(cell.get("r")) if cell.get("r") else c, text, is_text


def parsed(files: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Cells of a binaryFile DataFrame, and for a file that can't be read one row with its ``error``."""
    columns = ["file_name", "sheet", "row_idx", "col_idx", "value", "is_string", "error"]

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    rows = [(path, *r, None) for r in workbook_cells(bytes(content), max_rows)]
                except Exception as e:  # whatever a broken file leads to is that file's failure
                    rows = [(path, None, None, None, None, None, f"{type(e).__name__}: {e}")]
                out = pd.DataFrame(rows, columns=columns)
                yield out.astype({"row_idx": "Int32", "col_idx": "Int32", "is_string": "boolean"})

    return files.select("path", "content").mapInPandas(parse, "file_name string, sheet string, row_idx int, col_idx int, value string, is_string boolean, error string")


def cells_of(files: DataFrame, max_rows: int | None = None) -> DataFrame:
    return parsed(files, max_rows).where("error is null").drop("error")


def failures(files: DataFrame) -> DataFrame:
    """``file_name, error`` of the files that can't be read."""
    return parsed(files).where("error is not null").select("file_name", "error")


def workbooks(spark: SparkSession, path: str) -> DataFrame:
    """Content of the workbooks below a folder, without locks and hidden files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").option("recursiveFileLookup", True).load(path)
    return files.where(~base_name(F.col("path")).rlike(r"^(~\$|\.)"))


def read(spark: SparkSession, path: str, max_rows: int | None = None, pmid: str | None = None) -> DataFrame:
    """All cells below a path, in the layout of ``schemas.CELLS``."""
    cells = cells_of(workbooks(spark, path), max_rows)
    return cells.select(F.lit(pmid).cast("string").alias("pmid"), base_name(F.col("file_name")).alias("file_name"), F.col("sheet").alias("sheet_name"), "row_idx", "col_idx", "value", "is_string")
