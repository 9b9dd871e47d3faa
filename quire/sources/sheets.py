"""Spreadsheet sources: one page for each sheet of an .xlsx or .xlsm file, from its XML."""

from __future__ import annotations

import io
import re
import zipfile
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHEET = "array<struct<name:string,rows:array<array<string>>>>"
REFERENCE = re.compile(r"([A-Z]+)(\d+)")


def _tag(node) -> str:
    return node.tag.rpartition("}")[2]


def _column(letters: str) -> int:
    n = 0
    for c in letters:
        n = n * 26 + ord(c) - 64
    return n - 1


def _place(reference: str) -> tuple[int, int]:
    letters, digits = REFERENCE.fullmatch(reference).groups()
    return int(digits) - 1, _column(letters)


def _value(cell, shared: list[str]) -> str:
    kind = cell.get("t")
    if kind == "inlineStr":
        return "".join(t.text or "" for t in cell.iter() if _tag(t) == "t").strip()
    raw = next((v.text or "" for v in cell if _tag(v) == "v"), "")
    if kind == "s":
        return shared[int(raw)].strip()
    if kind == "b":
        return "True" if raw == "1" else "False"
    if kind is None and re.fullmatch(r"-?\d+\.0+", raw):
        raw = raw.partition(".")[0]
    return raw.strip()


def sheets(content: bytes) -> list[dict]:
    """Name and rows of each sheet: merged ranges carry their first value, empty rows are dropped."""
    if not content.startswith(b"PK"):
        raise ValueError("not an .xlsx workbook; the older .xls format can't be read")
    book = zipfile.ZipFile(io.BytesIO(content))
    names = set(book.namelist())
    shared: list[str] = []
    if "xl/sharedStrings.xml" in names:
        for item in ElementTree.fromstring(book.read("xl/sharedStrings.xml")):
            shared.append("".join(t.text or "" for t in item.iter() if _tag(t) == "t"))
    targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
    out = []
    for sheet in (s for s in ElementTree.fromstring(book.read("xl/workbook.xml")).iter() if _tag(s) == "sheet"):
        target = targets[next(v for k, v in sheet.attrib.items() if k.endswith("}id"))].lstrip("/")
        root = ElementTree.fromstring(book.read(target if target.startswith("xl/") else f"xl/{target}"))
        grid: dict[tuple[int, int], str] = {}
        for cell in (c for c in root.iter() if _tag(c) == "c"):
            grid[_place(cell.get("r"))] = _value(cell, shared)
        for merge in (m for m in root.iter() if _tag(m) == "mergeCell"):
            (top, left), (bottom, right) = map(_place, merge.get("ref").split(":"))
            grid |= {(r, c): grid.get((top, left), "") for r in range(top, bottom + 1) for c in range(left, right + 1)}
        width, height = (max((p[k] for p in grid), default=-1) + 1 for k in (1, 0))
        rows = [[grid.get((r, c), "") for c in range(width)] for r in range(height)]
        out.append({"name": sheet.get("name"), "rows": [r for r in rows if any(r)]})
    return out


def readable(content: bytes) -> list[dict] | None:
    """The sheets, or None for what isn't a workbook."""
    try:
        return sheets(content)
    except (ValueError, KeyError, IndexError, StopIteration, zipfile.BadZipFile, ElementTree.ParseError):
        return None


# Size of a drawn cell in pixels, and how much of its text is drawn.
CELL_WIDTH, CELL_HEIGHT, CELL_CHARS = 200, 40, 24


def sheet_grid(pages: DataFrame) -> DataFrame:
    """source_path, page_number, row, col, x0, y0, x1, y1, text: how a sheet is drawn, its header row first."""
    rows = F.concat(F.array("headers"), "rows")
    cells = pages.select("source_path", "page_number", F.posexplode(rows).alias("row", "cells")).select("source_path", "page_number", "row", F.posexplode("cells").alias("col", "value"))
    x, y = F.col("col") * CELL_WIDTH, F.col("row") * CELL_HEIGHT
    return cells.select("source_path", "page_number", "row", "col", x.alias("x0"), y.alias("y0"), (x + CELL_WIDTH).alias("x1"), (y + CELL_HEIGHT).alias("y1"), F.substring("value", 1, CELL_CHARS).alias("text"))


def workbook(content: Column) -> Column:
    @F.pandas_udf(SHEET)
    def run(contents: pd.Series) -> pd.Series:
        return contents.map(lambda c: None if c is None else readable(bytes(c)))

    return run(content)


def sheet_pages(files: DataFrame) -> DataFrame:
    """source_path, page_number, sheet, headers, rows, markdown, native_text, a row for each sheet."""
    from quire.operators.tables import build_markdown

    pages = files.select("source_path", F.posexplode(workbook(F.col("content"))).alias("at", "sheet"))
    rows = F.col("sheet.rows")
    headers = F.coalesce(F.get(rows, F.lit(0)), F.array().cast("array<string>"))
    data = F.when(F.size(rows) > 1, F.slice(rows, 2, F.greatest(F.size(rows) - 1, F.lit(1)))).otherwise(F.array().cast("array<array<string>>"))
    text = F.array_join(F.filter(F.flatten(rows), lambda v: v != ""), "\n")
    return pages.select("source_path", (F.col("at") + 1).alias("page_number"), F.col("sheet.name").alias("sheet"), headers.alias("headers"), data.alias("rows"), build_markdown(headers, data).alias("markdown"), text.alias("native_text"))
