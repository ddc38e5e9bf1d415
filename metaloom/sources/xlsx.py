"""Workbooks as cells, from the zipped XML itself. Dates come out as ISO days, links instead of their labels."""

from __future__ import annotations

import datetime
import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree as X

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from .cells import CELLS

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
#: The built-in number formats that are dates.
_DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}


def _column(reference: str) -> int:
    n = 0
    for c in re.match("[A-Z]+", reference)[0]:
        n = 26 * n + ord(c) - 64
    return n - 1


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = X.fromstring(book.read("xl/styles.xml"))
    own = {int(f.get("numFmtId")) for f in root.iter(f"{_MAIN}numFmt") if re.search("[ymdh]", re.sub(r'"[^"]*"|\[[^\]]*\]', "", f.get("formatCode", "")).lower())}
    cells = root.find(f"{_MAIN}cellXfs")
    return {i for i, f in enumerate(cells if cells is not None else []) if int(f.get("numFmtId", 0)) in _DATE_FORMATS | own}


def _first_sheet(book: zipfile.ZipFile) -> str:
    """The part of the first sheet in the workbook's order; by the number in its name where the workbook doesn't tell."""
    names = book.namelist()
    if {"xl/workbook.xml", "xl/_rels/workbook.xml.rels"} <= set(names):
        targets = {r.get("Id"): r.get("Target") for r in X.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
        for s in X.fromstring(book.read("xl/workbook.xml")).iter(f"{_MAIN}sheet"):
            target = (targets.get(s.get(f"{_REL}id")) or "").removeprefix("/xl/")
            if (name := f"xl/{target}") in names and target.startswith("worksheets/"):
                return name
    found = [(int(m[1]), n) for n in names if (m := re.fullmatch(r"xl/worksheets/sheet(\d+)\.xml", n))]
    return min(found)[1]


def parse(content: bytes) -> list[tuple[int, int, str]]:
    """Row, column and text of each cell of the first sheet that has a value; trailing empty rows and columns don't exist then."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        names = book.namelist()
        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in s.iter(f"{_MAIN}t")) for s in X.fromstring(book.read("xl/sharedStrings.xml"))]
        dates = _date_styles(book)
        sheet = _first_sheet(book)
        root = X.fromstring(book.read(sheet))
        rels = sheet.replace("worksheets/", "worksheets/_rels/") + ".rels"
        targets = {r.get("Id"): r.get("Target") for r in X.fromstring(book.read(rels))} if rels in names else {}
        links = {h.get("ref"): targets.get(h.get(f"{_REL}id")) for h in root.iter(f"{_MAIN}hyperlink")}
        out = []
        for cell in root.iter(f"{_MAIN}c"):
            at, kind = cell.get("r"), cell.get("t", "n")
            value = cell.findtext(f"{_MAIN}v")
            if kind == "inlineStr":
                value = "".join(t.text or "" for t in cell.iter(f"{_MAIN}t"))
            elif kind == "s" and value is not None:
                value = shared[int(value)]
            elif kind == "b" and value is not None:
                value = "true" if value == "1" else "false"
            elif kind == "n" and value is not None and int(cell.get("s", 0)) in dates:
                value = str((datetime.datetime(1899, 12, 30) + datetime.timedelta(days=float(value))).date())
            value = links.get(at) or value
            if value not in (None, ""):
                out.append((int(re.search(r"\d+", at)[0]) - 1, _column(at), value))
        return out


def read_xlsx(spark: SparkSession, path: str) -> DataFrame:
    """Cells of all workbooks under path."""
    return workbooks(spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").option("recursiveFileLookup", "true").load(path))


def workbooks(files: DataFrame) -> DataFrame:
    """Cells of workbooks (path, content); a file that is none gives an error row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for files in batches:
            for file, content in zip(files.path, files.content):
                try:
                    out = [(file, r, c, v, None) for r, c, v in parse(bytes(content))]
                except (zipfile.BadZipFile, X.ParseError, IndexError, KeyError, ValueError, OverflowError, NotImplementedError) as e:
                    out = [(file, None, None, None, f"not a workbook: {e}")]
                yield pd.DataFrame(out, columns=["file", "row", "col", "value", "error"]).astype({"row": "Int64", "col": "Int32"})

    return files.select("path", "content").mapInPandas(run, CELLS)
