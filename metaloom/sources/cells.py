"""Delimited text as cells: file, row, col, value. Encoding and wrong delimiters are reported, not raised."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CELLS = "file string, row bigint, col int, value string, error string"


def decode(content: bytes) -> tuple[str, str | None]:
    """Text and an error: UTF-8, or Latin-1 where it is not valid."""
    try:
        return content.decode("utf-8-sig"), None
    except UnicodeDecodeError as e:
        return content.decode("latin-1"), f"not UTF-8 at byte {e.start}"


def parse(content: bytes, delimiter: str) -> tuple[list[list[str | None]], list[str]]:
    """Rows of cells without wholly empty rows, '' as null; and errors."""
    text, bad = decode(content)
    errors = [bad] if bad else []
    csv.field_size_limit(1 << 31)  # cells may be of any size
    rows = []
    try:
        for r in csv.reader(io.StringIO(text, newline=""), delimiter=delimiter):
            rows.append([c if c != "" else None for c in r])
    except csv.Error as e:
        errors.append(f"row {len(rows) + 1}: {e}")
    kept = [r for r in rows if any(c is not None for c in r)]
    if len(kept) < len(rows):
        errors.append(f"{len(rows) - len(kept)} empty rows")
    other = "\t" if delimiter == "," else ","
    if kept and max(map(len, kept)) == 1 and other in (kept[0][0] or ""):
        errors.append("wrong delimiter")
        return parse(content, other)[0], errors
    return kept, errors


def read_delimited(spark: SparkSession, path: str, pattern: str = "*.[ct]sv") -> DataFrame:
    """Cells of all files under path."""
    return delimited(spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path))


def delimited(files: DataFrame) -> DataFrame:
    """Cells of files (path, content); a row with an error has no cell. Files are read whole, each in one task: sheets are small, there may be many."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for files in batches:
            for file, content in zip(files.path, files.content):
                rows, errors = parse(bytes(content), "\t" if file.endswith(".tsv") else ",")
                out = [(file, i, j, v, None) for i, r in enumerate(rows) for j, v in enumerate(r)] + [(file, None, None, None, e) for e in errors]
                yield pd.DataFrame(out, columns=["file", "row", "col", "value", "error"]).astype({"row": "Int64", "col": "Int32"})

    return files.select("path", "content").mapInPandas(run, CELLS)


def booleans(value):
    """The texts true and false, in any case, as booleans; null for others."""
    return F.when(F.lower(value) == "true", True).when(F.lower(value) == "false", False)


def edit_cells(sheet: DataFrame, edits: DataFrame) -> DataFrame:
    """Cells with the values of edits (file, row, col, new) in their place."""
    return sheet.join(edits, ["file", "row", "col"], "left").withColumn("value", F.coalesce("new", "value")).drop("new")
