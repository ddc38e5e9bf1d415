"""Queries: sheets, workbooks, XML, triples and listings made of the tables, written where that is the point, and read back."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import cells, markup, sinks, tree, xlsx
from ..sources.scratch import place
from ..sources.tables import table
from .registry import query

#: Parts in a sheet: more of them make more sheets.
_ROWS = 50


def _sheets(spark: SparkSession, d: str) -> DataFrame:
    """path, rows (sorted array of struct(key, name, size)): a sheet for each fifty parts."""
    part = table(spark, d, "part")
    of = part.groupBy(F.floor(F.col("p_partkey") / _ROWS).alias("n"))
    name = F.when(F.col("p_partkey") % 7 == 0, F.concat("p_name", F.lit(', "'), F.col("p_partkey").cast("string"), F.lit('"\nx'))).otherwise(F.col("p_name"))
    rows = F.array_sort(F.collect_list(F.struct(F.col("p_partkey").alias("key"), name.alias("name"), F.when(F.col("p_size") > 9, F.col("p_size")).alias("size"))))
    return of.agg(rows.alias("rows")).select(F.concat(F.lit("sheet"), F.col("n").cast("string")).alias("path"), "rows")


_SHEET_CELLS = f"""p AS (SELECT 'sheet' || p_partkey // {_ROWS} AS file, p_partkey - min(p_partkey) OVER (PARTITION BY p_partkey // {_ROWS}) + 1 AS row, p_partkey::VARCHAR AS k, CASE WHEN p_partkey % 7 = 0 THEN p_name || ', "' || p_partkey || '"' || chr(10) || 'x' ELSE p_name END AS n, CASE WHEN p_size > 9 THEN p_size::VARCHAR END AS s FROM part),
c AS (SELECT file, row, 0 AS col, k AS value FROM p UNION ALL SELECT file, row, 1, n FROM p UNION ALL SELECT file, row, 2, s FROM p UNION ALL SELECT DISTINCT file, 0, v.* FROM p, (VALUES (0, 'key'), (1, 'the name'), (2, 'size')) v(col, value))"""


@query(f"WITH {_SHEET_CELLS} SELECT file || '.' || CASE WHEN replace(file, 'sheet', '')::INT % 2 = 0 THEN 'csv' ELSE 'tsv' END AS file, row, col, value FROM c UNION ALL SELECT DISTINCT file || '.' || CASE WHEN replace(file, 'sheet', '')::INT % 2 = 0 THEN 'csv' ELSE 'tsv' END, NULL, NULL, 'error: 1 empty rows' FROM p")
def delimited_cells(spark: SparkSession, d: str) -> DataFrame:
    """Sheets at commas and at tabs, with quotes and lines in cells, and an empty row at the end that is reported."""
    s = _sheets(spark, d).withColumn("comma", F.regexp_replace("path", "sheet", "").cast("int") % 2 == 0)
    by = F.when(F.col("comma"), ",").otherwise("\t")
    quoted = lambda x: F.concat(F.lit('"'), F.replace(x, F.lit('"'), F.lit('""')), F.lit('"'))
    line = F.transform("rows", lambda r: F.concat(r["key"].cast("string"), by, quoted(r["name"]), by, F.coalesce(r["size"].cast("string"), F.lit(""))))
    text = F.concat(F.concat_ws("\n", F.concat(F.lit("﻿key"), by, F.lit("the name"), by, F.lit("size")), F.array_join(line, "\n")), F.lit("\n"), by, F.lit("\n"))
    files = s.select(F.concat("path", F.when(F.col("comma"), ".csv").otherwise(".tsv")).alias("path"), F.encode(text, "UTF-8").alias("content"))
    out = cells.delimited(files)
    return out.select("file", "row", "col", F.coalesce("value", F.concat(F.lit("error: "), "error")).alias("value"))


def _workbook(rows: pd.Series) -> pd.Series:
    """A workbook of each list of rows: names shared or inline, in turn."""
    from xml.sax.saxutils import escape

    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"

    def one(some) -> bytes:
        texts = ["key", "the name", "size"] + [r["name"] for r in some[::2]]
        lines = ['<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c><c r="C1" t="s"><v>2</v></c></row>']
        for k, r in enumerate(some):
            name = f'<c r="B{k + 2}" t="s"><v>{3 + k // 2}</v></c>' if k % 2 == 0 else f'<c r="B{k + 2}" t="inlineStr"><is><t xml:space="preserve">{escape(r["name"])}</t></is></c>'
            size = f'<c r="C{k + 2}"><v>{int(r["size"])}</v></c>' if r["size"] is not None and r["size"] == r["size"] else ""
            lines.append(f'<row r="{k + 2}"><c r="A{k + 2}"><v>{r["key"]}</v></c>{name}{size}</row>')
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
            book.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}">' + "".join(f'<si><t xml:space="preserve">{escape(t)}</t></si>' for t in texts) + "</sst>")
            book.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{main}"><sheetData>{"".join(lines)}</sheetData></worksheet>')
        return out.getvalue()

    return rows.map(one)


@query(f"WITH {_SHEET_CELLS} SELECT file || '.xlsx' AS file, row, col, value FROM c WHERE value IS NOT NULL")
def workbook_cells(spark: SparkSession, d: str) -> DataFrame:
    files = _sheets(spark, d).select(F.concat("path", F.lit(".xlsx")).alias("path"), F.pandas_udf(_workbook, "binary")("rows").alias("content"))
    return xlsx.workbooks(files).filter("error IS NULL").select("file", "row", "col", "value")


@query(f"WITH {_SHEET_CELLS} SELECT file || '.csv' AS file, row, col, CASE WHEN col = 2 AND value = '10' THEN 'ten' ELSE value END AS value FROM c")
def cell_edits(spark: SparkSession, d: str) -> DataFrame:
    """Sheets with the values of some cells put in place of what they held."""
    part = table(spark, d, "part")
    sheet = delimited_cells(spark, d).filter("row IS NOT NULL").withColumn("file", F.regexp_replace("file", "tsv$", "csv"))
    file = F.concat(F.lit("sheet"), F.floor(F.col("p_partkey") / _ROWS).cast("string"), F.lit(".csv"))
    edits = part.filter("p_size = 10").select(file.alias("file"), (F.col("p_partkey") % _ROWS + 1).alias("row"), F.lit(2).alias("col"), F.lit("ten").alias("new"))
    return cells.edit_cells(sheet, edits)


@query("""SELECT 'c' || c_custkey || '.xml' AS file, CASE c_custkey % 4 WHEN 0 THEN 'mbf' WHEN 1 THEN 'cgw' WHEN 2 THEN 'generic' END AS dialect, c_custkey % 4 = 3 AS bad, CASE WHEN c_custkey % 4 = 0 THEN c_name END AS subject, CASE WHEN c_custkey % 4 = 0 AND c_nationkey > 3 THEN 'organ ' || c_nationkey END AS organ,
CASE WHEN c_custkey % 4 = 0 THEN CASE WHEN c_mktsegment < 'axon' THEN c_mktsegment || '|axon' ELSE 'axon|' || c_mktsegment END END AS contours FROM customer""")
def xml_dialects(spark: SparkSession, d: str) -> DataFrame:
    """Documents of customers: tracings, another dialect, one that is unknown, and some that are no XML."""
    k = F.col("c_custkey")
    organ = F.when(F.col("c_nationkey") > 3, F.concat(F.lit(' organ="organ '), F.col("c_nationkey").cast("string"), F.lit('"'))).otherwise("")
    contours = F.concat(F.lit('<contour name="'), "c_mktsegment", F.lit('"/><contour name="axon" id="'), k.cast("string"), F.lit('"/><contour name="axon" id="x"/>'))
    tracing = F.concat(F.lit('<mbf xmlns="http://example.org/m"><data><subject subjectid="'), "c_name", F.lit('" species="rat"/><atlas'), organ, F.lit("/></data>"), contours, F.lit("</mbf>"))
    text = F.when(k % 4 == 0, tracing).when(k % 4 == 1, "<CGW/>").when(k % 4 == 2, "<something><mbf/></something>").otherwise("<mbf><data></mbf>")
    found = markup.xml_metadata(table(spark, d, "customer").select(F.concat(F.lit("c"), k.cast("string"), F.lit(".xml")).alias("path"), F.encode(text, "UTF-8").alias("content")))
    return found.select("file", "dialect", F.col("error").isNotNull().alias("bad"), F.col("meta.subject.id").alias("subject"), F.col("meta.atlas.organ").alias("organ"), F.array_join("meta.contours", "|").alias("contours"))


_TRIPLES = """t AS (SELECT 'http://x/c/' || c_custkey AS s, 'http://x/name' AS p, c_name || CASE WHEN c_custkey % 3 = 0 THEN ' "' || c_mktsegment || '"' || chr(10) || chr(92) ELSE '' END AS o, 'literal' AS o_kind FROM customer
UNION ALL SELECT 'http://x/c/' || c_custkey, 'http://x/nation', 'http://x/n/' || c_nationkey, 'iri' FROM customer UNION ALL SELECT '_:b' || c_custkey, 'http://x/of', '_:n' || c_nationkey, 'blank' FROM customer)"""


@query(f"WITH {_TRIPLES} SELECT s, p, o, o_kind FROM t")
def ntriples_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Triples of customers, written as text and read again, with quotes, lines and backslashes in literals."""
    c = table(spark, d, "customer")
    key, nation = F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string")
    name = F.when(F.col("c_custkey") % 3 == 0, F.concat("c_name", F.lit(' "'), "c_mktsegment", F.lit('"\n\\'))).otherwise(F.col("c_name"))
    one = lambda s, p, o, kind: c.select(s.alias("s"), F.lit(p).alias("p"), o.alias("o"), F.lit(kind).alias("o_kind"))
    subject = F.concat(F.lit("http://x/c/"), key)
    triples = one(subject, "http://x/name", name, "literal").unionByName(one(subject, "http://x/nation", F.concat(F.lit("http://x/n/"), nation), "iri")).unionByName(one(F.concat(F.lit("_:b"), key), "http://x/of", F.concat(F.lit("_:n"), nation), "blank"))
    path = place(spark, "triples")
    sinks.ntriples(triples).write.text(path)
    return markup.read_ntriples(spark, path).select("s", "p", "o", "o_kind")


@query("SELECT s_suppkey, s_name, CASE WHEN s_acctbal >= 0 THEN s_acctbal END AS s_acctbal FROM supplier")
def json_round_trip(spark: SparkSession, d: str) -> DataFrame:
    path = place(spark, "json")
    rows = table(spark, d, "supplier").select("s_suppkey", "s_name", F.when(F.col("s_acctbal") >= 0, F.col("s_acctbal")).alias("s_acctbal"))
    sinks.write_json(rows, path)
    return spark.read.schema(rows.schema).json(path)


@query("""SELECT '{"@context":{"name": "http://x/name"},"@id":"s' || s_suppkey || '","@type":"Supplier","name":"' || s_name || '"}' AS value FROM supplier""")
def json_ld_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "supplier").select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("id"), F.col("s_name").alias("name"))
    return sinks.json_ld(rows, {"name": "http://x/name"}, "id", "Supplier")


@query("SELECT p_partkey, p_name || ' x' AS note, p_brand || ',' || p_type AS tags FROM part")
def tsv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Lists at commas, tabs and line ends as spaces, read back by Spark's reader."""
    path = place(spark, "tsv")
    rows = table(spark, d, "part").select("p_partkey", F.concat("p_name", F.when(F.col("p_partkey") % 2 == 0, "\t").otherwise("\n"), F.lit("x")).alias("note"), F.array("p_brand", "p_type").alias("tags"))
    sinks.write_tsv(rows, path)
    return spark.read.option("sep", "\t").option("header", True).schema("p_partkey bigint, note string, tags string").csv(path)


@query("SELECT n_nationkey AS k, n_name AS name, count(c_custkey) AS n FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL")
def xml_round_trip(spark: SparkSession, d: str) -> DataFrame:
    path = place(spark, "xml")
    c = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("n"))
    rows = table(spark, d, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name")).join(c, "k", "left").fillna(0, ["n"])
    sinks.write_xml(rows, path)
    return spark.read.format("xml").option("rowTag", "record").schema(rows.schema).load(path)


@query("SELECT p_brand AS brand, '.parquet' AS suffix, 1::BIGINT AS n, true AS some FROM part GROUP BY ALL")
def folder_listing(spark: SparkSession, d: str) -> DataFrame:
    """Files by folder and suffix, of parts written in a folder a brand."""
    path = place(spark, "parts")
    table(spark, d, "part").withColumn("brand", F.col("p_brand")).repartition("brand").write.partitionBy("brand").parquet(path)
    files = tree.listing(spark, path, r"/_").withColumn("brand", F.url_decode(F.regexp_extract("path", "/brand=([^/]+)/", 1)))
    return files.groupBy("brand", "suffix").agg(F.count("*").alias("n"), (F.sum("size") > 0).alias("some")).withColumn("brand", F.regexp_replace(F.replace("brand", F.lit("%23"), F.lit("#")), "%2523", "#"))
