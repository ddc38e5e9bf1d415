"""Queries: cells' values normalised by column, and the errors of those that can't be."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cellvalues as C
from ..operators import tabular as T
from ..sources.tables import table
from .registry import query

_HEADER = ["Subject Id", "Sex", "Age", "Weight (kg)", "RRID for strain", "Protocol URL or DOI", "Also in dataset"]


def subject_sheet(spark: SparkSession, d: str) -> DataFrame:
    """A sheet for each brand, of its parts as subjects; some cells are empty, some can't be read."""
    k = F.col("p_partkey")
    key = k.cast("string")
    size = F.col("p_size").cast("string")
    columns = [
        F.concat(F.lit("sub-"), key),
        F.when(k % 9 == 0, "n/a").when(k % 2 == 0, "F").otherwise("Male"),
        F.when(k % 10 == 0, "adult").when(k % 10 == 1, "about ten").when(k % 10 == 2, F.concat(F.lit("~"), size, F.lit(" wk"))).when(k % 10 == 3, F.concat(F.lit("3-"), size, F.lit("weeks"))).otherwise(F.concat(size, F.lit(" days"))),
        F.when(k % 8 == 0, "").when(k % 8 == 1, "unknown").when(k % 8 == 2, "heavy").otherwise(size),
        F.when(k % 6 == 0, F.concat(F.lit("RRID: RGD_"), key)).when(k % 6 == 1, "unknown").when(k % 6 == 2, "no strain").otherwise(F.concat(F.lit("MGI:"), key)),
        F.when(k % 4 == 0, F.concat(F.lit("https://doi.org/10.1234/AB"), key, F.lit(", https://example.org/p"))).when(k % 4 == 1, F.concat(F.lit("doi:11.5/"), key, F.lit(",10.1234/x"))).when(k % 4 == 2, "").otherwise(" "),
        F.when(k % 5 == 0, F.concat(F.lit("N:1 N:"), key)).when(k % 5 == 1, F.concat(F.lit("a"), key, F.lit(", b"))),
    ]
    names = [c.lower() for c in "abcdefg"]
    rows = table(spark, d, "part").select("p_partkey", "p_brand", *(c.alias(n) for c, n in zip(columns, names)))
    sheet = T.cells(rows, F.concat(F.lit("subjects/"), "p_brand"), names, F.col("p_partkey") + 1)
    titles = F.array(*map(F.lit, _HEADER))
    return sheet.withColumn("value", F.when(F.col("row") == 0, F.get(titles, F.col("col"))).otherwise(F.col("value")))


def subject_values(spark: SparkSession, d: str, transposed: bool = False) -> DataFrame:
    sheet = subject_sheet(spark, d)
    return C.normalised(C.named(sheet, T.headers(sheet)), "subjects", transposed)


_PARTS = "p AS (SELECT p_partkey AS k, 'subjects/' || p_brand AS file, p_partkey::BIGINT + 1 AS row, p_partkey::VARCHAR AS t, p_size::VARCHAR AS s FROM part)"
_VALUES = f"""{_PARTS},
v AS (SELECT file, row, 'subject_id' AS name, ['sub-' || t] AS vals FROM p
UNION ALL SELECT file, row, 'sex', [CASE WHEN k % 2 = 0 THEN 'female' ELSE 'male' END] FROM p WHERE k % 9 <> 0
UNION ALL SELECT file, row, 'age', [CASE k % 10 WHEN 0 THEN 'adult' WHEN 1 THEN 'about ten' WHEN 2 THEN '~' || s || ' week' WHEN 3 THEN '3-' || s || ' week' ELSE s || ' day' END] FROM p
UNION ALL SELECT file, row, 'weight_kg', [CASE k % 8 WHEN 1 THEN 'UNKNOWN' WHEN 2 THEN 'heavy' ELSE s || ' kg' END] FROM p WHERE k % 8 <> 0
UNION ALL SELECT file, row, 'rrid_for_strain', [CASE k % 6 WHEN 0 THEN 'RRID:RGD_' || t WHEN 1 THEN 'UNKNOWN' WHEN 2 THEN 'no strain' ELSE 'RRID:MGI:' || t END] FROM p
UNION ALL SELECT file, row, 'protocol_url_or_doi', CASE k % 4 WHEN 0 THEN ['doi:10.1234/ab' || t, 'https://example.org/p'] WHEN 1 THEN ['doi:10.1234/x'] ELSE [] END FROM p WHERE k % 4 <> 2
UNION ALL SELECT file, row, 'also_in_dataset', CASE k % 5 WHEN 0 THEN ['1', t] ELSE ['a' || t, 'b'] END FROM p WHERE k % 5 < 2)"""
_ERRORS = f"""{_PARTS},
e AS (SELECT file, row, t, 3 AS col, 'Age' AS title, 'age' AS name, 'value belongs in age_category: adult' AS message, 'submission' AS blame FROM p WHERE k % 10 = 0
UNION ALL SELECT file, row, t, 3, 'Age', 'age', 'no quantity: about ten', 'pipeline' FROM p WHERE k % 10 = 1
UNION ALL SELECT file, row, t, 4, 'Weight (kg)', 'weight_kg', 'no quantity: heavy', 'pipeline' FROM p WHERE k % 8 = 2
UNION ALL SELECT file, row, t, 5, 'RRID for strain', 'rrid_for_strain', 'malformed RRID: no strain', 'submission' FROM p WHERE k % 6 = 2
UNION ALL SELECT file, row, t, 6, 'Protocol URL or DOI', 'protocol_url_or_doi', 'malformed DOI: doi:11.5/' || t, 'submission' FROM p WHERE k % 4 = 1
UNION ALL SELECT file, row, t, 7, 'Also in dataset', 'also_in_dataset', 'comma in list: a' || t || ', b', 'submission' FROM p WHERE k % 5 = 1)"""


@query(f"WITH {_VALUES} SELECT file, row, name, coalesce(array_to_string(vals, '\x1f'), '') AS vals FROM v")
def cell_values(spark: SparkSession, d: str) -> DataFrame:
    return subject_values(spark, d).select("file", "row", "name", F.array_join("values", "\x1f").alias("vals"))


@query(f"WITH {_ERRORS} SELECT message, blame, 'subjects.' || name AS stage, file, row + 1 AS row, col::BIGINT AS col, 'Problem with tabular cell :at R' || (row + 1) || 'C' || col || ' \"sub-' || t || '\" \"' || title || '\" :issue ' || message || ' :in ' || file AS text FROM e")
def cell_errors(spark: SparkSession, d: str) -> DataFrame:
    return C.cell_errors(subject_values(spark, d)).drop("row_name", "col_name")


@query(f"WITH {_ERRORS} SELECT file, col::BIGINT AS row, row + 1 AS col, title AS row_name, 'sub-' || t AS col_name, message FROM e")
def cell_errors_transposed(spark: SparkSession, d: str) -> DataFrame:
    """The same sheets, read as if their header were a column: addresses are those of the sheet as it lies."""
    return C.cell_errors(subject_values(spark, d, transposed=True)).select("file", "row", "col", "row_name", "col_name", "message")


@query(f"WITH {_VALUES} SELECT file, row, string_agg(name || '=' || array_to_string(vals, '|'), ';' ORDER BY name) FILTER (len(vals) > 1 OR name NOT IN ('sex', 'age', 'weight_kg')) AS many, string_agg(name || '=' || vals[1], ';' ORDER BY name) FILTER (len(vals) = 1 AND name IN ('sex', 'age', 'weight_kg')) AS one FROM v WHERE len(vals) > 0 AND name <> 'subject_id' GROUP BY ALL")
def value_records(spark: SparkSession, d: str) -> DataFrame:
    """Records of values, without the column that held their keys; single columns are unwrapped."""
    r = C.value_records(subject_values(spark, d), ["sex", "age", "weight_kg"], ["subject_id"])
    text = lambda m, f: F.array_join(F.transform(F.array_sort(F.map_entries(m)), lambda p: F.concat(p["key"], F.lit("="), f(p["value"]))), ";")
    some = lambda c: F.when(c != "", c)
    return r.select("file", "row", some(text("attrs", lambda v: F.array_join(v, "|"))).alias("many"), some(text("one", lambda v: v)).alias("one"))


_CURATION = ["Metadata element", "Organ", "Note"]


@query("SELECT 'curation/' || c_mktsegment AS file, c_custkey::BIGINT + 1 AS row, 'organ' AS name, CASE WHEN c_custkey % 3 = 0 THEN 'UBERON:' || c_nationkey ELSE 'organ ' || c_nationkey END AS v FROM customer WHERE c_custkey % 11 > 1")
def ignored_cells(spark: SparkSession, d: str) -> DataFrame:
    """Curation sheets made of customers: the first column and the rows of notes are left out."""
    k, nation = F.col("c_custkey"), F.col("c_nationkey").cast("string")
    a = F.when(k % 11 == 0, "Curator notes").when(k % 11 == 1, "Controlled fields").otherwise(F.concat(F.lit("row "), k.cast("string")))
    b = F.when(k % 3 == 0, F.concat(F.lit("an organ | UBERON:"), nation)).otherwise(F.concat(F.lit("organ "), nation))
    rows = table(spark, d, "customer").select("c_custkey", "c_mktsegment", a.alias("a"), b.alias("b"), F.lit("").alias("c"))
    sheet = T.cells(rows, F.concat(F.lit("curation/"), "c_mktsegment"), ["a", "b", "c"], k + 1)
    sheet = sheet.withColumn("value", F.when(F.col("row") == 0, F.get(F.array(*map(F.lit, _CURATION)), F.col("col"))).otherwise(F.col("value")))
    out = C.normalised(C.named(sheet, T.headers(sheet)), "curation")
    return out.select("file", "row", "name", F.array_join("values", "|").alias("v"))
