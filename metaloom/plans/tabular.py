"""Queries: sheets of cells."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import tabular as T
from ..sources.tables import table
from .registry import query

_COLUMNS = ["p_partkey", "p_name", "p_size"]


def sheet(spark: SparkSession, d: str) -> DataFrame:
    """A sheet for each brand, of its parts."""
    n = table(spark, d, "part")
    return T.cells(n, F.concat(F.lit("sheet"), "p_brand"), _COLUMNS, F.col("p_partkey") + 1)


_S = """s AS (SELECT 'sheet' || p_brand AS file, p_partkey + 1 AS row, c AS col, CASE c WHEN 0 THEN p_partkey::VARCHAR WHEN 1 THEN p_name ELSE p_size::VARCHAR END AS value FROM part, (VALUES (0), (1), (2)) v(c)
UNION ALL SELECT DISTINCT 'sheet' || p_brand, 0, c, ['p_partkey', 'p_name', 'p_size'][c + 1] FROM part, (VALUES (0), (1), (2)) v(c))"""


@query(f"WITH {_S} SELECT file, col::BIGINT AS row, row::INTEGER AS col, value FROM s")
def transpose(spark: SparkSession, d: str) -> DataFrame:
    return T.transpose(T.trim_empty(sheet(spark, d)))


@query(f"WITH {_S} SELECT file, col, CASE value WHEN 'p_name' THEN 'name' ELSE value END AS name, value AS original FROM s WHERE row = 0")
def header_norm(spark: SparkSession, d: str) -> DataFrame:
    return T.headers(sheet(spark, d), {"p_name": "name"})


@query(f"WITH {_S} SELECT file, 'duplicate p_size at R1C2,R1C3' AS message FROM s WHERE row = 0 AND col = 1")
def header_errors(spark: SparkSession, d: str) -> DataFrame:
    """A header in which a name comes twice."""
    cell = (F.col("row") == 0) & (F.col("col") == 1)
    return T.header_errors(sheet(spark, d).withColumn("value", F.when(cell, "p_size").otherwise(F.col("value"))))


@query("SELECT 'sheet' || p_brand AS file, p_partkey::BIGINT + 1 AS row, p_name AS name, p_size::VARCHAR AS region FROM part")
def cells_group(spark: SparkSession, d: str) -> DataFrame:
    s = sheet(spark, d)
    r = T.records(s, T.headers(s))
    return r.select("file", "row", F.col("attrs")["p_name"].alias("name"), F.col("attrs")["p_size"].alias("region"))


@query("SELECT p_partkey::BIGINT + 1 AS row, CASE WHEN p_partkey % 7 = 0 THEN 'ERROR-KEY-' || (p_partkey + 1) ELSE p_size || '_' || p_name END AS k FROM part")
def key_composite(spark: SparkSession, d: str) -> DataFrame:
    hole = (F.col("col") == 1) & (F.col("row") > 0) & ((F.col("row") - 1) % 7 == 0)
    s = sheet(spark, d).withColumn("value", F.when(~hole, F.col("value")))
    return T.records(s, T.headers(s)).select("row", T.composite_key(F.col("attrs"), ["p_size", "p_name"], F.col("row")).alias("k"))


@query("SELECT DISTINCT 'sheet' || p_brand AS file, 'version' AS name, '1.0' AS value FROM part")
def missing_rows(spark: SparkSession, d: str) -> DataFrame:
    s = sheet(spark, d)
    return T.add_missing(s, T.headers(s), {"version": "1.0", "p_name": "none"})


@query("SELECT p_partkey::BIGINT + 1 AS row, p_name AS name, p_partkey::VARCHAR || '/' || p_size AS ids FROM part WHERE p_name <> (SELECT min(p_name) FROM part)")
def records_group(spark: SparkSession, d: str) -> DataFrame:
    """Records in named groups, without an example row."""
    s = sheet(spark, d)
    r = T.records(s, T.headers(s))
    least = table(spark, d, "part").agg(F.min("p_name").alias("m"))
    example = r.join(F.broadcast(least), F.col("attrs")["p_name"] == F.col("m"), "left_semi")
    g = T.group(F.col("attrs"), {"title": ["p_name"]}, "ids")
    kept = T.drop_examples(r, example).select("row", g.alias("g"))
    ids = F.concat_ws("/", F.col("g")["ids"]["p_partkey"], F.col("g")["ids"]["p_size"])
    return kept.select("row", F.col("g")["title"]["p_name"].alias("name"), ids.alias("ids"))
