"""Queries: customers' orders as tracing files, told as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import tracings
from ..sources.tables import table
from .registry import query


@query("""WITH o AS (SELECT 'c' || o_custkey || '.xml' AS file, o_orderkey AS k, o_orderstatus AS s, o_orderpriority AS p FROM orders)
SELECT file, section, item FROM (SELECT DISTINCT file, 'contours' AS section, '{' || CASE WHEN k % 2 = 0 THEN '"id_ontology":"' || p || '",' ELSE '' END || '"name":"' || s || '"}' AS item FROM o
UNION SELECT DISTINCT file, 'trees', '{"entity_type":"' || p || '"}' FROM o UNION SELECT DISTINCT file, 'meta', '{"appname":"loom"}' FROM o) x
UNION ALL SELECT file, 'images', '{"channels":"' || k || '","path_mbf":["' || s || '"]}' FROM o UNION ALL SELECT file, 'channels', '{"id":"' || k || '"}' FROM o""")
def tracing_items(spark: SparkSession, d: str) -> DataFrame:
    """A tracing for each customer: orders as contours with their own guids, as trees full of points, and as images; equal contours and trees are told once."""
    k, s, p = F.col("o_orderkey").cast("string"), F.col("o_orderstatus"), F.col("o_orderpriority")
    association = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit('<property name="TraceAssociation"><s>'), p, F.lit("</s></property>"))).otherwise("")
    contour = F.concat(F.lit('<contour name="'), s, F.lit('"><property name="GUID"><s>'), k, F.lit("</s></property>"), association, F.lit('<point x="1"/></contour>'))
    tree = F.concat(F.lit('<tree type="'), p, F.lit('"><point x="2"/><branch><point x="3"/></branch></tree>'))
    image = F.concat(F.lit("<images><image><filename>"), s, F.lit('</filename><channels><channel id="'), k, F.lit('"/></channels></image></images>'))
    text = F.concat(F.lit('<mbf xmlns="http://www.mbfbioscience.com" appname="loom"><sparcdata><subject/></sparcdata>'), F.array_join(F.collect_list(F.concat(contour, tree, image)), ""), F.lit("</mbf>"))
    files = table(spark, d, "orders").groupBy("o_custkey").agg(F.encode(text, "UTF-8").alias("content")).select(F.concat(F.lit("c"), F.col("o_custkey").cast("string"), F.lit(".xml")).alias("path"), "content")
    return tracings.condensed(tracings.items(files))
