"""Queries: templates made of parts' types and brands."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import templates as T
from ..sources.tables import table
from .registry import query


@query("""WITH s AS (SELECT p_type AS template, 'add' AS key, p_name AS subkey, p_partkey::VARCHAR AS v FROM part UNION ALL SELECT p_brand, 'remove', NULL, p_partkey::VARCHAR FROM part WHERE p_partkey % 3 = 0),
u AS (SELECT template, source, row_number() OVER (PARTITION BY template ORDER BY source) AS pos FROM (SELECT DISTINCT p_brand AS template, p_type AS source FROM part)),
t AS (SELECT template, source, pos FROM u UNION ALL SELECT p_brand, p_brand, 1000000 FROM (SELECT DISTINCT p_brand FROM part) UNION ALL SELECT p_type, p_type, 1000000 FROM (SELECT DISTINCT p_type FROM part))
SELECT t.template, key, subkey, string_agg(v, ',' ORDER BY pos, v) AS vals FROM t JOIN s ON s.template = t.source GROUP BY ALL
UNION ALL SELECT t.template, 'header', NULL, 'row' FROM (SELECT DISTINCT template FROM t) t""")
def template_merge(spark: SparkSession, d: str) -> DataFrame:
    """A template for each type, with its parts by name, and one for each brand, which uses those of its types and removes some parts."""
    part = table(spark, d, "part")
    key = F.array(F.col("p_partkey").cast("string"))
    own = part.select(F.col("p_type").alias("template"), F.lit("add").alias("key"), F.col("p_name").alias("subkey"), key.alias("values"), F.lit(True).alias("many"))
    removed = part.filter("p_partkey % 3 = 0").select(F.col("p_brand").alias("template"), F.lit("remove").alias("key"), F.lit(None).cast("string").alias("subkey"), key.alias("values"), F.lit(True).alias("many"))
    names = part.select(F.col("p_type").alias("template")).union(part.select("p_brand")).distinct()
    heads = names.select("template", F.lit("header").alias("key"), F.lit(None).cast("string").alias("subkey"), F.array(F.lit("row")).alias("values"), F.lit(False).alias("many"))
    stems = own.unionByName(removed).unionByName(heads).withColumn("stem", F.lit("subjects"))
    by_brand = part.groupBy(F.col("p_brand").alias("template")).agg(F.array_sort(F.collect_set("p_type")).alias("types"))
    uses = by_brand.select("template", F.posexplode("types").alias("pos", "used"))
    return T.merged(names, uses, stems)[0].select("template", "key", "subkey", F.array_join("values", ",").alias("vals"))
