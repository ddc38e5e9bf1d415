"""Queries: conversations and order lines as graphs: components, reduction, merged orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import orders as O
from ..sources.tables import table
from .registry import query

_NODE = "conv_id || '/' || turn"


def _turns(spark: SparkSession, d: str) -> DataFrame:
    """Each turn with the next one, and each turn divisible by 3 with the turn two and three after it."""
    c = table(spark, d, "conversations").select("conv_id", "turn").distinct()
    step = c.withColumn("by", F.explode(F.when(F.col("turn") % 3 == 0, F.array(F.lit(1), F.lit(2), F.lit(3))).otherwise(F.array(F.lit(1)))))
    known = c.select("conv_id", F.col("turn").alias("to"))
    return step.withColumn("to", F.col("turn") + F.col("by")).join(known, ["conv_id", "to"]).select("conv_id", F.col("turn").alias("src"), F.col("to").alias("dst"))


@query("WITH c AS (SELECT DISTINCT conv_id, turn FROM conversations) SELECT a.conv_id, a.turn AS src, b.turn AS dst FROM c a JOIN c b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1")
def order_reduction(spark: SparkSession, d: str) -> DataFrame:
    """Of turns and their shortcuts only the next ones are needed."""
    return O.transitive_reduction(_turns(spark, d), ["conv_id"])[0]


@query("WITH c AS (SELECT DISTINCT conv_id, turn FROM conversations) SELECT conv_id, a.turn AS src, b.turn AS dst FROM c a JOIN c b USING (conv_id) WHERE a.turn < b.turn")
def order_closure(spark: SparkSession, d: str) -> DataFrame:
    return O.transitive_closure(_turns(spark, d), ["conv_id"])


@query("""WITH RECURSIVE o AS (SELECT DISTINCT o_custkey AS c, l_suppkey AS s FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderstatus = 'P' AND l_returnflag = 'R'),
e AS (SELECT 'c' || c AS a, 's' || s AS b FROM o UNION SELECT 's' || s, 'c' || c FROM o), r(node, reached) AS (SELECT a, a FROM e UNION SELECT node, b FROM r JOIN e ON a = reached)
SELECT node, min(reached) AS root FROM r GROUP BY node""")
def graph_components(spark: SparkSession, d: str) -> DataFrame:
    """Customers and suppliers connected by returned lines of pending orders."""
    o = table(spark, d, "orders").filter("o_orderstatus = 'P'").join(table(spark, d, "lineitem").filter("l_returnflag = 'R'"), F.col("o_orderkey") == F.col("l_orderkey"))
    return O.components(o.select(F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("src"), F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("dst")))


@query("""WITH c AS (SELECT DISTINCT conv_id AS k, turn AS t FROM conversations), e AS (SELECT k, a.t AS x, b.t AS y FROM c a JOIN c b USING (k) WHERE b.t = a.t + 1),
p AS (SELECT DISTINCT CASE WHEN k % 3 = 0 THEN 'owner ' || k % 10 ELSE '_:' || k || '/' || lpad((SELECT min(t) FROM c z WHERE z.k = e.k)::VARCHAR, 6, '0') END AS owner, CASE WHEN k % 2 = 0 THEN x // 2 ELSE 7 END AS src, CASE WHEN k % 2 = 0 THEN y // 2 ELSE 7 END AS dst FROM e)
SELECT owner, src::INTEGER AS src, dst::INTEGER AS dst FROM p WHERE src <> dst OR owner NOT IN (SELECT owner FROM p WHERE src <> dst)""")
def partial_orders(spark: SparkSession, d: str) -> DataFrame:
    """Turns as links: those of even conversations lie in pairs at one place, those of odd ones all at one; every third conversation has an owner."""
    c = table(spark, d, "conversations").select("conv_id", "turn").distinct()
    link = lambda t: F.concat_ws("/", F.col("conv_id").cast("string"), F.lpad(t.cast("string"), 6, "0"))
    places = c.select(link(F.col("turn")).alias("link"), F.when(F.col("conv_id") % 2 == 0, F.floor(F.col("turn") / 2)).otherwise(F.lit(7)).cast("int").alias("place"))
    edges = c.join(c.select("conv_id", (F.col("turn") - 1).alias("turn")), ["conv_id", "turn"]).select(link(F.col("turn")).alias("src"), link(F.col("turn") + 1).alias("dst"))
    owners = c.filter("conv_id % 3 = 0").groupBy("conv_id").agg(F.max("turn").alias("turn")).select(link(F.col("turn")).alias("link"), F.concat(F.lit("owner "), (F.col("conv_id") % 10).cast("string")).alias("owner"))
    return O.partial_orders(edges, places, owners)
