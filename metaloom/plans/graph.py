"""Queries: triples, patterns, closures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import paths as P
from ..operators import triples as G
from ..operators.deltalog import tree_paths
from ..sources.tables import table
from .registry import query


def triples(spark: SparkSession, d: str) -> DataFrame:
    """Customers, nations and regions."""
    iri = lambda kind, key: F.concat(F.lit(f"{kind}/"), F.col(key).cast("string"))
    c = table(spark, d, "customer").withColumn("nation", iri("nation", "c_nationkey"))
    n = table(spark, d, "nation").withColumn("region", iri("region", "n_regionkey"))
    return (
        G.build(c, iri("customer", "c_custkey"), {"nation": "in_nation", "c_name": "name", "c_mktsegment": "segment"})
        .unionByName(G.build(n, iri("nation", "n_nationkey"), {"region": "in_region", "n_name": "name"}))
        .unionByName(G.build(table(spark, d, "region"), iri("region", "r_regionkey"), {"r_name": "name"}))
    )


_T = """t(s, p, o) AS (SELECT 'customer/' || c_custkey, 'in_nation', 'nation/' || c_nationkey FROM customer UNION ALL SELECT 'customer/' || c_custkey, 'name', c_name FROM customer
UNION ALL SELECT 'customer/' || c_custkey, 'segment', c_mktsegment FROM customer UNION ALL SELECT 'nation/' || n_nationkey, 'in_region', 'region/' || n_regionkey FROM nation
UNION ALL SELECT 'nation/' || n_nationkey, 'name', n_name FROM nation UNION ALL SELECT 'region/' || r_regionkey, 'name', r_name FROM region)"""


@query(f"WITH {_T} SELECT s, p, o FROM t WHERE o IS NOT NULL")
def triples_build(spark: SparkSession, d: str) -> DataFrame:
    return triples(spark, d).select("s", "p", "o")


@query(f"WITH {_T} SELECT a.s AS c, a.o AS n, b.o AS r, x.o AS name FROM t a JOIN t b ON a.o = b.s AND b.p = 'in_region' JOIN t x ON x.s = a.s AND x.p = 'name' WHERE a.p = 'in_nation'")
def bgp_star(spark: SparkSession, d: str) -> DataFrame:
    return G.bgp(triples(spark, d), ("?c", "in_nation", "?n"), ("?n", "in_region", "?r"), ("?c", "name", "?name")).select("c", "n", "r", "name")


@query(f"WITH {_T} SELECT a.s AS n, b.s AS c FROM t a LEFT JOIN (SELECT x.s, x.o FROM t x JOIN t y ON x.s = y.s AND y.p = 'segment' AND y.o = 'BUILDING' WHERE x.p = 'in_nation') b ON b.o = a.s WHERE a.p = 'in_region'")
def optional_pattern(spark: SparkSession, d: str) -> DataFrame:
    t = triples(spark, d)
    return G.optional(G.pattern(t, "?n", "in_region", "?r"), G.bgp(t, ("?c", "in_nation", "?n"), ("?c", "segment", "BUILDING"))).select("n", "c")


@query(f"WITH {_T} SELECT s AS c FROM t WHERE p = 'in_nation' AND s NOT IN (SELECT s FROM t WHERE p = 'segment' AND o = 'BUILDING')")
def minus_pattern(spark: SparkSession, d: str) -> DataFrame:
    t = triples(spark, d)
    return G.minus(G.pattern(t, "?c", "in_nation", "?n"), G.pattern(t, "?c", "segment", "BUILDING")).select("c")


@query(f"WITH {_T} SELECT s AS x, o AS y FROM t WHERE p IN ('in_nation', 'in_region') AND s <> 'nation/3' UNION SELECT s, o FROM t WHERE p = 'name'")
def union_pattern(spark: SparkSession, d: str) -> DataFrame:
    t = triples(spark, d)
    return G.pattern(t, "?x", ["in_nation", "in_region"], "?y").filter("x <> 'nation/3'").union(G.pattern(t, "?x", "name", "?y")).distinct()


def replies(spark: SparkSession, d: str) -> DataFrame:
    """Each turn of a conversation points at the one before."""
    c = table(spark, d, "conversations").filter("turn > 0")
    at = lambda turn: F.concat(F.col("conv_id").cast("string"), F.lit("/"), turn.cast("string"))
    return c.select(at(F.col("turn")).alias("src"), at(F.col("turn") - 1).alias("dst"))


_R = """e AS (SELECT DISTINCT conv_id || '/' || turn AS src, conv_id || '/' || (turn - 1) AS dst FROM conversations WHERE turn > 0)"""


def _last_turns(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "conversations").groupBy("conv_id").agg(F.max("turn").alias("turn"))
    return c.select(F.concat(F.col("conv_id").cast("string"), F.lit("/"), F.col("turn").cast("string")).alias("start"))


_SEEDS = "z AS (SELECT conv_id || '/' || max(turn) AS start FROM conversations GROUP BY conv_id)"


@query(f"WITH RECURSIVE {_R}, {_SEEDS}, c(start, node) AS (SELECT start, dst FROM z JOIN e ON src = start UNION SELECT start, dst FROM c JOIN e ON src = node) SELECT start, node FROM c")
def closure_plus(spark: SparkSession, d: str) -> DataFrame:
    return P.closure(replies(spark, d), _last_turns(spark, d)).select("start", "node")


@query(f"WITH RECURSIVE {_R}, {_SEEDS}, c(start, node) AS (SELECT start, start FROM z UNION SELECT start, dst FROM c JOIN e ON src = node) SELECT start, node FROM c")
def closure_star(spark: SparkSession, d: str) -> DataFrame:
    return P.closure(replies(spark, d), _last_turns(spark, d), zero=True).select("start", "node")


@query(f"WITH {_R}, {_SEEDS} SELECT start, start AS node, 0 AS depth FROM z UNION SELECT start, dst, 1 FROM z JOIN e ON src = start UNION SELECT start, b.dst, 2 FROM z JOIN e a ON a.src = start JOIN e b ON b.src = a.dst")
def bounded_0_2(spark: SparkSession, d: str) -> DataFrame:
    return P.closure(replies(spark, d), _last_turns(spark, d), max_depth=2, zero=True)


@query(f"WITH {_T} SELECT DISTINCT a.s AS x, c.o AS y FROM t a JOIN t b ON a.o = b.s JOIN t c ON c.s = b.o WHERE a.p = 'in_nation' AND b.p = 'in_region' AND c.p = 'name'")
def alt_seq(spark: SparkSession, d: str) -> DataFrame:
    """A sequence path: in_nation / in_region / name."""
    return G.bgp(triples(spark, d), ("?x", "in_nation", "?a"), ("?a", "in_region", "?b"), ("?b", "name", "?y")).select("x", "y").distinct()


@query(f"WITH RECURSIVE {_R}, {_SEEDS}, c(start, node, depth) AS (SELECT start, start, 0 FROM z UNION SELECT start, dst, depth + 1 FROM c JOIN e ON src = node) SELECT start, node, min(depth) AS depth FROM c WHERE node LIKE '%/0' GROUP BY 1, 2")
def shortest(spark: SparkSession, d: str) -> DataFrame:
    r = replies(spark, d)
    return P.shortest_path(r, _last_turns(spark, d), r.select(F.col("dst").alias("node")).union(_last_turns(spark, d)).filter("node LIKE '%/0'").distinct()).select("start", "node", "depth")


@query(f"WITH RECURSIVE {_R}, c(node, level) AS (SELECT DISTINCT src, 0 FROM e WHERE src NOT IN (SELECT dst FROM e) UNION SELECT dst, level + 1 FROM c JOIN e ON src = node) SELECT node, max(level) AS level FROM c GROUP BY node")
def topological_levels(spark: SparkSession, d: str) -> DataFrame:
    return P.levels(replies(spark, d))


@query("SELECT o_orderkey AS id FROM orders WHERE o_custkey % 7 = 0")
def recon_cycle(spark: SparkSession, d: str) -> DataFrame:
    """Orders on a cycle: each was derived from its customer's next one, and in every seventh customer the last from the first."""
    by_customer = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    following, first = F.lead("o_orderkey").over(by_customer), F.first("o_orderkey").over(by_customer)
    parent = F.coalesce(following, F.when(F.col("o_custkey") % 7 == 0, first))
    nodes = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), parent.alias("parent_id"), F.lit("").alias("name"))
    return tree_paths(nodes).filter("error = 'cycle'").select("id")


def _labelled(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "conversations").filter("turn > 0")
    at = lambda turn: F.concat(F.col("conv_id").cast("string"), F.lit("/"), turn.cast("string"))
    return c.select(at(F.col("turn")).alias("src"), at(F.col("turn") - 1).alias("dst"), F.col("role").alias("label"))


@query(f"""WITH RECURSIVE e AS (SELECT conv_id || '/' || turn AS src, conv_id || '/' || (turn - 1) AS dst, role FROM conversations WHERE turn > 0), {_SEEDS},
w(start, node, labels, n) AS (SELECT start, dst, role, 1 FROM z JOIN e ON src = start UNION ALL SELECT start, dst, labels || '>' || role, n + 1 FROM w JOIN e ON src = node WHERE n < 4)
SELECT start, node, labels FROM w WHERE NOT contains(labels, 'system') AND contains(labels, 'user')""")
def quantified_path(spark: SparkSession, d: str) -> DataFrame:
    """Walks of at most four replies in which no turn is the system's and one is the user's."""
    w = P.walks(_labelled(spark, d), _last_turns(spark, d), 4)
    w = w.filter(F.forall("labels", lambda x: x != "system") & F.exists("labels", lambda x: x == "user"))
    return w.select("start", "node", F.array_join("labels", ">").alias("labels"))


@query("SELECT conv_id || '/0' AS head, (turn)::BIGINT AS position, role AS item FROM conversations")
def list_items(spark: SparkSession, d: str) -> DataFrame:
    """Conversations as linked lists of turns, unrolled."""
    c = table(spark, d, "conversations")
    at = lambda turn: F.concat(F.col("conv_id").cast("string"), F.lit("/"), turn.cast("string"))
    rest = c.select(at(F.col("turn") - 1).alias("cell"), at(F.col("turn")).alias("rest"))
    return P.list_items(c.select(at(F.col("turn")).alias("cell"), F.col("role").alias("first")).join(rest, "cell", "left"))


@query(f"WITH {_T} SELECT s, p, o FROM t WHERE o IS NOT NULL UNION SELECT a.s, 'in_part_of', b.o FROM t a JOIN t b ON a.o = b.s WHERE a.p = 'in_nation' AND b.p = 'in_region'")
def insert_edges(spark: SparkSession, d: str) -> DataFrame:
    return G.derive_edges(triples(spark, d), "in_nation", "in_region", "in_part_of")


@query("SELECT 'part/' || p_partkey AS s, p_size::DOUBLE AS value, 'cm' AS unit FROM part")
def quantity_triples(spark: SparkSession, d: str) -> DataFrame:
    """Sizes as blank nodes with value and unit, read back by a pattern."""
    p = table(spark, d, "part")
    t = G.quantity_nodes(p, F.concat(F.lit("part/"), F.col("p_partkey").cast("string")), "hasSize", F.col("p_size").cast("double"), F.lit("cm"))
    out = G.bgp(t, ("?s", "hasSize", "?q"), ("?q", "hasValue", "?value"), ("?q", "hasUnit", "?unit"))
    return out.select("s", F.col("value").cast("double").alias("value"), "unit")
