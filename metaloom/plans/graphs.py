"""Queries: order lines as lists in two graphs that are merged; restrictions unwrapped; identifiers replaced; Turtle written and read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import graphs as G
from ..sources import turtle
from ..sources.scratch import place
from ..sources.tables import table
from .registry import query


def _one(rows: DataFrame, s: Column, p: str, o: Column, kind: str) -> DataFrame:
    return rows.select(s.alias("s"), F.lit(p).alias("p"), o.cast("string").alias("o"), F.lit(kind).alias("o_kind"))


def _text(prefix: str, *columns: str) -> Column:
    return F.concat(F.lit(prefix), F.concat_ws("-", *(F.col(c).cast("string") for c in columns)))


@query("""WITH c AS (SELECT l_orderkey AS k, string_agg(l_returnflag || l_linestatus, '' ORDER BY l_linenumber, l_returnflag, l_linestatus) AS all_, count(*) AS n FROM lineitem GROUP BY l_orderkey),
x AS (SELECT k, substr(all_, 2 * i + 1) AS rest, i FROM (SELECT k, all_, unnest(range(n)) AS i FROM c)), d AS (SELECT DISTINCT rest FROM x)
SELECT 'list' AS p, count(*) AS n, count(DISTINCT rest) AS holders, count(DISTINCT rest) AS held FROM (SELECT DISTINCT k, rest FROM x WHERE i = 0)
UNION ALL SELECT 'first', count(*), count(*), count(DISTINCT rest[1:2]) FROM d UNION ALL SELECT 'rest', count(*), count(*), count(DISTINCT rest[3:]) FROM d""")
def graph_merge(spark: SparkSession, d: str) -> DataFrame:
    """The lines of each order as a list of flags, in two graphs with other names of the lists' cells; merged, a cell is there once for each list that begins with it. holders and held: distinct blank nodes and terms."""
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_returnflag", "l_linestatus")
    cells = table(spark, d, "lineitem").select("l_orderkey", F.concat("l_returnflag", "l_linestatus").alias("flag"), F.row_number().over(order).alias("n"), F.lead(F.lit(True)).over(order).alias("more")).withColumn("rest", F.col("n") + 1)

    def graph(name: str, letter: str) -> Column:
        cell, rest = _text(f"_:{letter}", "l_orderkey", "n"), _text(f"_:{letter}", "l_orderkey", "rest")
        triple = lambda s, p, o, kind: F.struct(s.alias("s"), F.lit(p).alias("p"), o.alias("o"), kind.alias("o_kind"), F.lit(name).alias("graph"))
        on = triple(cell, G.REST, F.when(F.col("more"), rest).otherwise(F.lit(G.NIL)), F.when(F.col("more"), "blank").otherwise("iri"))
        return F.array(F.when(F.col("n") == 1, triple(_text("order/", "l_orderkey"), "list", cell, F.lit("blank"))), triple(cell, "first", F.col("flag"), F.lit("literal")), on)

    # one pass over the lines makes both graphs
    triples = cells.select(F.explode(F.array_compact(F.concat(graph("one", "a"), graph("two", "b")))).alias("t")).select("t.*")
    merged = G.merge_graphs(triples)
    kinds = merged.withColumn("p", F.regexp_replace("p", ".*#", ""))
    holder = F.when(F.col("p") == "list", F.col("o")).otherwise(F.col("s"))
    return kinds.groupBy("p").agg(F.count("*").alias("n"), F.count_distinct(holder).alias("holders"), F.count_distinct("o").alias("held"))


@query("""SELECT 'part/' || p_partkey AS s, 'madeBy' AS property, 'some' AS quantifier, p_type AS o FROM part UNION ALL SELECT 'part/' || p_partkey, 'sizeIn', 'all', 'size/' || p_size FROM part WHERE p_size > 20""")
def restriction_edges(spark: SparkSession, d: str) -> DataFrame:
    """Parts under restrictions: some maker, only one size; and restrictions without a property, which are no edges."""
    part = table(spark, d, "part")

    def under(rows: DataFrame, letter: str, property: str | None, quantifier: str, filler: Column) -> DataFrame:
        node = _text(f"_:{letter}", "p_partkey")
        made = _one(rows, _text("part/", "p_partkey"), G.SUBCLASS, node, "blank").unionByName(_one(rows, node, G.TYPE, F.lit(G.RESTRICTION), "iri")).unionByName(_one(rows, node, quantifier, filler, "iri"))
        return made if property is None else made.unionByName(_one(rows, node, G.ON_PROPERTY, F.lit(property), "iri"))

    rows = under(part, "m", "madeBy", G.SOME, F.col("p_type")).unionByName(under(part.filter("p_size > 20"), "s", "sizeIn", G.ALL, _text("size/", "p_size"))).unionByName(under(part, "n", None, G.SOME, F.col("p_brand")))
    return G.restriction_edges(rows)


@query("""WITH t AS (SELECT 'c/' || c_custkey AS s, 'of' AS p, 'n/' || c_nationkey AS o, 'iri' AS o_kind FROM customer UNION ALL SELECT 'c/' || c_custkey, 'label', 'n/' || c_nationkey, 'literal' FROM customer
UNION ALL SELECT 'n/' || n_nationkey, 'label', n_name, 'literal' FROM nation)
SELECT DISTINCT CASE WHEN s LIKE 'n/%' THEN 'nation/' || n_name ELSE s END AS s, CASE p WHEN 'of' THEN 'in' ELSE p END AS p, CASE WHEN o_kind = 'iri' THEN (SELECT 'nation/' || n_name FROM nation WHERE o = 'n/' || n_nationkey) ELSE o END AS o, o_kind FROM t LEFT JOIN nation ON s = 'n/' || n_nationkey""")
def replaced_ids(spark: SparkSession, d: str) -> DataFrame:
    """Nations' keys replaced by names, as subjects and objects but not in literals; and a predicate replaced."""
    customer, nation = table(spark, d, "customer"), table(spark, d, "nation")
    c, n = _text("c/", "c_custkey"), _text("n/", "c_nationkey")
    rows = _one(customer, c, "of", n, "iri").unionByName(_one(customer, c, "label", n, "literal")).unionByName(_one(nation, _text("n/", "n_nationkey"), "label", F.col("n_name"), "literal"))
    to = nation.select(_text("n/", "n_nationkey").alias("old"), _text("nation/", "n_name").alias("new")).unionByName(nation.select(F.lit("of").alias("old"), F.lit("in").alias("new")).distinct())
    return G.replace_ids(rows, to).select("s", "p", "o", "o_kind")


_TTL = r"""t AS (SELECT 'http://x/c/' || c_custkey AS s, 'http://x/v#name' AS p, c_name || CASE WHEN c_custkey % 3 = 0 THEN ' "' || c_mktsegment || '" <a> . ; # ' || chr(10) || chr(9) || chr(92) ELSE '' END AS o, 'literal' AS o_kind, NULL AS o_datatype, CASE WHEN c_custkey % 2 = 0 THEN 'en-GB' END AS o_lang FROM customer
UNION ALL SELECT 'http://x/c/' || c_custkey, 'http://x/v#balance', c_acctbal::DECIMAL(15, 2)::VARCHAR, 'literal', 'http://www.w3.org/2001/XMLSchema#decimal', NULL FROM customer
UNION ALL SELECT 'http://x/c/' || c_custkey, 'http://www.w3.org/1999/02/22-rdf-syntax-ns#type', 'http://x/v#Customer', 'iri', NULL, NULL FROM customer
UNION ALL SELECT 'http://x/n/' || c_nationkey, 'http://x/v#has', 'http://x/c/' || c_custkey, 'iri', NULL, NULL FROM customer UNION ALL SELECT '_', 'http://x/v#of', '_', 'blank', NULL, NULL FROM customer)"""


@query(f"WITH {_TTL} SELECT * FROM t")
def turtle_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Triples of customers as Turtle with prefixes, a statement a subject, read back file by file."""
    c = table(spark, d, "customer")
    key, nation = _text("http://x/c/", "c_custkey"), _text("http://x/n/", "c_nationkey")
    name = F.when(F.col("c_custkey") % 3 == 0, F.concat("c_name", F.lit(' "'), "c_mktsegment", F.lit('" <a> . ; # \n\t\\'))).otherwise(F.col("c_name"))
    lang = F.when(F.col("c_custkey") % 2 == 0, "en-GB")
    none = F.lit(None).cast("string")
    full = lambda s, p, o, kind, datatype=none, lang=none: c.select(s.alias("s"), F.lit(p).alias("p"), o.cast("string").alias("o"), F.lit(kind).alias("o_kind"), datatype.alias("o_datatype"), lang.alias("o_lang"))
    rows = full(key, "http://x/v#name", name, "literal", lang=lang).unionByName(full(key, "http://x/v#balance", F.col("c_acctbal").cast("decimal(15,2)"), "literal", F.lit("http://www.w3.org/2001/XMLSchema#decimal")))
    rows = rows.unionByName(full(key, G.TYPE, F.lit("http://x/v#Customer"), "iri")).unionByName(full(nation, "http://x/v#has", key, "iri")).unionByName(full(_text("_:b", "c_custkey"), "http://x/v#of", _text("_:n", "c_nationkey"), "blank"))
    path = place(spark, "turtle")
    turtle.write(rows, path, {"": "http://x/v#", "c": "http://x/c/"})
    back = turtle.read(spark, path, together=True).filter("error IS NULL")
    hidden = lambda x: F.when(F.col(x).startswith("_:"), "_").otherwise(F.col(x)).alias(x)
    return back.select(hidden("s"), "p", F.when(F.col("o_kind") == "blank", "_").otherwise(F.col("o")).alias("o"), "o_kind", "o_datatype", "o_lang")
