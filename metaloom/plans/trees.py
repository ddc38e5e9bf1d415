"""Queries: documents ten levels deep, taken apart, mapped and put together again; queries by path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import trees as D
from ..sources.tables import table
from .registry import query
from .schemas import order_documents

_LEVELS = 5


def deep_documents(spark: SparkSession, d: str) -> DataFrame:
    """p_partkey, text: a part's columns below ten levels of objects and lists in turn."""
    text = F.to_json(F.struct("p_brand", "p_name", "p_size"))
    for k in range(_LEVELS):
        text = F.concat(F.lit('{"a~/b":'), (F.col("p_partkey") % (k + 2)).cast("string"), F.lit(',"errors":[],"level":['), text, F.lit(',null,"x'), F.lit(str(k)), F.lit('"]}'))
    return table(spark, d, "part").select("p_partkey", text.alias("text"))


def _nested(core: str, key: str = "'\"a~/b\":' || (p_partkey % {n}) || ',\"errors\":[],'", more: str = "',null,\"x{k}\"'") -> str:
    text = core
    for k in range(_LEVELS):
        text = f"'{{' || {key.format(n=k + 2, k=k)} || '\"level\":[' || {text} || {more.format(k=k)} || ']}}'"
    return text


_CORE = "'{\"p_brand\":\"' || p_brand || '\",\"p_name\":\"' || p_name || '\",\"p_size\":' || p_size || '}'"


@query(f"SELECT p_partkey, {_nested(_CORE)} AS document FROM part")
def tree_round_trip(spark: SparkSession, d: str) -> DataFrame:
    return D.assemble(D.nodes(deep_documents(spark, d), "p_partkey", "text"), "p_partkey")


@query("SELECT * FROM (VALUES (0, 'object', 1), (1, 'array', 2), (1, 'number', 1), (2, 'object', 1), (2, 'null', 1), (2, 'string', 1), (3, 'array', 2), (3, 'number', 1), (4, 'object', 1), (4, 'null', 1), (4, 'string', 1), (5, 'array', 2), (5, 'number', 1), (6, 'object', 1), (6, 'null', 1), (6, 'string', 1), (7, 'array', 2), (7, 'number', 1), (8, 'object', 1), (8, 'null', 1), (8, 'string', 1), (9, 'array', 2), (9, 'number', 1), (10, 'object', 1), (10, 'null', 1), (10, 'string', 1), (11, 'string', 2), (11, 'number', 1)) v(depth, kind, n), LATERAL (SELECT n * count(*) AS total FROM part)")
def tree_nodes(spark: SparkSession, d: str) -> DataFrame:
    """Nodes of all documents by depth and kind."""
    tree = D.nodes(deep_documents(spark, d), "p_partkey", "text")
    counted = tree.groupBy("depth", "kind").agg(F.count("*").alias("total"))
    return counted.join(table(spark, d, "part").agg(F.count("*").alias("parts"))).select("depth", "kind", (F.col("total") / F.col("parts")).cast("int").alias("n"), "total")


@query(
    "SELECT p_partkey, "
    + _nested("'{\"p_brand\":\"' || upper(p_brand) || '\",\"p_name\":\"' || p_name || '\"}'", "'\"a~/b\":' || (p_partkey % {n}) || ','", "',\"X{k}\"'")
    + " AS document FROM part"
)
def tree_map(spark: SparkSession, d: str) -> DataFrame:
    """Texts in upper case, but for p_name; without p_size; nulls and empty lists are left out."""
    tree = D.nodes(deep_documents(spark, d), "p_partkey", "text")
    mapped = D.map_nodes(tree, lambda value, kind, path: F.when(kind == "string", F.upper(value)).otherwise(value), skip=["p_size"], preserve=["p_name"])
    return D.assemble(mapped, "p_partkey", condense=True, preserve=["p_name"])


@query(
    "WITH l AS (SELECT l_orderkey, string_agg(CASE WHEN l_partkey % 49 = 0 THEN '1' ELSE '-' END, ',' ORDER BY l_linenumber, l_partkey, l_quantity, l_returnflag) AS extras, string_agg(l_quantity::INT::VARCHAR, ',' ORDER BY l_linenumber, l_partkey, l_quantity, l_returnflag) AS quantities FROM lineitem GROUP BY 1)"
    " SELECT o_orderkey, quantities, CASE WHEN contains(extras, '1') THEN extras END AS extras, o_orderstatus AS status FROM orders LEFT JOIN l ON l_orderkey = o_orderkey"
)
def path_columns(spark: SparkSession, d: str) -> DataFrame:
    """Of each order's lines the quantities, and of a key that few have, a column as long as the lines."""
    docs = order_documents(spark, d)
    v = F.col("document")
    text = lambda xs, kind: F.array_join(F.transform(xs, lambda x: F.coalesce(F.try_variant_get(x, "$", kind).cast("string"), F.lit("-"))), ",")
    return docs.select(
        "o_orderkey",
        text(D.path_query(v, "lines", "quantity")["many"], "int").alias("quantities"),
        text(D.path_query(v, "lines", "extra")["many"], "int").alias("extras"),
        F.try_variant_get(D.path_query(v, "status")["one"], "$", "string").alias("status"),
    )
