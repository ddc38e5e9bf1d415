"""Queries: nested documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import documents as D
from ..sources.tables import table
from .registry import query


@query("SELECT event_id, (props->>'$.k')::BIGINT AS k, coalesce(props->>'$.none', 'absent') AS none FROM events")
def json_get(spark: SparkSession, d: str) -> DataFrame:
    v = F.try_parse_json("props")
    return table(spark, d, "events").select("event_id", D.get(v, ["k"], "bigint").alias("k"), D.get(v, ["none"], "string", "absent").alias("none"))


@query("SELECT event_id, '#/' || key AS path, props->>('$.' || key) AS value FROM (SELECT event_id, props, unnest(json_keys(props)) AS key FROM events)")
def json_shred(spark: SparkSession, d: str) -> DataFrame:
    return D.shred(table(spark, d, "events").select("event_id", "props"), "event_id", "props").select("event_id", "path", "value")


@query("""SELECT event_id, event_type || '/' || user_id AS label, CASE WHEN event_type <> 'view' THEN event_type END AS kind FROM events""")
def json_derive(spark: SparkSession, d: str) -> DataFrame:
    """Values derived from several sources; empty ones are culled."""
    label = F.concat("event_type", F.lit("/"), F.col("user_id").cast("string"))
    kind = F.when(F.col("event_type") == "view", "").otherwise(F.col("event_type"))
    return table(spark, d, "events").select("event_id", D.cull(label, "string").alias("label"), D.cull(kind, "string").alias("kind"))


def _orders(spark: SparkSession, d: str) -> DataFrame:
    """A document per order, with its lines."""
    line = F.struct(F.col("l_linenumber").alias("n"), F.struct(F.col("l_quantity").alias("quantity"), F.col("l_returnflag").alias("flag")).alias("facts"))
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(line)).alias("lines")).select("l_orderkey", F.struct("lines").alias("doc"))


@query("""SELECT l_orderkey, string_agg(l_linenumber || l_returnflag || (l_quantity * 2)::BIGINT, ',' ORDER BY l_linenumber, l_quantity, l_returnflag) AS moved FROM lineitem GROUP BY 1""")
def doc_move(spark: SparkSession, d: str) -> DataFrame:
    """A field moved out of every line's facts, another updated in place."""
    doc = D.move(F.col("doc"), ["lines", int, "facts", "flag"], ["lines", int, "flag"])
    doc = D.update(doc, ["lines", int, "facts", "quantity"], lambda q: q * 2)
    text = F.transform(doc["lines"], lambda x: F.concat(x["n"].cast("string"), x["flag"], x["facts"]["quantity"].cast("bigint").cast("string")))
    return _orders(spark, d).select("l_orderkey", F.array_join(text, ",").alias("moved"))


@query("""SELECT team, n1 AS n_pairs, CASE WHEN n1 IS NULL THEN 'lengths differ: ' || a || ' ' || b END AS error FROM (SELECT c_custkey // 10 AS team, count(*) AS a, count(*) FILTER (c_acctbal > -900) AS b, CASE WHEN count(*) = count(*) FILTER (c_acctbal > -900) THEN count(*) END AS n1 FROM customer GROUP BY 1)""")
def zip_eq(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").groupBy(F.floor(F.col("c_custkey") / 10).alias("team")).agg(F.sort_array(F.collect_list("c_custkey")).alias("a"), F.sort_array(F.collect_list(F.when(F.col("c_acctbal") > -900, F.col("c_name")))).alias("b"))
    z = c.select("team", D.zip_equal(F.col("a"), F.col("b")).alias("z"))
    return z.select("team", F.when(F.col("z.pairs").isNotNull(), F.size("z.pairs").cast("bigint")).alias("n_pairs"), "z.error")


@query("""SELECT p_partkey, '{"brand":"' || p_brand || '","size":"' || p_size || '"}' AS document FROM part""")
def doc_assemble(spark: SparkSession, d: str) -> DataFrame:
    leaf = lambda k, c: F.struct(F.lit(f"#/{k}").alias("path"), F.col(c).cast("string").alias("value"))
    leaves = table(spark, d, "part").select("p_partkey", F.explode(F.array(leaf("size", "p_size"), leaf("brand", "p_brand"))).alias("x")).select("p_partkey", "x.*")
    return D.assemble(leaves, "p_partkey")


@query("SELECT event_id, '#/a/k' AS path, (props->>'$.k') AS value FROM events WHERE event_type <> 'error'")
def filter_failures(spark: SparkSession, d: str) -> DataFrame:
    """Values at or below the paths of errors taken out, and one key's values collected at any depth."""
    e = table(spark, d, "events").select("event_id", "event_type", F.concat(F.lit('{"a":'), "props", F.lit("}")).alias("t"))
    errors = e.filter("event_type = 'error'").select("event_id", F.lit("#/a").alias("path"))
    good, _ = D.drop_failures(D.shred(e, "event_id", "t"), errors, "event_id")
    return D.collect_by_key(good, "k").select("event_id", "path", "value")


def _parts(spark: SparkSession, d: str) -> DataFrame:
    """A document per part; every third has a maker already."""
    maker = F.when(F.col("p_partkey") % 3 == 0, "given")
    return table(spark, d, "part").select("p_partkey", F.struct(F.struct(F.col("p_brand").alias("brand"), maker.alias("maker")).alias("meta"), F.col("p_size").alias("size")).alias("doc"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'given' ELSE p_brand END AS maker, CASE WHEN p_partkey % 3 = 0 THEN 'target exists: meta/maker' END AS error, p_size AS copied FROM part")
def doc_add(spark: SparkSession, d: str) -> DataFrame:
    """A value added where there may be one already, and a copy under parents that are made."""
    rows = _parts(spark, d)
    kind = rows.schema["doc"].dataType
    added = rows.select("p_partkey", D.add(F.col("doc"), kind, ["meta", "maker"], F.col("doc.meta.brand")).alias("x"), D.copy(F.col("doc"), kind, ["size"], ["facts", "own", "size"]).alias("y"))
    return added.select("p_partkey", F.col("x.document.meta.maker").alias("maker"), "x.error", F.col("y.document.facts.own.size").alias("copied"))


@query("SELECT event_id, event_type AS kind, 'later' AS source, user_id::VARCHAR AS who FROM events")
def doc_merge(spark: SparkSession, d: str) -> DataFrame:
    """Maps of several sources as one; the last wins."""
    a = F.create_map(F.lit("kind"), F.col("event_type"), F.lit("source"), F.lit("earlier"))
    b = F.create_map(F.lit("source"), F.lit("later"), F.lit("who"), F.col("user_id").cast("string"))
    m = table(spark, d, "events").select("event_id", D.merge(a, b).alias("m"))
    return m.select("event_id", *(F.col("m")[k].alias(k) for k in ("kind", "source", "who")))


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts, to_base64(encode(event_type)) AS kind FROM events")
def doc_types(spark: SparkSession, d: str) -> DataFrame:
    return D.plain_types(table(spark, d, "events").select("event_id", "ts", F.col("event_type").cast("binary").alias("kind")))


@query("SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'lines/-1/flag' WHEN 1 THEN 'a/b' ELSE 'c/-1/-1' END AS place FROM part")
def schema_place(spark: SparkSession, d: str) -> DataFrame:
    """Schema paths as places in the data."""
    paths = F.element_at(F.array(F.lit("properties/lines/items/properties/flag"), F.lit("properties/a/allOf/0/properties/b"), F.lit("properties/c/items/oneOf/1/items")), (F.col("p_partkey") % 3 + 1).cast("int"))
    return table(spark, d, "part").select("p_partkey", F.split(paths, "/").alias("s")).select("p_partkey", F.array_join(D.data_path(F.col("s")), "/").alias("place"))


@query("SELECT event_id, '#/' || key AS path, CASE WHEN key <> 'id' THEN event_type END AS label FROM events, (VALUES ('kind'), ('id')) v(key)")
def identifier_labels(spark: SparkSession, d: str) -> DataFrame:
    """Identifiers with their labels, but not under keys that are left alone."""
    e = table(spark, d, "events")
    value = F.concat(F.lit("k:"), "event_type")
    leaves = e.select("event_id", F.explode(F.array(F.lit("#/kind"), F.lit("#/id"))).alias("path"), value.alias("value"))
    names = e.select(value.alias("value"), F.col("event_type").alias("label")).distinct()
    return D.expand_identifiers(leaves, names).select("event_id", "path", "label")
