"""Queries: reconciliation and tabular reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import reconcile as R
from ..operators.relational import numbered
from ..sources.tables import table
from .registry import query


@query("SELECT DISTINCT o_custkey AS k FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def recon_missing(spark: SparkSession, d: str) -> DataFrame:
    return R.missing(table(spark, d, "orders").select(F.col("o_custkey").alias("k")), table(spark, d, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("k")), "k")


@query("""SELECT a.k, a.t AS "left", b.t AS "right" FROM (SELECT DISTINCT l_partkey AS k, l_suppkey AS t FROM lineitem WHERE l_linenumber = 1) a
JOIN (SELECT DISTINCT l_partkey AS k, l_suppkey AS t FROM lineitem WHERE l_linenumber = 4) b ON a.k = b.k AND a.t <> b.t""")
def recon_double(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "lineitem").select(F.col("l_partkey").alias("k"), F.col("l_suppkey").alias("t"), "l_linenumber")
    return R.double_mapped(x.filter("l_linenumber = 1"), x.filter("l_linenumber = 4"), "k", "t")


@query("""SELECT coalesce(a.k, b.k) AS k, a.k IS NOT NULL AS in_first, b.k IS NOT NULL AS in_second FROM (SELECT DISTINCT doc_id AS k FROM labels) a
FULL JOIN (SELECT DISTINCT doc_id AS k FROM documents WHERE lang = 'en') b ON a.k = b.k""")
def membership_flags(spark: SparkSession, d: str) -> DataFrame:
    labels, docs = table(spark, d, "labels").select(F.col("doc_id").alias("k")), table(spark, d, "documents").filter("lang = 'en'").select(F.col("doc_id").alias("k"))
    return R.by_source(labels, docs, "k")


@query("""SELECT * FROM (SELECT coalesce(a.k, b.k) AS k, CASE WHEN a.k IS NULL THEN 'added' WHEN b.k IS NULL THEN 'removed' WHEN a.v <> b.v THEN 'changed' END AS change
FROM (SELECT user_id AS k, arg_max(event_type, event_id) AS v FROM events WHERE event_id < (SELECT max(event_id) // 2 FROM events) GROUP BY 1) a
FULL JOIN (SELECT user_id AS k, arg_max(event_type, event_id) AS v FROM events WHERE event_id >= (SELECT max(event_id) // 2 FROM events) AND user_id % 5 <> 0 GROUP BY 1) b ON a.k = b.k) WHERE change IS NOT NULL""")
def graph_changes(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    state = lambda x: x.groupBy(F.col("user_id").alias("k")).agg(F.max_by("event_type", "event_id").alias("v"))
    half = (e.agg(F.max("event_id")).first()[0] or 0) // 2
    return R.graph_changes(state(e.filter(F.col("event_id") < half)), state(e.filter((F.col("event_id") >= half) & (F.col("user_id") % 5 != 0))), "k", "v")


@query("SELECT json_key, count(DISTINCT user_id) AS n_users FROM (SELECT user_id, unnest(json_keys(props)) AS json_key FROM events) GROUP BY 1")
def column_names(spark: SparkSession, d: str) -> DataFrame:
    """In how many users' records each field name occurs; a user counts once."""
    names = table(spark, d, "events").select("user_id", F.explode(F.json_object_keys("props")).alias("json_key"))
    return names.groupBy("json_key").agg(F.countDistinct("user_id").alias("n_users"))


@query("""WITH v AS (SELECT 'p_brand' AS c, p_brand AS v FROM part UNION SELECT 'p_type', p_type FROM part UNION SELECT 'p_size', p_size::VARCHAR FROM part),
n AS (SELECT c, v, row_number() OVER (PARTITION BY c ORDER BY v) AS n FROM v)
SELECT n, max(v) FILTER (c = 'p_brand') AS p_brand, max(v) FILTER (c = 'p_type') AS p_type, max(v) FILTER (c = 'p_size') AS p_size FROM n GROUP BY n""")
def values_report(spark: SparkSession, d: str) -> DataFrame:
    """Distinct values of several columns, side by side."""
    columns = ["p_brand", "p_type", "p_size"]
    long = table(spark, d, "part").select(F.explode(F.array(*(F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in columns))).alias("x")).select("x.*").distinct()
    rows = numbered(long, ["c", "v"])
    first = rows.groupBy("c").agg(F.min("n").alias("first"))  # a row for each column
    return rows.join(F.broadcast(first), "c").withColumn("n", F.col("n") - F.col("first") + 1).groupBy("n").pivot("c", columns).agg(F.max("v"))


@query(r"""SELECT CASE WHEN regexp_matches(s, '^[0-9]+$') THEN '<number>' WHEN s = '' THEN '<none>' ELSE s END AS suffix, count(*) AS n
FROM (SELECT regexp_extract(regexp_replace(url, '[?#].*$', ''), '([^/.]*)$', 1) AS s FROM pages) GROUP BY 1""")
def filetypes(spark: SparkSession, d: str) -> DataFrame:
    """Counts by the last part of an address, all numbers as one."""
    last = F.regexp_extract(F.regexp_replace("url", "[?#].*$", ""), "([^/.]*)$", 1)
    folded = F.when(last.rlike("^[0-9]+$"), "<number>").when(last == "", "<none>").otherwise(last)
    return table(spark, d, "pages").groupBy(folded.alias("suffix")).agg(F.count("*").alias("n"))


@query("SELECT p_brand, string_agg(DISTINCT p_type, ';' ORDER BY p_type) AS keywords FROM part GROUP BY p_brand")
def keywords(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").groupBy("p_brand").agg(F.array_join(F.array_sort(F.collect_set("p_type")), ";").alias("keywords"))


@query("SELECT source, count(*) AS n, coalesce(sum(n_chars), -1)::BIGINT AS size, count(*) FILTER (n_chars IS NULL) > 0 AS uncertain FROM documents GROUP BY source")
def size_report(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").groupBy("source").agg(F.count("*").alias("n"), F.coalesce(F.sum("n_chars"), F.lit(-1)).alias("size"), (F.count_if(F.col("n_chars").isNull()) > 0).alias("uncertain"))


@query("SELECT c_nationkey, count(*) AS total, count(*) FILTER (fetched) AS here, sum(c_acctbal) FILTER (NOT fetched) IS NULL AS complete FROM (SELECT *, c_custkey IN (SELECT o_custkey FROM orders) AS fetched FROM customer) GROUP BY 1")
def to_fetch(spark: SparkSession, d: str) -> DataFrame:
    c, o = table(spark, d, "customer"), table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), F.lit(True).alias("here")).distinct()
    x = c.join(o, "c_custkey", "left").groupBy("c_nationkey")
    return x.agg(F.count("*").alias("total"), F.count("here").alias("here"), (F.count_if(F.col("here").isNull()) == 0).alias("complete"))


@query("SELECT CASE WHEN p_type LIKE 'ECONOMY%' THEN 'economy' WHEN p_type LIKE 'PROMO%' THEN 'promo' ELSE 'Other' END AS prefix, count(*) AS n, count(DISTINCT p_brand) AS n_brands FROM part GROUP BY 1")
def terms_by_prefix(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("p_type")
    return table(spark, d, "part").groupBy(F.when(t.startswith("ECONOMY"), "economy").when(t.startswith("PROMO"), "promo").otherwise("Other").alias("prefix")).agg(F.count("*").alias("n"), F.countDistinct("p_brand").alias("n_brands"))


@query("""SELECT event_type, user_id, n, CASE WHEN n = 1 THEN link END AS link FROM (SELECT event_type, user_id, count(*) AS n, min(event_id) AS link FROM events GROUP BY 1, 2)""")
def tag_report(spark: SparkSession, d: str) -> DataFrame:
    """Groups with their counts, and a link only where there is one row."""
    x = table(spark, d, "events").groupBy("event_type", "user_id").agg(F.count("*").alias("n"), F.min("event_id").alias("link"))
    return x.withColumn("link", F.when(F.col("n") == 1, F.col("link")))


@query("""SELECT coalesce(o_orderstatus, 'total') AS model, count(*) AS n, count(DISTINCT o_custkey) AS n_customers, count(DISTINCT o_orderpriority) AS n_priorities,
count(DISTINCT o_custkey) FILTER (o_totalprice > 200000) AS n_large FROM orders GROUP BY ROLLUP (o_orderstatus)""")
def dashboard(spark: SparkSession, d: str) -> DataFrame:
    """Distinct counts per model, and a total row."""
    x = table(spark, d, "orders").rollup("o_orderstatus")
    large = F.countDistinct(F.when(F.col("o_totalprice") > 200000, F.col("o_custkey")))
    return x.agg(F.count("*").alias("n"), F.countDistinct("o_custkey").alias("n_customers"), F.countDistinct("o_orderpriority").alias("n_priorities"), large.alias("n_large")).select(F.coalesce("o_orderstatus", F.lit("total")).alias("model"), "n", "n_customers", "n_priorities", "n_large")


@query("SELECT lang, count(*) AS n, count(text)::DOUBLE / count(*) AS has_text, count(*) FILTER (n_chars > 1000)::DOUBLE / count(*) AS is_long FROM documents GROUP BY lang")
def field_coverage(spark: SparkSession, d: str) -> DataFrame:
    n = F.count("*")
    return table(spark, d, "documents").groupBy("lang").agg(n.alias("n"), (F.count("text") / n).alias("has_text"), (F.count_if(F.col("n_chars") > 1000) / n).alias("is_long"))
