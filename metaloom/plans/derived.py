"""Queries: derivations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import derives as V
from ..sources.tables import table
from .registry import query


@query("SELECT user_id, ts::DATE AS day, CASE WHEN count(DISTINCT event_type) = 1 THEN min(event_type) END AS one, count(DISTINCT event_type) > 1 AS several FROM events GROUP BY 1, 2")
def derive_scalar(spark: SparkSession, d: str) -> DataFrame:
    """A user's kinds of a day: one as a value, several as a list."""
    kinds = table(spark, d, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(V.scalar_if_one(F.array_sort(F.collect_set("event_type"))).alias("s"))
    return kinds.select("user_id", "day", "s.one", F.col("s.many").isNotNull().alias("several"))


def _team(spark: SparkSession, d: str) -> DataFrame:
    """Teams of ten suppliers as people with roles."""
    roles = F.array_compact(F.array(F.when(F.col("s_acctbal") > 5000, "Creator"), F.when(F.col("s_suppkey") % 3 == 0, "PrincipalInvestigator")))
    person = F.struct(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), roles.alias("roles"))
    return table(spark, d, "supplier").groupBy(F.floor(F.col("s_suppkey") / 10).alias("team")).agg(F.array_sort(F.collect_list(person)).alias("people"))


@query("""SELECT s_suppkey // 10 AS team, string_agg(s_suppkey || CASE WHEN s_suppkey % 3 = 0 THEN 'PrincipalInvestigator' ELSE '' END, ',' ORDER BY s_suppkey) AS creators FROM supplier WHERE s_acctbal > 5000 GROUP BY 1""")
def derive_creators(spark: SparkSession, d: str) -> DataFrame:
    made = F.transform(V.with_role(F.col("people"), "Creator"), lambda p: F.concat(p["id"].cast("string"), F.array_join(p["roles"], "+")))
    return _team(spark, d).select("team", F.array_join(made, ",").alias("creators")).filter("creators <> ''")


@query("""SELECT s_suppkey // 10 AS team, string_agg('/contributors/' || i, ',' ORDER BY i) AS pointers FROM (SELECT *, row_number() OVER (PARTITION BY s_suppkey // 10 ORDER BY s_suppkey) - 1 AS i FROM supplier) WHERE s_suppkey % 3 = 0 GROUP BY 1""")
def derive_pointers(spark: SparkSession, d: str) -> DataFrame:
    return _team(spark, d).select("team", F.array_join(V.role_pointers(F.col("people"), "PrincipalInvestigator"), ",").alias("pointers")).filter("pointers <> ''")


@query("SELECT o_orderkey, '10.1234/o' || o_orderkey AS doi FROM orders WHERE o_orderkey % 3 <> 2")
def derive_doi(spark: SparkSession, d: str) -> DataFrame:
    bare = F.concat(F.lit("10.1234/O"), F.col("o_orderkey").cast("string"))
    given = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("https://doi.org/"), bare)).when(F.col("o_orderkey") % 3 == 1, F.concat(F.lit("doi: "), bare)).otherwise("no doi")
    return table(spark, d, "orders").select("o_orderkey", V.doi(given).alias("doi")).filter("doi IS NOT NULL")


@query("""SELECT p_partkey, arg_max(k, (length(k), k)) AS kind FROM part LEFT JOIN (VALUES ('ECONOMY'), ('PROMO'), ('STEEL'), ('BRASS'), ('ECONOMY TIN'), ('PROMO STEEL'), ('SMALL')) v(k) ON contains(' ' || p_type || ' ', ' ' || k || ' ') GROUP BY p_partkey""")
def derive_longest_key(spark: SparkSession, d: str) -> DataFrame:
    keys = spark.createDataFrame([(k, k) for k in ("ECONOMY", "PROMO", "STEEL", "BRASS", "ECONOMY TIN", "PROMO STEEL", "SMALL")], "k string, kind string")
    return V.match_longest_key(table(spark, d, "part").select("p_partkey", "p_type"), "p_type", keys, "k", "kind").select("p_partkey", "kind")


@query("SELECT l_orderkey, l_linenumber, p_name, CASE WHEN p_partkey IS NULL THEN 'missing file' END AS error FROM lineitem LEFT JOIN part ON l_partkey = p_partkey AND p_size > 10")
def manifest_join(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("path"))
    files = table(spark, d, "part").filter("p_size > 10").select(F.col("p_partkey").alias("path"), "p_name")
    return V.manifest_files(lines, files, "path").drop("path")


@query("SELECT DISTINCT o_custkey, o_orderstatus FROM orders WHERE o_custkey IS NOT NULL OR o_orderstatus IS NOT NULL")
def derive_entities(spark: SparkSession, d: str) -> DataFrame:
    return V.entities_of(table(spark, d, "orders"), ["o_custkey", "o_orderstatus"])


@query("SELECT DISTINCT conv_id || '/' || (turn - 1) AS child FROM conversations WHERE role = 'assistant' AND turn > 0 AND conv_id || '/' || (turn - 1) NOT IN (SELECT conv_id || '/' || turn FROM conversations WHERE role = 'assistant')")
def recon_ancestors(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "conversations")
    at = lambda t: F.concat(F.col("conv_id").cast("string"), F.lit("/"), t.cast("string"))
    derived = c.filter("turn > 0").select(at(F.col("turn")).alias("child"), at(F.col("turn") - 1).alias("parent"))
    return V.ancestors_not_done(derived, c.filter("role = 'assistant'").select(at(F.col("turn")).alias("child")))


@query("SELECT o_custkey AS dir FROM orders GROUP BY 1 HAVING count(*) = count(*) FILTER (o_orderstatus <> 'P')")
def recon_covered(spark: SparkSession, d: str) -> DataFrame:
    entries = table(spark, d, "orders").select(F.col("o_custkey").alias("dir"), F.col("o_orderkey").alias("name"), "o_orderstatus")
    return V.covered_directories(entries.select("dir", "name"), entries.filter("o_orderstatus <> 'P'"))


@query("SELECT o_custkey, arg_max(v, (a, b)) AS version, count(DISTINCT v) > 1 AS conflict FROM (SELECT o_custkey, o_orderkey % 13 AS a, o_orderkey % 3 AS b, (o_orderkey % 13) || '.' || (o_orderkey % 3) AS v FROM orders) GROUP BY 1")
def template_version(spark: SparkSession, d: str) -> DataFrame:
    """Versions from 0.0 to 12.2: 10.0 is later than 9.0."""
    version = F.concat_ws(".", (F.col("o_orderkey") % 13).cast("string"), (F.col("o_orderkey") % 3).cast("string"))
    return V.latest_version(table(spark, d, "orders").select("o_custkey", version.alias("version")), "o_custkey", "version")


@query("""SELECT n_nationkey AS nation, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS customers_count, (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey) AS suppliers_count,
(SELECT count(*) FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey = n_nationkey AND o_orderstatus = 'P') AS pending_count FROM nation""")
def derive_counts(spark: SparkSession, d: str) -> DataFrame:
    """Each nation's customers, suppliers and pending orders, counted."""
    customer = table(spark, d, "customer")
    pending = table(spark, d, "orders").filter("o_orderstatus = 'P'").join(customer, F.col("o_custkey") == F.col("c_custkey"))
    nations = table(spark, d, "nation").select(F.col("n_nationkey").alias("nation"))
    return V.entity_counts(nations, "nation", {"customers": customer.select(F.col("c_nationkey").alias("nation")), "suppliers": table(spark, d, "supplier").select(F.col("s_nationkey").alias("nation")), "pending": pending.select(F.col("c_nationkey").alias("nation"))})


@query("SELECT p_brand AS brand, string_agg(DISTINCT w, ',' ORDER BY w) AS words FROM (SELECT p_brand, unnest(string_split(p_name, ' ')) AS w FROM part) GROUP BY 1")
def derive_distinct(spark: SparkSession, d: str) -> DataFrame:
    """The different words in the names of each brand's parts, in order."""
    words = table(spark, d, "part").select(F.col("p_brand").alias("brand"), F.split("p_name", " ").alias("words"))
    return V.distinct_over(words, "brand", "words").select("brand", F.array_join("words", ",").alias("words"))


@query("SELECT p_partkey, CASE WHEN p_size > 10 THEN p_name || ' ' ELSE '' END || p_type || CASE WHEN p_size % 2 = 0 THEN ' ' || p_brand ELSE '' END AS study FROM part")
def derive_study(spark: SparkSession, d: str) -> DataFrame:
    """Texts of three parts, of which some are null or blank."""
    size = F.col("p_size")
    return table(spark, d, "part").select("p_partkey", V.study_text(F.when(size > 10, F.concat(F.lit(" "), "p_name")), F.col("p_type"), F.when(size % 2 == 0, F.col("p_brand")).otherwise("  ")).alias("study"))


@query("SELECT o_custkey, string_agg('p/' || o_orderkey, ',' ORDER BY o_orderkey) AS protocols FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 50000 GROUP BY 1")
def derive_protocols(spark: SparkSession, d: str) -> DataFrame:
    """A customer's orders as related identifiers: filled ones are protocols, and those of a low price have no type."""
    one = F.struct(F.col("o_orderkey").alias("n"), F.concat(F.lit("p/"), F.col("o_orderkey").cast("string")).alias("identifier"), F.when(F.col("o_orderstatus") == "F", "HasProtocol").otherwise("IsCitedBy").alias("relation"), F.when(F.col("o_totalprice") > 50000, "URL").alias("type"))
    related = table(spark, d, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(one)).alias("related"))
    return related.select("o_custkey", F.array_join(V.related_protocols(F.col("related")), ",").alias("protocols")).filter("protocols <> ''")


@query("""SELECT c_custkey AS award, coalesce(CASE WHEN c_custkey % 5 = 0 THEN c_mktsegment END, (SELECT min(s_name) FROM supplier WHERE s_suppkey = c_custkey)) AS organ, coalesce(c_custkey % 5 = 0 AND c_mktsegment IS NOT NULL, false) AS override FROM customer""")
def derive_award_organs(spark: SparkSession, d: str) -> DataFrame:
    """Customers as awards: suppliers of the same key are the source, segments of every fifth are given by hand."""
    customer = table(spark, d, "customer").withColumn("award", F.col("c_custkey"))
    sourced = table(spark, d, "supplier").select(F.col("s_suppkey").alias("award"), F.col("s_name").alias("organ"))
    return V.award_organs(customer.select("award"), sourced, customer.filter("award % 5 = 0").select("award", F.col("c_mktsegment").alias("organ")))
