"""Queries: rules over orders, and what is made of their violations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import constraints as V
from ..operators.constraints import Rule
from ..operators.relational import numbered
from ..sources.tables import table
from .registry import query

RULES = [
    Rule("price_high", "o_totalprice", "maximum", 400000.0, "input", "submission"),
    Rule("priority_known", "o_orderpriority", "enum", ("1-URGENT", "2-HIGH", "3-MEDIUM"), "curation", "pipeline"),
    Rule("status_pattern", "o_orderstatus", "pattern", "^[OF]$", "input", "EVERYONE"),
    Rule("price_low_if_open", "o_totalprice", "minimum", 50000.0, "output", "remote", "o_orderstatus = 'O'"),
    Rule("status_again", "o_orderstatus", "pattern", "^[OF]$", "output", "EVERYONE"),
]
#: The same rules in SQL: name, stage, blame, path, kind, and the condition of a violation.
_SQL = """
v AS (SELECT o_orderkey, o_custkey, r.* FROM orders, LATERAL (SELECT * FROM (VALUES
 ('price_high', 'input', 'submission', 'o_totalprice', 'maximum', o_totalprice > 400000),
 ('priority_known', 'curation', 'pipeline', 'o_orderpriority', 'enum', o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')),
 ('status_pattern', 'input', 'EVERYONE', 'o_orderstatus', 'pattern', o_orderstatus NOT IN ('O', 'F')),
 ('price_low_if_open', 'output', 'remote', 'o_totalprice', 'minimum', o_orderstatus = 'O' AND o_totalprice < 50000),
 ('status_again', 'output', 'EVERYONE', 'o_orderstatus', 'pattern', o_orderstatus NOT IN ('O', 'F'))) t(rule, stage, blame, path, kind, bad) WHERE bad) r)"""


def order_errors(spark: SparkSession, d: str) -> DataFrame:
    return V.violations(table(spark, d, "orders"), ["o_orderkey", "o_custkey"], RULES)


@query(f"WITH {_SQL} SELECT o_orderkey, rule, stage, blame, path, kind FROM v")
def rule_violations(spark: SparkSession, d: str) -> DataFrame:
    return order_errors(spark, d).drop("o_custkey")


@query("SELECT p_partkey FROM part WHERE NOT ((p_size < 20)::INT + (p_retailprice < 1200)::INT + (p_brand = 'Brand#11')::INT = 1)")
def one_of(spark: SparkSession, d: str) -> DataFrame:
    """Parts that satisfy none or several of three rules."""
    rules = [Rule("small", "p_size", "maximum", 19), Rule("cheap", "p_retailprice", "not_", Rule("dear", "p_retailprice", "minimum", 1200.0)), Rule("first", "p_brand", "enum", ("Brand#11",))]
    return V.violations(table(spark, d, "part"), ["p_partkey"], [Rule("exactly_one", "", "one_of", rules)]).select("p_partkey")


@query(f"WITH {_SQL} SELECT o_orderkey, path, kind, string_agg(DISTINCT stage, ',' ORDER BY stage) AS stages, count(*) AS total FROM v GROUP BY ALL")
def error_condense(spark: SparkSession, d: str) -> DataFrame:
    out = V.condense_stages(order_errors(spark, d), ["o_orderkey", "path", "kind"])
    return out.withColumn("stages", F.array_join("stages", ","))


def line_errors(spark: SparkSession, d: str) -> DataFrame:
    """Errors of order lines, under paths lines/<index>/field; a line can have both."""
    fields = F.array_compact(F.array(F.when(F.col("l_quantity") > 48, "l_quantity"), F.when(F.col("l_discount") > 0.09, "l_discount")))
    x = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber", F.explode(fields).alias("field"))
    part = lambda key, idx: F.struct(key.cast("string").alias("key"), idx.cast("int").alias("idx"))
    none = F.lit(None)
    return x.select("l_orderkey", "l_suppkey", F.array(part(F.lit("lines"), none), part(none, F.col("l_linenumber")), part(F.col("field"), none)).alias("path"))


_LINES = "x AS (SELECT l_orderkey, l_suppkey, l_linenumber, 'l_quantity' AS field FROM lineitem WHERE l_quantity > 48 UNION ALL SELECT l_orderkey, l_suppkey, l_linenumber, 'l_discount' FROM lineitem WHERE l_discount > 0.09)"


@query(f"WITH {_LINES} SELECT '#/lines/-1/' || field AS pointer, count(*) AS n, count(DISTINCT l_orderkey) AS n_orders FROM x GROUP BY 1")
def path_report(spark: SparkSession, d: str) -> DataFrame:
    e = line_errors(spark, d).withColumn("pointer", V.invariant(F.col("path")))
    return e.groupBy("pointer").agg(F.count("*").alias("n"), F.countDistinct("l_orderkey").alias("n_orders"))


@query(f"WITH {_LINES} SELECT l_orderkey, '#/lines/-1/' || field AS pointer, string_agg(DISTINCT l_linenumber::VARCHAR, ',' ORDER BY l_linenumber::VARCHAR) AS indexes, count(*) AS total_errors FROM x GROUP BY 1, 2")
def error_compact(spark: SparkSession, d: str) -> DataFrame:
    return V.compact(line_errors(spark, d), ["l_orderkey"]).withColumn("indexes", F.array_join(F.array_sort(F.col("indexes").cast("array<string>")), ","))


_SCORE = f"""{_SQL},
s AS (SELECT o_custkey, count(*) FILTER (blame IN ('submission', 'EVERYONE')) AS si, count(*) FILTER (blame IN ('pipeline', 'debug', 'EVERYONE')) AS ci,
count(*) FILTER (blame NOT IN ('submission', 'pipeline', 'debug', 'EVERYONE')) AS unclassified, count(*) AS ei FROM v GROUP BY o_custkey)"""


@query(f"WITH {_SCORE} SELECT * FROM s")
def blame_score(spark: SparkSession, d: str) -> DataFrame:
    return V.score(order_errors(spark, d), "o_custkey")


@query(f"""WITH {_SCORE} SELECT row_number() OVER (ORDER BY si, ci, c_mktsegment NULLS LAST, c_name) AS n, c_name, c_mktsegment, coalesce(si, 0) AS si, coalesce(ci, 0) AS ci, coalesce(ei, 0) AS ei
FROM (SELECT c_name, c_mktsegment, coalesce(si, 0) AS si, coalesce(ci, 0) AS ci, ei FROM customer LEFT JOIN s ON c_custkey = o_custkey)""")
def completeness(spark: SparkSession, d: str) -> DataFrame:
    """All customers by submission and curation errors, segment and name, with their row numbers."""
    scores, c = V.score(order_errors(spark, d), "o_custkey"), table(spark, d, "customer")
    zero = lambda x: F.coalesce(x, F.lit(0)).alias(x)
    rows = c.join(scores, c.c_custkey == scores.o_custkey, "left").select("c_name", "c_mktsegment", zero("si"), zero("ci"), zero("ei"))
    return numbered(rows, ["si", "ci", F.asc_nulls_last("c_mktsegment"), "c_name"])


@query(r"""SELECT source, lang, count(*) AS n, count(*) FILTER (n_chars < 500) AS n_short, count(*) FILTER (contains(text, chr(10))) AS n_lined,
count(*) FILTER (n_chars < 500) > 0 AND count(*) FILTER (contains(text, chr(10))) = 0 AS suspicious FROM documents GROUP BY source, lang""")
def file_qc(spark: SparkSession, d: str) -> DataFrame:
    """Per group, which kinds are there and which are missing."""
    x = table(spark, d, "documents").groupBy("source", "lang")
    x = x.agg(F.count("*").alias("n"), F.count_if(F.col("n_chars") < 500).alias("n_short"), F.count_if(F.col("text").contains("\n")).alias("n_lined"))
    return x.withColumn("suspicious", (F.col("n_short") > 0) & (F.col("n_lined") == 0))


@query("SELECT md5(text) AS digest, count(*) AS n, min(doc_id) AS first_doc FROM documents GROUP BY 1 HAVING count(*) > 1")
def dup_subjects(spark: SparkSession, d: str) -> DataFrame:
    """Texts that several documents have."""
    return table(spark, d, "documents").groupBy(F.md5("text").alias("digest")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc")).filter("n > 1")


@query(f"WITH {_SQL} SELECT DISTINCT o_orderkey, rule, stage, blame, path FROM v WHERE NOT (stage = 'output' AND EXISTS (SELECT 1 FROM v w WHERE w.o_orderkey = v.o_orderkey AND w.path = v.path AND w.stage = 'input'))")
def shadowed_stages(spark: SparkSession, d: str) -> DataFrame:
    """Errors once each, without those of the output that the input has had at the same place."""
    e = order_errors(spark, d).select("o_orderkey", "rule", "stage", "blame", "path")
    return V.drop_shadowed(e, {"output": "input"}, ["o_orderkey", "path"])


@query(f"WITH {_SCORE} SELECT o_custkey, CASE WHEN o_custkey % 10 = 0 THEN 5555 ELSE si END AS si, CASE WHEN o_custkey % 10 = 0 THEN 4444 ELSE ci END AS ci, CASE WHEN o_custkey % 10 = 0 THEN 9999 ELSE ei END AS ei FROM s")
def skip_sentinel(spark: SparkSession, d: str) -> DataFrame:
    return V.mark_skipped(V.score(order_errors(spark, d), "o_custkey"), F.col("o_custkey") % 10 == 0).drop("unclassified")


_PATHS = """p AS (SELECT l_orderkey AS k, ['.tar', '.tif', '.tiff', '.gci', '.ktf', '.txt', '.tar'][(l_linenumber - 1) % 7 + 1] AS s FROM lineitem)"""


@query(f"""WITH {_PATHS}, g AS (SELECT k, list_sort(list_distinct(list(s))) AS s FROM p GROUP BY k),
h AS (SELECT k, s, list_contains(s, '.tif') OR list_contains(s, '.tiff') AS image, list_contains(s, '.tar') AS archive FROM g)
SELECT 'o' || k AS stem, array_to_string(s, ',') AS suffixes, concat_ws(',', CASE WHEN archive AND NOT image THEN 'image' END, CASE WHEN image AND NOT archive THEN 'archive' END, CASE WHEN image AND NOT list_contains(s, '.tif') THEN '.tif' END,
CASE WHEN image AND NOT list_contains(s, '.tiff') THEN '.tiff' END, CASE WHEN image AND archive AND NOT list_contains(s, '.gci') THEN '.gci' END, CASE WHEN image AND archive AND NOT list_contains(s, '.ktf') THEN '.ktf' END) AS missing FROM h""")
def file_suffixes(spark: SparkSession, d: str) -> DataFrame:
    """Archives, images and what belongs to them: an order's lines as files."""
    suffix = F.element_at(F.array(*map(F.lit, (".tar.gz", ".tif", ".tiff", ".gci", ".ktf", ".txt", ".tar"))), (F.col("l_linenumber") - 1) % 7 + 1)
    tail = F.when(F.col("l_linenumber") == 2, "_th_s").when(F.col("l_linenumber") == 3, "_sgc_1").otherwise("")
    path = F.concat(F.when(F.col("l_linenumber") % 2 == 0, "primary/a/").otherwise("source/a/"), F.lit("o"), F.col("l_orderkey").cast("string"), tail, suffix)
    out = V.file_checks(table(spark, d, "lineitem").select(path.alias("path")))
    return out.select("stem", F.array_join("suffixes", ",").alias("suffixes"), F.array_join("missing", ",").alias("missing"))


@query(f"WITH {_SQL} SELECT DISTINCT o_orderkey, path, blame FROM v")
def error_set(spark: SparkSession, d: str) -> DataFrame:
    """Errors with set semantics, whatever stage or rule found them."""
    e = order_errors(spark, d).select("path", "blame", F.col("o_orderkey").cast("string").alias("error"))
    return V.distinct_errors(e).select(F.col("error").cast("bigint").alias("o_orderkey"), "path", "blame")
