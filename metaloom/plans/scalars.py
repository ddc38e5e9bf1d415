"""Queries: scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as N
from ..sources.tables import table
from .registry import query

_PREFIXES = {"part": "https://example.org/part/", "brand": "https://example.org/part/brand/"}


@query("SELECT c_custkey, CASE WHEN contains(n, ',') THEN split_part(n, ', ', 1) ELSE split_part(n, ' ', 2) END AS last, CASE WHEN contains(n, ',') THEN split_part(n, ', ', 2) ELSE split_part(n, ' ', 1) END AS first FROM (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment || ', ' || c_name ELSE c_name || ' ' || c_mktsegment END AS n FROM customer)")
def name_split(spark: SparkSession, d: str) -> DataFrame:
    name = F.when(F.col("c_custkey") % 2 == 0, F.concat("c_mktsegment", F.lit(", "), "c_name")).otherwise(F.concat("c_name", F.lit(" "), "c_mktsegment"))
    return table(spark, d, "customer").select("c_custkey", N.split_name(name).alias("n")).select("c_custkey", "n.last", "n.first")


@query("""SELECT p_partkey, array_to_string(list_sort(list_distinct(list_filter(list_transform(string_split(p_type || sep || p_brand || sep || ' ' || p_type || ' ', sep), lambda x: trim(x)), lambda x: x <> ''))), '/') AS parts
FROM (SELECT *, ['|', ';', ','][1 + p_partkey % 3] AS sep FROM part)""")
def multi_sep_split(spark: SparkSession, d: str) -> DataFrame:
    sep = F.element_at(F.array(F.lit("|"), F.lit(";"), F.lit(",")), (1 + F.col("p_partkey") % 3).cast("int"))
    value = F.concat("p_type", sep, "p_brand", sep, F.lit(" "), "p_type", F.lit(" "))
    return table(spark, d, "part").select("p_partkey", F.array_join(N.multi_split(value), "/").alias("parts"))


@query("SELECT event_id, CASE event_type WHEN 'click' THEN 'interaction' WHEN 'view' THEN 'impression' ELSE event_type END AS kind FROM events")
def alias_map(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", N.alias(F.col("event_type"), {"click": "interaction", "view": "impression"}).alias("kind"))


@query("SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN NULL ELSE p_brand END AS brand FROM part")
def na_drop(spark: SparkSession, d: str) -> DataFrame:
    given = F.when(F.col("p_size") % 8 == 0, "n/a").when(F.col("p_size") % 4 == 0, " NA ").otherwise(F.col("p_brand"))
    return table(spark, d, "part").select("p_partkey", N.drop_na(given).alias("brand"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id END AS value, CASE WHEN event_id % 3 = 0 THEN event_type END AS original FROM events")
def try_int(spark: SparkSession, d: str) -> DataFrame:
    given = F.when(F.col("event_id") % 3 == 0, F.col("event_type")).otherwise(F.concat(F.lit(" "), F.col("event_id").cast("string")))
    return table(spark, d, "events").select("event_id", N.try_int(given).alias("n")).select("event_id", "n.value", "n.original")


@query("SELECT page_id, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)', 1)) AS host FROM pages")
def url_host(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", N.url_host(F.col("url")).alias("host"))


@query(r"""SELECT page_id, regexp_extract(html, '<a\s[^>]*href="([^"]*)"', 1) AS href FROM pages""")
def anchor_href(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", N.anchor_href(F.col("html")).alias("href"))


@query(r"""SELECT page_id, trim(regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) AS body FROM pages""")
def html_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", N.html_text(F.col("html")).alias("body"))


@query(r"SELECT doc_id, md5(lower(trim(regexp_replace(translate(text, chr(10) || chr(9) || chr(160), '   '), 'https?://\S+', '', 'g')))) AS cleaned_md5 FROM documents")
def report_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.md5(N.clean_text(F.col("text"))).alias("cleaned_md5"))


@query("SELECT l_orderkey, l_linenumber, l_quantity * f AS value, b AS unit FROM lineitem JOIN (VALUES (0, 7.0, 'day'), (1, 1.0, 'day'), (2, 1000.0, 'g'), (3, 1.0, 'dimensionless')) u(k, f, b) ON l_linenumber % 4 = k")
def quantity_parse(spark: SparkSession, d: str) -> DataFrame:
    """Numbers with units, parsed from text and converted to base units."""
    unit = F.element_at(F.array(F.lit(" weeks"), F.lit("d"), F.lit(" kg"), F.lit("")), F.col("l_linenumber") % 4 + 1)
    parsed = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", N.quantity(F.concat(F.col("l_quantity").cast("string"), unit)).alias("q"))
    return parsed.select("l_orderkey", "l_linenumber", N.to_base(F.col("q.value"), F.col("q.unit")).alias("b")).select("l_orderkey", "l_linenumber", "b.value", "b.unit")


@query("SELECT p_partkey, 'https://example.org/part/' || p_partkey AS iri, 'part:' || p_partkey AS curie FROM part")
def curie(spark: SparkSession, d: str) -> DataFrame:
    short = F.concat(F.lit("part:"), F.col("p_partkey").cast("string"))
    return table(spark, d, "part").select("p_partkey", N.curie_expand(short, _PREFIXES).alias("iri")).withColumn("curie", N.curie_contract(F.col("iri"), _PREFIXES))


@query("SELECT p_partkey, replace(replace(p_name || ' ' || p_brand, ' ', '%20'), '#', '%23') AS quoted FROM part")
def iri_quote(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", N.url_quote(F.concat_ws(" ", "p_name", "p_brand")).alias("quoted"))


@query("SELECT event_id, event_id % 2 = 0 AS valid FROM events")
def orcid_check(spark: SparkSession, d: str) -> DataFrame:
    """Identifiers built with a right check character (even event_id) or a wrong one (odd)."""
    body = F.lpad(F.col("event_id").cast("string"), 15, "0")
    total = F.lit(0)
    for i in range(1, 16):
        total = (total + F.substring(body, i, 1).cast("int")) * 2
    check = (12 - total % 11 + F.col("event_id") % 2) % 11
    return table(spark, d, "events").select("event_id", N.orcid_valid(F.concat(F.lit("https://orcid.org/"), body, F.when(check == 10, "X").otherwise(check.cast("string")))).alias("valid"))


@query("""SELECT doc_id, strlen(text) <= 60 AS whole, (SELECT list_last(list_sort(list_filter(list_transform(range(61), lambda k: text[1:k]), lambda x: strlen(x) <= 60)))) AS short_text FROM documents""")
def truncate_utf8(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", (F.octet_length("text") <= 60).alias("whole"), N.truncate_bytes(F.col("text"), 60).alias("short_text"))
