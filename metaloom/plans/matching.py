"""Queries: names of customers against those of parts by edit distance, and paths of manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import matching as M
from ..sources.tables import table
from .registry import query


def _slips(spark: SparkSession, d: str) -> DataFrame:
    """Names of directories with slips, from customers."""
    k = F.col("c_custkey")
    key = k.cast("string")
    name = F.when(k % 4 == 0, F.concat(F.lit("sub"), key)).when(k % 4 == 1, F.concat(F.lit("sbu-"), key)).when(k % 4 == 2, key).otherwise(F.concat(F.lit("subject-"), key, F.lit("x")))
    return table(spark, d, "customer").select(name.alias("name"))


def _subjects(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select(F.concat(F.lit("sub-"), F.col("p_partkey").cast("string")).alias("name"), F.when(F.col("p_size") > 25, "*").otherwise(" ").alias("source"))


_SLIPS = """a AS (SELECT DISTINCT CASE c_custkey % 4 WHEN 0 THEN 'sub' || c_custkey WHEN 1 THEN 'sbu-' || c_custkey WHEN 2 THEN c_custkey::VARCHAR ELSE 'subject-' || c_custkey || 'x' END AS name FROM customer),
b AS (SELECT 'sub-' || p_partkey AS other, CASE WHEN p_size > 25 THEN '*' ELSE ' ' END AS source FROM part)"""


@query(f"WITH {_SLIPS} SELECT name, other, levenshtein(name, other)::INTEGER AS distance FROM a, b WHERE levenshtein(name, other) <= 2")
def near_names(spark: SparkSession, d: str) -> DataFrame:
    return M.similar(_slips(spark, d), _subjects(spark, d), 2)


@query(f"""WITH {_SLIPS}, c AS (SELECT name, other, source, levenshtein(name, other) AS distance FROM a, b WHERE levenshtein(name, other) <= 1 OR name = regexp_replace(other, '^sub-', ''))
SELECT name, min(distance)::INTEGER AS distance, count(other)::INTEGER AS n, min((lpad(distance::VARCHAR, 3, '0') || other || source)) AS first FROM a LEFT JOIN c USING (name) GROUP BY name""")
def nearest_names(spark: SparkSession, d: str) -> DataFrame:
    """For each directory without an entity, how many names it may be a slip of, and the nearest of these."""
    first = F.get("candidates", F.lit(0))
    text = F.concat(F.lpad(first["distance"].cast("string"), 3, "0"), first["other"], first["source"])
    return M.nearest_names(_slips(spark, d), _subjects(spark, d), 1).select("name", "distance", F.size("candidates").alias("n"), text.alias("first"))


def _manifests(spark: SparkSession, d: str) -> DataFrame:
    """Manifests, one a brand, that speak of parts' files: some twice, some with dots, some outside."""
    k = F.col("p_partkey")
    file = F.concat(F.col("p_name"), F.lit(" "), k.cast("string"), F.lit(".csv"))
    other = F.concat(F.lit("../all/"), F.col("p_type"), F.lit("/./x//y"))
    name = F.when(k % 5 == 0, other).when(k % 5 == 1, F.concat(F.lit("./sub/../"), file)).when(k % 5 == 2, F.lit("../../z")).otherwise(file)
    return table(spark, d, "part").select(F.concat(F.lit("data/"), "p_brand", F.lit("/manifest.csv")).alias("manifest"), k.alias("row"), F.when(k % 35 != 7, name).alias("filename"))


_MANIFEST = """m AS (SELECT 'data/' || p_brand || '/manifest.csv' AS manifest, p_partkey AS row, CASE WHEN p_partkey % 35 = 7 THEN 'data/' || p_brand WHEN p_partkey % 5 = 0 THEN 'data/all/' || p_type || '/x/y' WHEN p_partkey % 5 = 2 THEN 'z'
    ELSE 'data/' || p_brand || '/' || p_name || ' ' || p_partkey || '.csv' END AS target FROM part),
f AS (SELECT target, min({'m': manifest, 'r': row}) AS x FROM m GROUP BY 1)"""


@query(f"WITH {_MANIFEST} SELECT target, x.m AS manifest, x.r AS row FROM f")
def manifest_targets(spark: SparkSession, d: str) -> DataFrame:
    return M.manifest_targets(_manifests(spark, d))[0]


@query(f"WITH {_MANIFEST} SELECT manifest, row, target, 'already described in ' || x.m || ':' || x.r AS message FROM m JOIN f USING (target) WHERE x.m <> manifest OR x.r <> row")
def manifest_conflicts(spark: SparkSession, d: str) -> DataFrame:
    """Paths that more than one row speaks of: all but the first."""
    return M.manifest_targets(_manifests(spark, d))[1]


_FILES = """p AS (SELECT p_brand || '/' || p_name || p_partkey AS path, p_brand AS folder, p_name || p_partkey AS base FROM part),
t AS (SELECT DISTINCT CASE p_partkey % 4 WHEN 0 THEN p_brand || '/' || p_name || 'x' || p_partkey WHEN 1 THEN 'elsewhere/' || p_name || p_partkey ELSE p_brand || '/' || p_name || p_partkey END AS target FROM part),
l AS (SELECT target, split_part(target, '/', 1) AS folder, split_part(target, '/', 2) AS base FROM t WHERE target NOT IN (SELECT path FROM p))"""


@query(f"""WITH {_FILES} SELECT target, coalesce((SELECT string_agg(path, '|' ORDER BY path) FROM p WHERE p.base = l.base), '') AS moved,
coalesce((SELECT string_agg(path, '|' ORDER BY path) FROM p WHERE p.folder = l.folder AND levenshtein(p.base, l.base) <= 1), '') AS misspelt FROM l""")
def missing_files(spark: SparkSession, d: str) -> DataFrame:
    k, name, brand = F.col("p_partkey"), F.col("p_name"), F.col("p_brand")
    key = k.cast("string")
    paths = table(spark, d, "part").select(F.concat(brand, F.lit("/"), name, key).alias("path"))
    target = F.when(k % 4 == 0, F.concat(brand, F.lit("/"), name, F.lit("x"), key)).when(k % 4 == 1, F.concat(F.lit("elsewhere/"), name, key)).otherwise(F.concat(brand, F.lit("/"), name, key))
    out = M.missing_files(table(spark, d, "part").select(target.alias("target")), paths)
    return out.select("target", F.array_join("moved", "|").alias("moved"), F.array_join("misspelt", "|").alias("misspelt"))


def _number(c: str) -> str:
    return f"list_filter(list_distinct(list_transform(regexp_extract_all({c}, '[0-9]+'), lambda n: ltrim(n, '0'))), lambda n: n NOT IN ('', '1'))"


_REFS = f"""r AS (SELECT c_custkey AS ref, CASE c_custkey % 3 WHEN 0 THEN 'scan ' || c_custkey || ' of ' || c_nationkey || '.tif' WHEN 1 THEN 'scan ' || c_custkey || ' at ' || (c_nationkey + 500) || '.tif' ELSE 'slide.tif' END AS name FROM customer),
p AS (SELECT 'd' || p_size % 2 || '/' || CASE WHEN p_partkey % 2 = 0 THEN 'scan ' || p_partkey || ' of ' || p_size || '.tif' WHEN p_partkey % 50 = 1 THEN 'slide.tif' ELSE 'image-' || p_partkey || '.tif' END AS path FROM part),
i AS (SELECT regexp_extract(path, '[^/]+$') AS other, count(DISTINCT path) AS n, min(path) AS path FROM p GROUP BY 1),
x AS (SELECT ref, name, {_number("name")} AS own FROM r), y AS (SELECT other, n, path, {_number("other")} AS theirs FROM i),
j AS (SELECT ref, other, n, path, levenshtein(name, other) AS distance, 1 - coalesce(list_sum(list_transform(list_intersect(own, theirs), lambda v: ln(v::DOUBLE))), 0) / list_sum(list_transform(own, lambda v: ln(v::DOUBLE))) AS similarity
    FROM x, y WHERE name NOT IN (SELECT other FROM i) AND len(own) > 0),
b AS (SELECT * FROM j WHERE similarity <= 0.5000000001 QUALIFY row_number() OVER (PARTITION BY ref ORDER BY round(similarity, 9), distance, other) = 1)"""


@query(f"""WITH {_REFS} SELECT r.ref, coalesce(CASE WHEN i.n = 1 THEN i.path END, CASE WHEN b.n = 1 THEN b.path END) AS path, CASE WHEN i.n = 1 THEN 'exact-pathname-match' WHEN b.n = 1 THEN 'number-similarity' END AS mapped_by,
CASE WHEN i.n = 1 THEN 0 ELSE round(b.similarity, 6) END AS similarity, (CASE WHEN i.n = 1 THEN 0 ELSE b.distance END)::INTEGER AS distance,
CASE WHEN coalesce(i.n, b.n) > 1 THEN 'several paths of that name: ' || coalesce(i.n, b.n) WHEN i.n IS NULL AND b.n IS NULL THEN 'no path of that name' END AS error FROM r LEFT JOIN i ON i.other = r.name LEFT JOIN b ON b.ref = r.ref""")
def path_references(spark: SparkSession, d: str) -> DataFrame:
    """References written on another system, from customers, against the files of parts."""
    k, nation = F.col("c_custkey"), F.col("c_nationkey")
    scan = lambda a, b: F.concat(F.lit("C:\\data\\scan "), k.cast("string"), F.lit(f" {a} "), b.cast("string"), F.lit(".tif"))
    text = F.when(k % 3 == 0, scan("of", nation)).when(k % 3 == 1, scan("at", nation + 500)).otherwise(F.lit("slide.tif"))
    p = F.col("p_partkey")
    name = F.when(p % 2 == 0, F.concat(F.lit("scan "), p.cast("string"), F.lit(" of "), F.col("p_size").cast("string"), F.lit(".tif"))).when(p % 50 == 1, "slide.tif").otherwise(F.concat(F.lit("image-"), p.cast("string"), F.lit(".tif")))
    paths = table(spark, d, "part").select(F.concat(F.lit("d"), (F.col("p_size") % 2).cast("string"), F.lit("/"), name).alias("path"))
    out = M.match_references(table(spark, d, "customer").select(k.alias("ref"), text.alias("text")), paths)
    return out.withColumn("similarity", F.round("similarity", 6))
