"""Queries: structure reconciliation. Orders are samples of their customers, who are subjects; line items are directories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import structure as S
from ..sources.tables import table
from .registry import query


def _id(kind: str, key: str):
    return F.concat(F.lit(f"{kind}-"), F.col(key).cast("string"))


def entities(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    return o.select(_id("sam", "o_orderkey").alias("entity_id"), F.lit("sample").alias("kind"), (F.col("o_orderkey") % 5 == 0).alias("metadata_only"))


def dirs(spark: SparkSession, d: str) -> DataFrame:
    """A directory for each order of status F, under its customer's, some of them misspelt; and the folders of the first level."""
    o = table(spark, d, "orders").filter("o_orderstatus = 'F'")
    name = F.when(F.col("o_orderkey") % 11 == 0, F.concat(_id("sam", "o_orderkey"), F.lit("x"))).otherwise(_id("sam", "o_orderkey"))
    return o.select(F.concat_ws("/", F.lit("primary"), _id("sub", "o_custkey"), name).alias("path")).union(spark.createDataFrame([(t,) for t in S.TOP], "path string"))


def manifest(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").filter("o_orderkey % 13 = 0")
    return o.select(_id("sam", "o_orderkey").alias("entity_id"), F.concat_ws("/", F.lit("primary"), _id("sub", "o_custkey"), F.concat(_id("sam", "o_orderkey"), F.lit("x"))).alias("path"))


_HAS = "o_orderstatus = 'F' AND o_orderkey % 11 <> 0"


@query("SELECT 'sam-' || o_orderkey || CASE WHEN o_orderkey % 11 = 0 THEN 'x' ELSE '' END AS name, 'primary/sub-' || o_custkey || '/sam-' || o_orderkey || CASE WHEN o_orderkey % 11 = 0 THEN 'x' ELSE '' END AS path FROM orders WHERE o_orderstatus = 'F'")
def recon_dirs(spark: SparkSession, d: str) -> DataFrame:
    return S.directories_by_name(dirs(spark, d))


@query(f"SELECT 'sam-' || o_orderkey AS entity_id FROM orders WHERE o_orderkey % 5 <> 0 AND o_orderkey % 13 <> 0 AND NOT ({_HAS})")
def recon_no_dir(spark: SparkSession, d: str) -> DataFrame:
    return S.without_directory(entities(spark, d), dirs(spark, d), manifest(spark, d)).select("entity_id")


@query(f"SELECT 'sam-' || o_orderkey AS entity_id FROM orders WHERE o_orderkey % 5 = 0 AND (o_orderkey % 13 = 0 OR ({_HAS}))")
def recon_metadata_only(spark: SparkSession, d: str) -> DataFrame:
    return S.not_only_metadata(entities(spark, d), dirs(spark, d), manifest(spark, d)).select("entity_id")


@query(f"SELECT 'pop-' || o_custkey AS pool_id, 'sam-' || o_orderkey AS entity_id FROM orders WHERE o_custkey % 4 = 0 AND {_HAS}")
def recon_pools(spark: SparkSession, d: str) -> DataFrame:
    members = table(spark, d, "orders").select(_id("sam", "o_orderkey").alias("entity_id"), F.when(F.col("o_custkey") % 4 == 0, _id("pop", "o_custkey")).alias("pool_id"))
    return S.pooled_with_directory(members, dirs(spark, d))


@query("SELECT l_partkey AS sample_id, count(*) AS n, string_agg(DISTINCT l_suppkey, ',' ORDER BY l_suppkey) AS subjects FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def recon_unique(spark: SparkSession, d: str) -> DataFrame:
    samples = table(spark, d, "lineitem").select(F.col("l_partkey").alias("sample_id"), F.col("l_suppkey").alias("subject_id"))
    return S.repeated_ids(samples).withColumn("subjects", F.array_join("subjects", ","))


@query("SELECT 'sam-' || o_orderkey || 'x' AS name FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 11 = 0 AND o_orderkey % 13 <> 0")
def recon_unknown_dirs(spark: SparkSession, d: str) -> DataFrame:
    out = S.unknown_directories(dirs(spark, d), entities(spark, d), manifest(spark, d))
    return out.filter("name LIKE 'sam%'").select("name")


@query("SELECT 'sam-' || o_orderkey AS entity_id, 'sam-' || o_orderkey || 'x' AS name FROM orders WHERE o_orderkey % 13 = 0")
def recon_misnamed(spark: SparkSession, d: str) -> DataFrame:
    return S.misnamed_directories(manifest(spark, d)).select("entity_id", "name")


@query(f"SELECT 'sample' AS type, 'sam-' || o_orderkey AS entity_id, CASE WHEN {_HAS} THEN 'primary/sub-' || o_custkey || '/sam-' || o_orderkey ELSE '' END AS dirs FROM orders")
def recon_records(spark: SparkSession, d: str) -> DataFrame:
    return S.records(entities(spark, d), dirs(spark, d)).withColumn("dirs", F.array_join("dirs", ","))
