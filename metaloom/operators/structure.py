"""Reconciliation of what a dataset declares (subjects, samples, sites, pools, manifests) with the directories it has.

Entities: entity_id, kind, metadata_only (boolean). Directories: path (relative, without a leading slash). Every rule is a
set query and returns rows, none when all is well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Folders of the first level that are no entities.
TOP = ("code", "derivative", "docs", "primary", "protocol", "source")


def directories_by_name(dirs: DataFrame) -> DataFrame:
    """name, path: directories by their last name, without the folders of the first level."""
    parts = F.split("path", "/")
    top = (F.size(parts) == 1) & F.col("path").isin(*TOP)
    return dirs.filter(~top).select(F.substring_index("path", "/", -1).alias("name"), "path")


def pools(members: DataFrame) -> DataFrame:
    """members: entity_id, pool_id (null for none). Returns pool_id, entity_id of those in pools."""
    return members.filter("pool_id IS NOT NULL").select("pool_id", "entity_id").distinct()


def _has(dirs: DataFrame) -> DataFrame:
    return directories_by_name(dirs).select(F.col("name").alias("entity_id")).distinct()


def without_directory(entities: DataFrame, dirs: DataFrame, manifest: DataFrame) -> DataFrame:
    """Entities that have neither a directory nor a row of the manifest (entity_id), unless they are metadata only."""
    some = entities.filter(~F.coalesce("metadata_only", F.lit(False)))
    return some.join(_has(dirs), "entity_id", "left_anti").join(manifest.select("entity_id"), "entity_id", "left_anti")


def not_only_metadata(entities: DataFrame, dirs: DataFrame, manifest: DataFrame) -> DataFrame:
    """Entities that are marked metadata only and yet have a directory or a row of the manifest."""
    found = _has(dirs).union(manifest.select("entity_id")).distinct()
    return entities.filter("metadata_only").join(found, "entity_id", "left_semi")


def pooled_with_directory(members: DataFrame, dirs: DataFrame) -> DataFrame:
    """Members of pools that have directories of their own."""
    return pools(members).join(_has(dirs), "entity_id", "left_semi")


def repeated_ids(samples: DataFrame, version: str = "2.0") -> DataFrame:
    """samples: subject_id, sample_id. From version 2 on, a sample's id must be its own; before, the pair must be. A version that is none counts as not below 2."""
    major = version.split(".")[0].strip()
    keys = ["subject_id", "sample_id"] if major.isdecimal() and int(major) < 2 else ["sample_id"]
    return samples.groupBy(*keys).agg(F.count("*").alias("n"), F.array_sort(F.collect_set("subject_id")).alias("subjects")).filter("n > 1")


def unknown_directories(dirs: DataFrame, entities: DataFrame, manifest: DataFrame) -> DataFrame:
    """Directories whose name is no entity's, without those that a manifest covers (path) and without those above an entity's."""
    named = directories_by_name(dirs)
    known = named.join(entities.select(F.col("entity_id").alias("name")), "name", "left_semi")
    parts = F.split("path", "/")
    above = known.select(F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))).alias("path")).distinct()
    return named.join(above, "path", "left_anti").join(manifest.select("path"), "path", "left_anti")


def misnamed_directories(mapping: DataFrame) -> DataFrame:
    """mapping: entity_id, path. Directories whose name is not that of the entity they stand for."""
    name = F.substring_index("path", "/", -1)
    return mapping.filter(name != F.col("entity_id")).select("entity_id", "path", name.alias("name"))


def records(entities: DataFrame, dirs: DataFrame) -> DataFrame:
    """type, entity_id, dirs: every entity with its directories."""
    found = directories_by_name(dirs).groupBy("name").agg(F.array_sort(F.collect_set("path")).alias("dirs"))
    none = F.array().cast("array<string>")
    return entities.join(found, entities.entity_id == found.name, "left").select(F.col("kind").alias("type"), "entity_id", F.coalesce("dirs", none).alias("dirs"))
