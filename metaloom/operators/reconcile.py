"""Set queries between what is declared and what is there."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def missing(refs: DataFrame, entities: DataFrame, key: str) -> DataFrame:
    """Distinct references to keys that entities don't have."""
    return refs.select(key).distinct().join(entities.select(key), key, "left_anti")


def double_mapped(a: DataFrame, b: DataFrame, key: str, target: str) -> DataFrame:
    """Keys that two sources map to different targets: key, left, right."""
    x, y = a.select(key, F.col(target).alias("left")).distinct(), b.select(key, F.col(target).alias("right")).distinct()
    return x.join(y, key).filter("left <> right")


def by_source(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Every key of either source, with a flag for each."""
    x, y = a.select(key, F.lit(True).alias("in_first")).distinct(), b.select(key, F.lit(True).alias("in_second")).distinct()
    return x.join(y, key, "full").select(key, F.coalesce("in_first", F.lit(False)).alias("in_first"), F.coalesce("in_second", F.lit(False)).alias("in_second"))


def graph_changes(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """key, change: added, removed or changed, between two tables of one row a key."""
    a, b = old.select(key, F.col(value).alias("a"), F.lit(1).alias("in_a")), new.select(key, F.col(value).alias("b"), F.lit(1).alias("in_b"))
    change = F.when(F.col("in_a").isNull(), "added").when(F.col("in_b").isNull(), "removed").when(~F.col("a").eqNullSafe(F.col("b")), "changed")
    return a.join(b, key, "full").select(key, change.alias("change")).filter("change IS NOT NULL")
