"""Sheets as long tables of cells: file, row, col, value (text). Both axes are alike, so a transposed sheet is a projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import alias


def cells(rows: DataFrame, file: Column, columns: Sequence[str], row: Column) -> DataFrame:
    """A table's values as cells, its column names as row 0. row: the number of a row, from 1."""
    body = rows.select(file.alias("file"), row.cast("bigint").alias("row"), F.posexplode(F.array(*(F.col(c).cast("string") for c in columns))).alias("col", "value"))
    head = rows.select(file.alias("file")).distinct().select("file", F.lit(0).cast("bigint").alias("row"), F.posexplode(F.array(*(F.lit(c) for c in columns))).alias("col", "value"))
    return head.unionByName(body)


def trim_empty(sheet: DataFrame) -> DataFrame:
    """Strips values, drops byte order marks, and leaves out rows and columns that are wholly empty."""
    value = F.trim(F.replace("value", F.lit("\ufeff"), F.lit("")))
    full = sheet.withColumn("value", F.when(value != "", value))
    rows = full.filter("value IS NOT NULL").select("file", "row").distinct()
    cols = full.filter("value IS NOT NULL").select("file", "col").distinct()
    return full.join(rows, ["file", "row"], "left_semi").join(cols, ["file", "col"], "left_semi")


def transpose(sheet: DataFrame) -> DataFrame:
    return sheet.select("file", F.col("col").cast("bigint").alias("row"), F.col("row").cast("int").alias("col"), "value")


def headers(sheet: DataFrame, aliases: Mapping[str, str] | None = None) -> DataFrame:
    """file, col, name, original: normalised names; an empty one is TEMPH_<col>, and one met before gets _PREFIX_<col>."""
    plain = F.regexp_replace(F.trim(F.lower(F.regexp_replace("value", r"[^\p{L}\p{N}]+", " "))), " ", "_")
    named = alias(plain, aliases) if aliases else plain
    name = F.when(F.coalesce(named, F.lit("")) == "", F.concat(F.lit("TEMPH_"), F.col("col").cast("string"))).otherwise(named)
    first = sheet.filter("row = 0").select("file", "col", name.alias("name"), F.col("value").alias("original"))
    n = F.row_number().over(Window.partitionBy("file", "name").orderBy("col"))
    return first.withColumn("name", F.when(n > 1, F.concat("name", F.lit("_PREFIX_"), F.col("col").cast("string"))).otherwise(F.col("name")))


def header_errors(sheet: DataFrame, other_axis: DataFrame | None = None) -> DataFrame:
    """file, message: all problems of a file's header in one: nulls, duplicates and names that are on both axes."""
    head = sheet.filter("row = 0")
    at = F.concat(F.lit("R1C"), (F.col("col") + 1).cast("string"))
    nulls = head.filter("value IS NULL").select("file", F.concat(F.lit("null at "), at).alias("m"))
    twice = head.filter("value IS NOT NULL").groupBy("file", "value").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list(at)), ",").alias("at")).filter("n > 1")
    found = nulls.unionByName(twice.select("file", F.concat(F.lit("duplicate "), "value", F.lit(" at "), "at").alias("m")))
    if other_axis is not None:
        both = head.select("file", "value").distinct().join(other_axis.filter("row = 0").select("file", "value").distinct(), ["file", "value"])
        found = found.unionByName(both.select("file", F.concat(F.lit("on both axes: "), "value").alias("m")))
    return found.groupBy("file").agg(F.array_join(F.array_sort(F.collect_list("m")), "; ").alias("message"))


def records(sheet: DataFrame, names: DataFrame) -> DataFrame:
    """file, row, attrs (map of name to value): rows under their header; empty values are left out."""
    body = sheet.filter("row > 0 AND value IS NOT NULL").join(names.select("file", "col", "name"), ["file", "col"])
    return body.groupBy("file", "row").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "value")))).alias("attrs"))


def composite_key(attrs: Column, parts: Sequence[str], row: Column) -> Column:
    """The parts joined by _; ERROR-KEY-<row> where one is missing."""
    values = [F.try_element_at(attrs, F.lit(p)) for p in parts]
    whole = F.concat_ws("_", *values)
    bad = F.array_contains(F.array(*(v.isNull() for v in values)), True)
    return F.when(bad, F.concat(F.lit("ERROR-KEY-"), row.cast("string"))).otherwise(whole)


def add_missing(sheet: DataFrame, names: DataFrame, required: Mapping[str, str]) -> DataFrame:
    """file, name, value: required names that a file's header lacks, with their defaults."""
    wanted = names.select("file").distinct().select("file", F.explode(F.create_map(*(F.lit(x) for p in required.items() for x in p))).alias("name", "value"))
    return wanted.join(names.select("file", "name"), ["file", "name"], "left_anti")


def group(attrs: Column, groups: Mapping[str, Sequence[str]], rest: str | None = None) -> Column:
    """attrs (map) as a map of group to map: each name in the group that claims it; the others in the group rest, or under their own names."""
    claimed = [n for names in groups.values() for n in names]
    parts = []
    for g, names in groups.items():
        parts.append(F.struct(F.lit(g).alias("key"), _only(attrs, names, True).alias("value")))
    if rest is not None:
        parts.append(F.struct(F.lit(rest).alias("key"), _only(attrs, claimed, False).alias("value")))
    return F.map_from_entries(F.filter(F.array(*parts), lambda p: F.cardinality(p["value"]) > 0))


def _only(attrs: Column, names: Sequence[str], inside: bool) -> Column:
    return F.map_filter(attrs, lambda k, v: k.isin(*names) if inside else ~k.isin(*names))


def drop_examples(rows: DataFrame, examples: DataFrame) -> DataFrame:
    """rows whose attrs are not those of a template's example row."""
    same = lambda df: df.withColumn("_a", F.array_sort(F.map_entries("attrs")))
    return same(rows).join(same(examples).select("_a"), "_a", "left_anti").drop("_a")


def condense(values: Column, single: bool) -> Column:
    """An array's distinct values; the one value as such (as text) where a name takes a single one and there is one."""
    found = F.array_distinct(F.filter(values, lambda v: v.isNotNull() & (v != "")))
    return F.struct(F.when((F.size(found) == 1) & F.lit(single), F.get(found, F.lit(0))).alias("one"), F.when((F.size(found) > 1) | ~F.lit(single), found).alias("many"))
