"""Rules as data, compiled to boolean columns; violations as rows, rolled up."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """kind: required, type, enum, pattern, minimum, maximum, min_length, max_length, min_items, all_of, any_of, one_of, not_. when: an SQL condition that must hold for the rule to apply."""

    name: str
    path: str
    kind: str
    argument: object = None
    stage: str = "input"
    blame: str = "submission"
    when: str | None = None


def holds(rule: Rule) -> Column:
    """Whether a row satisfies the rule; a null value violates required only."""
    value, a = F.col(rule.path) if rule.path else F.lit(None), rule.argument
    inner = [holds(r) for r in a] if rule.kind in ("all_of", "any_of", "one_of") else []
    simple = {
        "required": lambda: value.isNotNull(),
        "type": lambda: value.cast("string").try_cast(a).isNotNull(),
        "enum": lambda: value.isin(*a),
        "pattern": lambda: value.rlike(a),
        "minimum": lambda: value >= a,
        "maximum": lambda: value <= a,
        "min_length": lambda: F.char_length(value) >= a,
        "max_length": lambda: F.char_length(value) <= a,
        "min_items": lambda: F.size(value) >= a,
        "all_of": lambda: reduce(Column.__and__, inner),
        "any_of": lambda: reduce(Column.__or__, inner),
        "one_of": lambda: reduce(Column.__add__, [c.cast("int") for c in inner]) == 1,
        "not_": lambda: ~holds(a),
    }[rule.kind]()
    met = simple if rule.kind == "required" or not rule.path else value.isNull() | simple
    met = F.coalesce(met, F.lit(True))
    return met if rule.when is None else ~F.coalesce(F.expr(rule.when), F.lit(False)) | met


def violations(rows: DataFrame, keys: Sequence[str], rules: Sequence[Rule]) -> DataFrame:
    """keys, rule, stage, blame, path, kind: a row for each rule that a row violates. One pass, whatever the number of rules."""
    each = [F.when(~holds(r), F.struct(F.lit(r.name).alias("rule"), F.lit(r.stage).alias("stage"), F.lit(r.blame).alias("blame"), F.lit(r.path).alias("path"), F.lit(r.kind).alias("kind"))) for r in rules]
    found = rows.select(*keys, F.filter(F.array(*each), lambda x: x.isNotNull()).alias("found"))
    return found.select(*keys, F.explode("found").alias("v")).select(*keys, "v.*")


def condense_stages(errors: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Errors that are equal but for the stage become one, with the sorted stages and the count."""
    return errors.groupBy(*keys).agg(F.array_sort(F.collect_set("stage")).alias("stages"), F.count("*").alias("total"))


def invariant(path: Column) -> Column:
    """A path of struct(key, idx), rendered as a pointer in which every list index is -1."""
    return F.concat(F.lit("#/"), F.array_join(F.transform(path, lambda p: F.when(p["idx"].isNotNull(), "-1").otherwise(p["key"])), "/"))


def compact(errors: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of each invariant path one row: the first list index's distinct values, sorted, and the number of errors."""
    first = F.get(F.filter("path", lambda p: p["idx"].isNotNull()), F.lit(0))["idx"]
    return errors.withColumn("pointer", invariant(F.col("path"))).withColumn("first", first).groupBy(*keys, "pointer").agg(F.array_sort(F.collect_set("first")).alias("indexes"), F.count("*").alias("total_errors"))


#: Which index an error counts in, by its blame.
BLAME = {"submission": "si", "pipeline": "ci", "debug": "ci", "EVERYONE": "both"}


def score(errors: DataFrame, key: str) -> DataFrame:
    """key, si, ci, unclassified, ei: errors by the side they are charged to; each error counts once in ei, one for everyone in both of the others."""
    side = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for p in BLAME.items() for x in p)), F.col("blame")), F.lit("none"))
    of = errors.withColumn("side", side).groupBy(key)
    return of.agg(F.count_if(F.col("side").isin("si", "both")).alias("si"), F.count_if(F.col("side").isin("ci", "both")).alias("ci"), F.count_if(F.col("side") == "none").alias("unclassified"), F.count("*").alias("ei"))


def distinct_errors(errors: DataFrame) -> DataFrame:
    """Each error once: error, stage, blame, path and json_path (those of them that there are) make it one."""
    return errors.dropDuplicates([c for c in ("error", "rule", "stage", "blame", "path", "json_path") if c in errors.columns])


def drop_shadowed(errors: DataFrame, shadows: Mapping[str, str], keys: Sequence[str]) -> DataFrame:
    """errors without those of a stage whose errors at the same keys another stage has too. shadows: stage to the stage that counts instead."""
    table = F.create_map(*(F.lit(x) for p in shadows.items() for x in p))
    by = errors.select(*keys, F.col("stage").alias("_by")).distinct()
    marked = errors.withColumn("_by", F.try_element_at(table, F.col("stage")))
    return marked.filter("_by IS NULL").unionByName(marked.filter("_by IS NOT NULL").join(by, [*keys, "_by"], "left_anti")).drop("_by")


def prefixed(path: Column, *prefix: str) -> Column:
    """An error's path (array of text) below the place where its part of the document stands."""
    return F.concat(F.array(*map(F.lit, prefix)), path)


#: The indexes of what was skipped.
SKIPPED = {"si": 5555, "ci": 4444, "ei": 9999}


def mark_skipped(scores: DataFrame, skipped: Column) -> DataFrame:
    """scores with the indexes of skipped rows set so high that they sort last."""
    return scores.select(*(F.when(skipped, F.lit(SKIPPED[c]).cast(kind)).otherwise(F.col(c)).alias(c) if c in SKIPPED else F.col(c) for c, kind in scores.dtypes))


def expand_stages(stages: Sequence[str], parents: Mapping[str, str]) -> list[str]:
    """The stages and all that descend from them. parents: stage to the stage it is made from."""
    found = list(stages)
    while more := [s for s, p in parents.items() if p in found and s not in found]:
        found += more
    return found


def file_checks(paths: DataFrame) -> DataFrame:
    """paths: path. Returns stem, suffixes, missing: of files under source and primary, what stands beside an archive or an image and what should.

    An archive needs an image and an image an archive; where both are there, .tif, .tiff, .gci and .ktf are wanted.
    """
    name = F.substring_index("path", "/", -1)
    stem = F.regexp_replace(F.regexp_extract(name, r"^[^.]+", 0), "(_sgc_.*|(_th)?_th_s)$", "")
    suffix = F.regexp_replace(F.substring(name, F.char_length(F.regexp_extract(name, r"^[^.]+", 0)) + 1, F.char_length(name)), r"^\.tar\.gz$", ".tar")
    some = paths.filter(F.substring_index("path", "/", 1).isin("source", "primary") & ~F.col("path").contains("/old_ihc/"))
    of = some.groupBy(stem.alias("stem")).agg(F.array_sort(F.collect_set(suffix)).alias("suffixes"))
    has = lambda s: F.array_contains("suffixes", s)
    image, archive = has(".tif") | has(".tiff"), has(".tar")
    whole = image & archive
    wanted = [F.when(archive & ~image, "image"), F.when(image & ~archive, "archive"), F.when(image & ~has(".tif"), ".tif"), F.when(image & ~has(".tiff"), ".tiff"), F.when(whole & ~has(".gci"), ".gci"), F.when(whole & ~has(".ktf"), ".ktf")]
    return of.withColumn("missing", F.array_compact(F.array(*wanted)))
