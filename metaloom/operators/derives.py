"""Derivations: values of a record made from its other values, or from other records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def scalar_if_one(values: Column) -> Column:
    """struct(one, many): a single value as such, several as a list, none as neither."""
    return F.struct(F.when(F.size(values) == 1, F.get(values, F.lit(0))).alias("one"), F.when(F.size(values) > 1, values).alias("many"))


def with_role(people: Column, role: str, field: str = "roles") -> Column:
    """The people (structs) that have the role, without it."""
    have = F.filter(people, lambda p: F.array_contains(p[field], role))
    return F.transform(have, lambda p: p.withField(field, F.filter(p[field], lambda r: r != role)))


def role_pointers(people: Column, role: str, base: str = "/contributors", field: str = "roles") -> Column:
    """Pointers to the people that have the role, by their place."""
    at = F.transform(people, lambda p, i: F.when(F.array_contains(p[field], role), F.concat(F.lit(f"{base}/"), i.cast("string"))))
    return F.array_compact(at)


def first_given(given: Column, rows: Column, match, value) -> Column:
    """given, or value of the first row (of an array of structs) that matches."""
    return F.coalesce(given, F.get(F.transform(F.filter(rows, match), value), F.lit(0)))


def union_of(*values: Column) -> Column:
    """The sorted distinct values of several arrays; nulls count as empty."""
    empty = F.array().cast("array<string>")
    return F.array_sort(F.array_distinct(F.array_compact(F.concat(*(F.coalesce(v, empty) for v in values)))))


def doi(text: Column) -> Column:
    """The bare DOI of an address, a doi: name or a bare DOI, in lower case; null if there is none."""
    found = F.regexp_extract(F.trim(text), r"(?i)^(?:https?://(?:dx\.)?doi\.org/|doi:\s*)?(10\.[0-9]{4,9}/\S+)$", 1)
    return F.when(found != "", F.lower(found))


def contributor_id(orcid: Column, member: Column, dataset: Column, first: Column, last: Column) -> Column:
    """ORCID, else member id, else an id under the dataset from the name."""
    name = F.concat_ws("-", F.regexp_replace(first, r"\s+", "-"), F.regexp_replace(last, r"\s+", "-"))
    return F.coalesce(orcid, member, F.concat(dataset, F.lit("/contributors/"), name))


def match_longest_key(rows: DataFrame, text: str, keys: DataFrame, key: str, value: str) -> DataFrame:
    """rows with the value of the longest key that text contains as whole words; an exact match is the longest. Null where none is.

    Rows meet keys under the keys' first words, so that not every row is compared with every key.
    """
    words = rows.select(F.col(text).alias("_t")).distinct().withColumn("_w", F.explode(F.array_distinct(F.split("_t", r"\s+"))))
    named = keys.select(F.col(key).alias("_k"), F.col(value).alias("_v")).withColumn("_w", F.element_at(F.split("_k", r"\s+"), 1))
    inside = F.concat(F.lit(" "), "_t", F.lit(" ")).contains(F.concat(F.lit(" "), F.col("_k"), F.lit(" ")))
    best = words.join(named, "_w").filter(inside).groupBy("_t").agg(F.max(F.struct(F.char_length("_k").alias("n"), F.col("_k").alias("k"), F.col("_v").alias("v"))).alias("b"))
    return rows.join(best.select(F.col("_t").alias(text), F.col("b.v").alias(value)), text, "left")


def match_either_name(people: DataFrame, members: DataFrame, first: str, last: str, value: str) -> DataFrame:
    """people with the value of the first member of that name, in either order."""
    a = members.select(F.col(first), F.col(last), F.col(value), F.lit(0).alias("_swapped"))
    b = members.select(F.col(last).alias(first), F.col(first).alias(last), F.col(value), F.lit(1).alias("_swapped"))
    best = a.unionByName(b).groupBy(first, last).agg(F.min(F.struct("_swapped", value)).alias("_m"))
    return people.join(best, [first, last], "left").withColumn(value, F.col(f"_m.{value}")).drop("_m")


def manifest_files(records: DataFrame, files: DataFrame, path: str) -> DataFrame:
    """records with their files' columns, and error "missing file" where there is no such file. Of repeated files the first by name counts."""
    others = [c for c in files.columns if c != path]
    one = files.groupBy(path).agg(F.min(F.struct(*others)).alias("_f"))
    out = records.join(one, path, "left")
    return out.select(*records.columns, *(F.col(f"_f.{c}").alias(c) for c in others), F.when(F.col("_f").isNull(), "missing file").alias("error"))


def entities_of(rows: DataFrame, fields: Sequence[str]) -> DataFrame:
    """The distinct entities that rows describe in the fields, without those that are wholly null."""
    return rows.select(*fields).dropna("all").distinct()


def prefixed(attributes: Column, prefix: str) -> Column:
    return F.map_filter(attributes, lambda k, v: k.startswith(prefix))


def ancestors_not_done(derived: DataFrame, done: DataFrame) -> DataFrame:
    """derived: child, parent; done: child. Parents of done children that are not done themselves."""
    parents = derived.join(done, "child", "left_semi").select(F.col("parent").alias("child")).distinct()
    return parents.join(done, "child", "left_anti")


def covered_directories(entries: DataFrame, covered: DataFrame) -> DataFrame:
    """entries: dir, name; covered: dir, name. Directories all of whose entries are covered."""
    marked = entries.join(covered.select("dir", "name").distinct().withColumn("_c", F.lit(1)), ["dir", "name"], "left")
    return marked.groupBy("dir").agg(F.count("*").alias("n"), F.count("_c").alias("c")).filter("n = c").select("dir")


def latest_version(rows: DataFrame, key: str, version: str) -> DataFrame:
    """key, version (the largest, by its numbers one after the other, then as text), conflict: whether there were several."""
    numbers = F.transform(F.regexp_extract_all(version, F.lit("[0-9]+"), F.lit(0)), lambda n: n.cast("decimal(38,0)"))
    largest = F.max(F.struct(numbers.alias("numbers"), F.col(version).alias("version")))
    return rows.groupBy(key).agg(largest["version"].alias("version"), (F.count_distinct(version) > 1).alias("conflict"))


def running_last(rows: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """rows with the last value that is not null up to there."""
    return rows.withColumn("last_known", F.last(value, ignorenulls=True).over(Window.partitionBy(key).orderBy(order)))


def entity_counts(owners: DataFrame, key: str, entities: dict[str, DataFrame]) -> DataFrame:
    """owners with the number of rows of each kind of entity, 0 where there is none. entities: kind to rows with the key; each is counted before it is joined, so an owner of many costs no more."""
    out = owners
    for kind, rows in entities.items():
        out = out.join(rows.groupBy(key).agg(F.count("*").alias(f"{kind}_count")), key, "left")
    return out.fillna(0, [f"{kind}_count" for kind in entities])


def distinct_over(rows: DataFrame, key: str, values: str) -> DataFrame:
    """key and the sorted distinct values of its rows, a list's elements one by one; null where a key has none. Values are made distinct before they are gathered."""
    each = F.explode_outer(values) if dict(rows.dtypes)[values].startswith("array") else F.col(values)
    return rows.select(key, each.alias(values)).distinct().groupBy(key).agg(F.array_sort(F.collect_list(values)).alias(values)).withColumn(values, F.when(F.size(values) > 0, F.col(values)))


def study_text(purpose: Column, collection: Column, conclusion: Column) -> Column:
    """The parts that are there, joined by spaces; null if there is none."""
    text = F.concat_ws(" ", *(F.when(F.trim(c) != "", F.trim(c)) for c in (purpose, collection, conclusion)))
    return F.when(text != "", text)


def related_protocols(related: Column) -> Column:
    """Identifiers of those related ones (structs of identifier, relation, type) whose relation is HasProtocol and which have a type, in order."""
    have = F.filter(related, lambda r: (r["relation"] == "HasProtocol") & r["type"].isNotNull() & r["identifier"].isNotNull())
    return F.transform(have, lambda r: r["identifier"])


def award_organs(awards: DataFrame, sourced: DataFrame, manual: DataFrame) -> DataFrame:
    """awards with organ and whether it is an override: the one given by hand, else the sourced one. sourced and manual: award, organ; of several the smallest."""
    one = lambda rows, name: rows.filter("organ IS NOT NULL").groupBy("award").agg(F.min("organ").alias(name))
    both = awards.join(one(manual, "_m"), "award", "left").join(one(sourced, "_s"), "award", "left")
    return both.withColumn("organ", F.coalesce("_m", "_s")).withColumn("override", F.col("_m").isNotNull()).drop("_m", "_s")
