"""Templates that use others: stems inherited in order and merged."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import save

#: Comes after every position: a template's own stems follow those that it uses.
_OWN = 2**31 - 1


def inherited(templates: DataFrame, uses: DataFrame) -> DataFrame:
    """template, source, place (array of int): whose stems each template takes, in the order of place: those of what it uses first, in turn, then its own.

    templates: template; uses: template, pos, used. A template that is used along two ways comes twice. Raises where templates use each other in a circle.
    """
    links = uses.select(F.col("template").alias("source"), "pos", "used")
    n = templates.count()
    level = templates.select("template", F.col("template").alias("source"), F.array().cast("array<int>").alias("at"))
    found, depth = None, 0
    while True:
        level = save(level, "templates")
        own = level.select("template", "source", F.concat("at", F.array(F.lit(_OWN))).alias("place"))
        found = own if found is None else found.unionByName(own)
        if level.isEmpty():
            return found
        if depth > n:
            raise ValueError("templates use each other in a circle")
        known = templates.select(F.col("template").alias("used"))
        level = level.join(links, "source").join(known, "used", "left_semi").select("template", F.col("used").alias("source"), F.concat("at", F.array(F.col("pos").cast("int"))).alias("at"))
        depth += 1


def merged(templates: DataFrame, uses: DataFrame, stems: DataFrame) -> tuple[DataFrame, DataFrame]:
    """template, stem, key, subkey, values of every template with what it inherits; and template, stem, message of stems whose headers disagree, or that have none.

    stems: template, stem, key, subkey, values (array), many. Of entries with equal template, stem, key and subkey, those that are many are put one after another, with null for none;
    of the others the last wins.
    """
    taken = inherited(templates, uses).join(stems.withColumnRenamed("template", "source"), "source")
    entry = F.struct("place", "values", "many")
    of = taken.groupBy("template", "stem", "key", "subkey").agg(F.array_sort(F.collect_list(entry)).alias("e"))
    # a single value is last's; where any before was many, all are put together
    values = F.when(F.exists("e", lambda x: x["many"]), F.flatten(F.transform("e", lambda x: F.coalesce(x["values"], F.array().cast("array<string>"))))).otherwise(F.element_at("e", -1)["values"])
    out = save(of.select("template", "stem", "key", "subkey", values.alias("values")), "merged")
    heads = taken.groupBy("template", "stem").agg(F.array_sort(F.collect_set(F.when(F.col("key") == "header", F.get("values", F.lit(0))))).alias("h"))
    bad = heads.filter(F.size("h") != 1)
    message = F.when(F.size("h") == 0, "no header").otherwise(F.concat(F.lit("headers disagree: "), F.array_join("h", ", ")))
    return out, bad.select("template", "stem", message.alias("message"))


def dropped(rows: DataFrame, removals: DataFrame) -> DataFrame:
    """rows (template, stem, name) without those that a pattern of removals (template, stem, pattern) matches as a whole."""
    bad = rows.join(removals, ["template", "stem"]).filter(F.regexp_like("name", F.concat(F.lit("^(?:"), F.col("pattern"), F.lit(")$"))))
    return rows.join(bad.select("template", "stem", "name").distinct(), ["template", "stem", "name"], "left_anti")
