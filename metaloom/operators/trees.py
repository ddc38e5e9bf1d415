"""Documents of any depth: their nodes as rows, recursive maps over these, documents made of nodes again, and queries by path.

nodes() takes documents apart level by level until no inner value is left, a job for each level of the deepest document;
assemble() puts them together from the leaves up. In between they are plain rows, which filters and joins can work on.
Rows of all documents share each level's job, and the children of one node are what is gathered in one row at most.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import save
from .schemas import let

_EMPTY = {"object": "{}", "array": "[]"}


def _kind(v: Column) -> Column:
    name = F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)
    return (
        F.when(F.try_variant_get(v, "$", "map<string,variant>").isNotNull(), "object")
        .when(F.try_variant_get(v, "$", "array<variant>").isNotNull(), "array")
        .when(name == "STRING", "string").when(name == "BOOLEAN", "boolean").when(name == "VOID", "null").otherwise("number")
    )


def nodes(rows: DataFrame, key: str, text: str) -> DataFrame:
    """key, depth, path (pointer), parent, name (key in an object), pos (index in an array), names (keys on the way, null for indexes), kind, value (JSON of a leaf, else null): a row for each node of JSON text.

    Text that is no JSON, or null, has no nodes. Keys must tell documents apart.
    """
    none = F.lit(None).cast("string")
    root = rows.select(key, F.lit("#").alias("path"), none.alias("parent"), none.alias("name"), F.lit(None).cast("int").alias("pos"), F.array().cast("array<string>").alias("names"), F.try_parse_json(text).alias("v")).filter("v IS NOT NULL")
    level, depth, found = root, 0, []
    while True:
        here = level.withColumn("kind", _kind(F.col("v"))).withColumn("v", F.to_json("v"))
        here = save(here.select(key, F.lit(depth).alias("depth"), "path", "parent", "name", "pos", "names", "kind", "v"), f"level{depth}")
        found.append(here.select(key, "depth", "path", "parent", "name", "pos", "names", "kind", F.when(~F.col("kind").isin(*_EMPTY), F.col("v")).alias("value")))
        inner = here.filter(F.col("kind").isin(*_EMPTY) & ~F.col("v").isin(*_EMPTY.values()))
        if inner.isEmpty():
            return reduce(DataFrame.unionByName, found)
        parts = rows.sparkSession.tvf.variant_explode(F.parse_json(F.col("v").outer()))
        own = F.when(F.col("kind") == "object", F.col("_part.key"))
        step = F.coalesce(F.replace(F.replace(own, F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1")), F.col("_part.pos").cast("string"))
        exploded = inner.lateralJoin(parts.select(F.struct("key", "pos", "value").alias("_part")))
        level = exploded.select(
            key, F.concat("path", F.lit("/"), step).alias("path"), F.col("path").alias("parent"), own.alias("name"), F.when(F.col("kind") == "array", F.col("_part.pos")).alias("pos"), F.concat("names", F.array(own)).alias("names"), F.col("_part.value").alias("v")
        )
        depth += 1


def _under(names: Sequence[str]) -> Column:
    """Whether a node is at or below a field of one of the names."""
    return F.arrays_overlap(F.array_compact("names"), F.array(*map(F.lit, names))) if names else F.lit(False)


def map_nodes(tree: DataFrame, f: Callable[[Column, Column, Column], Column], skip: Sequence[str] = (), preserve: Sequence[str] = ()) -> DataFrame:
    """nodes() with f(value, kind, path) in place of each leaf's JSON, at any depth; f may give null, which is JSON's null. Fields named in skip go with all below them; those named in preserve stay as they are, with all below, also what is named in skip there."""
    first = lambda some: F.array_position(F.transform("names", lambda n: F.coalesce(n.isin(*some), F.lit(False)) if some else F.lit(False)), F.lit(True))
    gone, held = first(skip), first(preserve)
    left = tree.filter((gone == 0) | ((held > 0) & (held < gone)))
    kept = held > 0
    made = F.coalesce(f(F.col("value"), F.col("kind"), F.col("path")), F.lit("null"))
    return left.withColumn("value", F.when(F.col("kind").isin(*_EMPTY), None).when(kept, F.col("value")).otherwise(made))


def assemble(tree: DataFrame, key: str, condense: bool = False, preserve: Sequence[str] = ()) -> DataFrame:
    """key, document (JSON text, keys sorted): nodes put together from the deepest level up.

    condense: nulls and what is empty, or becomes so, is left out, but for what stands below a field named in preserve.
    """
    deepest = tree.agg(F.max("depth")).first()[0]
    if deepest is None:
        return tree.select(key, F.col("value").alias("document")).limit(0)
    inside = F.coalesce(_under(preserve), F.lit(False)) & ~F.coalesce(F.col("name").isin(*preserve), F.lit(False)) if preserve else F.lit(False)
    empty = reduce(lambda out, k: F.when(F.col("kind") == k, _EMPTY[k]).otherwise(out), _EMPTY, F.col("value"))
    below = None
    for depth in range(deepest, -1, -1):
        here = tree.filter(F.col("depth") == depth).withColumn("_free", inside)
        if below is None:
            built = here.withColumn("json", empty)
        else:
            whole = F.when(F.col("kind") == "array", F.concat(F.lit("["), F.array_join(F.transform("_parts", lambda p: p["json"]), ","), F.lit("]"))).otherwise(
                F.concat(F.lit("{"), F.array_join(F.transform("_parts", lambda p: F.concat(F.to_json(F.to_variant_object(F.array(p["name"]))).substr(F.lit(2), F.char_length(F.to_json(F.to_variant_object(F.array(p["name"])))) - 2), F.lit(":"), p["json"])), ","), F.lit("}"))
            )
            built = here.join(below, [key, "path"], "left").withColumn("json", F.when(F.col("_parts").isNotNull(), whole).otherwise(empty))
        built = built.select(key, "path", "parent", "name", "pos", "_free", "json")
        if depth == 0:
            return built.select(key, F.col("json").alias("document"))
        worth = built.filter(~F.col("json").isin("null", *_EMPTY.values()) | F.col("_free")) if condense else built
        below = save(worth.groupBy(key, F.col("parent").alias("path")).agg(F.array_sort(F.collect_list(F.struct("pos", "name", "json"))).alias("_parts")), f"built{depth}")


def embedded_errors(tree: DataFrame, key: str, skip: Sequence[str] = ()) -> DataFrame:
    """key, path (of the list), error (JSON text): each entry of the lists named errors, at any depth, but not below fields named in skip."""
    left = tree.filter(~F.coalesce(_under(skip), F.lit(False))) if skip else tree
    lists = left.filter((F.col("name") == "errors") & (F.col("kind") == "array")).select(key, "path").distinct()
    at = F.regexp_extract("path", r"^(.*?/errors)/[0-9]+(/.*)?$", 1)
    mine = left.withColumn("_list", at).filter("_list <> ''").join(lists.select(key, F.col("path").alias("_list")), [key, "_list"], "left_semi")
    # each entry as a document of its own
    entry = F.regexp_extract("path", r"^(.*?/errors/[0-9]+)(/.*)?$", 1)
    own = mine.withColumn("_entry", entry).withColumn("_key", F.struct(key, "_list", F.col("_entry").alias("entry")))
    up = F.size(F.split("_entry", "/")) - 1
    rooted = own.withColumn("depth", F.col("depth") - up).withColumn("parent", F.when(F.col("path") != F.col("_entry"), F.col("parent")))
    out = assemble(rooted.drop(key), "_key")
    return out.select(F.col(f"_key.{key}").alias(key), F.col("_key._list").alias("path"), F.col("document").alias("error"))


def path_query(document: Column, *path: str) -> Column:
    """struct(one, many): the VARIANT at a path of keys. Where a list is on the way, many has a value for each of its elements, null where an element has none; null at the first key that is nowhere."""
    state = F.struct(document.alias("one"), F.lit(None).cast("array<variant>").alias("many"))
    field = lambda x, k: F.try_element_at(F.try_variant_get(x, "$", "map<string,variant>"), F.lit(k))

    def step(s: Column, k: str) -> Column:
        elements = F.coalesce(s["many"], F.try_variant_get(s["one"], "$", "array<variant>"))
        column = F.transform(elements, lambda x: field(x, k))
        some = F.exists(elements, lambda x: F.coalesce(F.map_contains_key(F.try_variant_get(x, "$", "map<string,variant>"), F.lit(k)), F.lit(False)))
        return F.struct(F.when(elements.isNull(), field(s["one"], k)).alias("one"), F.when(some, column).alias("many"))

    for k in path:
        state = let(state, (lambda key: lambda s: step(s, key))(k))
    return state
