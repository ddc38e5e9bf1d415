"""Nested documents: path operators on VARIANT and struct columns, shredding and assembly.

A path is a list of keys; the type int in it means every element. Values that can't be had become rows of errors.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

Path = Sequence


def pointer(path: Path) -> str:
    """A JSON path for variant_get; only keys and indexes."""
    return "$" + "".join(f"[{p}]" if isinstance(p, int) else f"['{p}']" for p in path)


def get(document: Column, path: Path, kind: str = "string", default: object = None) -> Column:
    """The value at path in a VARIANT, or default; never fails."""
    value = F.try_variant_get(document, pointer(path), kind)
    return value if default is None else F.coalesce(value, F.lit(default))


def missing(document: Column, path: Path) -> Column:
    return F.try_variant_get(document, pointer(path), "variant").isNull()


def get_all(value: Column, path: Path) -> Column:
    """Field access in structs and arrays; int maps over an array's elements."""
    if not path:
        return value
    if path[0] is int:
        return F.transform(value, lambda x: get_all(x, path[1:]))
    return get_all(value.getField(path[0]), path[1:])


def update(value: Column, path: Path, f: Callable[[Column], Column]) -> Column:
    """value with f applied at path (structs and arrays)."""
    if not path:
        return f(value)
    if path[0] is int:
        return F.transform(value, lambda x: update(x, path[1:], f))
    return value.withField(path[0], update(value.getField(path[0]), path[1:], f))


def drop(value: Column, path: Path) -> Column:
    return update(value, path[:-1], lambda x: x.dropFields(path[-1]))


def move(value: Column, source: Path, target: Path) -> Column:
    """The field at source under target; both have the same int places, and elements keep their order. The struct it leaves must keep a field."""
    shared = 0
    while shared < min(len(source), len(target)) - 1 and source[shared] == target[shared]:
        shared += 1
    if int in source[shared:] or int in target[shared:]:
        raise ValueError("places of int differ")
    a, b = source[shared:], target[shared:]

    def both(x: Column) -> Column:
        taken = get_all(x, a)
        return drop(update(x, b[:-1], lambda y: y.withField(b[-1], taken)), a)

    return update(value, source[:shared], both)


def cull(value: Column, kind: str) -> Column:
    """Null for what counts as missing: null, empty text, empty arrays and maps."""
    if kind == "string":
        return F.when(value != "", value)
    if kind.startswith(("array", "map")):
        return F.when(F.size(value) > 0, value)
    return value


def zip_equal(a: Column, b: Column) -> Column:
    """struct(pairs, error): two arrays side by side, or an error where their lengths differ."""
    same = F.size(a) == F.size(b)
    return F.struct(F.when(same, F.arrays_zip(a.alias("a"), b.alias("b"))).alias("pairs"), F.when(~same, F.concat_ws(" ", F.lit("lengths differ:"), F.size(a), F.size(b))).alias("error"))


def shred(rows: DataFrame, key: str, text: str, depth: int = 3) -> DataFrame:
    """key, path (pointer), value (as text), kind: a row for each leaf of JSON text, down to depth levels; what is deeper stays whole."""
    level = rows.select(key, F.lit("#").alias("path"), F.try_parse_json(text).alias("v"))
    leaves = None
    for k in range(depth + 1):
        kind = F.schema_of_variant("v")
        inner = kind.startswith("OBJECT<") | kind.startswith("ARRAY<")
        here = level.filter(~inner | (F.lit(k) == depth)).select(key, "path", F.coalesce(F.try_variant_get("v", "$", "string"), F.to_json("v")).alias("value"), kind.alias("kind"))
        leaves = here if leaves is None else leaves.unionByName(here)
        if k < depth:
            parts = rows.sparkSession.tvf.variant_explode(F.col("v").outer())
            level = level.filter(inner).lateralJoin(parts).select(key, F.concat("path", F.lit("/"), F.coalesce("key", F.col("pos").cast("string"))).alias("path"), F.col("value").alias("v"))
    return leaves


def assemble(leaves: DataFrame, key: str) -> DataFrame:
    """key, document: leaves one level deep as a JSON object again, keys sorted."""
    name = F.substring_index("path", "/", -1)
    entries = F.array_sort(F.collect_list(F.struct(name.alias("k"), F.col("value").alias("v"))))
    return leaves.groupBy(key).agg(F.map_from_entries(entries).alias("m")).select(key, F.to_json("m").alias("document"))


def ancestors(path: Column) -> Column:
    """A pointer and all pointers above it."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))


def drop_failures(leaves: DataFrame, errors: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """leaves without those at or below a path of errors (key, path), and those that were taken out."""
    marked = leaves.withColumn("_above", F.explode(ancestors(F.col("path"))))
    bad = marked.join(errors.select(key, F.col("path").alias("_above")).distinct(), [key, "_above"], "left_semi").select(key, "path").distinct()
    return leaves.join(bad, [key, "path"], "left_anti"), leaves.join(bad, [key, "path"], "left_semi")


def collect_by_key(leaves: DataFrame, name: str) -> DataFrame:
    """The leaves whose last key is name, at any depth."""
    return leaves.filter(F.substring_index("path", "/", -1) == name)


def _has(schema: StructType, path: Path) -> bool:
    """Whether a struct's type has the path; arrays are entered by int."""
    kind = schema
    for key in path:
        if key is int:
            if not isinstance(kind, ArrayType):
                return False
            kind = kind.elementType
        elif not isinstance(kind, StructType) or key not in kind.fieldNames():
            return False
        else:
            kind = kind[key].dataType
    return True


def add(value: Column, schema: StructType, path: Path, new: Column) -> Column:
    """struct(document, error): value (of type schema) with new at path; parents are made. A target that is there already, and not null, is left as it is and is an error."""
    shared = max(k for k in range(len(path)) if _has(schema, path[:k]))
    made = new
    for key in reversed(path[shared + 1 :]):
        made = F.struct(made.alias(key))
    exists = get_all(value, path).isNotNull() if _has(schema, path) else F.lit(False)
    target = path[: shared + 1]
    grown = update(value, target[:-1], lambda x: x.withField(target[-1], made))
    kept = update(value, target[:-1], lambda x: x.withField(target[-1], F.when(exists, get_all(value, target)).otherwise(made))) if _has(schema, path) else grown
    return F.struct(kept.alias("document"), F.when(exists, F.lit(f"target exists: {'/'.join(path)}")).alias("error"))


def copy(value: Column, schema: StructType, source: Path, target: Path) -> Column:
    """struct(document, error): the value at source also at target. A source that isn't there leaves the document as it is, without an error."""
    if not _has(schema, source):
        return F.struct(value.alias("document"), F.lit(None).cast("string").alias("error"))
    return add(value, schema, target, get_all(value, source))


def merge(*maps: Column) -> Column:
    """One map of several; of equal keys the last wins."""
    def over(a: Column, b: Column) -> Column:
        return F.map_concat(F.map_filter(a, lambda k, v: ~F.map_contains_key(b, k)), b)

    return reduce(over, maps)


def plain_types(df: DataFrame) -> DataFrame:
    """df with columns that JSON can hold: times and dates as ISO text, binary as base 64, decimals as doubles."""
    made = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind.startswith("timestamp"):
            c = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        elif kind == "date":
            c = F.date_format(c, "yyyy-MM-dd")
        elif kind == "binary":
            c = F.base64(c)
        elif kind.startswith("decimal"):
            c = c.cast("double")
        made.append(c.alias(name))
    return df.select(*made)


#: Keys of a schema's path that have no place in the data's path; with the last three goes the index that follows.
_SCHEMA_KEYS, _CHOICES = ("properties",), ("allOf", "anyOf", "oneOf")


def data_path(schema_path: Column) -> Column:
    """The place in the data that a schema's path (array of text) speaks of: items stand for -1, choices and their indexes are left out."""
    kept = F.filter(schema_path, lambda x, i: ~x.isin(*_SCHEMA_KEYS, *_CHOICES) & ~F.coalesce(F.get(schema_path, i - 1).isin(*_CHOICES), F.lit(False)))
    return F.transform(kept, lambda x: F.when(x == "items", "-1").otherwise(x))


def collect_by_kind(leaves: DataFrame, kind: str) -> DataFrame:
    """The leaves of a kind (as schema_of_variant names it), at any depth."""
    return leaves.filter(F.col("kind") == kind)


def expand_identifiers(leaves: DataFrame, identifiers: DataFrame, skip: Sequence[str] = ("errors", "inputs", "id")) -> DataFrame:
    """leaves (path, value) with label of identifiers (value, label), but not at or below keys of skip."""
    skipped = F.arrays_overlap(F.split("path", "/"), F.array(*map(F.lit, skip)))
    out = leaves.join(identifiers.select("value", "label"), "value", "left")
    return out.withColumn("label", F.when(~skipped, F.col("label")))
