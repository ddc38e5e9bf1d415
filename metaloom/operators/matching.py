"""Names and paths that ought to be the same: joins by edit distance, reports of nearest names, targets of manifests.

similar() joins two growing tables by edit distance without comparing all names with all. Two names are within a distance
only if both become the same text when at most so many characters are deleted from each, so names meet under what deletions
leave of them. How many names share one such text is bounded by the alphabet and the name's length, not by the tables:
no key grows hot once names are distinct, which they are made first. Every pair found is verified.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .relational import growing

def _shorter(text: Column) -> Column:
    """All texts with one character less."""
    n = F.char_length(text)
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.left(text, i - 1), F.substring(text, i + 1, n)))).otherwise(F.array().cast("array<string>"))


def deletions(text: Column, distance: int) -> Column:
    """text, and what is left of it without up to distance characters; distinct. Their number grows with the length to the power of distance."""
    all_, last = F.array(text), F.array(text)
    for _ in range(distance):
        last = F.array_distinct(F.flatten(F.transform(last, _shorter)))
        all_ = F.array_union(all_, last)
    return all_


def similar(a: DataFrame, b: DataFrame, distance: int = 2, keys: Sequence[str] = (), name: str = "name") -> DataFrame:
    """keys, name, other, distance: each distinct name of a with each distinct one of b that is at most distance edits away, equal ones too. keys: columns that have to be equal. Null names are like none."""
    if not 0 <= distance <= 3:
        raise ValueError("distances from 0 to 3 are found by deletions")

    def keyed(df: DataFrame, to: str) -> DataFrame:
        names = df.filter(F.col(name).isNotNull()).select(*keys, F.col(name).alias(to)).distinct()
        return names.select(*keys, to, F.explode(F.transform(deletions(F.col(to), distance), lambda x: F.xxhash64(x))).alias("_left"))

    met = keyed(a, "name").join(growing(keyed(b, "other")), [*keys, "_left"])
    # far ones that share a text go before pairs are made distinct
    near = F.levenshtein("name", "other", distance)
    return met.select(*keys, "name", "other", near.alias("distance")).filter("distance >= 0").distinct()


def nearest_names(unknown: DataFrame, known: DataFrame, distance: int = 2, prefix: str = r"^(pop-)?(sub|sam|site|perf)-") -> DataFrame:
    """name, distance, candidates (array of struct(distance, other, source)), nearest first: for each name of unknown the names of known (name, source) that it may be a slip of.

    A name without its prefix of an entity counts as near too: names also meet with prefixes taken off; the distance told is that of the whole names. A name that nothing is near to
    has no candidates.
    """
    bare = F.regexp_replace("name", prefix, "")
    sources = known.select(F.col("name").alias("other"), "source").distinct()
    whole = similar(unknown, known, distance).select("name", "other")
    off = lambda df: df.select("name", bare.alias("_bare")).distinct()
    # only names whose prefix is missing or another one: the others have met already
    bared = off(unknown).join(growing(off(known).select(F.col("name").alias("other"), "_bare")), "_bare").filter(F.col("name") != F.col("other")).select("name", "other")
    pairs = whole.unionByName(bared).distinct().join(growing(sources), "other")
    one = F.struct(F.levenshtein("name", "other").alias("distance"), "other", "source")
    found = pairs.groupBy("name").agg(F.array_sort(F.collect_list(one)).alias("candidates"))
    out = unknown.select("name").distinct().join(growing(found), "name", "left")
    return out.select("name", F.get("candidates", F.lit(0))["distance"].alias("distance"), F.coalesce("candidates", F.array().cast("array<struct<distance:int,other:string,source:string>>")).alias("candidates"))


def normal_path(parent: Column, name: Column) -> Column:
    """parent/name without empty parts and dots; null where .. leads out of all folders. A name that begins with / is taken from the root."""
    parts = F.split(F.when(name.startswith("/"), name).otherwise(F.concat_ws("/", parent, name)), "/")
    start = F.struct(F.array().cast("array<string>").alias("at"), F.lit(False).alias("out"))

    def step(s: Column, p: Column) -> Column:
        up = F.struct(F.slice(s["at"], F.lit(1), F.greatest(F.size(s["at"]) - 1, F.lit(0))).alias("at"), (s["out"] | (F.size(s["at"]) == 0)).alias("out"))
        return F.when(p.isin("", "."), s).when(p == "..", up).otherwise(F.struct(F.concat(s["at"], F.array(p)).alias("at"), s["out"].alias("out")))

    end = F.aggregate(parts, start, step)
    return F.when(~end["out"] & (F.size(end["at"]) > 0), F.array_join(end["at"], "/"))


def manifest_targets(manifests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """manifests: manifest (path of the file), row, filename. Returns target, manifest, row for each path that is spoken of, the first row of the first manifest if there are several; and manifest, row, target, message of the others, and of those that lead nowhere."""
    folder = F.regexp_replace("manifest", "/?[^/]*$", "")
    at = manifests.withColumn("target", normal_path(folder, F.col("filename")))
    first = at.filter("target IS NOT NULL").groupBy("target").agg(F.min(F.struct("manifest", "row")).alias("m"))
    kept = first.select("target", "m.manifest", "m.row")
    others = at.join(first, "target").filter(~(F.col("m.manifest").eqNullSafe(F.col("manifest")) & F.col("m.row").eqNullSafe(F.col("row"))))
    again = others.select("manifest", "row", "target", F.concat_ws(" ", F.lit("already described in"), F.concat_ws(":", "m.manifest", F.col("m.row").cast("string"))).alias("message"))
    nowhere = at.filter("target IS NULL").select("manifest", "row", "target", F.concat(F.lit("no path inside: "), F.coalesce("filename", F.lit("null"))).alias("message"))
    return kept, again.unionByName(nowhere)


def missing_files(targets: DataFrame, paths: DataFrame, distance: int = 1) -> DataFrame:
    """target, moved, misspelt (arrays of paths, sorted): targets (target) that paths (path) hasn't got, with the paths of that base name elsewhere, and those in the same folder whose base name is at most distance edits away."""
    base, folder = (lambda p: F.substring_index(p, "/", -1)), (lambda p: F.regexp_replace(p, "/?[^/]*$", ""))
    missing = targets.select("target").distinct().join(growing(paths.select(F.col("path").alias("target"))), "target", "left_anti")
    there = paths.select("path", base(F.col("path")).alias("name"), folder(F.col("path")).alias("folder")).distinct()
    lost = missing.select("target", base(F.col("target")).alias("name"), folder(F.col("target")).alias("folder"))
    moved = lost.join(growing(there.select("path", "name")), "name").groupBy("target").agg(F.array_sort(F.collect_set("path")).alias("moved"))
    near = similar(lost, there, distance, ["folder"])
    whole = lambda c: F.when(F.col("folder") == "", F.col(c)).otherwise(F.concat_ws("/", "folder", c))
    misspelt = near.select(whole("name").alias("target"), whole("other").alias("path")).groupBy("target").agg(F.array_sort(F.collect_set("path")).alias("misspelt"))
    none = F.array().cast("array<string>")
    return missing.join(growing(moved), "target", "left").join(growing(misspelt), "target", "left").select("target", F.coalesce("moved", none).alias("moved"), F.coalesce("misspelt", none).alias("misspelt"))


def _numbers(text: Column) -> Column:
    """The distinct numbers above 1 in a text: those that weigh something."""
    bare = F.transform(F.regexp_extract_all(text, F.lit("[0-9]+"), F.lit(0)), lambda n: F.ltrim(n, F.lit("0")))
    return F.array_distinct(F.filter(bare, lambda n: ~n.isin("", "1")))


def _weight(numbers: Column) -> Column:
    return F.aggregate(F.array_sort(numbers), F.lit(0.0), lambda s, n: s + F.ln(n.cast("double")))


def match_references(refs: DataFrame, paths: DataFrame, least: float = 0.5) -> DataFrame:
    """refs: ref, text (a path as another system wrote it); paths: path. Returns ref, path, mapped_by, similarity, distance, error.

    A reference is the path of its base name, if that is the only one. One whose base name no path has gets the nearest base name with its suffix: by the share that common numbers
    have of its own, weighted by their logarithms (similarity: 1 less that share), then by edit distance, then by name. It has to share least of its own weight.

    Base names are looked up under the reference's numbers, but not under the most frequent ones that together weigh less than least: a name that shares only these can't do.
    """
    base = lambda p: F.regexp_extract(p, r"[^\\/]+$", 0)
    suffix = lambda n: F.regexp_extract(n, r"[^.](\.[^.]+)$", 1)
    wanted = refs.select("ref", base(F.col("text")).alias("name"))
    index = paths.select("path", base(F.col("path")).alias("name")).distinct().groupBy("name").agg(F.count("*").alias("n"), F.min("path").alias("path"))
    exact = wanted.join(index, "name", "left")
    same = exact.filter("n IS NOT NULL").select(
        "ref", F.when(F.col("n") == 1, F.col("path")).alias("path"), F.when(F.col("n") == 1, "exact-pathname-match").alias("mapped_by"), F.when(F.col("n") == 1, F.lit(0.0)).alias("similarity"),
        F.when(F.col("n") == 1, F.lit(0)).alias("distance"), F.when(F.col("n") > 1, F.concat_ws(" ", F.lit("several paths of that name:"), F.col("n").cast("string"))).alias("error"),
    )
    lost = exact.filter("n IS NULL").select("ref", "name", suffix(F.col("name")).alias("suffix"), _numbers(F.col("name")).alias("own"))
    names = index.select(F.col("name").alias("other"), "n", "path", suffix(F.col("name")).alias("suffix"), _numbers(F.col("name")).alias("theirs"))
    listed = names.select("other", "suffix", F.explode("theirs").alias("number"))
    often = listed.groupBy("suffix", "number").agg(F.count("*").alias("often"))
    distinct = lost.select("name", "suffix", "own").distinct()
    counted = distinct.select("name", "suffix", "own", F.explode("own").alias("number")).join(often, ["suffix", "number"]).groupBy("name", "suffix", "own").agg(F.array_sort(F.collect_list(F.struct((-F.col("often")).alias("often"), "number"))).alias("by"))
    # numbers from the most frequent on, with the weight of all up to each
    total = _weight(F.col("own"))
    upto = F.transform("by", lambda x, i: F.struct(x["number"].alias("number"), F.aggregate(F.slice("by", F.lit(1), i + 1), F.lit(0.0), lambda s, y: s + F.ln(y["number"].cast("double"))).alias("w")))
    probed = counted.select("name", "suffix", F.explode(F.filter(upto, lambda x: x["w"] > total * least - 1e-9)["number"]).alias("number"))
    pairs = probed.join(listed, ["suffix", "number"]).select("name", "other").distinct()
    judged = pairs.join(distinct.select("name", "own"), "name").join(names.select("other", "theirs", "n", F.col("path").alias("_path")), "other")
    share = _weight(F.array_intersect("own", "theirs")) / _weight(F.col("own"))
    best = judged.withColumn("share", share).filter(F.col("share") > least - 1e-9).groupBy("name").agg(F.min(F.struct((1 - F.col("share")).alias("similarity"), F.levenshtein("name", "other").alias("distance"), "other", "n", "_path")).alias("b"))
    near = lost.select("ref", "name").join(best, "name", "left")
    rest = near.select(
        "ref", F.when(F.col("b.n") == 1, F.col("b._path")).alias("path"), F.when(F.col("b.n") == 1, "number-similarity").alias("mapped_by"), F.col("b.similarity").alias("similarity"), F.col("b.distance").alias("distance"),
        F.when(F.col("b").isNull(), "no path of that name").when(F.col("b.n") > 1, F.concat_ws(" ", F.lit("several paths of that name:"), F.col("b.n").cast("string"))).alias("error"),
    )
    return same.unionByName(rest)
