"""Edit-distance joins against all pairs, reports of nearest names, and paths of manifests."""

import random

import pytest
from pyspark.sql import functions as F

from metaloom.operators import matching as M


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        row, last = [i + 1], row
        for j, y in enumerate(b):
            row.append(min(last[j + 1] + 1, row[j] + 1, last[j] + (x != y)))
    return row[-1]


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_similar_equals_all_pairs(spark, distance):
    pick = random.Random(distance)
    word = lambda: "".join(pick.choice("abé-") for _ in range(pick.randrange(7)))
    a, b = [(word(), pick.randrange(2)) for _ in range(60)] + [(None, 1), ("abc", 0), ("abc", 0)], [(word(), pick.randrange(2)) for _ in range(60)] + [(None, 1)]
    left, right = spark.createDataFrame(a, "name string, k int"), spark.createDataFrame(b, "name string, k int")
    found = sorted(map(tuple, M.similar(left, right, distance).collect()))
    names = lambda rows: {n for n, _ in rows if n is not None}
    assert found == sorted((x, y, edits(x, y)) for x in names(a) for y in names(b) if edits(x, y) <= distance)
    keyed = sorted(map(tuple, M.similar(left, right, distance, ["k"]).collect()))
    assert keyed == sorted((k, x, y, edits(x, y)) for x, k in set(a) for y, m in set(b) if x is not None and y is not None and k == m and edits(x, y) <= distance)
    assert M.similar(left.limit(0), right, distance).count() == 0


def test_nearest_names(spark):
    unknown = spark.createDataFrame([("sub1",), ("1",), ("nothing",), ("sam-2",)], "name string")
    known = spark.createDataFrame([("sub-1", "*"), ("sub-2", " "), ("sub-11", " "), ("pop-sub-2", "*")], "name string, source string")
    found = {r.name: (r.distance, [tuple(c) for c in r.candidates]) for r in M.nearest_names(unknown, known, 1).collect()}
    assert found == {"sub1": (1, [(1, "sub-1", "*")]), "1": (4, [(4, "sub-1", "*")]), "nothing": (None, []), "sam-2": (2, [(2, "sub-2", " "), (6, "pop-sub-2", "*")])}


def test_normal_paths(spark):
    rows = [("a/b", "c"), ("a/b", "../c"), ("a", "../../c"), ("a", "/c/./d"), ("a", ".."), (None, "x//y/"), ("a", None), ("", "z")]
    df = spark.createDataFrame(rows, "parent string, name string").coalesce(1)
    found = [r.p for r in df.select(M.normal_path(F.col("parent"), F.col("name")).alias("p")).collect()]
    assert found == ["a/b/c", "a/c", None, "c/d", None, "x/y", "a", "z"]


def test_manifest_conflicts_keep_the_first(spark):
    rows = [("b/m.csv", 1, "x"), ("a/m.csv", 9, "../b/x"), ("a/m.csv", 2, "./../b/x"), ("a/m.csv", 3, "../../q"), ("m.csv", 1, "own")]
    kept, errors = M.manifest_targets(spark.createDataFrame(rows, "manifest string, row int, filename string"))
    assert sorted(map(tuple, kept.collect())) == [("b/x", "a/m.csv", 2), ("own", "m.csv", 1)]
    assert sorted((r.manifest, r.row, r.message) for r in errors.collect()) == [("a/m.csv", 3, "no path inside: ../../q"), ("a/m.csv", 9, "already described in a/m.csv:2"), ("b/m.csv", 1, "already described in a/m.csv:2")]


def test_missing_files(spark):
    paths = spark.createDataFrame([("a/one.csv",), ("b/two.csv",), ("top.csv",)], "path string")
    targets = spark.createDataFrame([("a/two.csv",), ("a/onee.csv",), ("tp.csv",), ("b/two.csv",), ("c/none",)], "target string")
    found = {r.target: (r.moved, r.misspelt) for r in M.missing_files(targets, paths).collect()}
    assert found == {"a/two.csv": (["b/two.csv"], []), "a/onee.csv": ([], ["a/one.csv"]), "tp.csv": ([], ["top.csv"]), "c/none": ([], [])}


def broadcasts(df):
    """Whether any side was sent through the driver, by the plan as it was run."""
    df.collect()
    return "Broadcast" in df._jdf.queryExecution().executedPlan().toString()


def test_missing_files_sends_no_table_through_the_driver(spark):
    paths = spark.createDataFrame([("a/one.csv",), ("b/two.csv",)], "path string")
    assert not broadcasts(M.missing_files(spark.createDataFrame([("a/two.csv",), ("a/onee.csv",)], "target string"), paths))


def test_similar_sends_no_table_through_the_driver(spark):
    a, b = spark.createDataFrame([("one", 1)], "name string, k int"), spark.createDataFrame([("onee", 1)], "name string, k int")
    assert not broadcasts(M.similar(a, b, 2)) and not broadcasts(M.similar(a, b, 1, ["k"]))


def test_nearest_names_sends_no_table_through_the_driver(spark):
    known = spark.createDataFrame([("sub-1", "*"), ("sub-2", " ")], "name string, source string")
    assert not broadcasts(M.nearest_names(spark.createDataFrame([("sub1",), ("1",)], "name string"), known, 1))
