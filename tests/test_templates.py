"""Templates that inherit from others."""

import pytest

from metaloom.operators import templates as T

STEMS = "template string, stem string, key string, subkey string, values array<string>, many boolean"


def frames(spark, uses, stems):
    names = sorted({u[0] for u in uses} | {s[0] for s in stems})
    return spark.createDataFrame([(n,) for n in names], "template string"), spark.createDataFrame(uses, "template string, pos int, used string"), spark.createDataFrame(stems, STEMS)


def test_diamond_order_and_last_wins(spark):
    uses = [("d", 0, "b"), ("d", 1, "c"), ("b", 0, "a"), ("c", 0, "a"), ("d", 2, "unknown")]
    stems = [(t, "subjects", "header", None, ["row"], False) for t in "abcd"]
    stems += [(t, "subjects", "remove", None, [t], True) for t in "abc"] + [("d", "subjects", "remove", None, None, True)]
    stems += [("b", "subjects", "add", "x", ["1"], True), ("c", "subjects", "add", "x", ["2", "3"], True), ("c", "subjects", "add", "y", None, True)]
    stems += [("a", "subjects", "kind", None, ["old"], False), ("c", "subjects", "kind", None, ["new"], False), ("c", "other", "header", None, ["col"], False)]
    out, errors = T.merged(*frames(spark, uses, stems))
    found = {(r.template, r.stem, r.key, r.subkey): r["values"] for r in out.collect()}
    assert found["d", "subjects", "remove", None] == ["a", "b", "a", "c"] and found["b", "subjects", "remove", None] == ["a", "b"]
    assert found["d", "subjects", "add", "x"] == ["1", "2", "3"] and found["d", "subjects", "add", "y"] == []
    assert found["d", "subjects", "kind", None] == ["new"] and found["b", "subjects", "kind", None] == ["old"]
    assert ("d", "other", "header", None) in found and ("b", "other", "header", None) not in found and errors.count() == 0


def test_headers_and_circles(spark):
    stems = [("a", "s", "header", None, ["row"], False), ("b", "s", "header", None, ["col"], False), ("b", "t", "remove", None, ["x"], True)]
    _, errors = T.merged(*frames(spark, [("b", 0, "a")], stems))
    assert sorted(map(tuple, errors.collect())) == [("b", "s", "headers disagree: col, row"), ("b", "t", "no header")]
    with pytest.raises(ValueError, match="circle"):
        T.merged(*frames(spark, [("b", 0, "a"), ("a", 0, "b")], stems))
    nothing = [f.limit(0) for f in frames(spark, [("b", 0, "a")], stems)]
    assert [x.count() for x in T.merged(*nothing)] == [0, 0]


def test_removals_match_whole_names(spark):
    rows = spark.createDataFrame([("a", "s", "device_id"), ("a", "s", "my_device_id"), ("b", "s", "device_id")], "template string, stem string, name string")
    removals = spark.createDataFrame([("a", "s", "device_.+"), ("a", "s", "x|y")], "template string, stem string, pattern string")
    assert sorted((r.template, r.name) for r in T.dropped(rows, removals).collect()) == [("a", "my_device_id"), ("b", "device_id")]
