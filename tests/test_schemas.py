"""Schemas over VARIANT documents: each keyword, nested choices, paths, and what isn't an error."""

import json

import pytest
from pyspark.sql import functions as F

from metaloom.operators import schemas as S
from metaloom.operators.constraints import Rule


def errors(spark, schema, *documents):
    df = spark.createDataFrame([(k, json.dumps(d)) for k, d in enumerate(documents)], "k int, t string").select("k", F.parse_json("t").alias("v"))
    out = [set() for _ in documents]
    for r in S.schema_violations(df, ["k"], F.col("v"), schema).collect():
        out[r.k].add((r.pointer, r.keyword))
    return out


def test_types(spark):
    values = ["a", 1, 1.5, 2.0, True, None, [1], {"a": 1}]
    fits = {"string": [0], "integer": [1, 3], "number": [1, 2, 3], "boolean": [4], "null": [5], "array": [6], "object": [7]}
    for kind, good in fits.items():
        assert [k for k, e in enumerate(errors(spark, {"type": kind}, *values)) if not e] == good, kind
    assert [k for k, e in enumerate(errors(spark, {"type": ["string", "null"]}, *values)) if not e] == [0, 5]


def test_keywords_of_other_kinds_do_not_apply(spark):
    schema = {"pattern": "^a", "minimum": 3, "minItems": 2, "required": ["x"], "maxLength": 2}
    found = errors(spark, schema, "ab", "b", "abc", 2, 3, [1], [1, 2], {}, {"x": None}, None, True)
    at = lambda *k: {("#", x) for x in k}
    assert found == [at(), at("pattern"), at("maxLength"), at("minimum"), at(), at("minItems"), at(), at("required"), at(), at(), at()]


def test_paths_through_objects_and_arrays(spark):
    schema = {
        "definitions": {"name": {"type": "string", "minLength": 1}},
        "properties": {"a/b": {"items": {"properties": {"n": {"$ref": "#/definitions/name"}}, "additionalProperties": False}}, "m": {"additionalProperties": {"type": "integer"}}, "e": {"properties": {}, "required": []}},
    }
    found = errors(spark, schema, {"a/b": [{"n": "x"}, {"n": ""}, {"n": 3, "z": 1}], "m": {"one": 1, "two": "2"}}, {"a/b": {"n": 1}, "other": 1}, {"a/b": []})
    assert found == [{("#/a~1b/1/n", "minLength"), ("#/a~1b/2/n", "type"), ("#/a~1b/2", "additionalProperties"), ("#/m/two", "type")}, set(), set()]


def test_choices(spark):
    choice = {"oneOf": [{"type": "integer"}, {"minimum": 2}, {"enum": ["x", None, 7, True, [1]]}]}
    found = errors(spark, choice, 1, 3, 2.5, "x", "y", None, 7, True, [1])
    # a keyword for another kind is satisfied, so "x" has two of three
    assert [bool(e) for e in found] == [False, True, False, True, False, True, True, True, True]
    nested = {"properties": {"v": {"anyOf": [{"allOf": [{"type": "string"}, {"not": {"pattern": "^no"}}]}, {"type": "array", "items": {"oneOf": [{"const": 1}, {"const": 2}]}}]}}}
    assert errors(spark, nested, {"v": "yes"}, {"v": "no!"}, {"v": [1, 2]}, {"v": [3]}, {}) == [set(), {("#/v", "anyOf")}, set(), {("#/v", "anyOf")}, set()]


def test_what_cannot_be_compiled(spark):
    with pytest.raises(ValueError, match="contains itself"):
        errors(spark, {"properties": {"a": {"$ref": "#"}}}, {})
    with pytest.raises(ValueError, match="aren't known"):
        errors(spark, {"patternProperties": {}}, {})
    with pytest.raises(ValueError, match="condition"):
        S.schema_of([Rule("r", "a", "minimum", 1, when="a > 1")])


def test_rules_as_schema(spark):
    rules = [Rule("a", "x", "required"), Rule("b", "x", "type", "int"), Rule("c", "x", "minimum", 3), Rule("d", "y", "not_", Rule("", "y", "pattern", "^q")), Rule("e", "", "any_of", [Rule("", "x", "maximum", 5), Rule("", "y", "enum", ("a", "b"))])]
    schema = json.loads(S.schema_text(S.schema_of(rules), "rows"))
    assert schema["title"] == "rows"
    found = errors(spark, schema, {"x": 4, "y": "z"}, {"y": "qq"}, {"x": 9, "y": "c"}, {"x": 9, "y": "a"}, {"x": 1, "y": "a"})
    assert found == [set(), {("#", "required"), ("#/y", "not")}, {("#", "anyOf")}, set(), {("#/x", "minimum")}]


def test_missing_and_null_documents(spark):
    df = spark.createDataFrame([(1, None), (2, "null")], "k int, t string").select("k", F.parse_json("t").alias("v"))
    assert [(r.k, r.keyword) for r in S.schema_violations(df, ["k"], F.col("v"), {"type": "object"}).collect()] == [(2, "type")]
