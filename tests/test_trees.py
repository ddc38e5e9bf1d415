"""Documents of any depth: round trips, recursive maps against plain Python, errors inside documents, queries by path."""

import json
import random

from pyspark.sql import functions as F

from metaloom.operators import trees as D


def made(pick, depth):
    if depth == 0 or pick.random() < 0.2:
        return pick.choice([None, 1, -2.5, "te\"xt\\ é\n", "", True, [], {}, "NA"])
    if pick.random() < 0.5:
        return [made(pick, depth - 1) for _ in range(pick.randrange(4))]
    return {pick.choice(["a", "b/c", "d~e", "skip", "keep", "0", 'q"q']): made(pick, depth - 1) for _ in range(pick.randrange(4))}


def frame(spark, documents):
    return spark.createDataFrame([(k, json.dumps(t)) for k, t in enumerate(documents)], "k int, t string").repartition(3)


def assembled(df):
    return {r.k: json.loads(r.document) for r in df.collect()}


def recursive(x, f, skip, preserve, condense):
    worth = lambda v: v is not None and v != [] and v != {}
    if isinstance(x, dict):
        out = {k: v if k in preserve else recursive(v, f, skip, preserve, condense) for k, v in x.items() if k not in skip}
        return {k: v for k, v in out.items() if not condense or worth(v)}
    if isinstance(x, list):
        out = [recursive(v, f, skip, preserve, condense) for v in x]
        return [v for v in out if not condense or worth(v)]
    return f(x)


def test_round_trip_and_maps_equal_plain_python(spark):
    pick = random.Random(3)
    deep = "leaf"
    for k in range(5):
        deep = {"n": [deep, k]}
    documents = [made(pick, 4) for _ in range(40)] + [deep, {}, [], 5]
    tree = D.nodes(frame(spark, documents), "k", "t")
    assert assembled(D.assemble(tree, "k")) == dict(enumerate(documents))
    f = lambda x: x + "!" if isinstance(x, str) else None if x == 1 and x is not True else x
    g = lambda value, kind, path: F.when(kind == "string", F.concat(F.left(value, F.char_length(value) - 1), F.lit('!"'))).when(value == "1", None).otherwise(value)
    mapped = D.map_nodes(tree, g, skip=["skip"], preserve=["keep"])
    for condense in (False, True):
        want = {k: recursive(d, f, ["skip"], ["keep"], condense) for k, d in enumerate(documents)}
        assert assembled(D.assemble(mapped, "k", condense, preserve=["keep"])) == want


def test_no_documents_and_bad_text(spark):
    df = spark.createDataFrame([(0, "{bad"), (1, "null"), (7, None)], "k int, t string")
    assert assembled(D.assemble(D.nodes(df, "k", "t"), "k")) == {1: None}
    assert D.assemble(D.nodes(df.limit(0), "k", "t"), "k").count() == 0


def test_errors_inside_documents(spark):
    documents = [{"errors": [{"message": "m", "path": [1, "a"]}, "plain"], "sub": {"x": [{"errors": [5]}], "errors": "none"}, "inputs": {"errors": ["hidden"]}}, {"errors": []}]
    found = D.embedded_errors(D.nodes(frame(spark, documents), "k", "t"), "k", skip=["inputs"]).collect()
    assert sorted((r.k, r.path, r.error) for r in found) == [(0, "#/errors", '"plain"'), (0, "#/errors", '{"message":"m","path":[1,"a"]}'), (0, "#/sub/x/0/errors", "5")]


def test_path_queries(spark):
    documents = [{"a": [{"b": 1}, {"b": {"c": 2}}, 3, {"d": 4}]}, {"a": {"b": {"c": 5}}}, {"a": []}, {"z": 1}, [{"a": 1}, {"a": 2}]]
    df = frame(spark, documents).select("k", F.parse_json("t").alias("v"))

    def query(*path):
        return {r.k: json.loads(r.q) for r in df.select("k", F.to_json(F.to_variant_object(D.path_query(F.col("v"), *path))).alias("q")).collect()}

    def out(one=None, many=None):
        return {"many": many, "one": one}

    assert query("a", "b") == {0: out(many=[1, {"c": 2}, None, None]), 1: out({"c": 5}), 2: out(), 3: out(), 4: out()}
    assert query("a", "b", "c") == {0: out(many=[None, 2, None, None]), 1: out(5), 2: out(), 3: out(), 4: out()}
    assert query("a")[4] == out(many=[1, 2]) and query("z")[3] == out(1)
