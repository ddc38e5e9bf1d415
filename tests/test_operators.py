"""Operators on small inputs of our own: defined results for nulls, ties and what is missing."""

import random

import pytest
from pyspark.sql import functions as F

from metaloom.functions import scalars as N
from metaloom.operators import constraints as V
from metaloom.operators import deltalog as H
from metaloom.operators import documents as D
from metaloom.operators import paths as P
from metaloom.operators import relational as R
from metaloom.operators import tabular as T
from metaloom.operators import triples as G
from metaloom.streaming import schedule, windows


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "v string").select(column.alias("x")).first().x


@pytest.mark.parametrize("text, want", [("Doe, Jane", ("Doe", "Jane")), ("Doe,Jane", ("Doe", "Jane")), ("Jane Doe", ("Doe", "Jane")), ("Jane", None), (None, None)])
def test_split_name(spark, text, want):
    assert one(spark, N.split_name(F.col("v")), text) == want


@pytest.mark.parametrize("text, want", [("a|b;c", ["a", "b;c"]), ("b; a ;b", ["a", "b"]), ("b,a", ["a", "b"]), ("", []), (None, None)])
def test_multi_split(spark, text, want):
    assert one(spark, N.multi_split(F.col("v")), text) == want


@pytest.mark.parametrize("text, want", [("https://orcid.org/0000-0002-1825-0097", True), ("0000-0002-1825-0098", False), ("0000-0002-1694-233X", True), ("x", False)])
def test_orcid(spark, text, want):
    assert one(spark, N.orcid_valid(F.col("v")), text) is want


@pytest.mark.parametrize("text, want", [("3 weeks", ("quantity", 3.0, "week", None, None)), ("3-5 days", ("range", None, "day", 3.0, 5.0)), ("~2.5 kg", ("approximate", 2.5, "kg", None, None)), ("7", ("quantity", 7.0, "dimensionless", None, None)), ("unknown", None)])
def test_quantity(spark, text, want):
    assert one(spark, N.quantity(F.col("v")), text) == want


def test_truncate_bytes(spark):
    assert one(spark, N.truncate_bytes(F.col("v"), 4), "aéé") == "aé"
    assert one(spark, N.truncate_bytes(F.col("v"), 9), "aéé") == "aéé"


def test_upsert_and_last_wins(spark):
    old, new = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), spark.createDataFrame([(2, None), (3, "c")], "k int, v string")
    assert sorted(map(tuple, R.upsert(old, new, ["k"]).collect())) == [(1, "a"), (2, "b"), (3, "c")]
    rows = spark.createDataFrame([(1, 1, "x"), (1, 2, "y"), (2, None, "z")], "k int, n int, v string")
    assert sorted(r.v for r in R.last_wins(rows, ["k"], ["n"]).collect()) == ["y", "z"]


def test_document_paths(spark):
    row = spark.sql("SELECT named_struct('a', array(named_struct('b', 1, 'c', named_struct('d', 'x', 'e', 1)))) AS doc")
    moved = row.select(D.move(F.col("doc"), ["a", int, "c", "d"], ["a", int, "d"]).alias("doc")).first().doc
    assert moved.a[0].d == "x" and "d" not in moved.a[0].c
    assert row.select(D.get_all(F.col("doc"), ["a", int, "b"]).alias("x")).first().x == [1]
    with pytest.raises(ValueError):
        D.move(F.col("doc"), ["a", int, "b"], ["z", "b"])


def test_shred_nested(spark):
    rows = spark.createDataFrame([(1, '{"a": {"b": [1, "x"]}, "c": null}'), (2, "not json"), (3, None)], "k int, t string")
    got = {(r.k, r.path): r.value for r in D.shred(rows, "k", "t").collect()}
    assert got[1, "#/a/b/0"] == "1" and got[1, "#/a/b/1"] == "x"
    assert (1, "#/c") in got


def test_rules(spark):
    rows = spark.createDataFrame([(1, 5, "x"), (2, None, "y"), (3, 50, None)], "k int, n int, s string")
    rules = [V.Rule("max", "n", "maximum", 10), V.Rule("need", "s", "required"), V.Rule("cond", "n", "required", when="s = 'y'")]
    assert sorted((r.k, r.rule) for r in V.violations(rows, ["k"], rules).collect()) == [(2, "cond"), (3, "max"), (3, "need")]


def test_closure_with_cycle(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4)], "src int, dst int")
    seeds = spark.createDataFrame([(1,)], "start int")
    assert sorted((r.node, r.depth) for r in P.closure(edges, seeds).collect()) == [(1, 3), (2, 1), (3, 2), (4, 3)]
    assert sorted(r.node for r in P.closure(edges, seeds, 1, zero=True).collect()) == [1, 2]
    way = P.shortest_path(edges, seeds, spark.createDataFrame([(4,)], "node int"), 9).first()
    assert way.path == [1, 2, 3, 4] and way.depth == 3
    with pytest.raises(ValueError):
        P.levels(edges.union(spark.createDataFrame([(0, 1)], "src int, dst int")))
    with pytest.raises(ValueError):
        P.levels(spark.createDataFrame([(1, 2), (2, 3), (3, 1), (10, 11)], "src int, dst int"))


def test_deep_trees_and_cycles(spark):
    rows = [(n, n - 1, f"n{n}") for n in range(1, 201)] + [(1001, 1002, "a"), (1002, 1001, "b"), (1003, 1001, "below")]
    got = {r.id: r for r in H.tree_paths(spark.createDataFrame(rows, "id int, parent_id int, name string")).collect()}
    assert got[200].path == "/".join(f"n{n}" for n in range(1, 201)) and got[200].depth == 199 and got[1].path == "n1" and len(got) == len(rows)
    assert [got[k].error for k in (1001, 1002, 1003, 7)] == ["cycle"] * 3 + [None] and got[1003].path is None


def test_tree_paths_carry_no_names_round_cycles(spark, monkeypatch):
    """Cycles of two and three, chains below them and a tree of five levels: nothing that is written in between is longer than the longest path."""
    rows = [(2 * k, 2 * k + 1, "n") for k in range(100)] + [(2 * k + 1, 2 * k, "n") for k in range(100)] + [(301, 302, "n"), (302, 303, "n"), (303, 301, "n"), (304, 304, "n")]
    rows += [(400, 0, "n"), (401, 400, "n"), (402, 401, "n"), (500, None, "n"), (501, 500, "n"), (502, 501, "n"), (503, 502, "n"), (504, 503, "n"), (600, 999, "n")]
    longest, kept = [0], H.save

    def save(df, name="table"):
        out = kept(df, name)
        if "path" in out.columns:
            longest.append(out.agg(F.max(F.length("path"))).first()[0] or 0)
        return out

    monkeypatch.setattr(H, "save", save)
    got = {r.id: (r.path, r.depth, r.error) for r in H.tree_paths(spark.createDataFrame(rows, "id int, parent_id int, name string")).collect()}
    assert len(got) == len(rows)
    assert got[504] == ("n/n/n/n/n", 4, None) and got[500] == ("n", 0, None) and got[600] == ("n", 0, None)
    assert all(got[i] == (None, None, "cycle") for i in [*range(200), 301, 302, 303, 304, 400, 401, 402])
    assert max(longest) == len("n/n/n/n/n")



def test_long_lists(spark):
    cells = spark.range(20_000).selectExpr("id AS cell", "id * 2 AS first", "CASE WHEN id % 20000 < 19999 THEN id + 1 END AS rest")
    got = P.list_items(cells)
    assert got.count() == 20_000 and got.filter("head = 0 AND item = 2 * position").count() == 20_000
    with pytest.raises(ValueError):
        P.list_items(spark.createDataFrame([(1, 1, 2), (2, 2, 1)], "cell int, first int, rest int"))


def test_numbered_and_within(spark):
    df = spark.range(500).selectExpr("id", "id % 7 AS k")
    assert [(r.n, r.k, r.id) for r in R.numbered(df, ["k", "id"]).orderBy("n").collect()] == [(n + 1, k, i) for n, (k, i) in enumerate(sorted((i % 7, i) for i in range(500)))]
    x = spark.createDataFrame([(1, -0.5), (1, 0.4), (1, 1.6), (2, 0.4)], "k int, v double")
    assert sorted((r.a.v, r.b.v) for r in R.within(x, x, ["k"], "v", 1.0).collect() if r.a.v < r.b.v) == [(-0.5, 0.4)]


def test_text_cuts_and_curies(spark):
    assert one(spark, N.truncate_bytes(F.col("v"), 7), "a\ufffd\ufffdb") == "a\ufffd\ufffd" and one(spark, N.truncate_bytes(F.col("v"), 6), "a\ufffd\ufffdb") == "a\ufffd"
    assert one(spark, N.truncate_bytes(F.col("v"), 4), "a\U0001f600") == "a" and one(spark, N.truncate_bytes(F.col("v"), 0), "x") == ""
    assert one(spark, N.curie_expand(F.col("v"), {"part": "http://x/"}), "part:a:b") == "http://x/a:b"
    assert one(spark, N.number_set_similarity(F.col("v"), F.lit("1 5")), "1") == 0.0 and one(spark, N.number_set_similarity(F.col("v"), F.lit("x 005")), "a5b07") == pytest.approx(1 - 1.6094379124341003 / (1.6094379124341003 + 1.9459101490553132))


def test_minus_without_shared_variable(spark):
    t = spark.createDataFrame([("a", "p", "b"), ("c", "q", "d")], "s string, p string, o string")
    assert G.minus(G.pattern(t, "?x", "p", "?y"), G.pattern(t, "?u", "q", "?w")).count() == 1


def test_headers(spark):
    s = spark.createDataFrame([("f", 0, 0, "Subject ID"), ("f", 0, 1, "subject_id"), ("f", 0, 2, None), ("f", 1, 0, "x")], "file string, row bigint, col int, value string")
    assert [r.name for r in T.headers(s).orderBy("col").collect()] == ["subject_id", "subject_id_PREFIX_1", "TEMPH_2"]
    assert T.header_errors(s).first().message == "null at R1C3"


@pytest.mark.parametrize("seed", range(3))
def test_log_replays_every_snapshot(spark, seed):
    pick = random.Random(seed)
    state, rows = {}, []
    for step in range(9):
        for _ in range(4):
            k = pick.randrange(6)
            if pick.random() < 0.3:
                state.pop(k, None)
            else:
                state[k] = pick.choice("abc")
        state.setdefault(9, "z")
        rows += [(step, k, v) for k, v in state.items()]
    log = H.append(spark.createDataFrame(rows, "step int, id int, v string"), "id", ["v"], "step", 4).cache()
    for step in range(9):
        got = {r.id: r.v for r in H.replay(log, "id", F.lit(step)).collect()}
        assert got == {k: v for s, k, v in rows if s == step}


def test_schedule_stream_equals_batch(spark, tmp_path):
    pick = random.Random(1)
    rows = [(k, n, pick.choice(["update", "start", "finish"]), pick.randrange(20)) for k in range(5) for n in range(12)]
    df = spark.createDataFrame(rows, "k int, n int, message string, at bigint")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = schedule.stream(source, "k", "n").writeStream.outputMode("update").format("memory").queryName("folded").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    got = sorted(map(tuple, spark.table("folded").collect()))
    assert got == sorted(map(tuple, schedule.fold(df, "k", "n").collect()))


def test_window_stream(spark, tmp_path):
    df = spark.sql("SELECT timestamp'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,CAST(id AS INT)) AS ts FROM range(6)")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")).withWatermark("ts", "1 minute")
    q = windows.tumbling(source, "ts", "2 minutes", [], F.count("*").alias("n")).writeStream.outputMode("complete").format("memory").queryName("tumbled").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    assert [r.n for r in spark.table("tumbled").collect()] == [2, 2, 2]
