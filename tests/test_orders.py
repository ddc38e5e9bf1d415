"""Deep chains, components, closures and reductions against plain Python."""

import random
import time

import pytest
from pyspark.sql import functions as F

from metaloom.operators import orders as O
from metaloom.operators import paths as P


def edges_of(spark, pairs, kind="int"):
    return spark.createDataFrame(pairs, f"src {kind}, dst {kind}")


def reach(pairs):
    out = {}
    for a, b in pairs:
        out.setdefault(a, set()).add(b)
    found = {}
    for start in {x for p in pairs for x in p}:
        depth, layer, seen = 0, {start}, {}
        while layer:
            depth += 1
            layer = {b for a in layer for b in out.get(a, ())} - set(seen)
            seen |= dict.fromkeys(layer, depth)
        found[start] = seen
    return found


def test_a_chain_of_ten_thousand(spark):
    n, began = 10_000, time.time()
    chain = spark.range(n).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    found = P.closure(chain, spark.createDataFrame([(0,)], "start bigint"))
    assert found.agg(F.count("*"), F.max("depth"), F.sum(F.abs(F.col("node") - F.col("depth")))).first() == (n, n, 0)
    back = P.levels(chain)
    assert back.agg(F.count("*"), F.sum(F.abs(F.col("node") - F.col("level")))).first() == (n + 1, 0)
    assert time.time() - began < 120


@pytest.mark.parametrize("shape", ["out", "in", "any"])
def test_closures_paths_and_levels_equal_plain_python(spark, shape):
    pick = random.Random(shape)
    if shape == "any":
        pairs = [(pick.randrange(15), pick.randrange(15)) for _ in range(22)]
    else:
        # one edge out of (or into) each node; some nodes lie on cycles
        pairs = [(k, pick.randrange(18)) for k in range(18) if k % 5]
        pairs = pairs if shape == "out" else [(b, a) for a, b in pairs]
    df, want = edges_of(spark, pairs), reach(pairs)
    seeds = spark.createDataFrame([(k,) for k in (0, 1, 2, 7, 99)], "start int")
    for depth in (None, 1, 3):
        found = {(r.start, r.node): r.depth for r in P.closure(df, seeds, depth).collect()}
        assert found == {(s, n): k for s in (0, 1, 2, 7) for n, k in want.get(s, {}).items() if depth is None or k <= depth}
    got = P.shortest_path(df, seeds, spark.createDataFrame([(k,) for k in (3, 7, 11)], "node int")).collect()
    assert {(r.start, r.node): r.depth for r in got} == {(s, t): 0 if s == t else want[s][t] for s in (0, 1, 2, 7) for t in (3, 7, 11) if s == t or t in want.get(s, {})}
    for r in got:
        assert len(r.path) == r.depth + 1 and r.path[0] == r.start and r.path[-1] == r.node and all(p in pairs for p in zip(r.path, r.path[1:]))


def test_levels_of_trees_and_their_cycles(spark):
    pick = random.Random(9)
    pairs = [(pick.randrange(k), k) for k in range(1, 60)]
    level = {0: 0}
    for a, b in pairs:
        level[b] = level[a] + 1
    assert {r.node: r.level for r in P.levels(edges_of(spark, pairs)).collect()} == level
    with pytest.raises(ValueError, match="cycle"):
        P.levels(edges_of(spark, [(1, 2), (2, 3), (3, 1)])).count()


def test_components(spark):
    pick = random.Random(2)
    pairs = [(k, k + 1) for k in range(300, 0, -1)] + [(pick.randrange(1000, 1400), pick.randrange(1000, 1400)) for _ in range(260)] + [(5000, 5000)]
    parent = {x: x for p in pairs for x in p}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    assert {r.node: r.root for r in O.components(edges_of(spark, pairs)).collect()} == {x: root(x) for x in parent}
    assert O.components(edges_of(spark, []).limit(0)).count() == 0


def test_reduction(spark):
    pick = random.Random(6)
    pairs = sorted({(a, b) for a, b in ((pick.randrange(12), pick.randrange(12)) for _ in range(40)) if a < b})
    want, direct = reach(pairs), set(pairs)
    df = edges_of(spark, [*pairs, (3, 3)]).withColumn("k", F.lit("g"))
    kept, cyclic = O.transitive_reduction(df, ["k"])
    spare = {(a, b) for a, b in direct if any((a, c) in direct and b in want.get(c, {}) for c in range(12) if c != b)}
    assert {(r.src, r.dst) for r in kept.collect()} == direct - spare and cyclic.count() == 0
    kept, cyclic = O.transitive_reduction(edges_of(spark, [(1, 2), (2, 1), (2, 3), (3, 4), (2, 4)]))
    assert {r.node for r in cyclic.collect()} == {1, 2} and {(1, 2), (2, 1), (3, 4)} <= {(r.src, r.dst) for r in kept.collect()}
