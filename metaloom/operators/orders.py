"""Graphs as partial orders: connected components, transitive closure and reduction, cycles, and orders merged by what they belong to.

Graphs are tables of edges (src, dst); where many small graphs lie in one table, keys are the columns that tell them apart.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import save

#: A bound that no graph reaches: components need about as many rounds as their number of nodes has binary digits.
MAX_ROUNDS = 100


def components(edges: DataFrame) -> DataFrame:
    """node, root: each node of an edge, with the smallest node that it is connected with.

    Each node has a parent, at first the smallest node beside it. In a round trees are hooked under the smallest grandparent beside any of their nodes, and paths to the
    root are halved. Only (node, parent) and the edges are held; minima are combined before the shuffle.
    """
    links = edges.select("src", "dst").filter("src <> dst")
    both = save(links.unionByName(links.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct(), "links")
    alone = edges.select(F.col("src").alias("node")).filter("node IS NOT NULL").union(edges.select("dst").filter("dst IS NOT NULL")).distinct()
    near = both.groupBy(F.col("src").alias("node")).agg(F.min("dst").alias("least"))
    state = save(alone.join(near, "node", "left").select("node", F.least("node", "least").alias("parent")), "parents")
    for _ in range(MAX_ROUNDS):
        up = state.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
        known = save(state.join(up, "parent").select("node", "parent", "grand"), "grandparents")
        beside = both.join(known.select(F.col("node").alias("dst"), "grand"), "dst").groupBy(F.col("src").alias("node")).agg(F.min("grand").alias("m"))
        told = known.join(beside, "node", "left")
        own = told.select("node", F.least("parent", "grand", "m").alias("parent"))
        hooked = told.filter("m IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.min("m").alias("parent"))
        new = save(own.unionByName(hooked).groupBy("node").agg(F.min("parent").alias("parent")), "parents")
        if new.join(state, ["node", "parent"], "left_anti").isEmpty():
            return state.withColumnRenamed("parent", "root")
        state = new
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")


def transitive_closure(edges: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """keys, src, dst: all pairs with a way from src to dst, by squaring: as many rounds as the longest way has binary digits. A node on a cycle has a way to itself."""
    found = save(edges.select(*keys, "src", "dst").distinct(), "ways")
    n = found.count()
    while True:
        a, b = found.withColumnRenamed("dst", "_mid"), found.withColumnRenamed("src", "_mid")
        found = save(found.unionByName(a.join(b, [*keys, "_mid"]).select(*keys, "src", "dst")).distinct(), "ways")
        if (now := found.count()) == n:
            return found
        n = now


def transitive_reduction(edges: DataFrame, keys: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """The edges without which the order would be another, self edges dropped: those of which no other way leads from src to dst. And keys, node of all nodes on cycles, whose edges stay as they are."""
    plain = save(edges.select(*keys, "src", "dst").filter("src <> dst").distinct(), "edges")
    ways = transitive_closure(plain, keys)
    cyclic = save(ways.filter("src = dst").select(*keys, F.col("src").alias("node")).distinct(), "cyclic")
    # a way of two steps or more that does not begin or end on a cycle through the edge itself
    on = plain.withColumnRenamed("dst", "_mid").join(ways.withColumnRenamed("src", "_mid"), [*keys, "_mid"]).select(*keys, "src", "dst").distinct()
    ends = lambda c: cyclic.select(*keys, F.col("node").alias(c))
    spare = on.join(ends("src"), [*keys, "src"], "left_anti").join(ends("dst"), [*keys, "dst"], "left_anti")
    return plain.join(spare, [*keys, "src", "dst"], "left_anti"), cyclic


def partial_orders(edges: DataFrame, places: DataFrame, owners: DataFrame) -> DataFrame:
    """owner, src, dst: edges between links as edges between their places, merged by owner.

    edges: src, dst (links); places: link, place; owners: link, owner. A connected graph belongs to the owner of any of its links, the smallest if there are several; one without owner is
    told apart by its smallest link. Edges from a place to itself are dropped, unless an owner has no others.
    """
    roots = components(edges)
    named = roots.join(owners.select(F.col("link").alias("node"), "owner"), "node").groupBy("root").agg(F.min("owner").alias("owner"))
    owner = F.coalesce("owner", F.concat(F.lit("_:"), F.col("root").cast("string")))
    of = roots.join(named, "root", "left").select(F.col("node").alias("src"), owner.alias("owner"))
    at = lambda c, to: places.select(F.col("link").alias(c), F.col("place").alias(to))
    placed = save(edges.join(of, "src").join(at("src", "_a"), "src").join(at("dst", "_b"), "dst").select("owner", F.col("_a").alias("src"), F.col("_b").alias("dst")).distinct(), "placed")
    other = placed.filter("src <> dst")
    return other.unionByName(placed.filter("src = dst").join(other.select("owner").distinct(), "owner", "left_anti"))
