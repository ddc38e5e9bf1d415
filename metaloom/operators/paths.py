"""Closures, shortest paths and levels.

Where every node has one way on at most, or one way back (replies, parents, lists, trees), jumps are doubled: a graph of
any depth takes as many rounds as its depth has binary digits. Elsewhere a frontier is joined with the edges until nothing
new is found; its layers are tables of their own, so that no round writes again what an earlier one has found.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import save

#: Layers after which they are written as one table.
_LAYERS = 16


def _cut(df: DataFrame) -> DataFrame:
    return save(df, "frontier")


def _together(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def narrow(links: DataFrame) -> bool:
    """Whether every node of distinct edges has one edge out at most, or every node one edge in."""
    most = lambda c: (links.groupBy(c).count().agg(F.max("count")).first()[0] or 0) <= 1
    return most("src") or most("dst")


def doubled(jumps: DataFrame) -> DataFrame:
    """Edges of twice as many steps. On narrow edges they are never more than the edges themselves."""
    a, b = jumps.alias("a"), jumps.alias("b")
    return _cut(a.join(b, F.col("a.dst") == F.col("b.src")).select(F.col("a.src").alias("src"), F.col("b.dst").alias("dst")))


def _reach(links: DataFrame, frontier: DataFrame, max_depth: int | None) -> DataFrame:
    """closure() of narrow edges, without the seeds themselves: what is reached in 1 to 2**k steps, and from there by jumps of 2**k steps."""
    found = _cut(frontier.join(links, frontier.node == links.src).select("start", F.col("dst").alias("node"), F.lit(1).alias("depth")))
    jumps, step, n = links, 1, found.count()
    while n > 0 and (max_depth is None or step < max_depth):
        further = found.join(jumps, found.node == jumps.src).select("start", F.col("dst").alias("node"), (F.col("depth") + step).alias("depth"))
        found = _cut(found.unionByName(further).groupBy("start", "node").agg(F.min("depth").alias("depth")))
        if (now := found.count()) == n:
            break
        n, step = now, 2 * step
        if max_depth is None or step < max_depth:
            jumps = doubled(jumps)
    return found if max_depth is None else found.filter(F.col("depth") <= max_depth)


def closure(edges: DataFrame, seeds: DataFrame, max_depth: int | None = None, zero: bool = False) -> DataFrame:
    """edges: src, dst; seeds: start. Returns start, node, depth (of the shortest path): what each seed reaches in at least one step (zero: or none), up to max_depth steps.

    Seeds are applied before the first round, and what was seen before is never joined again, so that cycles end.
    """
    links = _cut(edges.select("src", "dst").distinct())
    frontier = seeds.select("start", F.col("start").alias("node")).distinct()
    own = frontier.withColumn("depth", F.lit(0))
    if narrow(links):
        found = _reach(links, frontier, max_depth) if max_depth is None or max_depth > 0 else own.limit(0)
        return found.unionByName(own).groupBy("start", "node").agg(F.min("depth").alias("depth")) if zero else found
    found, depth = [own] if zero else [], 0
    while max_depth is None or depth < max_depth:
        depth += 1
        step = frontier.join(links, frontier.node == links.src).select("start", F.col("dst").alias("node")).distinct()
        frontier = _cut(step.join(_together(found), ["start", "node"], "left_anti") if found else step)
        if frontier.isEmpty():
            break
        found.append(frontier.withColumn("depth", F.lit(depth)))
        if len(found) > _LAYERS:
            found = [_cut(_together(found))]
    return _together(found) if found else own.limit(0)


def shortest_path(edges: DataFrame, seeds: DataFrame, targets: DataFrame, max_depth: int | None = None) -> DataFrame:
    """start, node, depth, path (of nodes, the smallest of equally short ones), for each target that a seed reaches; a seed that is a target has depth 0. Without max_depth all paths are followed to their end."""
    links = _cut(edges.select("src", "dst").distinct())
    if narrow(links):
        # there is one path only: from a node of narrow edges out it is what is reached before; with one edge in, what lies on the way back
        return _only_paths(links, seeds, targets, max_depth)
    frontier = seeds.select("start", F.col("start").alias("node"), F.array("start").alias("path")).distinct()
    found, depth = [frontier.withColumn("depth", F.lit(0))], 0
    while max_depth is None or depth < max_depth:
        depth += 1
        step = frontier.join(links, frontier.node == links.src).select("start", F.col("dst").alias("node"), F.concat("path", F.array("dst")).alias("path"))
        seen = _together(found).select("start", "node")
        frontier = _cut(step.join(seen, ["start", "node"], "left_anti").groupBy("start", "node").agg(F.min("path").alias("path")))
        if frontier.isEmpty():
            break
        found.append(frontier.withColumn("depth", F.lit(depth)))
        if len(found) > _LAYERS:
            found = [_cut(_together(found))]
    return _together(found).join(targets.select("node").distinct(), "node", "left_semi").select("start", "node", "depth", "path")


def _only_paths(links: DataFrame, seeds: DataFrame, targets: DataFrame, max_depth: int | None) -> DataFrame:
    reached = _cut(closure(links, seeds, max_depth, zero=True))
    hits = _cut(reached.join(targets.select("node").distinct(), "node", "left_semi").select("start", F.col("node").alias("target"), F.col("depth").alias("until")))
    back = closure(links.select(F.col("dst").alias("src"), F.col("src").alias("dst")), hits.select(F.col("target").alias("start")).distinct(), max_depth, zero=True)
    # on the way: as far from the start as is left to the target
    on = reached.join(hits, "start").filter("depth <= until")
    way = on.join(back.select(F.col("start").alias("target"), "node", F.col("depth").alias("rest")), ["target", "node"]).filter("depth + rest = until")
    steps = F.transform(F.array_sort(F.collect_list(F.struct("depth", "node"))), lambda s: s["node"])
    return way.groupBy("start", F.col("target").alias("node"), F.col("until").alias("depth")).agg(steps.alias("path"))


def _heights(links: DataFrame, nodes: DataFrame, n: int) -> DataFrame:
    """levels() of narrow edges: a path of 2**k steps or more is a jump of 2**k after a path that ends where it begins."""
    found, jumps, step = nodes.withColumn("level", F.lit(0)), links, 1
    while not jumps.isEmpty():
        if step > n:
            raise ValueError("a cycle")
        longer = found.join(jumps, found.node == jumps.src).select(F.col("dst").alias("node"), (F.col("level") + step).alias("level"))
        found = _cut(found.unionByName(longer).groupBy("node").agg(F.max("level").alias("level")))
        jumps, step = doubled(jumps), 2 * step
    return found


def levels(edges: DataFrame) -> DataFrame:
    """node, level: a topological order, as the length of the longest path that ends at a node. Raises on cycles, with or without a way into them."""
    links = _cut(edges.select("src", "dst").distinct())
    nodes = save(links.select(F.col("src").alias("node")).union(links.select("dst")).distinct(), "nodes")
    n, level = nodes.count(), 0
    if narrow(links):
        return _heights(links, nodes, n)
    frontier = nodes.join(links.select(F.col("dst").alias("node")), "node", "left_anti")
    found = [_cut(frontier.withColumn("level", F.lit(0)))]
    while True:
        level += 1
        frontier = _cut(found[-1].join(links, found[-1].node == links.src).select(F.col("dst").alias("node")).distinct().withColumn("level", F.lit(level)))
        if frontier.isEmpty():
            break
        if level >= n:
            raise ValueError("a cycle")
        found.append(frontier)
        if len(found) > 16:  # so that the union stays short; a node's last level is its longest
            found = [_cut(reduce(DataFrame.unionByName, found[:-1]).groupBy("node").agg(F.max("level").alias("level"))), found[-1]]
    out = _cut(reduce(DataFrame.unionByName, found).groupBy("node").agg(F.max("level").alias("level")))
    if out.count() < n:
        raise ValueError("a cycle")
    return out


def walks(edges: DataFrame, seeds: DataFrame, max_depth: int) -> DataFrame:
    """edges: src, dst, label. Returns start, node, labels: every walk of 1 to max_depth steps with its labels in order, to be filtered with F.forall or F.exists."""
    layer = seeds.select("start", F.col("start").alias("node"), F.array().cast("array<string>").alias("labels")).distinct()
    found = None
    for _ in range(max_depth):
        layer = layer.join(edges, layer.node == edges.src).select("start", F.col("dst").alias("node"), F.concat("labels", F.array("label")).alias("labels"))
        found = layer if found is None else found.unionByName(layer)
    return found


def list_items(cells: DataFrame) -> DataFrame:
    """cells: cell, first, rest (null at the end). Returns head, position, item: the linked lists as rows, by doubling jumps. Raises on cycles."""
    links = cells.filter("rest IS NOT NULL").select(F.col("cell").alias("src"), F.col("rest").alias("dst"))
    found = cells.join(links.select(F.col("dst").alias("cell")), "cell", "left_anti").select(F.col("cell").alias("head"), "cell", F.lit(0).cast("bigint").alias("position"))
    step, n = 1, cells.count()
    while not links.isEmpty():
        if step > 2 * n:
            raise ValueError("a cycle")
        further = found.join(links, found.cell == links.src).select("head", F.col("dst").alias("cell"), (F.col("position") + step).alias("position"))
        found = _cut(found.unionByName(further))
        a, b = links.alias("a"), links.alias("b")
        links = _cut(a.join(b, F.col("a.dst") == F.col("b.src")).select(F.col("a.src").alias("src"), F.col("b.dst").alias("dst")))
        step *= 2
    return found.join(cells.select("cell", F.col("first").alias("item")), "cell").select("head", "position", "item")
