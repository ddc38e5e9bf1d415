"""Hierarchies, snapshot differences and an append-only change log.

A log has key, uct (when a change was recorded), delta (0 in a keyframe, which holds a whole snapshot), op (upsert or
remove) and the value columns. A snapshot has one row a key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import save
from .relational import growing

KEYFRAME = 40


def diff(old: DataFrame, new: DataFrame, key: str | Sequence[str], values: Sequence[str]) -> DataFrame:
    """key (one or several columns), change (added, removed or changed) and new's values."""
    key = [key] if isinstance(key, str) else list(key)
    a, b = old.select(*key, F.struct(*values).alias("was"), F.lit(1).alias("a")), new.select(*key, F.struct(*values).alias("now"), F.lit(1).alias("b"))
    change = F.when(F.col("a").isNull(), "added").when(F.col("b").isNull(), "removed").when(~F.col("was").eqNullSafe(F.col("now")), "changed")
    return a.join(b, key, "full").select(*key, change.alias("change"), "now.*").filter("change IS NOT NULL")


def append(snapshots: DataFrame, key: str, values: Sequence[str], step: str, keyframe: int = KEYFRAME) -> DataFrame:
    """The log of numbered snapshots (step 0, 1, ...): a whole snapshot every keyframe steps, else only what has changed."""
    by_key = Window.partitionBy(key).orderBy(step)
    now = F.struct(*values)
    same = (F.lag(step).over(by_key) == F.col(step) - 1) & F.lag(now).over(by_key).eqNullSafe(now)
    rows = snapshots.withColumn("_same", F.coalesce(same, F.lit(False))).withColumn("_next", F.lead(step).over(by_key))
    delta = F.col(step) % keyframe
    upserts = rows.filter((delta == 0) | ~F.col("_same")).select(key, F.col(step).alias("uct"), delta.alias("delta"), F.lit("upsert").alias("op"), *values)
    last = snapshots.agg(F.max(step).alias("_last"))
    gone = rows.join(F.broadcast(last), F.col(step) < F.col("_last")).filter(F.col("_next").isNull() | (F.col("_next") > F.col(step) + 1)).withColumn("uct", F.col(step) + 1)
    gone = gone.filter(F.col("uct") % keyframe != 0).select(key, "uct", (F.col("uct") % keyframe).alias("delta"), F.lit("remove").alias("op"), *(F.lit(None).cast(dict(snapshots.dtypes)[v]).alias(v) for v in values))
    return upserts.unionByName(gone)


def replay(log: DataFrame, key: str, at: Column | None = None, order: Sequence[str] = ("uct",)) -> DataFrame:
    """The snapshot after the log's last change, or after the last one not later than at. Newest first, the first row of a key counts; removed keys are left out.

    Only the rows from the last keyframe on are read, where deltas are kept.
    """
    some = log if at is None else log.filter(F.col(order[0]) <= at)
    if "delta" in log.columns:
        start = some.filter("delta = 0").agg(F.max(order[0]).alias("_start"))
        some = some.join(F.broadcast(start), F.col(order[0]) >= F.coalesce("_start", F.col(order[0]))).drop("_start")
    newest = Window.partitionBy(key).orderBy(*(F.desc(c) for c in order))
    return some.withColumn("_n", F.row_number().over(newest)).filter("_n = 1 AND op = 'upsert'").drop("_n")


def _circling(links: DataFrame) -> DataFrame:
    """_lost: of links (id, _top: its parent) the nodes on or below a cycle, by doubling jumps.

    A jump of 2**k steps is left for the nodes that are so deep. Depths have no gaps, so where doubling loses no jump those that are left lead round. No names are carried: round a cycle they would double, too.
    """
    jumps = save(links.select("id", "_top").distinct(), "jumps")
    n = jumps.count()
    for _ in range(n.bit_length()):
        a, b = jumps.alias("a"), growing(jumps.alias("b"))
        jumps = save(a.join(b, F.col("a._top") == F.col("b.id")).select(F.col("a.id").alias("id"), F.col("b._top").alias("_top")), "jumps")
        if (now := jumps.count()) == n:
            break
        n = now
    return jumps.select(F.col("id").alias("_lost")).distinct()


def tree_paths(nodes: DataFrame) -> DataFrame:
    """nodes: id, parent_id, name. Adds path (names from the root), depth and error, by doubling jumps: a tree of depth n takes log2(n) rounds.

    Nodes whose parent is missing begin a path of their own; those on or below a cycle have no path, and the error "cycle".
    """
    known = growing(nodes.select(F.col("id").alias("_top")))
    linked = save(nodes.join(known, nodes.parent_id == known._top, "left"), "parents")
    lost = growing(save(_circling(linked.filter("_top IS NOT NULL")), "lost"))
    # a node is on or below a cycle if its parent is
    below = linked._top == lost._lost
    none = linked.join(lost, below, "left_semi").select(*nodes.columns, F.lit(None).cast("string").alias("path"), F.lit(None).cast("int").alias("depth"), F.lit("cycle").alias("error"))
    state = save(linked.join(lost, below, "left_anti").withColumn("path", F.col("name")).withColumn("depth", F.lit(0)), "paths")
    for _ in range(state.count().bit_length()):
        if state.filter("_top IS NOT NULL").isEmpty():
            break
        above = growing(state.select(F.col("id").alias("_at"), F.col("_top").alias("_next"), F.col("path").alias("_path"), F.col("depth").alias("_depth")))
        met = state.join(above, state._top == above._at, "left")
        further = F.when(F.col("_at").isNotNull(), F.col("_depth") + 1).otherwise(0)
        state = save(met.select(*nodes.columns, F.col("_next").alias("_top"), F.concat_ws("/", "_path", "path").alias("path"), (F.col("depth") + further).alias("depth")), "paths")
    return state.select(*nodes.columns, "path", "depth", F.lit(None).cast("string").alias("error")).unionByName(none)


def classify(local: DataFrame, index: DataFrame) -> DataFrame:
    """id, changes: of each object what differs between a listing and the index (id, parent_id, name, size): several may apply."""
    a = local.select("id", *(F.col(c).alias(f"a_{c}") for c in ("parent_id", "name", "size")), F.lit(1).alias("in_a"))
    b = index.select("id", *(F.col(c).alias(f"b_{c}") for c in ("parent_id", "name", "size")), F.lit(1).alias("in_b"))
    both = F.col("in_a").isNotNull() & F.col("in_b").isNotNull()
    differs = lambda c: both & ~F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}"))
    found = F.array_compact(F.array(
        F.when(F.col("in_b").isNull(), "add"), F.when(F.col("in_a").isNull(), "remove"), F.when(differs("name"), "rename"), F.when(differs("parent_id"), "reparent"), F.when(differs("size"), "change"),
    ))
    return a.join(b, "id", "full").select("id", F.when(F.size(found) == 0, F.array(F.lit("no-change"))).otherwise(found).alias("changes"))
