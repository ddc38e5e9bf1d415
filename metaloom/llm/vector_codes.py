"""Product codes of vectors: each part's nearest entry of a codebook that dual-tree Lloyd rounds have fitted.

Vectors become whole numbers and are cut into equal parts; each part position has a codebook of its own. Everything is
counted in integers, so the outcome depends on neither the order of rows nor their partitioning.

Trees over parts. Each task cuts its rows into blocks of BLOCK vectors. In a block each position has a balanced tree:
a node's parts are sorted along its widest dimension and halved, down to LEAF parts. A node caches its bounding box, the
sum of its parts and their number. Blocks are written once, and read again by each round.

Trees over entries. A round builds such a tree over each position's entries (at most a few bytes, sent to the tasks).

A round walks down both trees at once. Distances between the boxes of two nodes bound those of all pairs in them: where
the least exceeds another node's greatest, the combination is pruned. As soon as one entry is left for a node of parts,
the cached sum and number are its whole contribution. Below single entries another bound follows: an entry that is
farther than another for every place in the box goes too. Leaves where several entries stay are decided by integer distances of each part, ties
to the lower index. A task returns one sum for each entry and position; Spark adds them up, and the new entries, bounded
by parts * entries, come to the driver.

Defined cases: rows whose vector is null, empty, or holds null or non-finite components are dropped, and those whose
length isn't that of the row with the smallest id. Lengths that can't be cut into equal parts are filled up with
zeros. Whole numbers beyond 2**27 are held there. Repeated rows count each; rows with equal ids are ordered by their
vectors, null ids come last. Where there are fewer rows than entries, the codebooks are smaller. An empty table gives an
empty result; other columns of any name stay out of the way.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from .common import save
from .vectors import matrix, whole

#: Vectors in a block, and parts in a leaf.
BLOCK, LEAF = 2048, 16
SCALE, PARTS, ENTRIES, ROUNDS, BOUND = 4096, 8, 16, 6, 2**27
#: Labels with more than this share of all rows meet their sums by broadcast: at most so many.
HOT_LABELS = 1000


class Tree:
    """Balanced trees over points [trees, n, dims], all of one shape. Level k has 2**k nodes; rows of a node are consecutive in order."""

    def __init__(self, points: np.ndarray, leaf: int, order: np.ndarray | None = None):
        trees, n, dims = points.shape
        self.depth = 0
        while n > leaf << self.depth:
            self.depth += 1
        self.size = -(-n // (1 << self.depth)) << self.depth
        self.order = self._sorted(points) if order is None else order
        self.real = self.order < n
        placed = np.take_along_axis(points, np.minimum(self.order, n - 1)[:, :, None], 1)
        self.placed, weight = placed, self.real[:, :, None]
        low, high = placed.reshape(trees, 1 << self.depth, -1, dims).min(2), placed.reshape(trees, 1 << self.depth, -1, dims).max(2)
        total, count = (placed * weight).reshape(trees, 1 << self.depth, -1, dims).sum(2), self.real.reshape(trees, 1 << self.depth, -1).sum(2)
        self.low, self.high, self.total, self.count = [low], [high], [total], [count]
        for _ in range(self.depth):
            pairs = lambda x: x.reshape(trees, x.shape[1] // 2, 2, *x.shape[2:])
            low, high, total, count = pairs(low).min(2), pairs(high).max(2), pairs(total).sum(2), pairs(count).sum(2)
            for levels, x in ((self.low, low), (self.high, high), (self.total, total), (self.count, count)):
                levels.insert(0, x)

    def _sorted(self, points: np.ndarray) -> np.ndarray:
        """Positions in tree order; those from n on stand for copies of the last point that count nothing."""
        trees, n, dims = points.shape
        order = np.tile(np.arange(self.size), (trees, 1))
        for level in range(self.depth):
            nodes = order.reshape(trees, 1 << level, -1)
            of = np.take_along_axis(points, np.minimum(order, n - 1)[:, :, None], 1).reshape(trees, 1 << level, -1, dims)
            widest = (of.max(2) - of.min(2)).argmax(2)
            along = np.take_along_axis(of, widest[:, :, None, None], 3)[..., 0]
            order = np.take_along_axis(nodes, along.argsort(2, kind="stable"), 2).reshape(trees, -1)
        return order


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ((a - b) ** 2).sum(-1)


def walk(points: Tree, books: np.ndarray) -> tuple[np.ndarray, dict[str, int]]:
    """Each part's entry [trees, rows in tree order], and how the work was shared out. books: [trees, entries, dims]."""
    trees, n_entries, _ = books.shape
    entries = Tree(books, 1)
    found = np.full(points.order.shape, -1, dtype=np.int64)
    # pairs of a node of parts and a node of entries that are still possible, level by level of both trees
    possible = np.ones((trees, 1, 1), dtype=bool)
    work = {"pairs": 0, "whole": 0, "leaf": 0}
    for level in range(max(points.depth, entries.depth) + 1):
        at, of = min(level, points.depth), min(level, entries.depth)
        if level > 0:
            possible = np.repeat(possible, 2, 1) if at == level else possible
            possible = np.repeat(possible, 2, 2) & (entries.count[of] > 0)[:, None, :] if of == level else possible
        t, p, e = np.nonzero(possible)
        if not len(t):
            break
        a_low, a_high, b_low, b_high = points.low[at][t, p], points.high[at][t, p], entries.low[of][t, e], entries.high[of][t, e]
        nearest = (np.maximum(0, np.maximum(a_low - b_high, b_low - a_high)) ** 2).sum(1)
        farthest = (np.maximum(a_high - b_low, b_high - a_low) ** 2).sum(1)
        best = np.full(possible.shape[:2], np.iinfo(np.int64).max)
        np.minimum.at(best, (t, p), farthest)
        stays = nearest <= best[t, p]
        possible[t, p, e] = stays
        work["pairs"] += len(t)
        if of == entries.depth:
            # the entry whose greatest distance is least, against each other: the difference is linear, so a corner of the box has its extreme
            far = np.full(possible.shape, np.iinfo(np.int64).max)
            far[t, p, e] = farthest
            rival = np.where(possible, far, np.iinfo(np.int64).max).argmin(2)
            t, p, e = np.nonzero(possible)
            mine, other = entries.placed[t, e], entries.placed[t, rival[t, p]]
            toward = other - mine
            least = (mine**2).sum(1) - (other**2).sum(1) + 2 * np.where(toward > 0, points.low[at][t, p] * toward, points.high[at][t, p] * toward).sum(1)
            possible[t, p, e] = least <= 0
            # one entry left: the node is assigned as a whole
            single = possible.sum(2) == 1
            t, p = np.nonzero(single)
            if len(t):
                width = points.size >> at
                found.reshape(trees, -1, width)[t, p] = entries.order[t, possible[t, p].argmax(1)][:, None]
                work["whole"] += len(t)
                possible[t, p] = False
    width = points.size >> points.depth
    t, p = np.nonzero(possible.any(2))
    if len(t):
        # uncertain leaves: integer distances of each part to each entry that is left, in the order of the entries' own indexes
        back = np.argsort(entries.order, 1, kind="stable")[:, :n_entries]
        left = np.take_along_axis(possible[t, p], back[t], 1)
        of = points.placed.reshape(trees, -1, width, points.placed.shape[2])[t, p]
        best, which = np.full(of.shape[:2], np.iinfo(np.int64).max), np.zeros(of.shape[:2], dtype=np.int64)
        for k in range(n_entries):
            some = np.nonzero(left[:, k])[0]
            d = squared(of[some], books[t[some], k][:, None, :])
            nearer = d < best[some]
            best[some] = np.where(nearer, d, best[some])
            which[some] = np.where(nearer, k, which[some])
        found.reshape(trees, -1, width)[t, p] = which
        work["leaf"] += len(t)
    return found, work


def sums(points: Tree, found: np.ndarray, entries: int) -> tuple[np.ndarray, np.ndarray]:
    """Sum and number of the parts of each entry: whole nodes that agree give their cached ones."""
    trees, _, dims = points.placed.shape
    total, count = np.zeros((trees, entries, dims), dtype=np.int64), np.zeros((trees, entries), dtype=np.int64)
    open_ = np.ones((trees, 1), dtype=bool)
    for level in range(points.depth + 1):
        nodes = found.reshape(trees, 1 << level, -1)
        first = nodes[:, :, 0]
        agree = (nodes == first[:, :, None]).all(2) & open_
        t, p = np.nonzero(agree)
        np.add.at(total, (t, first[t, p]), points.total[level][t, p])
        np.add.at(count, (t, first[t, p]), points.count[level][t, p])
        open_ = open_ & ~agree
        if level < points.depth:
            open_ = np.repeat(open_, 2, 1)
    t, p = np.nonzero(open_)
    if len(t):
        width = points.size >> points.depth
        which, real = found.reshape(trees, -1, width)[t, p].ravel(), points.real.reshape(trees, -1, width)[t, p].ravel()
        of, where = points.placed.reshape(trees, -1, width, dims)[t, p].reshape(-1, dims), np.repeat(t, width)
        np.add.at(total, (where[real], which[real]), of[real])
        np.add.at(count, (where[real], which[real]), 1)
    return total, count


def _cut(x: np.ndarray, parts: int) -> np.ndarray:
    """Rows [n, dims] as [parts, n, dims / parts], filled up with zeros."""
    missing = -x.shape[1] % parts
    if missing:
        x = np.concatenate([x, np.zeros((len(x), missing), dtype=x.dtype)], 1)
    return np.ascontiguousarray(x.reshape(len(x), parts, -1).transpose(1, 0, 2))


def _loaded(row: dict, parts: int) -> Tree:
    x = np.frombuffer(row["points"], dtype="<i4").astype(np.int64).reshape(parts, row["n"], -1)
    order = np.frombuffer(row["places"], dtype="<u2").astype(np.int64).reshape(parts, -1)
    return Tree(x, LEAF, order)


def blocks(rows: DataFrame, parts: int) -> DataFrame:
    """id, label (arrays), n, points, places (binary): up to BLOCK rows of (id, label, x) each, with their parts and the order of their trees."""
    kind = StructType([StructField("id", ArrayType(rows.schema["id"].dataType)), StructField("label", ArrayType(rows.schema["label"].dataType)), StructField("n", LongType()), *(StructField(c, BinaryType()) for c in ("points", "places"))])

    def made(table: pa.Table) -> pa.RecordBatch:
        x = _cut(matrix(table.column("x").combine_chunks()), parts)
        tree = Tree(x, LEAF)
        lists = [pa.ListArray.from_arrays([0, table.num_rows], table.column(c).combine_chunks()) for c in ("id", "label")]
        return pa.RecordBatch.from_arrays([*lists, pa.array([table.num_rows], pa.int64()), pa.array([x.astype("<i4").tobytes()]), pa.array([tree.order.astype("<u2").tobytes()])], ["id", "label", "n", "points", "places"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            some = pa.Table.from_batches([batch])
            held = some if held is None else pa.concat_tables([held, some])
            while held.num_rows >= BLOCK:
                yield made(held.slice(0, BLOCK))
                held = held.slice(BLOCK)
        if held is not None and held.num_rows:
            yield made(held)

    return save(rows.select("id", "label", "x").mapInArrow(build, kind), "code-blocks")


def _round(trees: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round: floors of the means; entries without parts stay."""
    parts, entries, dims = books.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((parts, entries, dims), dtype=object), np.zeros((parts, entries), dtype=np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                tree = _loaded(row, parts)
                s, n = sums(tree, walk(tree, books)[0], entries)
                total, count = total + s.astype(object), count + n
        p, e = np.nonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(count[p, e], pa.int64()), pa.array([[str(x) for x in total[a, b]] for a, b in zip(p, e)], pa.list_(pa.string()))], ["part", "entry", "n", "total"])

    each = trees.select("n", "points", "places").mapInArrow(add, "part int, entry int, n bigint, total array<string>")
    added = [F.sum(F.get("total", F.lit(k)).cast("decimal(38,0)")).alias(f"t{k}") for k in range(dims)]
    new = books.copy()
    for row in each.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*added).alias("total")).collect():
        new[row.part, row.entry] = [int(x) // row.n for x in row.total]
    return new


def fit(rows: DataFrame, trees: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks [parts, entries, dims of a part], from the parts of the rows with the smallest ids on."""
    first = rows.orderBy(F.col("id").asc_nulls_last(), "x").select("x").limit(entries).collect()
    books = _cut(np.array([r.x for r in first], dtype=np.int64), parts)
    for _ in range(rounds):
        books = _round(trees, books)
    return books


def encode(trees: DataFrame, books: np.ndarray) -> DataFrame:
    """id, label, code (index of each part's entry, two hex digits each), error (squared distances summed up)."""
    parts, schema = len(books), trees.schema
    kind = StructType([StructField("id", schema["id"].dataType.elementType), StructField("label", schema["label"].dataType.elementType), StructField("code", StringType()), StructField("error", LongType())])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.select(["n", "points", "places"]).slice(k, 1).to_pylist()[0]
                tree = _loaded(row, parts)
                found = walk(tree, books)[0]
                off = squared(tree.placed, np.take_along_axis(books, found[:, :, None], 1))
                codes, errors = np.empty((row["n"], parts), dtype=np.uint8), np.zeros(row["n"], dtype=np.int64)
                for p in range(parts):
                    at = tree.order[p][tree.real[p]]
                    codes[at, p] = found[p][tree.real[p]]
                    errors[at] += off[p][tree.real[p]]
                lists = [batch.column(c).slice(k, 1).flatten() for c in ("id", "label")]
                yield pa.RecordBatch.from_arrays([*lists, pa.array([c.tobytes().hex() for c in codes]), pa.array(errors)], ["id", "label", "code", "error"])

    return trees.mapInArrow(assign, kind)


def fingerprint(books: np.ndarray) -> str:
    """SHA-256 of all components in decimal, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def with_label_errors(coded: DataFrame) -> DataFrame:
    """coded with label_error: error summed over equal labels, nulls together. A label of many rows isn't gathered in one task."""
    coded = save(coded, "codes")
    of = save(coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"), F.count("*").alias("n")), "label-errors")
    total = coded.count()
    hot = F.broadcast(of.filter(F.col("n") * HOT_LABELS > total).select("of", "label_error"))
    rest = of.filter(F.col("n") * HOT_LABELS <= total).select("of", "label_error")
    same = coded["label"].eqNullSafe(F.col("of"))
    cold = coded.join(hot.select("of"), same, "left_anti")
    return coded.join(hot, same).unionByName(cold.join(rest, cold["label"].eqNullSafe(F.col("of")))).drop("of")


def report(embeddings: DataFrame, id_: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256: a row for each vector that is kept."""
    kept = whole(embeddings.select(F.col(id_).alias("id"), F.col(label).alias("label"), F.col(vector).alias("v")), "v", scale, 0, BOUND).drop("v").filter(F.size("x") > 0)
    smallest = kept.agg(F.min(F.struct(F.col("id").isNull(), F.col("id"), F.size("x").alias("dims"))).alias("s")).first().s
    kept = kept.filter(F.size("x") == (smallest.dims if smallest else 0))
    trees = blocks(kept, parts)
    books = fit(kept, trees, parts, entries, rounds) if smallest else np.zeros((parts, entries, 1), dtype=np.int64)
    out = with_label_errors(encode(trees, books))
    return out.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(fingerprint(books)).alias("codebooks_sha256"))


def sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """The report for DuckDB: every distance computed, no trees. Lengths that parts divides."""
    near = f"SELECT r, p, min(list_sum(list_transform(list_zip(x, b.y), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) * {entries} + e)::BIGINT AS best FROM parts JOIN book{{k}} b USING (p) GROUP BY r, p"
    steps = ""
    for k in range(rounds):
        steps += f"""near{k} AS MATERIALIZED ({near.format(k=k)}),
        mean{k} AS MATERIALIZED (SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS y FROM (
            SELECT p, e, j, sum(c)::BIGINT AS s, count(*) AS n FROM (SELECT p, best % {entries} AS e, unnest(x) AS c, generate_subscripts(x, 1) AS j FROM near{k} JOIN parts USING (r, p)) GROUP BY p, e, j) GROUP BY p, e),
        book{k + 1} AS MATERIALIZED (SELECT p, e, coalesce(m.y, b.y) AS y FROM book{k} b LEFT JOIN mean{k} m USING (p, e)),
        """
    return f"""
    WITH kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id, v) AS r, vec_id, label, v FROM (SELECT vec_id, label, list_transform(embedding, lambda c: CAST(floor({scale} * CAST(c AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0)),
        parts AS MATERIALIZED (SELECT r, p, v[p * len(v) // {parts} + 1:(p + 1) * len(v) // {parts}] AS x FROM kept, range({parts}) t(p)),
        book0 AS MATERIALIZED (SELECT p, r - 1 AS e, x AS y FROM parts WHERE r <= {entries}),
        {steps}near AS MATERIALIZED ({near.format(k=rounds)}),
        coded AS (SELECT r, string_agg(printf('%02x', best % {entries}), '' ORDER BY p) AS code, sum(best // {entries})::BIGINT AS error FROM near GROUP BY r)
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
        (SELECT sha256(string_agg(array_to_string(y, ','), ',' ORDER BY p, e)) FROM book{rounds}) AS codebooks_sha256
    FROM coded JOIN kept USING (r)"""
