"""Near copies for the pipeline: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

A text's words are those of the fingerprints (ASCII lower case, ASCII white space); one of fewer than WIDTH words is one
shingle. Candidates share a key of BANDS, each made of ROWS minimum hashes: at a similarity of 0.8, a pair has none with
a probability of (1 - 0.8^5)^32 = 3e-6. 64-bit fingerprints can't do that: such pairs differ in 9.7 bits on average, with
a deviation of 2.9, so keys would have to allow for some 20. Each candidate's similarity is then counted on the sets.

Only components matter, so groups of many copies are not paired off: under each key, all are compared with the key's
smallest and largest node first; then nodes under keys that still hold several components meet by their rarest shingles,
which finds every similar pair of different components without pairing off what shares a key.

Texts of the same words are one node. Texts without words are one node, and like no other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import save
from .components import components

WIDTH = 5
#: The least similarity, as a fraction.
SIMILAR = (4, 5)
BANDS, ROWS = 32, 5
#: Bytes of text taken together.
SLICE = 500_000
SEED = 42
_odd = lambda n, seed: np.random.default_rng([SEED, seed]).integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1)
PLACES, ORDERS, JOINS = _odd(WIDTH, 1), _odd(BANDS * ROWS, 2), _odd(BANDS * ROWS, 3).reshape(BANDS, ROWS)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[list[bytes]]) -> list[np.ndarray]:
    """Of texts, as lists of words: the sorted different hashes of the shingles of each."""
    coded = pa.array([w for t in texts for w in t], pa.binary()).dictionary_encode()
    hashes = np.fromiter((xxhash.xxh64_intdigest(w, SEED) for w in coded.dictionary.to_pylist()), np.uint64)
    words, at, found = hashes[coded.indices.to_numpy()], 0, []
    for t in texts:
        own = words[at : at + len(t)]
        at += len(t)
        n, width = max(min(len(t), 1), len(t) - WIDTH + 1), min(WIDTH, len(t))
        sums = np.full(n, width, np.uint64)
        for i in range(width):
            sums += own[i : i + n] * PLACES[i]
        found.append(np.unique(_mixed(sums)))
    return found


def band_keys(sets: list[np.ndarray]) -> np.ndarray:
    """Of sets that are not empty: their keys, a row each."""
    values, starts = np.concatenate(sets), np.cumsum([0, *map(len, sets[:-1])])
    least = np.stack([np.minimum.reduceat(values * a, starts) for a in ORDERS], 1).reshape(len(sets), BANDS, ROWS)
    return _mixed((_mixed(least) * JOINS).sum(2, dtype=np.uint64)).view(np.int64)


def _slices(column: pa.Array) -> Iterator[tuple[int, list[list[bytes]]]]:
    """First row and words of the texts of runs of about SLICE bytes."""
    first, texts, size = 0, [], 0
    for i, x in enumerate(column):
        text = x.as_py()
        texts.append(text.lower().split())  # on bytes, both know ASCII only
        size += len(text)
        if size >= SLICE:
            yield first, texts
            first, texts, size = i + 1, [], 0
    if texts:
        yield first, texts


def with_keys(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash (of the raw text), node (of the words), n (the number of different shingles), keys: a row for each of docs."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in _slices(batch.column("t")):
                nodes = np.fromiter((xxhash.xxh64_intdigest(b" ".join(t), SEED) for t in texts), np.uint64, len(texts))
                sets = shingle_sets(texts)
                sizes = np.array([len(s) for s in sets])
                keys = band_keys([s for s in sets if len(s)]).ravel() if sizes.any() else np.zeros(0, np.int64)
                ends = np.cumsum([0, *(np.minimum(sizes, 1) * BANDS)]).astype(np.int32)
                part = batch.slice(first, len(texts))
                columns = [part.column("doc_id"), part.column("text_hash"), pa.array(nodes.view(np.int64)), pa.array(sizes.astype(np.int32)), pa.ListArray.from_arrays(pa.array(ends), pa.array(keys))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "node", "n", "keys"])

    told = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.coalesce("text", F.lit("")).cast("binary").alias("t"))
    return told.mapInArrow(run, f"doc_id {id_type}, text_hash bigint, node bigint, n int, keys array<bigint>")


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """wanted: node, doc_id, text_hash (a row of docs that has the node's text). Returns node, shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in _slices(batch.column("t")):
                sets = shingle_sets(texts)
                ends = pa.array(np.cumsum([0, *map(len, sets)]).astype(np.int32))
                values = pa.array(np.concatenate(sets).view(np.int64))
                yield pa.RecordBatch.from_arrays([batch.column("node").slice(first, len(texts)), pa.ListArray.from_arrays(ends, values)], ["node", "shingles"])

    of = wanted.select("node", F.col("text_hash").alias("wanted_hash"), F.xxhash64("doc_id", "text_hash").alias("k")).hint("merge")
    rows = docs.select(F.xxhash64("text").alias("h"), F.coalesce("text", F.lit("")).cast("binary").alias("t"), "doc_id").withColumn("k", F.xxhash64("doc_id", "h"))
    # as in keep_one: one key, by which rows stay dealt for the window
    met = rows.join(of, (rows.k == of.k) & (rows.h.bitwiseXOR(of.wanted_hash) == 0)).select("node", "t", rows.k)
    one = met.withColumn("at", F.row_number().over(Window.partitionBy("k").orderBy("k"))).filter("at = 1")
    return one.select("node", "t").mapInArrow(run, "node bigint, shingles array<bigint>")


def _alike(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of pairs (u, v) whose sets are similar. Sets meet in the JVM, a pair at a time, so that no batch of large sets is ever held."""
    of = lambda node, name: sets.select(F.col("node").alias(node), F.col("shingles").alias(name))
    met = pairs.join(of("u", "a"), "u").join(of("v", "b"), "v").withColumn("common", F.size(F.array_intersect("a", "b")))
    return met.filter(F.col("common") * SIMILAR[1] >= SIMILAR[0] * (F.size("a") + F.size("b") - F.col("common"))).select("u", "v")


def _pairs(found: DataFrame, a: Column, b: Column) -> DataFrame:
    """u, v (u < v), once each, of structs a and b of node and n, where the sizes allow for a similar pair."""
    sized = found.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).filter("a.node < b.node")
    most, least = F.greatest("a.n", "b.n"), F.least("a.n", "b.n")
    return sized.filter(least * SIMILAR[1] >= most * SIMILAR[0]).select(F.col("a.node").alias("u"), F.col("b.node").alias("v")).distinct()


def _prefix_pairs(sets: DataFrame, roots: DataFrame) -> DataFrame:
    """roots: node, root. Returns u, v (u < v), once each: every two nodes of different roots that are similar, and few others.

    Shingles are ordered by the number of nodes that hold them, those of a single root first, which meet nothing. Similar sets
    of n shingles share one of the first n - ceil(0.8 n) + 1 of each; at the first that they share, enough must be left of both.
    """
    held = sets.join(roots, "node").select("node", "root", F.size("shingles").alias("n"), F.explode("shingles").alias("h"))
    common = held.groupBy("h").agg(F.count("*").alias("c"), F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi")
    own = Window.partitionBy("node")
    placed = held.join(common.select("h", "c"), "h").withColumn("at", F.col("n") - F.count("*").over(own) + F.row_number().over(own.orderBy("c", "h")))
    # n - ceil(n * s / t) + 1, in whole numbers
    prefix = placed.filter(F.col("at") <= F.floor(F.col("n") * (SIMILAR[1] - SIMILAR[0]) / SIMILAR[1]) + 1).select("h", F.struct("node", "n", "at", "root").alias("a"))
    prefix = save(prefix, "near-prefixes")
    met = prefix.join(prefix.select("h", F.col("a").alias("b")), "h").filter("a.root < b.root")
    both, left = F.col("a.n") + F.col("b.n"), F.least(F.col("a.n") - F.col("a.at"), F.col("b.n") - F.col("b.at")) + 1
    met = met.filter(left * (SIMILAR[0] + SIMILAR[1]) >= both * SIMILAR[0])
    return _pairs(met, F.col("a"), F.col("b"))


def near_copies(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, component (its number), component_id (its smallest doc_id): a row for each of docs."""
    prints = save(with_keys(docs), "near-prints")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    nodes = save(prints.groupBy("node").agg(F.min(order).alias("k"), F.first("n").alias("n"), F.first("keys").alias("keys")), "near-nodes")
    members = nodes.select(F.explode("keys").alias("key"), F.struct("node", "n").alias("m"))
    shared = members.groupBy("key").agg(F.count("*").alias("c"), F.min("m").alias("lo"), F.max("m").alias("hi")).filter("c > 1").drop("c")
    members = save(members.join(shared, "key"), "near-members")
    sets = save(_sets(docs, nodes.join(members.select("m.node").distinct(), "node", "left_semi").select("node", "k.doc_id", "k.text_hash")), "near-sets")
    first = members.select("m", F.explode(F.array("lo", "hi")).alias("other"))
    tried = save(_pairs(first, F.col("m"), F.col("other")), "near-pairs")
    links = save(_alike(tried, sets), "near-links")
    found = save(components(links), "near-roots")
    labelled = members.select("key", "m", F.col("m.node").alias("node")).join(found, "node", "left").select("key", "m", F.coalesce("root", "node").alias("root"))
    mixed = labelled.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi").select("key")
    labelled = save(labelled.join(mixed, "key", "left_semi"), "near-mixed")
    roots = labelled.select("m.node", "root").distinct()
    rest = save(_prefix_pairs(sets, roots).join(tried, ["u", "v"], "left_anti"), "near-rest")
    more = save(_alike(rest, sets), "near-links")
    if not more.isEmpty():
        found = components(links.unionByName(more))
    of_node = nodes.join(found, "node", "left").select("node", F.coalesce("root", "node").alias("root"), F.col("k.doc_id").alias("first_id"))
    ids = of_node.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_node = of_node.join(ids, "root").select("node", "root", "component_id")
    return prints.join(of_node, "node").select("doc_id", "text_hash", "component_id", F.col("root").alias("component"))
