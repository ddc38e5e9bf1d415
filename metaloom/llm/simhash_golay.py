"""SimHash near-duplicates, found with the binary Golay code.

A text's fingerprint holds, for each of 64 bits, what the majority of its shingles' XXH64 hashes have. Fingerprints that
differ in at most MAX_BITS = 2 bits are linked; components of links are groups of near-duplicates.

Search: the 64 bits are cut into three segments of 22, 21 and 21 bits. Of two errors at most, some segment i is free and
its successor j (in a circle) has one at most. Padded to 23 bits, segment j is decoded to the codewords of the perfect
[23,12,7] Golay code within 4 bits: 1 or 6 of them. If two segments differ in at most one bit, the codeword nearest to
the first is among the codewords near the second. So every link meets under the key (i, segment i, codeword of j), the
first fingerprint giving its nearest codeword and the second all of its own. The link is kept under one key only, and
only after its bits are counted. A key under which more than HOT_KEY fingerprints stand is not joined: for these, the at
most 2080 fingerprints within two bits are looked up by value instead, so that no link is lost and no group is paired off.

Copies share a fingerprint and are one node. Defined cases: null text counts as empty (fingerprint 0); a null doc_id is
kept, and never the component's id unless all its doc_ids are null; repeated rows are returned as often as they come.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import save
from .components import components
from .near_copies import near_copies

MAX_BITS = 2
#: Fingerprints under one key above which neighbours are looked up by value.
HOT_KEY = 1000
SEED = 42
#: The generator polynomial of the [23,12,7] Golay code, a fixed value: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101
#: Shift and width of each segment of a fingerprint.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
MASKS = [((1 << width) - 1) << shift for shift, width in SEGMENTS]
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: bytes, width: int = 3) -> int:
    """Of UTF-8 text, as an unsigned number."""
    words = text.lower().split()  # on bytes, both know ASCII only
    if not words:
        return 0
    shingles = map(b" ".join, zip(*(words[i:] for i in range(width)))) if len(words) >= width else [b" ".join(words)]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(x, SEED) for x in shingles), np.uint64)
    of_bytes = hashes.view(np.uint8).reshape(-1, 8)
    ones = [np.bincount(of_bytes[:, k], minlength=256) @ _BITS for k in range(8)]
    bits = (2 * np.concatenate(ones) > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def with_fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash (of the raw text), fp (the fingerprint as a signed long), a row for each of docs."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.fromiter((fingerprint(x.as_py()) for x in batch.column("t")), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(prints.view(np.int64))], ["doc_id", "text_hash", "fp"])

    told = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.coalesce("text", F.lit("")).cast("binary").alias("t"))
    return told.mapInArrow(run, f"doc_id {id_type}, text_hash bigint, fp bigint")


def _syndrome(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.int64).copy()
    for bit in range(22, 10, -1):
        x ^= np.where((x >> bit) & 1 == 1, GENERATOR << (bit - 11), 0)
    return x


def golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """By syndrome: the error of weight 3 at most, and the five errors of weight 4 where that has weight 3 (else -1)."""
    errors = {w: np.array([sum(1 << b for b in c) for c in combinations(range(23), w)], np.int64) for w in range(5)}
    near, far = np.zeros(2048, np.int64), np.full((2048, 5), -1, np.int64)
    for w in range(4):
        near[_syndrome(errors[w])] = errors[w]
    s = _syndrome(errors[4])
    order = np.argsort(s, kind="stable")
    far[np.unique(s)] = errors[4][order].reshape(-1, 5)
    return near, far


def _keys(fps: DataFrame, own: bool) -> DataFrame:
    """key, fp: under the nearest codewords only (own), or under all near ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near, far = golay_tables()
        for batch in batches:
            for at in range(0, batch.num_rows, 8192):
                signed = batch.column(0).slice(at, 8192).to_numpy(zero_copy_only=False)
                fp = signed.view(np.uint64)
                parts = [((fp >> np.uint64(shift)) & np.uint64((1 << width) - 1)).astype(np.int64) for shift, width in SEGMENTS]
                keys, who = [], []
                for i in range(3):
                    coded = parts[(i + 1) % 3]
                    s = _syndrome(coded)
                    head = (i << 40) | (parts[i] << 12)
                    keys.append(head | ((coded ^ near[s]) >> 11))
                    who.append(signed)
                    if not own:
                        for k in range(5):
                            some = far[s, k] >= 0
                            keys.append((head | ((coded ^ far[s, k]) >> 11))[some])
                            who.append(signed[some])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(who))], ["key", "fp"])

    return fps.select("fp").mapInArrow(run, "key bigint, fp bigint")


def _first_key(x: Column) -> Column:
    """The number of the segment under which a link whose fingerprints differ by x is kept."""
    free = [x.bitwiseAND(F.lit(np.uint64(m).astype(np.int64).item())) for m in MASKS]
    near = [(free[i] == 0) & (F.bit_count(free[(i + 1) % 3]) <= 1) for i in range(3)]
    return F.when(near[0], 0).when(near[1], 1).when(near[2], 2)


def links(fps: DataFrame) -> DataFrame:
    """fps: distinct fp. Returns u, v (u < v): every two fingerprints that differ in at most MAX_BITS bits, once."""
    left, right = _keys(fps, True), _keys(fps, False)
    hot = save(right.groupBy("key").count().filter(F.col("count") > HOT_KEY).select("key"), "simhash-hot-keys")
    diff = F.col("u").bitwiseXOR(F.col("v"))
    plain = left.join(hot, "key", "left_anti").select("key", F.col("fp").alias("u")).join(right.select("key", F.col("fp").alias("v")), "key")
    plain = plain.filter((F.col("u") < F.col("v")) & (F.bit_count(diff) <= MAX_BITS) & (F.shiftright("key", 40) == _first_key(diff))).select("u", "v")
    masks = np.array([1 << a for a in range(64)] + [1 << a | 1 << b for a, b in combinations(range(64), 2)], np.uint64).view(np.int64)
    by_key = fps.sparkSession.createDataFrame([(int(x),) for x in masks], "mask bigint").select("mask", _first_key(F.col("mask")).alias("part"))
    near = left.join(hot, "key", "left_semi").select(F.col("fp").alias("u"), F.shiftright("key", 40).cast("int").alias("part"))
    near = near.join(F.broadcast(by_key), "part").select("u", F.col("u").bitwiseXOR(F.col("mask")).alias("v")).filter("u < v")
    return plain.unionByName(near.join(fps.select(F.col("fp").alias("v")), "v", "left_semi").select("u", "v"))


def _groups(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows' fingerprints; and fp, root (of its component), first_id."""
    prints = save(with_fingerprints(docs), "simhash-prints")
    fps = save(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    found = components(save(links(fps), "simhash-links"))
    return prints, fps.join(found, fps.fp == found.node, "left").select("fp", F.coalesce("root", "fp").alias("root"), "first_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, fp, component_id: a row for each of docs."""
    prints, of_fp = _groups(docs)
    ids = of_fp.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return prints.join(of_fp.join(ids, "root").select("fp", "component_id"), "fp").select("doc_id", "text_hash", "fp", "component_id")


def near_duplicates_or_copies(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, component: components of both kinds of links, those of fingerprints and those of near_copies."""
    found = save(near_copies(docs).select("doc_id", "text_hash", "component"), "near-components")
    prints, of_fp = _groups(docs)
    roots = prints.select("text_hash", "fp").distinct().join(of_fp.select("fp", "root"), "fp").select("text_hash", "root")
    both = save(found.select("text_hash", "component").distinct().join(roots, "text_hash").select("root", "component").distinct(), "near-both")
    least = both.groupBy("root").agg(F.min("component").alias("u"), F.max("component").alias("v")).filter("u < v").drop("v")
    united = components(save(both.join(least, "root").filter("u < component").select("u", F.col("component").alias("v")).distinct(), "near-united"))
    return found.join(united.select(F.col("node").alias("component"), "root"), "component", "left").select("doc_id", "text_hash", F.coalesce("root", "component").alias("component"))


def keep_one(docs: DataFrame, groups: Callable[[DataFrame], DataFrame] = near_copies) -> DataFrame:
    """docs without near copies (groups finds them: near_copies, or with the links of fingerprints near_duplicates_or_copies): of each component the row with the smallest doc_id stays, then that with the smallest hash of its text, then of its other columns."""
    found = save(groups(docs), "near-groups")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    stay = found.groupBy("component").agg(F.min(order).alias("k")).select("k.doc_id", "k.text_hash")
    # one key of id and text, by which rows are dealt for the join and stay dealt for the window; never broadcast, as it grows with the data
    stay = stay.withColumn("k", F.xxhash64("doc_id", "text_hash")).hint("merge")
    tie = F.xxhash64(*(F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind))
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("d"), F.xxhash64("text").alias("h"), tie.alias("tie")).withColumn("k", F.xxhash64("d", "h"))
    # the second comparison is written such that it isn't a second key, by which the window would have to deal anew
    kept = rows.join(stay, (rows.k == stay.k) & (rows.h.bitwiseXOR(stay.text_hash) == 0)).select("row", rows.k, "tie")
    return kept.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("tie"))).filter("n = 1").select("row.*")
