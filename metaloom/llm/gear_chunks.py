"""Substring dedup by content-defined chunking.

A gear hash rolls over the UTF-8 bytes; a chunk ends before a word if the hash of the WINDOW bytes up to there has BITS
zero bits and the chunk has MIN_CHUNK bytes. So an insertion moves only the chunk ends near it. Of each digest the
document with the smallest doc_id is the owner; in every other document the chunk is a repeat. Runs of adjoining repeats
of MIN_RUN bytes or more are cut, so that common phrases stay. Rows that share a doc_id are one document: what one of
them repeats of another stays.

Only digests and offsets are shuffled: owners are combined before the shuffle, and only digests that several documents
have are joined back. A digest with more than one in HOT_SHARE of all repeated chunks is hot; there are fewer than
HOT_SHARE of these. They are known to every task, and their chunks are dealt over SALTS tasks, each with a copy of the
owner, so that no digest fills a task.

Defined cases: null or blank texts have no chunks and are kept as they are; a null doc_id never owns a chunk that a
document with an id has; repeated rows are cut alike; further columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, let, save

#: Bytes that the rolling hash covers.
WINDOW = 16
#: One word in 2**BITS ends a chunk.
BITS = 2
MIN_CHUNK = 16
#: Bytes from which a run of repeated chunks is cut.
MIN_RUN = 128
#: A digest is hot if it has more than one in so many of the repeated chunks; over how many tasks a hot one is dealt.
HOT_SHARE, SALTS = 10_000, 256
GEAR = np.array([xxhash.xxh32_intdigest(bytes([b])) for b in range(256)], np.uint32)
_WHITE = np.isin(np.arange(256), np.frombuffer(SPACES.encode(), np.uint8))


def chunks(data: bytes) -> list[tuple[int, int]]:
    """Start and end of each chunk of data; leading white space belongs to none."""
    if not data.strip():
        return []
    a = np.frombuffer(data, np.uint8)
    h = GEAR[a]
    k = 1
    while k < WINDOW:
        h[k:] = h[k:] + (h[:-k] << np.uint32(k))
        k *= 2
    white = _WHITE[a]
    starts = np.flatnonzero(white[:-1] & ~white[1:]) + 1
    ends = starts[(h[starts - 1] >> np.uint32(32 - BITS)) == 0].tolist()
    at = len(data) - len(data.lstrip())
    out = []
    for end in ends:
        if end - at >= MIN_CHUNK:
            out.append((at, end))
            at = end
    out.append((at, len(data)))
    return out


def chunk_table(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, digest (XXH64 of the chunk without trailing white space), span (start << 32 | end, in bytes)."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        for batch in batches:
            rows, digests, spans = [], [], []

            def out() -> pa.RecordBatch:
                at = pa.array(rows, pa.int32())
                columns = [batch.column("doc_id").take(at), batch.column("text_hash").take(at), pa.array(np.array(digests, np.uint64).view(np.int64)), pa.array(spans, pa.int64())]
                return pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "digest", "span"])

            for i, text in enumerate(batch.column("t")):
                data = text.as_py()
                found = chunks(data)
                rows += [i] * len(found)
                digests += [digest(data[a:b].rstrip()) for a, b in found]
                spans += [a << 32 | b for a, b in found]
                if len(rows) > 200_000:
                    yield out()
                    rows, digests, spans = [], [], []
            yield out()

    told = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.coalesce("text", F.lit("")).cast("binary").alias("t"))
    return told.mapInArrow(run, f"doc_id {id_type}, text_hash bigint, digest bigint, span bigint")


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, start, end, owner: the chunks that a document with a smaller doc_id owns."""
    has = F.count("doc_id")
    owners = chunk_table(docs).groupBy("digest").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last"), has.alias("n"), F.count("*").alias("all"))
    owners = save(owners.filter("owner < last OR (n > 0 AND n < all)").select("digest", "owner", "all"), "gear-owners")
    least = (owners.agg(F.sum("all")).first()[0] or 0) / HOT_SHARE
    hot = owners.filter(F.col("all") > least)  # fewer than HOT_SHARE rows
    salts = F.when(F.col("all") > least, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    copies = owners.select("digest", "owner", F.explode(salts).alias("salt"))
    dealt = chunk_table(docs).join(F.broadcast(hot.select("digest", F.lit(True).alias("hot"))), "digest", "left")
    dealt = dealt.withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("doc_id", "span"), F.lit(SALTS))).otherwise(0).cast("int"))
    found = dealt.join(copies.hint("merge"), ["digest", "salt"]).filter(~F.col("doc_id").eqNullSafe(F.col("owner")))
    span = F.col("span")
    return found.select("doc_id", "text_hash", F.shiftright(span, 32).alias("start"), span.bitwiseAND(F.lit((1 << 32) - 1)).alias("end"), "owner")


def repeated_runs(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, spans (array of start, end, in order, to be cut), owners (sorted doc_ids)."""
    rows = repeated_chunks(docs).repartition("doc_id", "text_hash").dropDuplicates(["doc_id", "text_hash", "start"])
    in_order = Window.partitionBy("doc_id", "text_hash").orderBy("start")
    begins = F.when(F.lag("end").over(in_order) == F.col("start"), 0).otherwise(1)
    runs = rows.withColumn("begins", begins).withColumn("run", F.sum("begins").over(in_order))
    runs = runs.groupBy("doc_id", "text_hash", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.collect_set("owner").alias("owners"))
    runs = runs.filter(F.col("end") - F.col("start") >= MIN_RUN)
    spans = F.sort_array(F.collect_list(F.struct("start", "end")))
    return runs.groupBy("doc_id", "text_hash").agg(spans.alias("spans"), F.sort_array(F.array_distinct(F.flatten(F.collect_list("owners")))).alias("owners"))


def substring_dedup(docs: DataFrame) -> DataFrame:
    """docs with repeated runs cut from text; n_chars, where there is one, follows the new text."""
    runs = save(repeated_runs(docs), "gear-runs")
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("d"), F.xxhash64("text").alias("h"))
    # never broadcast, as it grows with the data
    rows = rows.join(runs.hint("merge"), rows.d.eqNullSafe(runs.doc_id) & (rows.h == runs.text_hash), "left").select("row", "spans")
    starts, ends = F.col("spans.start"), F.col("spans.end")

    def joined(data):
        piece = lambda s, i: F.decode(F.substring(data, s.cast("int") + 1, (F.get(F.concat(starts, F.array(F.octet_length("row.text").cast("bigint"))), i) - s).cast("int")), "UTF-8")
        return F.array_join(F.transform(F.concat(F.array(F.lit(0).cast("bigint")), ends), piece), "")

    text = F.when(F.col("spans").isNull(), F.col("row.text")).otherwise(let(F.col("row.text").cast("binary"), joined))
    out = rows.select("row", text.alias("text"))
    changed = {"text": F.col("text"), "n_chars": F.when(F.col("text").isNotNull(), F.char_length("text").cast("bigint"))}
    return out.select(*(changed[c].alias(c) if c in changed else F.col(f"row.`{c}`") for c in docs.columns))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_cut_runs, n_cut_bytes, owner_ids (the documents whose text is repeated): a row for each of docs."""
    runs = save(repeated_runs(docs), "gear-runs")
    rows = docs.select("doc_id", F.xxhash64("text").alias("h"), F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n_bytes"))
    of = runs.select(F.col("doc_id").alias("d"), "text_hash", F.size("spans").cast("bigint").alias("n"), F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"]).alias("cut"), "owners")
    found = rows.join(of, rows.doc_id.eqNullSafe(of.d) & (rows.h == of.text_hash), "left")
    zero = F.lit(0).cast("bigint")
    return found.select("doc_id", "n_bytes", F.coalesce("n", zero).alias("n_cut_runs"), F.coalesce("cut", zero).alias("n_cut_bytes"), F.coalesce("owners", F.array().cast(of.schema["owners"].dataType)).alias("owner_ids"))
