r"""Benchmark decontamination as a prefix-filtered set join.

An item's windows are its runs of WINDOW words (a shorter item is one window). A window is a set of shingles at known
places; a document that holds the window holds all of them, so at containment 1 the prefix to be joined is one shingle:
the window's rarest, by its number of places in all documents. A window with a shingle that no document has is dropped
at once. A place of the prefix fixes where the window would start; bounds on the start and the document's length come
next, then the words themselves are compared.

Documents are read twice: once to count the benchmark's shingles, as hashes without any context, and once for the places
of the prefixes alone, with the words around them. Both times tasks ask a Bloom filter of at most MAX_BITS bits, which is
put together by Spark; what it lets through by mistake falls out in the joins by hash, so that a benchmark of any size
takes two passes.

Defined cases: null text has no words; items without words have no windows; a null item_id is not listed; repeated
documents each get their row; a benchmark without windows leaves every document clean; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, UPPER, ascii_lower, let, plain_words, save

WINDOW, SHINGLE = 10, 3
#: The filter has BITS bits a shingle, but at most MAX_BITS (64 MB); each shingle sets PROBES of them.
BITS, MAX_BITS, PROBES = 32, 1 << 29, 3
#: Bytes of text taken together.
SLICE = 2_000_000
SEED = 42
_PLACES = np.random.default_rng(SEED).integers(0, 1 << 63, SHINGLE, np.uint64) * np.uint64(2) + np.uint64(1)
#: Bytes to bytes: A-Z in lower case, and a space for whatever belongs to no word; bytes of other alphabets stay.
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def _words(text: str = "text") -> Column:
    return plain_words(ascii_lower(F.coalesce(text, F.lit(""))))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _word_hashes(words: list[bytes]) -> np.ndarray:
    """XXH64 of each word, computed once a different word."""
    coded = pa.array(words, pa.binary()).dictionary_encode()
    return np.fromiter((xxhash.xxh64_intdigest(w, SEED) for w in coded.dictionary.to_pylist()), np.uint64)[coded.indices.to_numpy()]


def _shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the runs of size words, by their first word's place; of words' hashes."""
    n = max(0, len(words) - size + 1)
    total = np.full(n, size, np.uint64)
    for k in range(size):
        total += words[k : k + n] * _PLACES[k]
    return _mixed(total)


def _probes(hashes: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """The bits that each hash sets. bits: a power of two."""
    for k in range(PROBES):
        yield (_mixed(hashes + np.uint64(k)) & np.uint64(bits - 1)).astype(np.int64)


class Filter:
    """A Bloom filter over hashes."""

    def __init__(self, cells: np.ndarray):
        self.cells = cells

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        """Which of hashes may be in it."""
        found = np.arange(len(hashes))
        for at in range(PROBES):
            bit = list(_probes(hashes[found], 64 * len(self.cells)))[at] if len(found) else found
            found = found[(self.cells[bit >> 6] >> (bit & 63).astype(np.uint64)) & np.uint64(1) == 1]
        return found


def _filter(hashes: DataFrame, n: int) -> Filter:
    """Of n rows of hash at most. Its cells are put together by tasks; the driver gets MAX_BITS / 64 numbers at most."""
    bits = min(MAX_BITS, max(1 << 16, 1 << (BITS * n - 1).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bit = np.concatenate(list(_probes(batch.column(0).to_numpy().view(np.uint64), bits)))
            cells, at = np.unique(bit >> 6, return_inverse=True)
            values = np.zeros(len(cells), np.uint64)
            np.bitwise_or.at(values, at, np.uint64(1) << (bit & 63).astype(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(values.view(np.int64))], ["cell", "bits"])

    set_bits = hashes.select("hash").mapInArrow(run, "cell bigint, bits bigint").groupBy("cell").agg(F.bit_or("bits").alias("bits")).toArrow()
    cells = np.zeros(bits >> 6, np.uint64)
    cells[set_bits["cell"].to_numpy()] = set_bits["bits"].to_numpy().view(np.uint64)
    return Filter(cells)


def benchmark_windows(benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(win, words, len) of each different window, and (win, item_id) of each item that has it."""
    n = lambda w: F.size(w)
    starts = lambda w: F.when(n(w) > 0, F.sequence(F.lit(0), F.greatest(n(w) - WINDOW, F.lit(0))))
    each = benchmark.select("item_id", let(_words(), lambda w: F.transform(starts(w), lambda i: F.slice(w, i + 1, WINDOW))).alias("windows"))
    rows = save(each.select("item_id", F.explode_outer("windows").alias("words")).filter("words IS NOT NULL").select("item_id", F.array_join("words", " ").alias("win"), "words"), "benchmark-windows")
    windows = rows.groupBy("win").agg(F.first("words").alias("words")).withColumn("len", F.size("words"))
    return windows, rows.select("win", "item_id").distinct()


def window_shingles(windows: DataFrame) -> DataFrame:
    """windows: win, words. Returns win, at, hash, size: the shingles of each window, of SHINGLE words or of all that it has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, places, hashes, sizes = [], [], [], []
            for row, words in enumerate(batch.column("words")):
                own = [w.encode() for w in words.as_py()]
                size = min(SHINGLE, len(own))
                found = _shingles(_word_hashes(own), size)
                rows += [row] * len(found)
                places += range(len(found))
                hashes.append(found)
                sizes += [size] * len(found)
            found = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
            columns = [batch.column("win").take(pa.array(rows, pa.int32())), pa.array(places, pa.int32()), pa.array(found.view(np.int64)), pa.array(sizes, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["win", "at", "hash", "size"])

    return windows.select("win", "words").mapInArrow(run, "win string, at int, hash bigint, size int")


def _slices(column: pa.Array) -> Iterator[tuple[int, list[list[bytes]]]]:
    """First row and words of the texts of runs of about SLICE bytes."""
    first, texts, size = 0, [], 0
    for i, x in enumerate(column):
        text = x.as_py()
        texts.append(text.translate(_PLAIN).split())
        size += len(text)
        if size >= SLICE:
            yield first, texts
            first, texts, size = i + 1, [], 0
    if texts:
        yield first, texts


def _found(texts: list[list[bytes]], sizes: list[int], wanted: Filter) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of texts, as lists of words: where each begins, and the place, hash and text of each shingle that wanted lets through."""
    ends = np.cumsum([len(t) for t in texts])
    words = _word_hashes([w for t in texts for w in t])
    places, hashes, of = [], [], []
    for size in sizes:
        own = _shingles(words, size)
        at = wanted(own)
        text = np.searchsorted(ends, at, side="right")
        whole = at + size <= ends[text] if len(at) else np.zeros(0, bool)
        places.append(at[whole])
        hashes.append(own[at[whole]])
        of.append(text[whole])
    joined = lambda x, kind: np.concatenate([np.zeros(0, kind), *x])
    return ends - np.array([len(t) for t in texts], np.int64), joined(places, np.int64), joined(hashes, np.uint64), joined(of, np.int64)


def shingle_counts(docs: DataFrame, sizes: list[int], wanted: Filter) -> DataFrame:
    """hash, n: in how many places of docs each shingle stands that wanted lets through."""
    sent = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in _slices(batch.column("t")):
                hashes, n = np.unique(_found(texts, sizes, sent.value)[2], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(n)], ["hash", "n"])

    told = docs.select(F.coalesce("text", F.lit("")).cast("binary").alias("t"))
    return told.mapInArrow(run, "hash bigint, n bigint").groupBy("hash").agg(F.sum("n").alias("n"))


def _places(docs: DataFrame, sizes: list[int], wanted: Filter) -> DataFrame:
    """A row with pos for each place where docs have a shingle that wanted lets through, with as many words before and after it as a window may need; and a row without, for each of docs."""
    sent = docs.sparkSession.sparkContext.broadcast(wanted)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "text_hash", "n_words", "pos", "hash", "from", "around"]
        for batch in batches:
            for first, texts in _slices(batch.column("t")):
                begin, places, hashes, of = _found(texts, sizes, sent.value)
                pos = places - begin[of]
                froms = np.maximum(pos - WINDOW + 1, 0)
                around = [b" ".join(texts[k][a : i + WINDOW]) for k, a, i in zip(of.tolist(), froms.tolist(), pos.tolist())]
                n_words = np.array([len(t) for t in texts])
                part = batch.slice(first, len(texts))
                kinds = [pa.int32(), pa.int64(), pa.int32(), pa.string()]
                none = [pa.nulls(len(texts), k) for k in kinds]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_hash"), pa.array(n_words), *none], names)
                take = pa.array(of)
                some = [pa.array(pos, pa.int32()), pa.array(hashes.view(np.int64)), pa.array(froms, pa.int32()), pa.array(around, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays([part.column("doc_id").take(take), part.column("text_hash").take(take), pa.array(n_words[of]), *some], names)

    told = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.coalesce("text", F.lit("")).cast("binary").alias("t"))
    return told.mapInArrow(run, f"doc_id {id_type}, text_hash bigint, n_words bigint, pos int, hash bigint, from int, around string")


def hits(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(doc_id, text_hash, n_words) of each of docs; (doc_id, text_hash, start, end, win) of every place of a window; (win, item_id)."""
    windows, items = benchmark_windows(benchmark)
    windows = save(windows, "benchmark-distinct")
    parts = save(window_shingles(windows), "benchmark-shingles")
    some = parts.agg(F.count_distinct("hash"), F.sort_array(F.collect_set("size"))).first()
    counts = shingle_counts(docs, some[1], _filter(parts, some[0])) if some[0] else parts.select("hash", F.lit(0).alias("n"))
    rarity = F.struct(F.coalesce("n", F.lit(0)).alias("n"), "at", "hash")
    prefix = parts.join(counts, "hash", "left").groupBy("win").agg(F.min(rarity).alias("p")).filter("p.n > 0")
    prefix = save(prefix.join(windows, "win").select("win", "words", "len", "p.at", "p.hash"), "benchmark-prefixes")
    told = save(_places(docs, some[1], _filter(prefix, some[0])), "benchmark-places")
    each = told.filter("pos IS NULL").select("doc_id", "text_hash", "n_words")
    start = F.col("pos") - F.col("at")
    met = told.filter("pos IS NOT NULL").join(prefix, "hash").filter((start >= 0) & (start + F.col("len") <= F.col("n_words")))
    met = met.filter(F.slice(F.split("around", " "), start - F.col("from") + 1, F.col("len")) == F.col("words"))
    return each, met.select("doc_id", "text_hash", start.alias("start"), (start + F.col("len")).alias("end"), "win").distinct(), items


def contamination(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text_hash, n_words) of each of docs; (doc_id, text_hash, n_hit, items, which are sorted strings) of those with a hit, a row for each doc_id and text."""
    each, found, items = hits(docs, benchmark)
    found = save(found, "benchmark-hits")
    key = ["doc_id", "text_hash"]
    in_order = Window.partitionBy(*key).orderBy("start", "end")
    before = F.max("end").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.greatest(F.col("end") - F.greatest("start", F.coalesce(before, F.lit(0))), F.lit(0))
    covered = found.select(*key, "start", "end").withColumn("new", new).groupBy(*key).agg(F.sum("new").alias("n_hit"))
    named = found.select(*key, "win").distinct().join(items, "win").groupBy(*key).agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    a, b = covered.alias("a"), named.alias("b")
    both = a.join(b, F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.text_hash") == F.col("b.text_hash")), "left")
    return each, save(both.select("a.doc_id", "a.text_hash", "n_hit", F.coalesce("items", F.array().cast("array<string>")).alias("items")), "benchmark-found")


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated: a row for each of docs."""
    rows, found = contamination(docs, benchmark)
    found = found.withColumnsRenamed({"doc_id": "d", "text_hash": "h"})
    out = rows.join(found, rows.doc_id.eqNullSafe(found.d) & (rows.text_hash == found.h), "left")
    n_hit, items = F.coalesce("n_hit", F.lit(0).cast("bigint")), F.coalesce("items", F.array().cast("array<string>"))
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(items).cast("bigint").alias("n_items"), F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without those that hold a window of the benchmark."""
    found = contamination(docs, benchmark)[1].select(F.col("doc_id").alias("d"), "text_hash")
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("i"), F.xxhash64("text").alias("h"))
    return rows.join(found, rows.i.eqNullSafe(found.d) & (rows.h == found.text_hash), "left_anti").select("row.*")


def sql() -> str:
    """report() for DuckDB: every window of every document compared."""
    words = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
WITH b AS (SELECT item_id, {words} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, array_to_string(w[i + 1:i + {WINDOW}], ' ') AS win, least(len(w), {WINDOW}) AS n
       FROM (SELECT item_id, w, unnest(range(greatest(len(w) - {WINDOW - 1}, least(len(w), 1)))) AS i FROM b)),
d AS (SELECT doc_id, {words} AS w FROM documents),
s AS (SELECT doc_id, i, n, array_to_string(w[i + 1:i + n], ' ') AS win
      FROM (SELECT doc_id, w, n, unnest(range(len(w) - n + 1)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
h AS (SELECT doc_id, i, s.n, item_id FROM s JOIN bw USING (win)),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY doc_id),
g AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items FROM h GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN g USING (doc_id)"""
