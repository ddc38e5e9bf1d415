"""Packing of tokenised documents into sequences of one size, by column generation for the cutting-stock problem.

Pieces. Each document is tokenised once and cut at every `size` tokens. Whole pieces are sequences of their own. The
others, one a document at most, fall into length classes of `unit` tokens, counted over all documents.

Patterns. A pattern says how many pieces of each class share a sequence. The linear program asks for the fewest sequences
that hold all classes' counts. Its rows are the classes, size / unit at most whatever the number of documents, so it is
solved on the driver: a revised simplex whose columns come from a knapsack by dynamic programming, which finds the pattern
that the dual prices value most, until none is worth more than a sequence. Solutions are rounded down; what is
left is a few pieces for each pattern and is filled greedily, largest classes first.

Assignment. Documents are ranked within their classes: by task, and by row in it; only counts of (task, class) are summed
up. A rank range of each class belongs to each pattern, which gives a piece its sequence without any search.

Filling. Classes round up, so sequences are a little short. Of all that are short the fullest are kept, as many as their
tokens can fill; the pieces of the others form a stream that is cut over the gaps of those kept, and what remains, less
than one sequence, is cut into powers of two. So only the documents in that stream, about one in a hundred, are cut
where they needn't be, and no sequence has padding at all. The tokens of cut pieces are looked up for their checksums.

Defined cases: a null text counts as empty, which is the end token alone; repeated rows and null ids are documents of
their own; an empty table gives an empty result; texts of any length are cut; other columns stay out of the way. Sequences and ranks
follow the order of the input's files: other files give another, equally full, packing.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from .common import save

SIZE, UNIT, END = 2048, 8, 1
#: Words and parts of words that a worker remembers the ids of; the longest such word; and characters of text that it reads at once.
MEMO, LONGEST, AT_ONCE = 400_000, 64, 1_000_000
#: Tokens of a stream that are cut together, and ranges of ids that are counted at once.
STREAM, RANGES = 32_768, 4096
#: A pattern has to be worth this much more than a sequence to come into the program.
GAIN = 1e-4
_INT = np.dtype("<u4")


#: Fixed values, how word_bpe_49k.json normalises and cuts text; a file that does otherwise has whole texts encoded.
_NORMALISERS = ["NFC", "Replace", "Lowercase"]
_CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Texts of ASCII and Latin-1 letters, for which that pattern is the second one after lower(); of other texts, whole words are looked up.
_PLAIN = re.compile(r"[ \t-\r\x21-\x7e\xc0-\xd6\xd8-\xf6\xf8-\xff]*")
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^ \t-\ra-z0-9\xdf-\xf6\xf8-\xff]+")


class Encoder:
    """Texts to ids as bytes. The ids are the library's, asked once for each part of a word: the file's rules never look across white space, nor across the parts that its pattern cuts."""

    def __init__(self, file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(file)
        self.library.no_truncation()
        self.library.no_padding()
        told = json.loads(file)
        cuts = [p["pattern"].get("Regex") for p in (told.get("pre_tokenizer") or {}).get("pretokenizers", []) if p["type"] == "Split"]
        self.by_words = [n["type"] for n in (told.get("normalizer") or {}).get("normalizers", [])] == _NORMALISERS and cuts == [_CUT]
        vocabulary = self.library.get_vocab()
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        self.ends[[k for w, k in vocabulary.items() if w.endswith(told["model"].get("end_of_word_suffix") or "\n")]] = True
        self.known: dict[str, bytes] = {"": b""}

    def _asked(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype=_INT).tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _parts(self, parts: list[str]) -> list[bytes]:
        """Parts are read as one text: each ends with the only token that can end it."""
        ids = np.array(self.library.encode_batch_fast([" ".join(parts)], add_special_tokens=False)[0].ids, dtype=_INT)
        ends = (np.nonzero(self.ends[ids])[0] + 1).tolist()
        if len(ends) != len(parts) or ends[-1] != len(ids):
            return self._asked(parts)
        whole = ids.tobytes()
        return [whole[4 * a : 4 * b] for a, b in zip([0, *ends], ends)]

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_words:
            return self._asked(texts)
        plain = [_PLAIN.fullmatch(t) is not None and "<|" not in t for t in texts]
        cut = [_PARTS.findall(t.lower()) if p else t.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") for t, p in zip(texts, plain)]
        found = [list(map(self.known.get, some)) for some in cut]
        new_parts, new_words = set(), set()
        for some, ids, p in zip(cut, found, plain):
            if None in ids:
                (new_parts if p else new_words).update(w for w, x in zip(some, ids) if x is None)
        parts, words = list(new_parts), list(new_words - new_parts)
        new = dict(zip(parts, self._parts(parts))) if parts else {}
        new.update(zip(words, self._asked(words)))
        if len(self.known) + len(new) > MEMO:
            self.known = {"": b""}
        self.known.update((w, x) for w, x in new.items() if len(w) <= LONGEST)
        return [b"".join([new[w] if x is None else x for w, x in zip(some, ids)]) if None in ids else b"".join(ids) for some, ids in zip(cut, found)]


@lru_cache(maxsize=1)
def encoder(file: str) -> Encoder:
    """One for each Python worker, which keeps what it has learnt from task to task."""
    return Encoder(file)


def default_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


_PIECE = [("part", IntegerType()), ("row", LongType()), ("start", LongType()), ("length", LongType()), ("doc_tokens", LongType()), ("crc", LongType()), ("class", IntegerType()), ("rank", LongType()), ("ids", BinaryType())]


def pieces(docs: DataFrame, file: str, size: int = SIZE, unit: int = UNIT, keep_ids: bool = False) -> DataFrame:
    """part, row (which document), doc_id, start, length, doc_tokens, crc, class, rank (within part and class), ids (bytes; null for whole pieces unless keep_ids)."""
    kind = StructType([StructField("doc_id", docs.schema["doc_id"].dataType), *(StructField(n, t) for n, t in _PIECE)])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, part, row, ranks = encoder(file), TaskContext.get().partitionId(), 0, {}
        end = np.array([END], dtype=_INT).tobytes()
        for batch in batches:
            for low, high in _portions(batch.column("text")):
                made = []
                for at, ids in zip(range(low, high), reader.encode(batch.column("text").slice(low, high - low).to_pylist())):
                    ids += end
                    n = len(ids) // 4
                    for start in range(0, n, size):
                        own = ids[4 * start : 4 * (start + size)]
                        length = len(own) // 4
                        of = size // unit + 1 if length == size else -(-length // unit)
                        ranks[of] = ranks.get(of, -1) + 1
                        made.append((at, part, row, start, length, n, zlib.crc32(own), of, ranks[of], own if keep_ids or length < size else None))
                    row += 1
                at, *rest = zip(*made)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(at)), *(pa.array(c, t) for c, t in zip(rest, _TYPES))], kind.fieldNames())

    text = F.coalesce("text", F.lit("")).alias("text")
    return save(docs.select("doc_id", text).mapInArrow(cut, kind), "pieces")


_TYPES = [pa.int32(), *[pa.int64()] * 5, pa.int32(), pa.int64(), pa.binary()]


def _portions(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about AT_ONCE characters each."""
    low, total = 0, 0
    for k, text in enumerate(texts):
        total += len(text.as_buffer())
        if total >= AT_ONCE:
            yield low, k + 1
            low, total = k + 1, 0
    if low < len(texts):
        yield low, len(texts)


@dataclass(frozen=True)
class Pattern:
    """How many pieces of each class share a sequence, and how many sequences are made so."""

    of: Mapping[int, int]
    times: int


def knapsack(prices: np.ndarray, classes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most that a pattern can be worth, and how many it has of each class. classes: ascending."""
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for w in range(1, capacity + 1):
        fits = np.searchsorted(classes, w, side="right")
        best[w] = best[w - 1]
        if fits:
            worth = prices[:fits] + best[w - classes[:fits]]
            k = int(worth.argmax())
            if worth[k] > best[w] + 1e-12:
                best[w], last[w] = worth[k], k
    of, w = np.zeros(len(classes)), capacity
    while w > 0:
        if last[w] < 0:
            w -= 1
        else:
            of[last[w]] += 1
            w -= classes[last[w]]
    return float(best[capacity]), of


def inverted(square: np.ndarray) -> np.ndarray:
    """The inverse by elimination. Its size is bounded, and it needs no threads of a linear algebra library beside the driver's own."""
    n = len(square)
    both = np.concatenate([square, np.eye(n)], 1)
    for k in range(n):
        at = k + int(np.abs(both[k:, k]).argmax())
        both[[k, at]] = both[[at, k]]
        both[k] /= both[k, k]
        factors = both[:, k].copy()
        factors[k] = 0
        both -= factors[:, None] * both[k]
    return both[:, n:]


def relaxed(classes: np.ndarray, counts: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Columns (patterns) and how often each is used, as fractions, in the linear program of fewest sequences. A revised simplex; columns are generated."""
    m = len(classes)
    columns = np.diag((capacity // classes).astype(float))
    cost, inverse = np.ones(m), np.diag(1.0 / (capacity // classes))
    used = counts / (capacity // classes)
    for step in range(40 * m + 1000):
        prices = (cost[:, None] * inverse).sum(0)
        if prices.min() < -1e-9:
            new, price = np.zeros(m), 0.0
            new[prices.argmin()] = -1.0
        else:
            worth, new = knapsack(np.maximum(prices, 0), classes, capacity)
            price = 1.0
            if worth <= 1 + GAIN:
                break
        along = (inverse * new).sum(1)
        rows = np.nonzero(along > 1e-9)[0]
        if not len(rows):
            break
        ratio = used[rows] / along[rows]
        ties = rows[ratio <= ratio.min() + 1e-12]
        out = ties[along[ties].argmax()]
        by = max(used[out] / along[out], 0.0)
        used = np.maximum(used - by * along, 0)
        used[out] = by
        columns[:, out], cost[out] = new, price
        pivot = inverse[out] / along[out]
        inverse = inverse - np.outer(along, pivot)
        inverse[out] = pivot
        if step % 100 == 99:
            inverse = inverted(columns)
            used = np.maximum((inverse * counts).sum(1), 0)
    real = cost > 0
    return columns[:, real].astype(np.int64), used[real]


def patterns(counts: Mapping[int, int], capacity: int) -> list[Pattern]:
    """Patterns that hold all pieces: the program's, rounded down, and greedy ones for what is left."""
    left = {c: n for c, n in counts.items() if n > 0}
    if not left:
        return []
    classes = np.array(sorted(left))
    columns, used = relaxed(classes, np.array([left[c] for c in classes.tolist()], dtype=float), capacity)
    found = []
    for column, often in zip(columns.T, used):
        of = {int(c): int(k) for c, k in zip(classes, column) if k > 0}
        # floors of a hair less than a whole number would lose one
        if (times := int(often + 1e-6)) > 0:
            found.append(Pattern(of, times))
            left = {c: n - of.get(c, 0) * times for c, n in left.items()}
    left = {c: n for c, n in left.items() if n > 0}
    while left:
        of, room = {}, capacity
        for c in sorted(left, reverse=True):
            if k := min(left[c], room // c):
                of[c], room = k, room - k * c
        times = min(left[c] // k for c, k in of.items())
        found.append(Pattern(of, times))
        left = {c: n for c in left if (n := left[c] - of.get(c, 0) * times) > 0}
    return found


def assigned(cut: DataFrame, size: int = SIZE, unit: int = UNIT) -> tuple[DataFrame, int]:
    """The pieces with seq, offset and content (tokens of their sequence), and the number of sequence ids that are taken."""
    spark, whole = cut.sparkSession, size // unit + 1
    by_task = save(cut.groupBy("part", "class").agg(F.count("*").alias("n")), "class-counts")
    counts = {r["class"]: r.n for r in by_task.groupBy("class").agg(F.sum("n").alias("n")).collect()}
    ranges, first, reached = {c: [] for c in counts}, 0, dict.fromkeys(counts, 0)
    for p in [*patterns({c: n for c, n in counts.items() if c != whole}, size // unit), *([Pattern({whole: 1}, counts[whole])] if whole in counts else [])]:
        slot = 0
        for c, k in p.of.items():
            ranges[c].append((reached[c], p.times, first, slot))
            reached[c] += k * p.times
            slot += k
        first += p.times
    table = spark.createDataFrame(list(ranges.items()), "class int, ranges array<struct<low:bigint,times:bigint,first:bigint,slot:int>>")
    before = Window.partitionBy("class").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = by_task.select("part", "class", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    ranked = cut.drop("ids").join(begins, ["part", "class"]).withColumn("rank", F.col("begin") + F.col("rank")).join(F.broadcast(table), "class")
    own = F.element_at(F.filter("ranges", lambda r: r["low"] <= F.col("rank")), -1)
    placed = ranked.withColumn("r", own).withColumn("seq", F.expr("r.first + (rank - r.low) % r.times")).withColumn("slot", F.expr("r.slot + (rank - r.low) div r.times"))
    placed = placed.select("part", "row", "doc_id", "start", "length", "doc_tokens", "crc", "seq", "slot")
    inside = Window.partitionBy("seq")
    until = inside.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    short = placed.filter(F.col("length") < size).withColumn("offset", F.coalesce(F.sum("length").over(until), F.lit(0))).withColumn("content", F.sum("length").over(inside))
    full = placed.filter(F.col("length") == size).withColumn("offset", F.lit(0).cast("bigint")).withColumn("content", F.lit(size).cast("bigint"))
    return save(short.unionByName(full).drop("slot"), "assigned"), first


def _first_ids(rows: DataFrame, wanted: int, until: int) -> int:
    """The id below which there are wanted rows (seq, unique, below until): ranges of ids are counted, and the range where it lies again."""
    low, high = 0, until
    while high - low > 1 and wanted > 0:
        width = -(-(high - low) // RANGES)
        counted = rows.filter(F.col("seq").between(low, high - 1)).groupBy(F.expr(f"(seq - {low}) div {width}").alias("k")).count().collect()
        for r in sorted(counted):
            if wanted <= r["count"]:
                low, high = low + r.k * width, min(high, low + (r.k + 1) * width)
                break
            wanted -= r["count"]
        else:
            return high
    return high if wanted > 0 else low


def running(rows: DataFrame, order: list[str], value: str, name: str) -> DataFrame:
    """rows with begin: the sum of value over all rows before, in the order. Ranges of rows are summed up by themselves; one number a range is summed up in one task."""
    ranged = save(rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), name)
    totals = ranged.groupBy("_range").agg(F.sum(value).alias("_n"))
    before = totals.select("_range", F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = ranged.join(F.broadcast(before), "_range")
    return out.withColumn("begin", F.col("_before") + F.coalesce(F.sum(value).over(inside), F.lit(0))).drop("_range", "_before")


def _blocks(begin: str, length: str) -> Column:
    return F.explode(F.expr(f"sequence({begin} div {STREAM}, ({begin} + {length} - 1) div {STREAM})"))


def poured(gaps: DataFrame, stock: DataFrame) -> DataFrame:
    """stock's pieces cut over gaps. gaps: seq, at (offset of the gap), room; stock: pieces. Both in the order of running(), with begin, and equally long in all.

    Borders of both are put in one order within blocks of the stream; from border to border there is one gap and one piece.
    """
    into = gaps.withColumn("block", _blocks("begin", "room")).withColumn("pos", F.expr(f"greatest(begin, block * {STREAM})"))
    into = into.select("block", "pos", F.struct("seq", F.expr("at + pos - begin").alias("offset"), F.expr("begin + room").alias("end")).alias("gap"))
    out = stock.withColumn("block", _blocks("begin", "length")).withColumn("pos", F.expr(f"greatest(begin, block * {STREAM})"))
    out = out.select("block", "pos", F.struct("part", "row", "doc_id", "start", "length", "doc_tokens", "crc", F.expr("pos - begin").alias("from"), F.expr("begin + length").alias("end")).alias("piece"))
    ordered = Window.partitionBy("block").orderBy("pos")
    so_far = ordered.rowsBetween(Window.unboundedPreceding, 0)
    border = into.unionByName(out, allowMissingColumns=True)
    filled = border.withColumn("g", F.last(F.when(F.col("gap").isNotNull(), F.struct("gap", F.col("pos").alias("p"))), True).over(so_far)).withColumn("s", F.last(F.when(F.col("piece").isNotNull(), F.struct("piece", F.col("pos").alias("p"))), True).over(so_far)).withColumn("next", F.lead("pos").over(ordered))
    until = F.least("g.gap.end", "s.piece.end", (F.col("block") + 1) * STREAM, "next")
    parts = filled.withColumn("n", until - F.col("pos")).filter("n > 0").select(
        "s.piece.*", F.expr("s.piece.start + s.piece.`from` + pos - s.p").alias("own"), "n", F.expr("g.gap.seq").alias("seq"), F.expr("g.gap.offset + pos - g.p").alias("offset")
    )
    # a gap and a piece have one stretch in common, maybe in two blocks
    return parts.groupBy("part", "row", "start", "seq").agg(F.first("doc_id").alias("doc_id"), F.first("doc_tokens").alias("doc_tokens"), F.first("crc").alias("crc"), F.first("length").alias("piece_length"), F.min("own").alias("own"), F.sum("n").alias("n"), F.min("offset").alias("offset"))


def pack(docs: DataFrame, size: int = SIZE, unit: int = UNIT, tokenizer_file: str | None = None, keep_ids: bool = False) -> tuple[DataFrame, DataFrame]:
    """The packing (part, row, doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset), and the pieces with their ids from which sequences() makes the sequences."""
    spark = docs.sparkSession
    cut = pieces(docs, Path(tokenizer_file or default_file()).read_text(), size, unit, keep_ids)
    placed, taken = assigned(cut, size, unit)
    open_ = placed.filter((F.col("offset") == 0) & (F.col("content") < size)).select("seq", "content")
    sizes = {r.content: r.n for r in open_.groupBy("content").agg(F.count("*").alias("n")).collect()}
    tokens = sum(c * n for c, n in sizes.items())
    keep, border = tokens // size, size
    for content in sorted(sizes, reverse=True):
        border = content
        if sizes[content] > keep:
            break
        keep -= sizes[content]
    stays = _first_ids(open_.filter(F.col("content") == border), keep, taken)
    kept = (F.col("content") > border) | ((F.col("content") == border) & (F.col("seq") < stays))
    gaps = running(open_.filter(kept).select("seq", F.col("content").alias("at"), (size - F.col("content")).alias("room")), ["seq"], "room", "gaps")
    stock = running(placed.filter(~kept), ["seq", "offset"], "length", "stock")
    # what is left after all gaps, in powers of two
    total = gaps.agg(F.sum("room")).first()[0] or 0
    rest, more = tokens % size, []
    for k in reversed(range(rest.bit_length())):
        if rest >> k & 1:
            more.append((taken + len(more), 0, 1 << k, total))
            total += 1 << k
    if more:
        gaps = gaps.unionByName(spark.createDataFrame(more, "seq bigint, at bigint, room bigint, begin bigint"))
    moved = save(poured(gaps, stock), "moved")
    # a join by shuffle at every size: how many documents are cut grows with the input
    changed = moved.filter(F.col("n") < F.col("piece_length")).hint("merge").join(cut.filter(F.col("length") < size).select("part", "row", "start", "ids"), ["part", "row", "start"])
    changed = changed.withColumn("crc", F.crc32(F.substring("ids", (4 * (F.col("own") - F.col("start")) + 1).cast("int"), (4 * F.col("n")).cast("int"))))
    columns = ["part", "row", "doc_id", F.col("own").alias("start"), F.col("n").alias("length"), F.col("crc").alias("ids_crc32"), "doc_tokens", F.col("seq").alias("sequence_id"), "offset"]
    as_they_were = placed.filter(kept).withColumn("own", F.col("start")).withColumn("n", F.col("length"))
    out = as_they_were.select(*columns).unionByName(moved.filter(F.col("n") == F.col("piece_length")).select(*columns)).unionByName(changed.select(*columns))
    return out, cut


def sequences(packing: DataFrame, cut: DataFrame, size: int = SIZE, pad: int = 0) -> DataFrame:
    """sequence_id, n_tokens, ids (bytes, four a token, little-endian), padded to size unless n_tokens is a power of two. cut: pieces with all their ids."""
    at = packing.withColumn("piece", F.expr(f"start div {size} * {size}"))
    joined = at.join(cut.select("part", "row", F.col("start").alias("piece"), "ids"), ["part", "row", "piece"])
    own = F.substring("ids", (4 * (F.col("start") - F.col("piece")) + 1).cast("int"), (4 * F.col("length")).cast("int"))
    of = joined.select("sequence_id", "length", F.struct("offset", own.alias("ids")).alias("p")).groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), F.array_sort(F.collect_list("p")).alias("p"))
    whole = F.aggregate("p", F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
    padded = F.when(F.bit_count("n_tokens") == 1, F.lit(0)).otherwise(size - F.col("n_tokens"))
    filling = F.unhex(F.repeat(F.lit(np.array([pad], dtype=_INT).tobytes().hex()), padded.cast("int")))
    return of.select("sequence_id", "n_tokens", F.concat(whole, filling).alias("ids"))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset: a row for each piece."""
    return pack(docs)[0].drop("part", "row")
