"""Language-model scores from a hierarchical Pitman-Yor model of word pairs.

Restaurants. Each word that occurs MIN_CONTEXT times or more in the training texts (1: every word), and the start of a text,
is a context with a restaurant of its own, whose dishes are the words that follow it: every pair of a context and a word is
counted. All contexts share the root restaurant as parent. Its customers are the contexts' tables and the words after words
without a restaurant, which predict from the root; its base is uniform over the training words and one unknown word. The
lexicon has the LEXICON most frequent of these words at most; it tells only where cells are kept and in which order they are
swept. The cells of other words, the rarer ones, are in rows: those that follow a rarer context, and those of a rarer word.

Seating. What a prediction needs of a seating is the number of tables of each cell (a restaurant and a dish). Gibbs sweeps
take the tables of one cell away and draw their number anew from its full conditional given all other cells, which is
S(n, t) x^t, where S are generalised Stirling numbers for the discount and x is what a new table has against the seated:
the context's concentration and tables, times the root's probability of the word, both without the cell's own tables.
Cells of more than LARGE customers get the expected number. A cell of one customer has one table. Sweeps of pairs inside the
lexicon run side by side over all cells, given the totals of the sweep before. Then those of rarer contexts, then those of
rarer words run one cell after the other within a row. A rarer word after a rarer context has one table: its probability at
the root is so low that a second one would hardly be drawn. Of BURN_IN + SAMPLES sweeps the last SAMPLES count: their
predictive probabilities are averaged.

Every draw takes its random number from the sweep, the word and the context alone, so results depend on nothing else.

Spark. Counts are combined in each task before they are shuffled, by pair, so that no context or word fills a task. What is
broadcast or comes to the driver has one entry a word of the lexicon, or PAIRS entries: for scoring, the most frequent
pairs go to the tasks, and tokens of other pairs are joined with their cell, or with the row of the rarer word or context.
Probabilities are computed once a cell, in tasks; what the driver gets of the most frequent pairs is compressed there.

Words are 63 bits of their XXH64. Defined cases: a null text counts as empty (its one token is the end); a null doc_id is
held out; repeated rows are counted and scored each; without training rows every probability is the base.
"""

from __future__ import annotations

import contextlib
import copy
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, save

#: The least count of a word with a restaurant of its own (1: every word), and the bound of the lexicon, which only tells where a restaurant is kept.
MIN_CONTEXT, LEXICON = 1, 200_000
#: Pairs whose probabilities are broadcast; a bound.
PAIRS = 2_000_000
BURN_IN, SAMPLES = 2, 3
SWEEPS = BURN_IN + SAMPLES
#: Customers of a cell up to which its tables are drawn.
LARGE = 100
#: Concentrations of the contexts and of the root. The discounts are fitted: cells or words seen once, over those and twice those seen twice.
CONCENTRATION, ROOT_CONCENTRATION = 1.0, 1.0
#: Characters tokenised together, cells gathered in a task before they are combined, and rows given to Spark together.
SLICE, GATHER, ROWS = 4_000_000, 3_000_000, 100_000
END = b"\n"
SEED = 42
ROOT = -2
#: Keys from here on are a text's own, above those of all pairs.
OWN = 1 << 62
#: Words of the lexicon in the row of a rarer context are their numbers from here on; such a row's key is told from that of a rarer word by bits turned.
WORD, TURN = 1 << 32, 0x2545F4914F6CDD1D


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[int, list[bytes]]]:
    """First row and lower-cased texts of runs of about SLICE bytes."""
    first, texts, size = 0, [], 0
    for i, x in enumerate(batch.column("t")):
        texts.append(x.as_py().lower())
        size += len(texts[-1])
        if size >= SLICE:
            yield first, texts
            first, texts, size = i + 1, [], 0
    if texts:
        yield first, texts


def _tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all tokens in order: index into the different words; the words' hashes; the number of tokens of each text."""
    words, lengths = [], []
    for text in texts:
        own = text.split()
        words += own
        words.append(END)
        lengths.append(len(own) + 1)
    coded = pa.array(words, pa.binary()).dictionary_encode()
    hashes = np.fromiter((xxhash.xxh64_intdigest(w, SEED) for w in coded.dictionary.to_numpy(zero_copy_only=False)), np.uint64, len(coded.dictionary)) >> np.uint64(1)
    return coded.indices.to_numpy(), hashes.astype(np.int64), np.array(lengths)


def _places(lexicon: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The number of each word in the sorted lexicon, -1 for others."""
    if not len(lexicon):
        return np.full(len(hashes), -1)
    # looked up in ascending order, which reads the lexicon once and in order
    order = np.argsort(hashes)
    ascending = hashes[order]
    at = np.minimum(np.searchsorted(lexicon, ascending), len(lexicon) - 1)
    out = np.empty(len(hashes), np.int64)
    out[order] = np.where(lexicon[at] == ascending, at, -1)
    return out


def _contexts(words: np.ndarray, lengths: np.ndarray, start: int) -> np.ndarray:
    """Of tokens: the word before each, start for the first of a text."""
    out = np.empty(len(words), np.int64)
    out[1:] = words[:-1]
    out[np.cumsum(lengths) - lengths] = start
    return out


def _sums(where: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    return np.bincount(where, values, size).astype(float)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of batches in batches of ROWS rows or a little more."""
    some: list[pa.RecordBatch] = []
    for batch in batches:
        some.append(batch)
        if sum(x.num_rows for x in some) >= ROWS:
            yield pa.concat_batches(some)
            some = []
    if sum(x.num_rows for x in some):
        yield pa.concat_batches(some)


def _handed(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """batch in pieces of a tenth of ROWS, so that Spark holds little of it at once."""
    for i in range(0, batch.num_rows, max(ROWS // 10, 1)):
        yield batch.slice(i, max(ROWS // 10, 1))


@contextlib.contextmanager
def _removed_shuffles(spark: SparkSession) -> Iterator[None]:
    """What actions in here shuffle is removed from disk as each ends, and not when the driver comes to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _told(docs: DataFrame) -> DataFrame:
    remainder = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(10)), F.lit(0))
    return docs.select("doc_id", F.monotonically_increasing_id().alias("row"), (remainder == 0).alias("held_out"), F.coalesce("text", F.lit("")).cast("binary").alias("t"))


def words(docs: DataFrame) -> DataFrame:
    """word, n: the training words and their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in _slices(batch):
                codes, hashes, _ = _tokens(texts)
                yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(np.bincount(codes, minlength=len(hashes)))], ["word", "n"])

    return _told(docs).filter("NOT held_out").mapInArrow(run, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _most(table: DataFrame, least: int, bound: int) -> Column:
    """Of rows: whether n is least or more, or more than that so that they are at most bound: a histogram of the counts' logarithms tells."""
    size = F.floor(F.log2("n") * 16).cast("int")
    total, above = 0, None
    for r in sorted(table.filter(F.col("n") >= least).groupBy(size.alias("size")).count().collect(), reverse=True):  # 64 * 16 rows at most
        total += r["count"]
        if total > bound:
            above = r["size"]
            break
    return F.col("n") >= least if above is None else (F.col("n") >= least) & (size > above)


#: What a row of cells counts: a pair inside the lexicon (a is context << 32 | word), a rarer word (a is its hash) after a context of the lexicon (b), what follows a rarer context (a is its hash; b is the word's number, or -1 - its hash).
PAIR, RARE, AFTER = 0, 1, 2


def cells(docs: DataFrame, sent: Broadcast) -> DataFrame:
    """kind, a, b, n: how often each training word follows each context. Pairs with rarer words that only held-out texts have count 0. sent: the lexicon."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, gathered, size = sent.value, [[], [], []], 0

        def combined(kind: int) -> tuple[np.ndarray, np.ndarray | None, np.ndarray]:
            """Of a kind, which is no longer gathered: a, b (of pairs none) and n."""
            columns = [np.concatenate(c) for c in zip(*gathered[kind])]
            gathered[kind] = []
            if kind == PAIR:  # tokens, sorted where they lie
                a = columns[0]
                a.sort()
                new = np.flatnonzero(np.append(True, a[1:] != a[:-1]))
                return a[new], None, np.diff(np.append(new, len(a)))
            order = np.lexsort((columns[1], columns[0]))
            a, b, n = (c[order] for c in columns)
            new = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
            return a[new], b[new], np.add.reduceat(n, new, dtype=np.int64)

        def out() -> Iterator[pa.RecordBatch]:
            for kind in range(3):
                if gathered[kind]:
                    a, b, n = combined(kind)
                    for i in range(0, len(a), ROWS):
                        some = slice(i, i + ROWS)
                        size = len(a[some])
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(size, kind, np.int8)), pa.array(a[some]), pa.array(np.full(size, -1) if b is None else b[some]), pa.array(n[some].astype(np.int64))], ["kind", "a", "b", "n"])
                    del a, b, n
            pa.default_memory_pool().release_unused()

        for batch in batches:
            held_out = batch.column("held_out").to_numpy(zero_copy_only=False)
            for first, texts in _slices(batch):
                codes, hashes, lengths = _tokens(texts)
                word, hashed = _places(known, hashes)[codes], hashes[codes]
                context, before = _contexts(word, lengths, len(known)), _contexts(hashed, lengths, 0)
                counts = np.repeat(~held_out[first : first + len(texts)], lengths)
                pair, rare, after = (word >= 0) & (context >= 0) & counts, (word < 0) & (context >= 0), (context < 0) & (counts | (word < 0))
                if pair.any():
                    gathered[PAIR].append((context[pair] << 32 | word[pair],))
                if rare.any():
                    gathered[RARE].append((hashed[rare], context[rare], counts[rare]))
                if after.any():
                    gathered[AFTER].append((before[after], np.where(word[after] >= 0, word[after], -1 - hashed[after]), counts[after]))
                size += len(codes)
                del codes, hashes, hashed, word, context, before, counts, pair, rare, after
                if size > GATHER:
                    yield from out()
                    size = 0
        yield from out()

    counts = _told(docs).mapInArrow(run, "kind tinyint, a bigint, b bigint, n bigint")
    # dealt before they are summed: a task's rows are combined already, and a map of them in each would take memory for nothing
    return counts.repartition("kind", "a", "b").groupBy("kind", "a", "b").agg(F.sum("n").alias("n"))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def uniform(sweep: int, word: np.ndarray, context: np.ndarray | int) -> np.ndarray:
    """A number between 0 and 1 for each word and context, by their hashes."""
    seed = _mixed(np.array([SEED * 1000 + sweep], np.uint64))
    x = _mixed(np.asarray(word, np.int64).view(np.uint64) ^ seed)
    x = _mixed(x + np.asarray(context, np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return ((x >> np.uint64(11)).astype(float) + 0.5) / 2.0**53


def stirling(discount: float) -> np.ndarray:
    """Logarithms of the generalised Stirling numbers S(n, t), n and t up to LARGE."""
    s = np.full((LARGE + 1, LARGE + 1), -np.inf)
    s[0, 0] = 0
    t = np.arange(LARGE + 1)
    for n in range(LARGE):
        with np.errstate(divide="ignore"):
            stay = s[n] + np.log(np.maximum(n - discount * t, 0))
        s[n + 1] = np.logaddexp(np.append(-np.inf, s[n, :-1]), stay)
    return s


def expected(n: np.ndarray, x: np.ndarray, discount: float) -> np.ndarray:
    """The expected tables of n customers who come in blocks of a sixteenth of those seated, where a new table has x against them."""
    tables = np.minimum(n, 1).astype(float)
    seated = np.minimum(n, 1).astype(float)
    while (active := np.flatnonzero(seated < n)).size:
        block = np.minimum(np.maximum(1, seated[active] // 16), n[active] - seated[active])
        tables[active] += block * x[active] / (x[active] + seated[active] - discount * tables[active])
        seated[active] += block
    return tables


def draw(n: np.ndarray, x: np.ndarray, u: np.ndarray, table: np.ndarray, discount: float) -> np.ndarray:
    """Tables of cells of n customers from their conditional, by the random numbers u."""
    out = np.minimum(n, 1).astype(float)
    large = n > LARGE
    if large.any():
        out[large] = expected(n[large], x[large], discount)
    some = np.flatnonzero((n > 1) & ~large)
    some = some[np.argsort(n[some], kind="stable")]
    at = 0
    while at < len(some):
        size = n[some[at]]
        end = at + min(int(np.searchsorted(n[some[at:]], size, side="right")), 100_000)
        own = some[at:end]
        log = table[size, 1 : size + 1] + np.log(x[own])[:, None] * np.arange(1, size + 1)
        shares = np.exp(log - log.max(1, keepdims=True)).cumsum(1)
        out[own] = 1 + (shares < u[own, None] * shares[:, -1:]).sum(1)
        at = end
    return out


class Model:
    """What all cells share. Vectors are by context (the last is the start of a text) or by word of the lexicon."""

    def __init__(self, lexicon: np.ndarray, counts: np.ndarray, n_tokens: int, n_words: int):
        self.lexicon, self.counts, self.n_tokens, self.n_words = lexicon, counts, n_tokens, n_words
        self.customers = np.zeros(len(lexicon) + 1)
        self.fixed_tables = np.zeros(len(lexicon) + 1)  # of cells that are not swept: of one customer, and of rarer words
        self.direct = np.zeros(len(lexicon))  # root customers of words of the lexicon: of cells of rarer contexts, and of cells of one customer
        self.rare_customers = self.rare_tables = 0.0
        self.discount = self.root_discount = 0.5
        #: Of each sweep (the first is the start): tables by context, root customers and root tables by word, all root customers and tables.
        self.tables: list[np.ndarray] = []
        self.root_customers: list[np.ndarray] = []
        self.root_tables: list[np.ndarray] = []
        self.totals: list[tuple[float, float]] = []

    def after(self, sweep: int) -> Model:
        """What a sweep of pairs needs of the one before."""
        out = copy.copy(self)
        out.lexicon = out.counts = out.direct = out.fixed_tables = out.customers = None
        for name in ("tables", "root_customers", "root_tables"):
            setattr(out, name, [x if s == sweep else None for s, x in enumerate(getattr(self, name))])
        return out

    def new_at_root(self, tables: np.ndarray | float) -> np.ndarray | float:
        return (ROOT_CONCENTRATION + self.root_discount * tables) / (self.n_words + 1)

    def root(self, sweep: int, customers: np.ndarray | float, tables: np.ndarray | float, less: np.ndarray | float = 0) -> np.ndarray:
        """The root's probability of words with so many customers and tables there, without less of its customers."""
        all_customers, all_tables = self.totals[sweep]
        customers = customers - less
        seated = np.maximum(customers - self.root_discount * np.minimum(tables, customers), 0)
        return (seated + self.new_at_root(all_tables)) / (ROOT_CONCENTRATION + all_customers - less)

    def backoff(self, sweep: int) -> np.ndarray:
        """By context, and 1 for none (the last entry, -1): the share that goes to the root."""
        return np.append((CONCENTRATION + self.discount * self.tables[sweep]) / (CONCENTRATION + self.customers), 1.0)

    def sweep_pairs(self, sweep: int, key: np.ndarray, n: np.ndarray, tables: np.ndarray, table: np.ndarray) -> np.ndarray:
        """New tables of cells inside the lexicon, given the sweep before."""
        context, word = key >> 32, key & (1 << 32) - 1
        root = self.root(sweep - 1, self.root_customers[sweep - 1][word], self.root_tables[sweep - 1][word], tables)
        x = (CONCENTRATION + self.discount * np.maximum(self.tables[sweep - 1][context] - tables, 0)) * root
        return draw(n, x, uniform(sweep, word, context), table, self.discount)

    def sweep_root(self, sweep: int, table: np.ndarray) -> np.ndarray:
        """New tables at the root of the words of the lexicon, whose customers there are known."""
        x = np.full(len(self.lexicon), self.new_at_root(max(self.totals[sweep - 1][1] - 1, 0)))
        return draw(np.rint(self.root_customers[sweep]).astype(np.int64), x, uniform(sweep, np.arange(len(self.lexicon)), ROOT), table, self.root_discount)

    def sweep_rare(self, word: np.ndarray, at: np.ndarray, context: np.ndarray, n: np.ndarray, tables: np.ndarray, root_table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rarer words, all sweeps: tables of each cell, summed over the samples, and by sample the words' customers and tables at the root. at: where each word's cells begin; a context -1 is the root, those below are rarer words."""
        now = np.where(context == -1, n, np.minimum(n, 1)).astype(float)
        below = np.add.reduceat(now, at) if len(at) else np.zeros(0)
        above = np.minimum(below, 1)
        swept = np.flatnonzero((n > 1) & (context >= 0))
        of = np.searchsorted(at, swept, side="right") - 1
        sums, kept = np.zeros(len(n)), []
        for sweep in range(1, SWEEPS + 1):
            for some in _rounds(of):
                cell, row = swept[some], of[some]
                x = (CONCENTRATION + self.discount * (self.tables[sweep][context[cell]] - 1)) * self.root(sweep, below[row], above[row], now[cell])
                new = draw(n[cell], x, uniform(sweep, word[row], context[cell]), tables, self.discount)
                below[row] += new - now[cell]
                now[cell] = new
            x = np.full(len(at), self.new_at_root(max(self.totals[sweep][1] - 1, 0)))
            above = draw(np.rint(below).astype(np.int64), x, uniform(sweep, word, ROOT), root_table, self.root_discount)
            if sweep > BURN_IN:
                sums += now
                kept.append((below.copy(), above))
        return sums, np.stack([k[0] for k in kept], 1), np.stack([k[1] for k in kept], 1)

    def sweep_after(self, context: np.ndarray, at: np.ndarray, word: np.ndarray, n: np.ndarray, tables: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rarer contexts, all sweeps: tables of each cell, summed over the samples, and of each context, their mean. at: where each context's cells begin; words below 0 are rarer ones, whose cells keep one table."""
        now = np.minimum(n, 1).astype(float)
        seated = np.add.reduceat(now, at) if len(at) else np.zeros(0)
        swept = np.flatnonzero((n > 1) & (word >= 0))
        of = np.searchsorted(at, swept, side="right") - 1
        sums = np.zeros(len(n))
        for sweep in range(1, SWEEPS + 1):
            for some in _rounds(of):
                cell, row = swept[some], of[some]
                # at the root the cell counts as one customer
                root = self.root(sweep, self.root_customers[sweep][word[cell]], self.root_tables[sweep][word[cell]], 1)
                new = draw(n[cell], (CONCENTRATION + self.discount * (seated[row] - now[cell])) * root, uniform(sweep, word[cell], context[row]), tables, self.discount)
                seated[row] += new - now[cell]
                now[cell] = new
            sums += now * (sweep > BURN_IN)
        return sums, (np.add.reduceat(sums, at) if len(at) else np.zeros(0)) / SAMPLES


def _rounds(of: np.ndarray) -> list[np.ndarray]:
    """of: the row of each cell, ascending. The first cells of all rows, then the second, and so on."""
    if not len(of):
        return []
    rank = np.arange(len(of)) - np.searchsorted(of, of)
    return np.split(np.argsort(rank, kind="stable"), np.cumsum(np.bincount(rank))[:-1])


def _discount(once: int, twice: int) -> float:
    return min(0.95, max(0.05, once / (once + 2 * twice))) if once + twice else 0.5


def _vector(rows: DataFrame, size: int) -> np.ndarray:
    """rows: place and value, size rows at most."""
    found = rows.toArrow()
    return _sums(found[0].to_numpy(), found[1].to_numpy(), size)


def _context(key: str) -> Column:
    return F.shiftright(key, 32).cast("int")


def _word(key: str) -> Column:
    return F.col(key).bitwiseAND(F.lit((1 << 32) - 1)).cast("int")


def fit(docs: DataFrame) -> tuple[Model, DataFrame, DataFrame, DataFrame]:
    """The model; key, n, tables (summed over samples) of pairs inside the lexicon; word, n, contexts, ns, tables (summed), customers and root_tables (by sample) of rarer words, and sizes and seated (the contexts' customers and tables, where these are rarer words); context, n, seated, words, ns, tables of rarer contexts."""
    spark = docs.sparkSession
    all_words = save(words(docs), "lm-words")
    n_words, n_tokens = all_words.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    found = all_words.filter(_most(all_words, MIN_CONTEXT, LEXICON)).orderBy("word").toArrow()  # LEXICON rows at most
    model = Model(found["word"].to_numpy(), found["n"].to_numpy().astype(float), n_tokens, n_words)
    discard(all_words)
    sent = spark.sparkContext.broadcast(model.lexicon)
    table = save(cells(docs, sent), "lm-cells")
    sent.destroy()
    pairs, size = table.filter(F.col("kind") == PAIR), len(model.lexicon)
    # a rarer context's cells are fewer than the least count of the lexicon, and the pairs of rarer words of held-out texts
    after = table.filter(F.col("kind") == AFTER).groupBy(F.col("a").alias("context")).agg(F.sum("n").alias("n"), F.sort_array(F.collect_list(F.struct(F.col("b").alias("word"), "n"))).alias("cells"))
    after = save(after.filter("n > 0 OR exists(cells, c -> c.word < 0)"), "lm-after")
    has_own = F.col("n") >= max(MIN_CONTEXT, 1)
    followers = after.select(has_own.alias("has_own"), F.explode("cells").alias("c")).select("has_own", "c.*")
    context = F.when(F.col("kind") == PAIR, _context("a")).when(F.col("kind") == RARE, F.col("b").cast("int"))
    by_context = table.groupBy(context.alias("c")).agg(F.sum("n").alias("n"), F.count_if((F.col("n") == 1) | (F.col("kind") == RARE) & (F.col("n") > 0)).alias("fixed")).filter("c >= 0").toArrow()  # LEXICON + 1 rows at most, as all vectors
    model.customers, model.fixed_tables = (_sums(by_context["c"].to_numpy(), by_context[c].to_numpy(), size + 1) for c in ("n", "fixed"))
    of_pairs = pairs.filter("n = 1").select(_word("a").alias("w"), "n")
    of_after = followers.filter("word >= 0").select(F.col("word").cast("int").alias("w"), F.when(F.col("has_own"), F.least("n", F.lit(1))).otherwise(F.col("n")).alias("n"))
    model.direct = _vector(of_pairs.unionByName(of_after).groupBy("w").agg(F.sum("n")), size)
    once = lambda c, k: F.count_if(F.col(c) == k)
    own = table.filter(context >= 0).select("n").unionByName(followers.filter("has_own").select("n")).agg(once("n", 1), once("n", 2)).first()
    model.discount = _discount(*own)
    # customers at the root of rarer words, with one table a cell
    rarer = table.filter(F.col("kind") == RARE).select(F.col("a").alias("word"), F.least("n", F.lit(1)).alias("below"))
    rarer = rarer.unionByName(followers.filter("word < 0").select((-1 - F.col("word")).alias("word"), F.when(F.col("has_own"), F.least("n", F.lit(1))).otherwise(F.col("n")).alias("below")))
    at_root = rarer.groupBy("word").agg(F.sum("below").alias("below")).agg(once("below", 1), once("below", 2), F.coalesce(F.sum("below"), F.lit(0)), F.count_if(F.col("below") > 0)).first()
    model.rare_customers, model.rare_tables = float(at_root[2]), float(at_root[3])
    own_table = stirling(model.discount)

    def begin(by_context: np.ndarray, by_word: np.ndarray) -> None:
        """Totals from the tables of the swept cells."""
        model.tables.append(model.fixed_tables + by_context)
        model.root_customers.append(model.direct + by_word)

    def close(root_tables: np.ndarray) -> None:
        model.root_tables.append(root_tables)
        model.totals.append((model.root_customers[-1].sum() + model.rare_customers, root_tables.sum() + model.rare_tables))

    def sums(swept: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        by = lambda c, size: _vector(swept.groupBy(c.alias("place")).agg(F.sum("now")), size)
        return by(_context("key"), size + 1), by(_word("key"), size)

    swept = save(pairs.filter("n > 1").select(F.col("a").alias("key"), "n", F.lit(1.0).alias("now"), F.lit(0.0).alias("tables")), "lm-pairs")
    begin(*sums(swept))
    close(np.minimum(model.root_customers[0], 1))
    # fitted over all words; where rarer ones have no restaurant, over those
    seen = model.root_customers[0] if MIN_CONTEXT <= 1 else np.zeros(0)
    model.root_discount = _discount(at_root[0] + int((seen == 1).sum()), at_root[1] + int((seen == 2).sum()))
    root_table = stirling(model.root_discount)
    for sweep in range(1, SWEEPS + 1):
        sent = spark.sparkContext.broadcast(model.after(sweep - 1))

        def run(batches: Iterator[pa.RecordBatch], sweep: int = sweep, sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in _gathered(batches):
                key, n, now, before = (c.to_numpy() for c in batch.columns)
                new = sent.value.sweep_pairs(sweep, key, n, now, own_table)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(new), pa.array(before + new * (sweep > BURN_IN))], ["key", "n", "now", "tables"])

        last, swept = swept, save(swept.mapInArrow(run, "key bigint, n bigint, now double, tables double"), "lm-sweep")
        discard(last)
        sent.destroy()
        begin(*sums(swept))
        close(model.sweep_root(sweep, root_table))
    sent = spark.sparkContext.broadcast(model)
    own_after = save(_after(after.filter(has_own), sent, own_table), "lm-after-swept")
    sent.destroy()
    followers = own_after.select("context", F.col("n").alias("size"), "seated", F.explode(F.arrays_zip("words", "ns", "tables")).alias("c")).select("context", "size", "seated", "c.*")
    # the samples' customers at the root, now with the tables that rarer contexts have: like those of rarer words, these count with their mean
    more = _vector(followers.filter("words >= 0").groupBy(F.col("words").cast("int")).agg(F.sum(F.col("tables") / SAMPLES - F.least("ns", F.lit(1)))), size)
    for sweep in range(BURN_IN + 1, SWEEPS + 1):
        model.root_customers[sweep] = model.root_customers[sweep] + more
    struct = F.struct("context", "n", "size", "seated")
    none = [F.lit(None).cast("bigint").alias("size"), F.lit(None).cast("double").alias("seated")]
    rare = table.filter(F.col("kind") == RARE).select(F.col("a").alias("word"), F.col("b").alias("context"), "n", *none)
    rare = rare.unionByName(followers.filter("words < 0").select((-1 - F.col("words")).alias("word"), (-2 - F.col("context")).alias("context"), F.col("ns").alias("n"), "size", "seated"))
    at_once = after.filter(~has_own).select(F.explode("cells").alias("c")).select("c.*").filter("word < 0").groupBy((-1 - F.col("word")).alias("word")).agg(F.lit(-1).cast("bigint").alias("context"), F.sum("n").alias("n"))
    rare = rare.unionByName(at_once.select("word", "context", "n", *none)).groupBy("word").agg(F.sort_array(F.collect_list(struct)).alias("cells"), F.sum("n").alias("n"))
    sent = spark.sparkContext.broadcast(model)
    rare = save(_rare(rare, sent, own_table, root_table), "lm-rare-swept")
    sent.destroy()
    discard(after)
    # the samples' totals, now with the tables that rarer words have
    sampled = [F.sum(F.get(c, F.lit(s))) for c in ("customers", "root_tables") for s in range(SAMPLES)]
    of_rare = rare.agg(*(F.coalesce(x, F.lit(0.0)) for x in sampled)).first()
    cell = rare.select(F.explode(F.arrays_zip("contexts", "ns", "tables")).alias("c")).select("c.*").filter("contexts >= 0")
    more = _vector(cell.groupBy("contexts").agg(F.sum(F.col("tables") / SAMPLES - F.least("ns", F.lit(1)))), size + 1)
    for s in range(SAMPLES):
        sweep = BURN_IN + 1 + s
        model.tables[sweep] = model.tables[sweep] + more
        model.totals[sweep] = (model.root_customers[sweep].sum() + of_rare[s], model.root_tables[sweep].sum() + of_rare[SAMPLES + s])
    singles = pairs.filter("n = 1").select(F.col("a").alias("key"), "n", F.lit(float(SAMPLES)).alias("tables"))
    return model, swept.select("key", "n", "tables").unionByName(singles), rare, own_after


def _inner(cell: pa.ListArray) -> tuple[np.ndarray, pa.StructArray]:
    """Where each row's structs begin and the last ends, and all of them."""
    offsets = cell.offsets.to_numpy()
    return offsets - offsets[0], cell.flatten()


def _lists(values: np.ndarray | pa.Array, at: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), values if isinstance(values, pa.Array) else pa.array(values))


def _after(after: DataFrame, sent: Broadcast, own_table: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered(batches):
            ends, inner = _inner(batch.column("cells"))
            word, n = inner.field("word").to_numpy(), inner.field("n").to_numpy()
            tables, seated = sent.value.sweep_after(batch.column("context").to_numpy(), ends[:-1], word, n, own_table)
            columns = [batch.column("context"), batch.column("n"), pa.array(seated), _lists(word, ends), _lists(n, ends), _lists(tables, ends)]
            yield from _handed(pa.RecordBatch.from_arrays(columns, ["context", "n", "seated", "words", "ns", "tables"]))

    return after.select("context", "n", "cells").mapInArrow(run, "context bigint, n bigint, seated double, words array<bigint>, ns array<bigint>, tables array<double>")


def _rare(rare: DataFrame, sent: Broadcast, own_table: np.ndarray, root_table: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered(batches):
            ends, inner = _inner(batch.column("cells"))
            context, n = inner.field("context").to_numpy(), inner.field("n").to_numpy()
            tables, below, above = sent.value.sweep_rare(batch.column("word").to_numpy(), ends[:-1], context, n, own_table, root_table)
            each = np.arange(0, SAMPLES * batch.num_rows + 1, SAMPLES)
            columns = [batch.column("word"), batch.column("n"), *(_lists(x, ends) for x in (context, n, tables, inner.field("size"), inner.field("seated"))), _lists(below.ravel(), each), _lists(above.ravel(), each)]
            yield from _handed(pa.RecordBatch.from_arrays(columns, ["word", "n", "contexts", "ns", "tables", "sizes", "seated", "customers", "root_tables"]))

    schema = "word bigint, n bigint, contexts array<bigint>, ns array<bigint>, tables array<double>, sizes array<bigint>, seated array<double>, customers array<double>, root_tables array<double>"
    return rare.select("word", "n", "cells").mapInArrow(run, schema)


class Predictions:
    """Probabilities, averaged over the samples, with the vectors that they need."""

    def __init__(self, model: Model):
        kept = range(BURN_IN + 1, SWEEPS + 1)
        self.model, self.sweeps = model.after(-1), list(kept)
        self.backoff = np.stack([model.backoff(s) for s in kept])  # samples x contexts, the last for none
        self.customers = np.append(model.customers, 0.0)
        self.root = np.stack([model.root(s, model.root_customers[s], model.root_tables[s]) for s in kept])  # samples x words
        self.mean_root = self.root.mean(0)

    def own(self, n: np.ndarray | float, tables: np.ndarray | float) -> np.ndarray | float:
        return np.maximum(n - self.model.discount * tables / SAMPLES, 0)

    def __call__(self, context: np.ndarray, root: np.ndarray, n: np.ndarray | float, tables: np.ndarray | float) -> np.ndarray:
        """Of tokens: root is samples x tokens, n and tables (summed over the samples) are those of the cells, 0 for none."""
        return self.own(n, tables) / (CONCENTRATION + self.customers[context]) + (self.backoff[:, context] * root).mean(0)

    def of_pairs(self, key: np.ndarray, n: np.ndarray | float, tables: np.ndarray | float) -> np.ndarray:
        return self(key >> 32, self.root[:, key & (1 << 32) - 1], n, tables)

    def rarer_backoff(self, size: np.ndarray, seated: np.ndarray) -> np.ndarray:
        """The share that goes to the root of a rarer context, whose tables count with their mean."""
        return (CONCENTRATION + self.model.discount * seated) / (CONCENTRATION + size)

    def of_root(self, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """Samples x words: the root's probability of words outside the lexicon, whose customers and tables are words x samples."""
        return np.stack([self.model.root(sweep, customers[:, s], tables[:, s]) for s, sweep in enumerate(self.sweeps)])


class Head:
    """The most frequent pairs and the logarithms of their probabilities: compressed, until a task asks for them."""

    def __init__(self, parts: list[tuple[int, bytes]]):
        self.parts, self.opened = parts, None

    def __call__(self) -> tuple[np.ndarray, np.ndarray]:
        """Keys, ascending, and logarithms."""
        if self.opened is None:
            found = [np.frombuffer(pa.decompress(x, 16 * n, "zstd", asbytes=True), np.int64).reshape(2, n) for n, x in self.parts]
            key = np.concatenate([x[0].cumsum() for x in found] or [np.zeros(0, np.int64)])
            log = np.concatenate([x[1].view(float) for x in found] or [np.zeros(0)])
            order = np.argsort(key, kind="stable")
            self.opened, self.parts = (key[order], log[order]), []
        return self.opened


def _head(pairs: DataFrame) -> Head:
    """pairs: k and log. Tasks compress them, so what the driver gets and holds is less than the pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if found := [tuple(c.to_numpy() for c in batch.columns) for batch in batches if batch.num_rows]:
            key, log = map(np.concatenate, zip(*found))
            order = np.argsort(key)
            packed = pa.compress(np.stack([np.diff(key[order], prepend=0), log[order].view(np.int64)]).tobytes(), "zstd", asbytes=True)
            yield pa.RecordBatch.from_arrays([pa.array([len(key)]), pa.array([packed], pa.binary())], ["n", "packed"])

    return Head([(r["n"], bytes(r["packed"])) for r in pairs.mapInArrow(run, "n bigint, packed binary").collect()])  # PAIRS pairs at most


def _pair_logs(pairs: DataFrame, sent: Broadcast) -> DataFrame:
    """k, log: the logarithms of the probabilities of pairs inside the lexicon."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, n, tables = (c.to_numpy() for c in batch.columns)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.log10(sent.value.of_pairs(key, n, tables)))], ["k", "log"])

    return pairs.select("key", "n", "tables").mapInArrow(run, "k bigint, log double")


def _rare_logs(rare: DataFrame, sent: Broadcast) -> DataFrame:
    """k, total, others, logs, at_root of rarer words: their cells' contexts and logarithms, and that of the root."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            told, (ends, context) = sent.value, _inner(batch.column("contexts"))
            context, of = context.to_numpy(), np.repeat(np.arange(batch.num_rows), np.diff(ends))
            n, tables = (batch.column(c).flatten().to_numpy() for c in ("ns", "tables"))
            size, seated = (batch.column(c).flatten().fill_null(0).to_numpy() for c in ("sizes", "seated"))
            customers, root_tables = (batch.column(c).flatten().to_numpy().reshape(-1, SAMPLES) for c in ("customers", "root_tables"))
            root = told.of_root(customers, root_tables)
            p = told.own(n, tables) / (CONCENTRATION + size) + told.rarer_backoff(size, seated) * root.mean(0)[of]
            inside = context >= 0
            p[inside] = told(context[inside], root[:, of[inside]], n[inside], tables[inside])
            columns = [pa.array(-1 - batch.column("word").to_numpy()), batch.column("n"), _lists(context, ends), _lists(np.log10(p), ends), pa.array(np.log10(root.mean(0)))]
            yield pa.RecordBatch.from_arrays(columns, ["k", "total", "others", "logs", "at_root"])

    columns = "word", "n", "contexts", "ns", "tables", "sizes", "seated", "customers", "root_tables"
    return rare.select(*columns).mapInArrow(run, "k bigint, total bigint, others array<bigint>, logs array<double>, at_root double")


def _after_logs(after: DataFrame, sent: Broadcast) -> DataFrame:
    """k, others, logs, back of rarer contexts: the words of the lexicon after them and their logarithms, and that of the share that goes to the root."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            told, (ends, word) = sent.value, _inner(batch.column("words"))
            word, of = word.to_numpy(), np.repeat(np.arange(batch.num_rows), np.diff(ends))
            inside = word >= 0
            word, of, (n, tables) = word[inside], of[inside], (batch.column(c).flatten().to_numpy()[inside] for c in ("ns", "tables"))
            size, seated = batch.column("n").to_numpy(), batch.column("seated").to_numpy()
            back = told.rarer_backoff(size, seated)
            p = told.own(n, tables) / (CONCENTRATION + size[of]) + back[of] * told.mean_root[word]
            ends = np.append(0, np.cumsum(inside))[ends]
            columns = [pa.array(-1 - (batch.column("context").to_numpy() ^ TURN)), _lists(word + WORD, ends), _lists(np.log10(p), ends), pa.array(np.log10(back))]
            yield pa.RecordBatch.from_arrays(columns, ["k", "others", "logs", "back"])

    return after.select("context", "n", "seated", "words", "ns", "tables").mapInArrow(run, "k bigint, others array<bigint>, logs array<double>, back double")


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: a row for each of docs."""
    spark = docs.sparkSession
    with _removed_shuffles(spark):
        model, pairs, rare, after = fit(docs)
    n_tokens, n_words = model.n_tokens, model.n_words
    told = Predictions(model)
    alone = float(np.log10(told.of_root(np.zeros((1, SAMPLES)), np.zeros((1, SAMPLES))).mean()))
    vectors = spark.sparkContext.broadcast(told)
    with _removed_shuffles(spark):
        is_head = _most(pairs, 2, PAIRS)
        head = _head(_pair_logs(pairs.filter(is_head), vectors))
    sent = spark.sparkContext.broadcast((model.lexicon, np.log10((model.counts + 0.1) / (n_tokens + 0.1 * (n_words + 1))), head))
    del model, told, head
    names = ["k", "row", "other", "times", "miss", "own"]
    of_text = ["doc_id", "held_out", "n_tokens", "n_known", "base", "log"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (lexicon, log_base, head), told = sent.value, vectors.value
        head_keys, head_log = head()
        for batch in batches:
            held_out = batch.column("held_out").to_numpy(zero_copy_only=False)
            for first, texts in _slices(batch):
                codes, hashes, lengths = _tokens(texts)
                word = _places(lexicon, hashes)[codes]
                hashed = hashes[codes]
                context, before = _contexts(word, lengths, len(lexicon)), _contexts(hashed, lengths, 0)
                of, n = np.repeat(np.arange(len(texts)), lengths), len(texts)
                known, follows, pair = word >= 0, (word >= 0) & (context < 0), (word >= 0) & (context >= 0)
                key, of_pair = context[pair] << 32 | word[pair], of[pair]
                place = _places(head_keys, key)
                is_head = place >= 0
                log = _sums(of_pair[is_head], head_log[place[is_head]], n)
                some = batch.slice(first, n)
                # a key of its own, which meets nothing, keeps a text's own row from those that share one
                row = some.column("row").to_numpy()
                own = [some.column("doc_id"), some.column("held_out"), pa.array(lengths), pa.array(_sums(of[known], np.ones(known.sum()), n).astype(np.int64)), pa.array(_sums(of[known], log_base[word[known]], n)), pa.array(log)]
                own = pa.StructArray.from_arrays(own, of_text)
                yield pa.RecordBatch.from_arrays([pa.array(OWN + row), pa.array(row), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.float64()), own], names)
                # tokens that are scored by a join; sorted by key they stay in the order of texts, so those of a text and a cell stand together
                rest = word < 0
                k = np.concatenate([key[~is_head], -1 - hashed[rest], -1 - (before[follows] ^ TURN)])
                if not len(k):
                    continue
                who = np.concatenate([of_pair[~is_head], of[rest], of[follows]])
                after = np.concatenate([np.full((~is_head).sum(), -1), np.where(context[rest] >= 0, context[rest], -2 - before[rest]), WORD + word[follows]])
                n_pairs = len(k) - rest.sum() - follows.sum()
                order = np.append(np.argsort(k[:n_pairs], kind="stable"), n_pairs + np.lexsort((after[n_pairs:], who[n_pairs:], k[n_pairs:])))
                k, who, after = k[order], who[order], after[order]
                new = np.flatnonzero(np.append(True, (who[1:] != who[:-1]) | (k[1:] != k[:-1]) | (after[1:] != after[:-1])))
                times = np.diff(np.append(new, len(k))).astype(np.int32)
                k, who, after = k[new], who[new], after[new]
                del codes, hashes, hashed, word, context, before, of, known, follows, pair, key, of_pair, place, is_head, rest, order, new
                # where there may be no cell, what counts then: of pairs the probability, of rarer contexts the root's
                lost = held_out[first : first + n][who]
                miss = np.full(len(k), np.nan)
                inside, behind = (k >= 0) & lost, (after >= WORD) & (lost | (MIN_CONTEXT > 1))
                miss[inside] = np.log10(told.of_pairs(k[inside], 0, 0))
                miss[behind] = np.log10(told.mean_root[after[behind] - WORD])
                yield from _handed(pa.RecordBatch.from_arrays([pa.array(k), pa.array(row[who]), pa.array(after), pa.array(times), pa.array(miss, from_pandas=True), pa.nulls(len(k), own.type)], names))

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"k bigint, row bigint, other bigint, times int, miss double, own struct<doc_id: {id_type}, held_out: boolean, n_tokens: bigint, n_known: bigint, base: double, log: double>"
    tokens = _told(docs).mapInArrow(run, schema)
    # the cells of all kinds under one key: pairs as they are, rarer words by the complement of their hash, rarer contexts by that of the turned hash
    logs = _pair_logs(pairs.filter(~is_head), vectors)
    for more in (_rare_logs(rare, vectors), _after_logs(after, vectors)):
        logs = logs.unionByName(more, allowMissingColumns=True)
    is_own, is_pair, is_after = F.col("k") >= OWN, F.col("k") >= 0, (F.col("k") < 0) & (F.col("other") >= WORD)
    place = F.when(~is_pair, F.array_position("others", F.col("other")).cast("int"))
    # a rarer context that is not known, or has no restaurant, leaves all to the root; an unknown word has the root's last share
    without = F.when(is_pair, F.col("miss")).when(is_after, F.coalesce("back", F.lit(0.0)) + F.col("miss")).otherwise(F.coalesce("at_root", F.lit(alone)))
    total = F.coalesce("total", F.lit(0))
    met = tokens.join(logs.hint("merge"), "k", "left").select(
        "k", "row", "times", "own", "other", total.alias("total"), F.coalesce("log", F.when(place > 0, F.get("logs", place - 1)), without).alias("of_token"),
    )
    base = F.log10((F.col("total") + 0.1) / (n_tokens + 0.1 * (n_words + 1)))
    first = lambda c: F.max(f"own.{c}").alias(c)
    each = lambda own, token: F.sum(F.when(is_own, F.col(f"own.{own}")).otherwise(token))
    out = met.groupBy("row").agg(
        first("doc_id"), first("held_out"), first("n_tokens"), each("n_known", F.when(~is_pair & ~is_after & (F.col("total") > 0), F.col("times")).otherwise(0)).alias("n_known"),
        each("base", F.when(is_pair | is_after, 0.0).otherwise(F.col("times") * base)).alias("base_score"), each("log", F.col("times") * F.col("of_token")).alias("score"),
    )
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n_tokens).cast("bigint").alias("train_tokens"), "base_score", "score")
