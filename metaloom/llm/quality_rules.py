"""Quality rules: rule counts for every text, and a hashed n-gram log-likelihood ratio between trusted and raw text.

Only DataFrame functions; each row is judged on its own. The raw multinomial counts the
n-grams of all documents. Every trusted row counts: one half of them, dealt by hash, fits the trusted multinomial. Both
have N_BUCKETS cells, so the model is a bounded array. The other half, which the model has not seen, gives the threshold:
of its texts that pass the base rules, a share of REJECTED may lie below. So the verdict follows the ratios' spread at
every size. Trusted ids are broadcast up to BROADCAST_ROWS; more of them meet the documents in a shuffle.
Weights are whole millionths: their sums, and so the verdicts, don't depend on the order.

Defined cases: a null or empty text has no words and fails the base rules; a null label counts as untrusted; repeated
rows get the same verdict each; with no trusted row in the fitted half every weight is 0, and with none in either
half the base rules decide; documents may have any further columns, which are carried in a struct and so can't clash.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, let, save, spaced_words

#: Cells of the two multinomials.
N_BUCKETS = 16384
#: Trusted ids up to which they are broadcast.
BROADCAST_ROWS = 2_000_000
#: N-grams of raw text that are added to the trusted counts, in raw text's shares: where little is trusted, ratios are near 1.
PRIOR = 16384.0
#: The share of unseen trusted texts that the threshold, a mean log ratio an n-gram, may reject.
REJECTED = 0.005
UNIT = 1_000_000


def _ngrams(hashes: Column) -> Column:
    """Buckets of all words and pairs of neighbours."""
    bucket = lambda h: F.pmod(h, F.lit(N_BUCKETS)).cast("int")
    pairs = F.transform(F.slice(hashes, 1, F.greatest(F.size(hashes) - 1, F.lit(0))), lambda h, i: bucket(F.xxhash64(h, F.get(hashes, i + 1))))
    return F.concat(F.transform(hashes, bucket), pairs)


def _word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _trusted(labels: DataFrame) -> DataFrame:
    """doc_id, fitted (whether the model is fitted on it, or else the threshold): every trusted row."""
    trusted = labels.groupBy("doc_id").agg(F.min(F.coalesce((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0), F.lit(False))).alias("good")).filter("good")
    return trusted.select("doc_id", (F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0).alias("fitted"))


def _sent(ids: DataFrame) -> DataFrame:
    """ids with a broadcast hint if they are few."""
    return F.broadcast(ids) if ids.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else ids


def fit(docs: DataFrame, trusted: DataFrame) -> np.ndarray:
    """The weight of each bucket, in millionths of a nat: log of its share in trusted text over its share in all text."""
    grams = let(_word_hashes(spaced_words(F.coalesce("text", F.lit("")))), _ngrams)
    flagged = docs.select("doc_id", grams.alias("grams")).join(_sent(trusted.filter("fitted").select("doc_id", F.lit(1).alias("is_target"))), "doc_id", "left")
    # explode() would infer a filter on grams, which computes them once more
    counts = flagged.select("is_target", F.explode_outer("grams").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("raw"), F.count("is_target").alias("target"))
    counts = save(counts, "quality-model").filter("bucket IS NOT NULL").toArrow()  # N_BUCKETS rows at most
    raw, target = np.zeros(N_BUCKETS), np.zeros(N_BUCKETS)
    at = counts["bucket"].to_numpy()
    raw[at], target[at] = counts["raw"].to_numpy(), counts["target"].to_numpy()
    if not target.any():
        return np.zeros(N_BUCKETS, np.int64)
    shares = (raw + 1) / (raw.sum() + N_BUCKETS)
    return np.rint(UNIT * np.log((target / shares + PRIOR) / (target.sum() + PRIOR))).astype(np.int64)


def threshold(docs: DataFrame, trusted: DataFrame, weights: np.ndarray) -> float:
    """The least mean log ratio that is kept: a REJECTED quantile of the unseen trusted texts that pass the base rules."""
    if not weights.any():
        return -math.inf
    unseen = docs.select("doc_id", "text").join(_sent(trusted.filter("NOT fitted").select("doc_id")), "doc_id", "left_semi")
    # no filter on what is judged: it would be pushed below the join, and every document judged
    ratios = save(judge(unseen, weights, -math.inf).select(F.when(~F.col("base_failed"), F.col("llr")).alias("llr")), "quality-unseen")
    least = _quantile(ratios.filter("llr IS NOT NULL"), REJECTED)
    return -math.inf if least is None else least


def _quantile(values: DataFrame, share: float) -> float | None:
    """The least llr that a share of values don't exceed. Histograms of ever finer bins find its bin, so that neither a task nor the driver holds all values."""
    n = values.count()
    below, rank = values, max(math.ceil(share * n), 1)
    for bits in (12, 24, 36, None):
        place = F.col("llr") if bits is None else F.floor(F.col("llr") * F.lit(2.0**bits))
        for r in below.groupBy(place.alias("place")).count().orderBy("place").collect():
            if rank <= r["count"]:
                break
            rank -= r["count"]
        else:
            return None
        below = below.filter(place == F.lit(r.place))
    return r.place


def _repeated(words: Column, windows: Column) -> Column:
    """Words inside 3-word windows that occur twice or more. windows: the windows' hashes, by position.

    Hash and position are packed into one long, so that a primitive sort brings equal windows together; the full hashes
    of neighbours are compared.
    """
    bits = F.ceil(F.log2(F.size(words) + F.lit(1))).cast("int")
    mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), bits) - 1
    packed = F.transform(windows, lambda h, i: F.call_function("shiftleft", h, bits).bitwiseOR(i.cast("bigint")))
    at = lambda x: F.get(windows, x.bitwiseAND(mask).cast("int"))

    def starts(s: Column) -> Column:
        same = lambda x, i: at(x) == at(F.get(s, i))
        return F.filter(s, lambda x, i: F.coalesce(same(x, i - 1), F.lit(False)) | F.coalesce(same(x, i + 1), F.lit(False)))

    ordered = F.sort_array(F.transform(let(F.sort_array(packed), starts), lambda x: x.bitwiseAND(mask)))
    gap = lambda s: lambda p, i: F.least(F.lit(3).cast("bigint"), F.coalesce(F.get(s, i + 1) - p, F.lit(3).cast("bigint")))
    covered = lambda s: F.aggregate(F.transform(s, gap(s)), F.lit(0).cast("bigint"), lambda a, x: a + x)
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), let(ordered, covered)).otherwise(F.lit(0).cast("bigint"))


def judge(docs: DataFrame, weights: np.ndarray, least: float) -> DataFrame:
    """Columns row (a struct of all of docs), the rule counts, base_failed, llr (mean log ratio in nats) and kept."""
    table = F.split(F.lit(",".join(map(str, weights.tolist()))), ",").cast("array<bigint>")  # folded into one literal
    lines = lambda t: F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")

    def of_hashes(h: Column) -> Column:
        windows = F.transform(F.slice(h, 1, F.greatest(F.size(h) - 2, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(h, i + 1), F.get(h, i + 2)))
        total = F.aggregate(_ngrams(h), F.lit(0).cast("bigint"), lambda a, g: a + F.get(table, g))
        n_grams = F.greatest(2 * F.size(h) - 1, F.lit(1))
        return F.struct(let(windows, lambda x: _repeated(h, x)).alias("n_repeat_words"), (total / (n_grams * F.lit(float(UNIT)))).alias("llr"))

    def of_words(w: Column) -> Column:
        return F.struct(F.size(w).cast("bigint").alias("n_words"), F.char_length(F.array_join(w, "")).cast("bigint").alias("word_chars"), let(_word_hashes(w), of_hashes).alias("h"))

    t = F.coalesce("text", F.lit(""))
    out = docs.select(
        F.struct("*").alias("row"), let(spaced_words(t), of_words).alias("m"),
        (F.char_length(t) - F.char_length(F.regexp_replace(t, r"[#*$%&|<>]+", ""))).cast("bigint").alias("n_symbols"),
        let(lines(t), lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("bigint")).alias("n_dup_lines"),
    )
    out = out.select("row", "m.n_words", "m.word_chars", "n_symbols", "n_dup_lines", "m.h.n_repeat_words", "m.h.llr")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.select("*", failed.alias("base_failed"), (~failed & (F.col("llr") >= least)).alias("kept"))


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fits the model on docs and labels and judges every row of docs."""
    trusted = save(_trusted(labels), "quality-trusted")
    weights = fit(docs, trusted)
    return judge(docs, weights, threshold(docs, trusted, weights))
