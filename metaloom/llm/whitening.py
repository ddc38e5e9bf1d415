"""Whitened principal components, from covariances by polarisation.

Components become whole numbers x. The fit list holds each distinct vector once. Two passes over it: the first gives its
length n and the sums of each dimension; in the second, d = x - floor(sum / n) is squared, for each dimension and for the
sum of each two dimensions, and the squares are added up exactly. With these, variances of dimensions and of sums follow
without rounding, and a covariance is half of what the variance of a sum has beyond the two variances. Tasks return one
number for each pair of dimensions, so what comes to the driver is bounded by the square of the vectors' length, like the
matrix for eigh. Only the quotients are rounded, once each. A third pass projects the fit list and measures how far its
covariance is from the identity; the last one projects all rows.

Defined cases: rows whose vector is null, empty, or holds null or non-finite components are dropped, and those whose
length isn't that of the row with the smallest id. Whole numbers beyond 2**28 are held there. Repeated rows come out
each, but count once in the fit list, as do equal vectors of other ids. A component whose eigenvalue is zero but for
rounding (as with one distinct vector only) has null in whitened, and isn't part of identity_error, which is null if no
component is left. A deviation that a long can't hold is null. Where vectors are shorter than the number of components
asked for, there are as many as dimensions. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DecimalType, DoubleType, IntegerType, StructField, StructType

from .common import save
from .vectors import matrix, whole

SCALE, SHIFT, COMPONENTS, BOUND = 64, 1_000_000, 16, 2**28
#: Rows squared at once: with whole numbers below 2**30, fewer than 2**3 squares fit a long; usual ones are far smaller.
_ROWS = 2048
_SUMS = "place bigint, total decimal(38,0)"


@dataclass(frozen=True)
class Fit:
    """n: length of the fit list. base, rest: sum of dimension k = n * base[k] + rest[k]. values, vectors: eigenvalues, falling, and unit eigenvectors as columns."""

    n: int
    base: np.ndarray
    rest: np.ndarray
    trace: float
    values: np.ndarray
    vectors: np.ndarray

    @property
    def scales(self) -> np.ndarray:
        """One over the root of each eigenvalue; NaN where it is zero but for rounding."""
        real = self.values > max(self.trace, 0.0) * len(self.base) * np.finfo(float).eps
        return np.where(real, 1 / np.sqrt(np.where(real, self.values, 1)), np.nan)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.base) - self.rest / self.n) @ self.vectors * self.scales


def _packed(rows: DataFrame) -> DataFrame:
    """rows (x) with x as bytes, so that equal vectors are equal keys."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in matrix(batch.column("x")).astype("<i4")] if batch.num_rows else [], pa.binary())], ["x"])

    return rows.select("x").mapInArrow(pack, StructType([StructField("x", BinaryType())]))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("x").to_pylist()), dtype="<i4").reshape(batch.num_rows, -1).astype(np.int64)


def _added(fit: DataFrame, width: int, squares) -> list[int]:
    """The sums over the fit list of what squares makes of a block of rows (an array of width numbers)."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, dtype=object)
        for batch in batches:
            for k in range(0, batch.num_rows, _ROWS):
                total = total + squares(_matrix(batch.slice(k, _ROWS))).astype(object)
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int64()), pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0))], ["place", "total"])

    found = fit.mapInArrow(add, _SUMS).groupBy("place").agg(F.sum("total").cast("string").alias("total")).collect()
    out = [0] * width
    for row in found:
        out[row.place] = int(row.total)
    return out


def polarised(d: np.ndarray) -> np.ndarray:
    """The sums over rows of each dimension's squares, and then of the squares of each two dimensions' sums."""
    top = int(np.abs(d).max(initial=0))
    if 4 * top * top * max(len(d), 1) >= 2**63:
        d = d.astype(object)
    pairs = [((d[:, k : k + 1] + d[:, k + 1 :]) ** 2).sum(0) for k in range(d.shape[1] - 1)]
    return np.concatenate([(d**2).sum(0), *pairs])


def covariance(n: int, rest: list[int], squares: list[int]) -> tuple[np.ndarray, float]:
    """The covariance matrix and its trace. rest: sums of d by dimension; squares: as of polarised, for the whole list."""
    dims = len(rest)
    spread = [n * squares[k] - rest[k] ** 2 for k in range(dims)]
    out, at = np.zeros((dims, dims)), dims
    for i in range(dims):
        out[i, i] = spread[i] / (n * n)
        for j in range(i + 1, dims):
            both = n * squares[at] - (rest[i] + rest[j]) ** 2
            out[i, j] = out[j, i] = (both - spread[i] - spread[j]) / (2 * n * n)
            at += 1
    return out, sum(spread) / (n * n)


def fitted(fit: DataFrame, dims: int, components: int = COMPONENTS) -> Fit | None:
    """What a fit list (x, bytes) gives; None if it is empty."""
    first = _added(fit, dims + 1, lambda x: np.concatenate([[len(x)], x.sum(0)]))
    n, sums = first[0], first[1:]
    if n == 0:
        return None
    base, rest = np.array([s // n for s in sums], dtype=np.int64), [s % n for s in sums]
    squares = _added(fit, dims * (dims + 1) // 2, lambda x: polarised(x - base))
    matrix_, trace = covariance(n, rest, squares)
    values, vectors = np.linalg.eigh(matrix_)
    order = np.argsort(-values, kind="stable")[:components]
    vectors = vectors[:, order]
    # one sign for all rows: the largest component of each vector is positive
    sign = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])])
    return Fit(n, base, np.array([float(r) for r in rest]), trace, values[order], vectors * sign)


def identity_error(fit: DataFrame, found: Fit) -> float | None:
    """The largest entry, taken positive, of the whitened fit list's covariance less the identity."""
    real = np.nonzero(~np.isnan(found.scales))[0]
    k = len(real)
    if k == 0:
        return None

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k + k * k)
        for batch in batches:
            if batch.num_rows:
                w = found.whitened(_matrix(batch))[:, real]
                total += np.concatenate([w.sum(0), (w.T @ w).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(range(k + k * k), pa.int64()), pa.array(total)], ["place", "total"])

    added = np.zeros(k + k * k)
    for row in fit.mapInArrow(add, "place bigint, total double").groupBy("place").agg(F.sum("total").alias("total")).collect():
        added[row.place] = row.total
    mean, product = added[:k] / found.n, added[k:].reshape(k, k) / found.n
    return float(np.abs(product - np.outer(mean, mean) - np.eye(k)).max())


def _deviations(d: np.ndarray, found: Fit) -> list[Decimal]:
    """Sum over dimensions of (n * x - sum)**2 for rows d = x - base: n and the sums may be large, so the last steps use integers of any size."""
    rest = np.array([int(r) for r in found.rest], dtype=object)
    small, square = found.n < 2**40, int(sum(rest * rest))
    if small and int(np.abs(d).max(initial=0)) * found.n < 2**28:
        off = found.n * d - rest.astype(np.int64)
        return [Decimal(int(x)) for x in (off * off).sum(1)]
    lengths = (d.astype(object) ** 2).sum(1)
    along = (d.astype(object) * rest).sum(1)
    return [Decimal(int(found.n * found.n * q - 2 * found.n * a + square)) for q, a in zip(lengths, along)]


def project(rows: DataFrame, found: Fit) -> DataFrame:
    """id, deviation (decimal(38,0)), whitened (array of double): for each of rows (id, x)."""
    kind = StructType([StructField("id", rows.schema["id"].dataType), StructField("deviation", DecimalType(38, 0)), StructField("whitened", ArrayType(DoubleType()))])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column("x"))
                w = found.whitened(x)
                flat = pa.array(w.ravel(), mask=np.isnan(w.ravel()))
                lists = pa.ListArray.from_arrays(pa.array(range(0, w.size + 1, w.shape[1]), pa.int32()), flat)
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(_deviations(x - found.base, found), pa.decimal128(38, 0)), lists], ["id", "deviation", "whitened"])

    return rows.select("id", "x").mapInArrow(each, kind)


def report(embeddings: DataFrame, id_: str = "vec_id", vector: str = "embedding", scale: int = SCALE, shift: int = SHIFT, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: for each vector that is kept and each component."""
    kept = whole(embeddings.select(F.col(id_).alias("id"), F.col(vector).alias("v")), "v", scale, shift, BOUND).drop("v").filter(F.size("x") > 0)
    smallest = kept.agg(F.min(F.struct(F.col("id").isNull(), F.col("id"), F.size("x").alias("dims"))).alias("s")).first().s
    dims = smallest.dims if smallest else 1
    kept = kept.filter(F.size("x") == dims)
    fit = save(_packed(kept).distinct(), "fit-list")
    found = fitted(fit, dims, components)
    if found is None:
        none = kept.select(F.col("id").alias("vec_id"), F.lit(0).alias("component"), F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("deviation"))
        return none.select("*", *(F.lit(0.0).alias(c) for c in ("whitened", "explained", "identity_error"))).limit(0)
    error = identity_error(fit, found)
    shares = [float(v / found.trace) if found.trace > 0 else 0.0 for v in np.maximum(found.values, 0)]
    rows = project(kept, found).select("id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return rows.select(
        F.col("id").alias("vec_id"),
        (F.col("place") + 1).cast(IntegerType()).alias("component"),
        F.lit(found.n).cast("bigint").alias("n"),
        F.col("deviation").try_cast("bigint").alias("deviation"),
        "whitened",
        F.get(F.array(*map(F.lit, shares)), F.col("place")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
