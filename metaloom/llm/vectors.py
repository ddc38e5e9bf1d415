"""Vectors as whole numbers, for the operators on embeddings: which rows are kept, and Arrow columns as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vector: Column) -> Column:
    """Whether a vector is there, and all of its components are there and finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad, F.lit(False))


def whole(rows: DataFrame, vector: str, scale: int, shift: int, bound: int) -> DataFrame:
    """rows with a finite vector, as x (array of long): floor(scale * component) + shift. Components beyond bound are held there, so that no sum of squares overflows."""
    x = F.transform(F.col(vector), lambda c: F.floor(F.greatest(F.lit(-float(bound)), F.least(F.lit(float(bound)), c.cast("double") * scale))) + shift)
    return rows.filter(finite(F.col(vector))).withColumn("x", x)


def matrix(column: pa.Array) -> np.ndarray:
    """A column of equally long lists of longs as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
