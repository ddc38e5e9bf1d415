"""Joins and selections that the DataFrame API has no one word for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import save

#: Rows of a side up to which it may be sent to every task.
BROADCAST_ROWS = 100_000


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it has at most so many rows, else as it is, so that the join shuffles."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def growing(df: DataFrame) -> DataFrame:
    """df with the hint that its join is to shuffle both sides, whatever the planner guesses from the sizes of files: rows that are exploded, or that files hold well compressed, would be sent to the driver whole."""
    return df.hint("merge")


def numbered(df: DataFrame, order: Sequence[Column | str], name: str = "n") -> DataFrame:
    """df with the number of each row in the order, from 1: rows are dealt by ranges and numbered there, plus the rows of the ranges before. No task sees all rows."""
    at = F.monotonically_increasing_id()
    rows = save(df.repartitionByRange(*order).sortWithinPartitions(*order).select("*", at.alias("_at")), "numbered")
    part = F.shiftright("_at", 33)
    counts = rows.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))  # a row for each range
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("_part", before.alias("_before"))
    inside = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return rows.withColumn("_part", part).join(F.broadcast(offsets), "_part").withColumn(name, inside + F.col("_before") + 1).drop("_at", "_part", "_before")


def within(a: DataFrame, b: DataFrame, keys: Sequence[str], value: str, width: float) -> DataFrame:
    """Pairs (columns a and b, structs) of equal keys whose values differ by less than width: rows meet in bands of that width, not all with all."""
    band = F.floor(F.col(value) / width)
    x = a.select(F.struct("*").alias("a"), *(F.col(k).alias(f"_{k}") for k in keys), band.alias("_band"))
    y = b.select(F.struct("*").alias("b"), *(F.col(k).alias(f"_{k}") for k in keys), F.explode(F.array(band - 1, band, band + 1)).alias("_band"))
    return x.join(y, [*(f"_{k}" for k in keys), "_band"]).filter(F.abs(F.col(f"a.{value}") - F.col(f"b.{value}")) < width).select("a", "b")


def last_wins(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Of each key the last row in the order, as when a mapping is filled row by row. Nulls count as smallest."""
    latest = Window.partitionBy(*keys).orderBy(*(F.col(c).desc_nulls_last() if isinstance(c, str) else c for c in order))
    return df.withColumn("_n", F.row_number().over(latest)).filter("_n = 1").drop("_n")


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of both by key; a null in new leaves old's cell as it is."""
    a, b = old.alias("a"), new.alias("b")
    on = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys]
    return a.join(b, on, "full").select(*(F.coalesce(F.col(f"b.{c}"), F.col(f"a.{c}")).alias(c) for c in old.columns))


def nearest(values: DataFrame, column: str, choices: Sequence[str], most: Column | None = None) -> DataFrame:
    """Adds nearest and distance: of a fixed list, what has the least edit distance, the first in the alphabet of equals; null beyond most."""
    value = F.col(column)
    best = F.array_min(F.array(*(F.struct(F.levenshtein(value, F.lit(c)).alias("distance"), F.lit(c).alias("value")) for c in choices)))
    fits = best["distance"] <= (F.char_length(value) / 2 if most is None else most)
    return values.withColumn("nearest", F.when(fits, best["value"])).withColumn("distance", best["distance"])


def contained(texts: DataFrame, text: str, terms: DataFrame, term: str) -> DataFrame:
    """Pairs of a text and a term of one word or more that the text's words contain, without comparing all pairs.

    Texts meet terms under the term's first word; whole terms are compared after that.
    """
    words = texts.select("*", F.explode(F.array_distinct(F.split(F.col(text), r"\s+"))).alias("_word"))
    keyed = terms.withColumn("_word", F.element_at(F.split(F.col(term), r"\s+"), 1))
    inside = F.concat(F.lit(" "), F.regexp_replace(F.col(text), r"\s+", " "), F.lit(" ")).contains(F.concat(F.lit(" "), F.col(term), F.lit(" ")))
    return words.join(keyed, "_word").filter(inside).drop("_word")


def as_of(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, value: str) -> DataFrame:
    """left with the latest value of right at or before its time, by key: one shuffle, no range join."""
    columns = left.columns
    none = F.lit(None)
    a = left.select(F.struct("*").alias("row"), F.col(key).alias("_key"), F.col(left_time).alias("_time"), none.cast(right.schema[value].dataType).alias("_value"), F.lit(1).alias("_side"))
    b = right.select(none.cast(a.schema["row"].dataType).alias("row"), F.col(key).alias("_key"), F.col(right_time).alias("_time"), F.col(value).alias("_value"), F.lit(0).alias("_side"))
    before = Window.partitionBy("_key").orderBy("_time", "_side", "_value").rowsBetween(Window.unboundedPreceding, 0)
    out = a.unionByName(b).withColumn("_last", F.last("_value", ignorenulls=True).over(before)).filter("_side = 1")
    return out.select(*(F.col(f"row.{c}") for c in columns), F.col("_last").alias(value))
