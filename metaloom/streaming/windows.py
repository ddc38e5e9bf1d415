"""Event-time windows, for batches and streams alike: on a stream, put a watermark first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _bounds(df: DataFrame, window: Column, keys: Sequence[str], aggregates: Sequence[Column]) -> DataFrame:
    out = df.groupBy(window.alias("w"), *keys).agg(*aggregates)
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *(c for c in out.columns if c != "w"))


def tumbling(df: DataFrame, time: str, width: str, keys: Sequence[str], *aggregates: Column) -> DataFrame:
    return _bounds(df, F.window(time, width), keys, aggregates)


def sliding(df: DataFrame, time: str, width: str, slide: str, keys: Sequence[str], *aggregates: Column) -> DataFrame:
    return _bounds(df, F.window(time, width, slide), keys, aggregates)


def session(df: DataFrame, time: str, gap: str, keys: Sequence[str], *aggregates: Column) -> DataFrame:
    return _bounds(df, F.session_window(time, gap), keys, aggregates)


def first_rows(df: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    """Of each key the row with the smallest time."""
    order = Window.partitionBy(*keys).orderBy(F.asc_nulls_last(time))
    return df.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n")


def dedupe(df: DataFrame, keys: Sequence[str], time: str, delay: str) -> DataFrame:
    """The first row of each key; a stream forgets keys after the delay."""
    return df.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys)) if df.isStreaming else first_rows(df, keys, time)
