"""The scheduling state machine: one pure transition, folded over a batch or over a stream.

State 0 is idle, 1 queued, 2 running, 3 running and queued again. An update that is newer than the last queued one is
queued; started and finished move the machine on; what doesn't fit the state changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (state, message) to the new state.
MOVES = {(0, "update"): 1, (1, "update"): 1, (2, "update"): 3, (3, "update"): 3, (1, "start"): 2, (2, "finish"): 0, (3, "finish"): 1}


def enqueue(updated: Column, succeeded: Column, failed: Column, code_changed: Column) -> Column:
    """Whether a dataset is due: never run, changed code without a failure, or newer than the last failure or success."""
    return (succeeded.isNull() & failed.isNull()) | (code_changed & failed.isNull()) | F.coalesce(updated > failed, updated > succeeded, F.lit(False))


def transition(state: int, queued: int | None, message: str, at: int) -> tuple[int, int | None]:
    """The new state and the time of the update last queued; a repeated update of the same time or an older one changes nothing."""
    if message == "update" and queued is not None and at <= queued:
        return state, queued
    return MOVES.get((state, message), state), at if message == "update" else queued


def fold(messages: DataFrame, key: str, order: str) -> DataFrame:
    """key, state, queued, n, after all messages (key, order, message, at) in order; inside one aggregate expression."""
    step = F.struct(F.col(order).alias("o"), F.col("message").alias("message"), F.col("at").cast("bigint").alias("at"))
    listed = messages.groupBy(key).agg(F.array_sort(F.collect_list(step)).alias("steps"))
    start = F.struct(F.lit(0).alias("state"), F.lit(None).cast("bigint").alias("queued"))

    def move(a: Column, m: Column) -> Column:
        new = a["state"]
        for (state, message), to in MOVES.items():
            new = F.when((a["state"] == state) & (m["message"] == message), to).otherwise(new)
        is_update = m["message"] == "update"
        stale = is_update & F.coalesce(m["at"] <= a["queued"], F.lit(False))
        return F.struct(F.when(stale, a["state"]).otherwise(new).alias("state"), F.when(is_update & ~stale, m["at"]).otherwise(a["queued"]).alias("queued"))

    return listed.select(key, F.aggregate("steps", start, move).alias("s"), F.size("steps").cast("bigint").alias("n")).select(key, "s.state", "s.queued", "n")


def stream(messages: DataFrame, key: str, order: str) -> DataFrame:
    """The same for a stream: a row for each key that a batch has changed."""

    def run(k: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        at, queued, n = state.get if state.exists else (0, None, 0)
        for row in pd.concat(list(batches)).sort_values(order).itertuples(index=False):
            at, queued = transition(at, queued, row.message, row.at)
            n += 1
        state.update((at, queued, n))
        yield pd.DataFrame({key: [k[0]], "state": [at], "queued": pd.array([queued], "Int64"), "n": [n]})

    kind = dict(messages.dtypes)[key]
    return messages.groupBy(key).applyInPandasWithState(run, f"`{key}` {kind}, state int, queued bigint, n bigint", "state int, queued bigint, n bigint", "update", "NoTimeout")
