"""Every query of the library's own operators: name to callable, and name to the same query in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
FLAGSHIP = "completeness"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a function under its name; sql is the same query for DuckDB, None where SQL can't express it."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def load() -> None:
    """Imports the modules whose queries register themselves."""
    from . import cellvalues, derived, documents, extraction, graph, graphs, history, matching, normal, orders, relational, reports, scalars, schemas, sources, structure, tabular, templates, tracings, trees, validation  # noqa: F401
