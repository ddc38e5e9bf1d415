"""Triples and graph patterns over them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .relational import small


def build(rows: DataFrame, subject: Column, predicates: Mapping[str, str]) -> DataFrame:
    """s, p, o, o_kind: a triple for each mapped column that is not null; an array's elements fan out. predicates: column to predicate.

    Arrays of structs and the like have to be taken apart before. One pass over rows.
    """
    kinds = dict(rows.dtypes)
    as_values = lambda c: F.col(c).cast("array<string>") if kinds[c].startswith("array") else F.array(F.col(c).cast("string"))

    def made(column: str, predicate: str) -> Column:
        kind = kinds[column].removeprefix("array<").rstrip(">")
        given = F.coalesce(as_values(column), F.array().cast("array<string>"))
        return F.transform(given, lambda v: F.struct(F.lit(predicate).alias("p"), v.alias("o"), F.lit(kind).alias("o_kind")))

    each = [made(c, p) for c, p in predicates.items()]
    return rows.select(subject.alias("s"), F.explode(F.concat(*each)).alias("t")).select("s", "t.*").filter("o IS NOT NULL")


def pattern(triples: DataFrame, subject: str, predicate: str | Sequence[str] | None, obj: str) -> DataFrame:
    """One triple pattern: ?x binds a column x, anything else is a value; several predicates are alternatives. A variable in both places must be equal."""
    out = triples
    if predicate is not None:
        out = out.filter(F.col("p").isin([predicate] if isinstance(predicate, str) else list(predicate)))
    columns = []
    for place, term in (("s", subject), ("o", obj)):
        if term.startswith("?"):
            columns.append((place, term[1:]))
        else:
            out = out.filter(F.col(place) == term)
    if len(columns) == 2 and columns[0][1] == columns[1][1]:
        return out.filter("s = o").select(F.col("s").alias(columns[0][1]))
    return out.select(*(F.col(place).alias(name) for place, name in columns))


def _shared(a: DataFrame, b: DataFrame) -> list[str]:
    return [c for c in a.columns if c in b.columns]


def bgp(triples: DataFrame, *patterns: tuple) -> DataFrame:
    """Patterns joined on the variables they share; each must share one with those before."""
    out = pattern(triples, *patterns[0])
    for p in patterns[1:]:
        new = pattern(triples, *p)
        out = out.join(new, _shared(out, new))
    return out


def optional(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.join(b, _shared(a, b), "left")


def minus(a: DataFrame, b: DataFrame) -> DataFrame:
    """Takes away what b agrees with; nothing where they share no variable."""
    shared = _shared(a, b)
    return a.join(b, shared, "left_anti") if shared else a


def values(a: DataFrame, name: str, given: Sequence) -> DataFrame:
    return a.join(small(a.sparkSession.createDataFrame([(x,) for x in given], a.select(name).schema)), name, "left_semi")


def derive_edges(triples: DataFrame, first: str, second: str, made: str) -> DataFrame:
    """triples and, for each two that follow on each other, one with the predicate made (as an INSERT of derived edges)."""
    new = bgp(triples, ("?s", first, "?m"), ("?m", second, "?o")).select("s", F.lit(made).alias("p"), "o").distinct()
    return triples.select("s", "p", "o").unionByName(new).distinct()


def quantity_nodes(rows: DataFrame, subject: Column, predicate: str, value: Column, unit: Column) -> DataFrame:
    """s, p, o, o_kind: a blank node for each quantity, named by its content, with its value and unit."""
    node = F.concat(F.lit("_:q"), F.substring(F.sha2(F.concat_ws("|", subject, F.lit(predicate), value.cast("string"), unit), 256), 1, 16))
    triple = lambda s, p, o, kind: F.struct(s.alias("s"), F.lit(p).alias("p"), o.cast("string").alias("o"), F.lit(kind).alias("o_kind"))
    made = F.array(triple(subject, predicate, node, "blank"), triple(node, "hasValue", value, "double"), triple(node, "hasUnit", unit, "string"))
    return rows.filter(value.isNotNull()).select(F.explode(made).alias("t")).select("t.*")
