"""Whole graphs of triples (s, p, o, o_kind and, if present, o_datatype and o_lang): blank nodes named by what they hold, graphs merged, identifiers replaced, restrictions as edges.

Blank nodes begin with "_:"; as objects their o_kind is blank. Rows with a null s, p or o are left out everywhere.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import save
from .relational import growing
from .triples import bgp

#: Predicates and objects that lists and restrictions are written with.
RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
OWL = "http://www.w3.org/2002/07/owl#"
SUBCLASS = "http://www.w3.org/2000/01/rdf-schema#subClassOf"
TYPE, FIRST, REST, NIL = (RDF + n for n in ("type", "first", "rest", "nil"))
RESTRICTION, ON_PROPERTY, SOME, ALL = (OWL + n for n in ("Restriction", "onProperty", "someValuesFrom", "allValuesFrom"))

#: A prime; two remainders of it lie in one long, and products of two are no more than a long holds.
_PRIME = (1 << 31) - 1


def _digest(text: Column) -> Column:
    return F.sha2(text, 256)


def _halves(digest: Column) -> tuple[Column, Column]:
    hashes = (F.xxhash64(F.lit(k), digest) for k in (1, 2))
    return tuple(_pair(F.shiftrightunsigned(h, 33), h.bitwiseAND(_PRIME)) for h in hashes)


def _lanes(text: Column) -> tuple[Column, Column]:
    """Two longs, of two numbers below the prime each, from a text."""
    return _halves(_digest(text))


def _pair(high: Column, low: Column) -> Column:
    return F.shiftleft(F.pmod(high, F.lit(_PRIME)), 31) + F.pmod(low, F.lit(_PRIME))


def _times(a: str, b: str, plus: Column) -> Column:
    """a * b + plus, pair by pair."""
    high, low = (lambda c: F.shiftright(c, 31)), (lambda c: c.bitwiseAND(_PRIME))
    x, y = F.col(a), F.col(b)
    return _pair(high(x) * high(y) + high(plus), low(x) * low(y) + low(plus))


def _sums(rows: DataFrame, term: Column) -> DataFrame:
    """s, c1, c2, n: distinct terms of each node as sums of their numbers without carries: combined before the shuffle, and no node's statements ever lie in one row."""
    one, two = _lanes(term)
    return rows.select("s", one.alias("_1"), two.alias("_2")).groupBy("s").agg(F.bit_xor("_1").alias("c1"), F.bit_xor("_2").alias("c2"), F.count("*").alias("n"))


def _told(triples: DataFrame, *more: Column) -> DataFrame:
    has = lambda c: F.col(c) if c in triples.columns else F.lit(None).cast("string")
    rows = triples.select("s", "p", "o", "o_kind", has("o_datatype").alias("o_datatype"), has("o_lang").alias("o_lang"), *more)
    return rows.filter("s IS NOT NULL AND p IS NOT NULL AND o IS NOT NULL")


def _together(tables: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


def _leap(chains: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chains (s, a1, b1, a2, b2, next) led on by doubling, to nodes with names (known: s, h1, h2). Returns the names found, and the chains that lead to none yet.

    A round joins only the chains still under way with what they meet: a name, or another chain. Those that lead round in a circle stay on it, those that lead to a node that is neither wait there.
    """
    found, waiting, under_way, n = [], [], chains, chains.count()
    none = F.lit(None).cast("bigint")
    for _ in range(n.bit_length() + 1):
        names = _together([known, *found]).select(F.col("s").alias("next"), *(F.col(f"h{k}").alias(f"_h{k}") for k in (1, 2)), *(none.alias(f"_{c}{k}") for k in (1, 2) for c in "ab"), F.lit(None).cast("string").alias("_next"))
        others = _together([under_way, *waiting]).select(F.col("s").alias("next"), *(none.alias(f"_h{k}") for k in (1, 2)), *(F.col(f"{c}{k}").alias(f"_{c}{k}") for k in (1, 2) for c in "ab"), F.col("next").alias("_next"))
        met = under_way.join(growing(names.unionByName(others)), "next", "left")
        go = F.col("_next").isNotNull()
        led = [F.when(go, _times(f"a{k}", f"_a{k}", F.lit(0).cast("bigint"))).otherwise(F.col(f"a{k}")).alias(f"a{k}") for k in (1, 2)]
        led += [F.when(go, _times(f"a{k}", f"_b{k}", F.col(f"b{k}"))).otherwise(F.col(f"b{k}")).alias(f"b{k}") for k in (1, 2)]
        named = [_times(f"a{k}", f"_h{k}", F.col(f"b{k}")).alias(f"h{k}") for k in (1, 2)]
        moved = save(met.select("s", *led, F.coalesce("_next", "next").alias("next"), *named, go.alias("_go")), "chains")
        found.append(moved.filter("h1 IS NOT NULL").select("s", "h1", "h2"))
        left = moved.filter("h1 IS NULL").select("s", "a1", "a2", "b1", "b2", "next", "_go")
        waiting.append(left.filter("NOT _go").drop("_go"))
        under_way = left.filter("_go").drop("_go")
        if under_way.isEmpty():
            break
    return _together(found), _together([under_way, *waiting])


def _named(rows: DataFrame, spine: str) -> tuple[DataFrame, DataFrame, bool]:
    """Of told rows the distinct statements of blank nodes, names (s, h1, h2), and whether every blank node has one. See blank_names()."""
    held = save(rows.filter(F.col("s").startswith("_:")).distinct(), "held")
    blank = F.col("o_kind") == "blank"
    text, term = F.to_json(F.struct("p", "o_kind", "o", "o_datatype", "o_lang")), F.col("_term")
    terms = held.select("s", F.when(~blank, _digest(text)).alias("_term"), blank.alias("_link")).unionByName(rows.filter(blank).select(F.col("o").alias("s"), F.lit(None).cast("string").alias("_term"), F.lit(False).alias("_link")))
    one, two = (F.when(term.isNotNull(), c) for c in _halves(term))
    own = terms.select("s", one.alias("_1"), two.alias("_2"), "_link")
    zero = F.lit(0).cast("bigint")
    own = save(own.groupBy("s").agg(F.coalesce(F.bit_xor("_1"), zero).alias("c1"), F.coalesce(F.bit_xor("_2"), zero).alias("c2"), F.count("_1").alias("n"), F.bool_or("_link").alias("holds")), "own")

    key = F.concat_ws("|", F.col("c1").cast("string"), F.col("c2").cast("string"), F.col("n").cast("string"))
    numbered = lambda suffix, *names: [n.alias(a) for a, n in zip(names, _lanes(F.concat(key, F.lit(suffix))))]
    fresh = save(own.filter("NOT holds").select("s", *numbered("", "h1", "h2")), "names")
    left = own.filter("holds").count()
    open_links = held.filter(blank).select("s", "p", "o").withColumns({c: F.lit(None).cast("bigint") for c in ("h1", "h2")})
    named, pending = [fresh], None
    while left:
        to = fresh.select(F.col("s").alias("o"), F.col("h1").alias("_h1"), F.col("h2").alias("_h2"))
        filled = save(open_links.join(growing(to), "o", "left").select("s", "p", "o", F.coalesce("h1", "_h1").alias("h1"), F.coalesce("h2", "_h2").alias("h2")), "filled")
        on = F.col("p") == spine
        name = F.when(on, F.struct("h1", "h2"))
        per = filled.groupBy("s").agg(
            F.bool_and(F.col("h1").isNotNull()).alias("whole"), F.bool_and(F.col("h1").isNotNull() | on).alias("beside"), F.min(F.when(on, F.col("o"))).alias("lo"), F.max(F.when(on, F.col("o"))).alias("hi"), (F.min(name) == F.max(name)).alias("alike")
        )
        led = F.coalesce(F.when(F.col("whole"), F.col("alike")).otherwise(F.col("lo") == F.col("hi")), F.lit(False))
        ready = save(per.filter("whole OR (beside AND lo = hi)").select("s", led.alias("led"), F.col("lo").alias("next")), "ready")
        if ready.isEmpty() and pending is None:
            break
        body = ready.join(growing(own), "s").select("s", "led", "next", "c1", "c2", "n")
        beside = filled.filter(~on | F.lit(not ready.filter("NOT led").isEmpty()))
        if not beside.isEmpty():
            inner = beside.join(growing(ready), "s").filter(~(on & F.col("led"))).select("s", "p", "h1", "h2").distinct()
            more = _sums(inner, F.to_json(F.struct("p", "h1", "h2"))).select("s", *(F.col(c).alias(f"_{c}") for c in ("c1", "c2", "n")))
            mixed = [F.col(c).bitwiseXOR(F.coalesce(f"_{c}", zero)).alias(c) for c in ("c1", "c2")]
            body = body.join(growing(more), "s", "left").select("s", "led", "next", *mixed, (F.col("n") + F.coalesce("_n", zero)).alias("n"))
        body = save(body, "bodies")
        direct = body.filter("NOT led").select("s", *numbered("", "h1", "h2"))
        chains = body.filter("led").select("s", *numbered("|a", "a1", "a2"), *numbered("|b", "b1", "b2"), "next")
        found, pending = _leap(save(chains if pending is None else chains.unionByName(pending), "chains"), _together([*named, direct]))
        fresh = save(direct.unionByName(found), "names")
        if not (now := fresh.count()):
            break
        left -= now
        named.append(fresh)
        open_links = filled.join(growing(ready), "s", "left_anti")
        if len(named) > 16:  # so that unions stay short
            named = [save(_together(named), "names")]
    return held, _together(named), not left


def _called() -> Column:
    return F.concat(F.lit("_:c"), *(F.lpad(F.col(c).cast("string"), 19, "0") for c in ("h1", "h2")))


def blank_names(triples: DataFrame, spine: str = REST) -> DataFrame:
    """node, name, of each blank node: equal names where nodes hold equal statements, however these and the nodes in them are called and wherever they lie.

    What a node holds is its set of statements with it as subject, other nodes in them told by their names; so two nodes that hold nothing are one. A name is made from the
    leaves up, one round for each level of nesting. A node with one object under spine is a function a * x + b of that object's name x, a and b made from all else that it holds:
    such functions are composed by doubling, so that a list counts as few levels as its length has binary digits. Nodes on a circle of blank nodes, or that hold one, are not in the result.
    Names have some 124 bits.
    """
    return _named(_told(triples), spine)[1].select(F.col("s").alias("node"), _called().alias("name"))


def name_blanks(triples: DataFrame, spine: str = REST) -> DataFrame:
    """The distinct triples with blank nodes called by blank_names(); those without such a name keep their own.

    Nodes of one name hold the same, so the statements of one of them are told, not those of all.
    """
    rows = _told(triples)
    held, names, whole = _named(rows, spine)
    names = save(names.select("s", _called().alias("name")), "called")
    one = save(names.groupBy("name").agg(F.min("s").alias("s")), "one")
    told = held.join(growing(one), "s").withColumn("s", F.col("name")).drop("name")
    if not whole:
        told = told.unionByName(held.join(growing(names), "s", "left_anti"))
    told = told.unionByName(rows.filter(~F.col("s").startswith("_:")))
    blank = F.col("o_kind") == "blank"
    called = told.filter(blank).join(growing(names.withColumnRenamed("s", "o")), "o", "left").withColumn("o", F.coalesce("name", "o")).drop("name")
    return told.filter(~blank).unionByName(called).distinct()


def merge_graphs(triples: DataFrame, graph: str = "graph") -> DataFrame:
    """One graph of those that the column tells apart: equal triples and equal blank structures are there once, whatever their graphs called them.

    Blank nodes on a circle, or that hold one, stay apart by graph. Merging what has been merged changes nothing, but for the names of these.
    """
    rows = _told(triples, F.col(graph).cast("string").alias("_g"))
    apart = lambda c: F.concat(F.lit("_:g"), F.hex(F.xxhash64(F.coalesce("_g", F.lit("")))), F.lit("-"), F.substring(c, F.lit(3), F.char_length(c)))
    s = F.when(F.col("s").startswith("_:"), apart("s")).otherwise(F.col("s"))
    o = F.when(F.col("o_kind") == "blank", apart("o")).otherwise(F.col("o"))
    return name_blanks(save(rows.select(s.alias("s"), "p", o.alias("o"), "o_kind", "o_datatype", "o_lang"), "apart"))


def replace_ids(triples: DataFrame, replacements: DataFrame) -> DataFrame:
    """The distinct triples with each IRI old as its new one, in every place. replacements: old, new; of several new ones the smallest; a new one is not replaced again."""
    rows, to = _told(triples), replacements.filter("old IS NOT NULL AND new IS NOT NULL").groupBy("old").agg(F.min("new").alias("new"))
    for place, some in (("s", F.lit(True)), ("p", F.lit(True)), ("o", F.col("o_kind") == "iri")):
        rows = rows.join(to.withColumnRenamed("old", "_old"), (F.col(place) == F.col("_old")) & some, "left").withColumn(place, F.coalesce("new", place)).drop("_old", "new")
    return rows.distinct()


def restriction_edges(triples: DataFrame, under: str = SUBCLASS) -> DataFrame:
    """s, property, quantifier (some or all), o: what subjects are under by a restriction on a property, without the restriction's node; as a table of edges for closures. Those without a filler or property are left out."""
    rows = _told(triples)
    kinds = [bgp(rows, ("?r", quantifier, "?o"), ("?r", ON_PROPERTY, "?property"), ("?r", TYPE, RESTRICTION), ("?s", under, "?r")).select("s", "property", F.lit(word).alias("quantifier"), "o") for word, quantifier in (("some", SOME), ("all", ALL))]
    return kinds[0].unionByName(kinds[1]).distinct()
