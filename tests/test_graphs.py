"""Blank nodes named by what they hold, graphs merged, and Turtle, against plain Python."""

import random

import pytest

from metaloom.operators import graphs as G

SCHEMA = "graph string, s string, p string, o string, o_kind string"


def forest(seed: int, n: int) -> list[tuple]:
    """Random statements of n blank nodes, lists among them, without circles: a node holds only nodes with larger numbers."""
    r, out = random.Random(seed), []
    for k in range(n):
        for _ in range(r.choice((0, 1, 1, 2))):
            out.append((f"_:{k}", r.choice("pq"), r.choice("xyz"), r.choice(("iri", "literal"))))
        if k < n - 1 and r.random() < 0.7:
            out.append((f"_:{k}", G.REST, f"_:{r.randrange(k + 1, min(n, k + 3))}", "blank"))
        for _ in range(r.choice((0, 0, 1, 2))):
            if k < n - 1:
                out.append((f"_:{k}", r.choice((*"pq", G.REST)), f"_:{r.randrange(k + 1, n)}", "blank"))
    return out


def shape(rows: list[tuple], node: str, known: dict) -> frozenset:
    """What a node holds, as sets of sets."""
    if node not in known:
        known[node] = frozenset((p, kind, shape(rows, o, known) if kind == "blank" else o) for s, p, o, kind in rows if s == node)
    return known[node]


def test_names_are_equal_where_structures_are(spark):
    rows = [t for g, seed in enumerate((0, 1, 0)) for t in [(f"_:{g}-{s[2:]}", p, f"_:{g}-{o[2:]}" if k == "blank" else o, k) for s, p, o, k in forest(seed, 9)]]
    df = spark.createDataFrame(rows, "s string, p string, o string, o_kind string")
    names = {r.node: r.name for r in G.blank_names(df).collect()}
    known: dict = {}
    nodes = {t[0] for t in rows} | {t[2] for t in rows if t[3] == "blank"}
    assert set(names) == nodes
    by_shape = {}
    for n in nodes:
        by_shape.setdefault(shape(rows, n, known), set()).add(names[n])
    assert all(len(v) == 1 for v in by_shape.values())
    assert len({v for s in by_shape.values() for v in s}) == len(by_shape) < len(nodes)


def test_merging_is_idempotent_and_names_do_not_count(spark):
    one = forest(7, 8)
    again = {f"_:{k}": f"_:other{(k * 5) % 8}" for k in range(8)}
    two = [(again[s], p, again.get(o, o), k) for s, p, o, k in one]
    merged = lambda *graphs: G.merge_graphs(spark.createDataFrame([(str(i), *t) for i, g in enumerate(graphs) for t in g], SCHEMA))
    told = lambda df: sorted(map(tuple, df.collect()), key=repr)
    both = told(merged(one, two))
    assert both == told(merged(two))
    once_more = spark.createDataFrame([("z", *t[:4]) for t in both], SCHEMA)
    assert told(G.merge_graphs(once_more)) == both


def test_long_lists_take_few_rounds(spark):
    n = 2000
    cell = spark.range(n).selectExpr("concat('_:', id) AS s", f"'{G.REST}' AS p", f"IF(id = {n - 1}, '{G.NIL}', concat('_:', id + 1)) AS o", f"IF(id = {n - 1}, 'iri', 'blank') AS o_kind")
    names = G.blank_names(cell)
    assert names.count() == names.select("name").distinct().count() == n


def test_ended_lists_are_not_written_again(spark, monkeypatch):
    """300 lists of two cells beside one of 64: doubling goes on with the long one alone."""
    cells = [(f"_:{k}-{i}", G.REST, f"_:{k}-{i + 1}" if i + 1 < n else G.NIL, "blank" if i + 1 < n else "iri") for k, n in enumerate([64, *[2] * 300]) for i in range(n)]
    written, kept = [], G.save

    def save(df, name="table"):
        out = kept(df, name)
        written.append(out.count() if name == "chains" else 0)
        return out

    monkeypatch.setattr(G, "save", save)
    assert G.blank_names(spark.createDataFrame(cells, "s string, p string, o string, o_kind string")).select("name").distinct().count() == 64
    assert sum(written) < 2 * len(cells)


def test_both_graphs_of_graph_merge_come_from_one_pass(spark, monkeypatch):
    from metaloom.plans import graphs

    seen = []
    monkeypatch.setattr(graphs.G, "merge_graphs", lambda df: seen.append(df) or df)
    graphs.graph_merge(spark, "/root/testdata/sf0.001")
    assert seen[0]._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1


def test_circles_keep_their_names(spark):
    rows = [("a", "_:1", "p", "_:2", "blank"), ("a", "_:2", "p", "_:1", "blank"), ("a", "_:3", G.REST, "_:3", "blank"), ("a", "_:4", "p", "_:1", "blank"), ("a", "_:5", "p", "x", "iri"), ("b", "_:5", "p", "x", "iri"), (None, None, "p", "x", "iri")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert {r.node for r in G.blank_names(df).collect()} == {"_:5"}
    merged = G.merge_graphs(df)
    assert merged.count() == 5
    assert G.merge_graphs(df.limit(0)).count() == 0


def test_replaced_ids_and_restrictions(spark):
    rows = [("a", G.SUBCLASS, "_:r", "blank"), ("_:r", G.TYPE, G.RESTRICTION, "iri"), ("_:r", G.ON_PROPERTY, "part", "iri"), ("_:r", G.SOME, "b", "iri"), ("b", "label", "a", "literal"), ("c", G.SUBCLASS, "_:t", "blank"), ("_:t", G.SOME, "b", "iri")]
    df = spark.createDataFrame(rows, "s string, p string, o string, o_kind string")
    assert [tuple(r) for r in G.restriction_edges(df).collect()] == [("a", "part", "some", "b")]
    new = G.replace_ids(df, spark.createDataFrame([("a", "A"), ("label", "name"), ("b", "a"), ("b", "z"), (None, "x")], "old string, new string"))
    got = {tuple(r)[:3] for r in new.collect()}
    assert {("A", G.SUBCLASS, "_:r"), ("a", "name", "a"), ("_:r", G.SOME, "a")} <= got and len(got) == len(rows)


TTL = '''@prefix : <http://x/v#> . # a comment
PREFIX c: <http://x/c/>
@base <http://x/base/> .
c:1 a :Thing ; :name "it\\u0041 \\"q\\"", 'one'@en , """two
"lines" . ; ends\\\\"""^^:kind ;; :size 4, -1.5, 2e3, true .
<rel> :holds [ :in [ :deep () ] ; :list ( 1 [ :p c:a\\,b ] ( c:x.y ) ) ] .
:bad :worse .
c:2 :of _:n.1 . _:n.1 :of c:2 . [ :p :o ] .
:x :unknown nope:y . # . not here
:s :text "no end
. :t :u :v .
:w :p "last" .'''


def test_turtle_is_read_by_statement(spark):
    from metaloom.sources import turtle

    files = spark.createDataFrame([("a/x.ttl", bytearray(TTL.encode())), ("a/y.ttl", bytearray(b"\xff")), ("a/z.ttl", None), ("a/e.ttl", bytearray()), ("a/n.ttl", bytearray(b"<s> <p> _:n.1 ."))], "path string, content binary")
    rows = turtle.triples(files).collect()
    good = {(r.s, r.p, r.o, r.o_kind, r.o_datatype, r.o_lang) for r in rows if r.error is None and r.file == "a/x.ttl"}
    v, c, xsd = "http://x/v#", "http://x/c/", "http://www.w3.org/2001/XMLSchema#"
    one = lambda p: {t[2:] for t in good if t[0] == c + "1" and t[1] == p}
    assert one(G.TYPE) == {(v + "Thing", "iri", None, None)}
    assert one(v + "name") == {('itA "q"', "literal", None, None), ("one", "literal", None, "en"), ('two\n"lines" . ; ends\\', "literal", v + "kind", None)}
    assert one(v + "size") == {("4", "literal", xsd + "integer", None), ("-1.5", "literal", xsd + "decimal", None), ("2e3", "literal", xsd + "double", None), ("true", "literal", xsd + "boolean", None)}
    of = lambda s, p: next(t[2] for t in good if t[:2] == (s, p))
    held = of("http://x/base/rel", v + "holds")
    assert of(of(held, v + "in"), v + "deep") == G.NIL
    cell = of(held, v + "list")
    assert of(cell, G.FIRST) == "1"
    cell = of(cell, G.REST)
    assert of(of(cell, G.FIRST), v + "p") == c + "a,b"
    cell = of(cell, G.REST)
    assert of(of(cell, G.FIRST), G.FIRST) == c + "x.y" and of(cell, G.REST) == of(of(cell, G.FIRST), G.REST) == G.NIL
    assert of(of(c + "2", v + "of"), v + "of") == c + "2"
    assert of(v + "w", v + "p") == "last"
    errors = {(r.file, r.line): r.error for r in rows if r.error}
    assert set(errors) == {("a/x.ttl", 7), ("a/x.ttl", 9), ("a/x.ttl", 10), ("a/y.ttl", None)}
    assert "nope" in errors["a/x.ttl", 9] and "UTF-8" in errors["a/y.ttl", None]
    blanks = lambda df: {r.o for r in df.filter("o LIKE '%n.1'").collect()}
    assert len(blanks(turtle.triples(files))) == 2 and len(blanks(turtle.triples(files, together=True))) == 1


def test_turtle_of_deep_and_odd_terms(spark, tmp_path):
    from metaloom.sources import turtle

    deep = b"<s> <p> " + b"[ <p> " * 3000 + b"1" + b" ]" * 3000 + b" ."
    files = spark.createDataFrame([("d.ttl", bytearray(deep))], "path string, content binary")
    assert turtle.triples(files).filter("error IS NULL").count() == 3001
    rows = [("http://x/a b", "http://x/p", "http://x/<\\>", "iri", None, None), ("http://x/s", "http://x/p", 'a"\\\r\n\t', "literal", "http://x/d", None), ("http://x/s", "http://x/p", "", "literal", None, "en"), (None, "p", "o", "iri", None, None)]
    rows += [("http://x/hot", "http://x/p", str(k), "literal", None, None) for k in range(2500)] + [("_:a", "http://x/p", "_:b", "blank", None, None)]
    df = spark.createDataFrame(rows, "s string, p string, o string, o_kind string, o_datatype string, o_lang string")
    assert turtle.statements(df, {}).count() > 5
    turtle.write(df, str(tmp_path / "t"), {"x": "http://x/"})
    back = {tuple(r)[2:8] for r in turtle.read(spark, str(tmp_path / "t")).collect()}
    assert {t for t in back if not t[0].startswith("_")} == {t for t in rows if t[0] and not t[0].startswith("_")} and len(back) == len(rows) - 1
