"""Turtle: files read statement by statement, in parallel by file, with what can't be read as rows; and a writer that puts a subject's triples together."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Mapping
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.relational import small

SCHEMA = "file string, line int, s string, p string, o string, o_kind string, o_datatype string, o_lang string, error string"
#: Triples of a subject in one statement; more are told in several.
BLOCK = 1000
#: Rows that a task hands on at once.
_BATCH = 8192

#: Terms that the syntax stands for.
_RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
_XSD = "http://www.w3.org/2001/XMLSchema#"
_ODD = r'[<>"{}|^`\\\x00-\x20]'
_ESCAPES = {"t": "\t", "b": "\b", "n": "\n", "r": "\r", "f": "\f", '"': '"', "'": "'", "\\": "\\"}

_TOKEN = re.compile(
    r"""(?P<skip>(?:[ \t\r\n]|\#[^\n]*)+)
    |(?P<iri><[^<>"{}|^`\x00-\x20]*>)
    |(?P<text>\"{3}(?:\"{0,2}(?:[^\"\\]|\\.))*\"{3}|'{3}(?:'{0,2}(?:[^'\\]|\\.))*'{3}|"(?:[^"\\\n\r]|\\.)*"|'(?:[^'\\\n\r]|\\.)*')
    |(?P<word>@[A-Za-z]+(?:-[A-Za-z0-9]+)*)
    |(?P<blank>_:[\w](?:[\w.\-\u00b7]*[\w\-\u00b7])?)
    |(?P<number>[+-]?(?:\d+\.\d*[eE][+-]?\d+|\.?\d+[eE][+-]?\d+|\d*\.\d+|\d+))
    |(?P<name>(?:[^\W\d_](?:[\w.\-\u00b7]*[\w\-\u00b7])?)?:(?:(?:[\w:]|%[0-9A-Fa-f]{2}|\\[_~.\-!$&'()*+,;=/?\#@%])(?:(?:[\w.:\-\u00b7]|%[0-9A-Fa-f]{2}|\\[_~.\-!$&'()*+,;=/?\#@%])*(?:[\w:\-\u00b7]|%[0-9A-Fa-f]{2}|\\[_~.\-!$&'()*+,;=/?\#@%]))?)?)
    |(?P<bare>[A-Za-z]+)
    |(?P<mark>\^\^|[.;,\[\]()])""",
    re.X | re.S,
)


class Fault(ValueError):
    pass


def _unescaped(text: str) -> str:
    def one(m: re.Match) -> str:
        if (digits := m[1] or m[2]) is not None:
            code = int(digits, 16)
            if code > 0x10FFFF or 0xD800 <= code < 0xE000:
                raise Fault(f"no character has the number {digits}")
            return chr(code)
        if m[3] not in _ESCAPES:
            raise Fault(f"unknown escape \\{m[3]}")
        return _ESCAPES[m[3]]

    return re.sub(r"\\(?:u([0-9A-Fa-f]{4})|U([0-9A-Fa-f]{8})|(.))", one, text, flags=re.S) if "\\" in text else text


class _File:
    """The statements of one text. Nested nodes and lists are kept on a stack of our own, so their depth is bounded by memory only."""

    def __init__(self, text: str, base: str, scope: str, shared: str):
        self.text, self.base, self.scope, self.shared = text, base, scope, shared
        self.at, self.made, self.prefixes = 0, 0, {}
        self.kind, self.value, self.begin = "", "", 0
        self.out: list[tuple] = []

    def step(self) -> None:
        """To the next token; kind is end after the last one."""
        while True:
            self.begin = self.at
            if self.at >= len(self.text):
                self.kind, self.value = "end", ""
                return
            m = _TOKEN.match(self.text, self.at)
            if m is None:
                raise Fault(f"unexpected {self.text[self.at]!r}")
            self.at = m.end()
            if m.lastgroup != "skip":
                self.kind, self.value = m.lastgroup, m[0]
                return

    def mark(self, value: str) -> bool:
        return self.kind == "mark" and self.value == value

    def take(self, value: str) -> None:
        if not self.mark(value):
            raise Fault(f"{value} expected, not {self.value or 'the end'}")
        self.step()

    def fresh(self) -> str:
        self.made += 1
        return f"_:{self.scope}-g{self.made}"

    def iri(self) -> str:
        kind, value = self.kind, self.value
        if kind == "iri":
            found = _unescaped(value[1:-1])
            found = found if re.match(r"[A-Za-z][A-Za-z0-9+.\-]*:", found) or not self.base else urljoin(self.base, found)
        elif kind == "name":
            prefix, _, local = value.partition(":")
            if prefix not in self.prefixes:
                raise Fault(f"unknown prefix {prefix}:")
            found = self.prefixes[prefix] + re.sub(r"\\(.)", r"\1", local)
        else:
            raise Fault(f"a name expected, not {value or 'the end'}")
        self.step()
        return found

    def directive(self) -> bool:
        """@prefix, @base and their forms without @ and dot."""
        word = self.value.lower() if self.kind == "bare" else self.value
        if self.kind not in ("word", "bare") or word.lstrip("@") not in ("prefix", "base"):
            return False
        dotted = self.kind == "word"
        self.step()
        if word.endswith("prefix"):
            if self.kind != "name" or not self.value.endswith(":"):
                raise Fault("a prefix expected")
            prefix = self.value[:-1]
            self.step()
            if self.kind != "iri":
                raise Fault("a prefix needs an IRI")
            self.prefixes[prefix] = self.iri()
        elif self.kind == "iri":
            self.base = self.iri()
        else:
            raise Fault("a base needs an IRI")
        if dotted:
            self.dot()
        return True

    def verb(self) -> str:
        if self.kind == "bare" and self.value == "a":
            self.step()
            return _RDF + "type"
        return self.iri()

    def plain(self) -> tuple:
        """(term, kind, datatype, language) of what isn't nested."""
        kind, value = self.kind, self.value
        if kind == "blank":
            self.step()
            return f"_:{self.shared}-{value[2:]}", "blank", None, None
        if kind == "number":
            self.step()
            name = "double" if "e" in value.lower() else "decimal" if "." in value else "integer"
            return value, "literal", _XSD + name, None
        if kind == "bare" and value in ("true", "false"):
            self.step()
            return value, "literal", _XSD + "boolean", None
        if kind == "text":
            quote = 3 if value[:3] in ('"""', "'''") else 1
            text = _unescaped(value[quote:-quote])
            self.step()
            if self.kind == "word":
                lang = self.value[1:]
                self.step()
                return text, "literal", None, lang
            if self.mark("^^"):
                self.step()
                return text, "literal", self.iri(), None
            return text, "literal", None, None
        return self.iri(), "iri", None, None

    def statement(self) -> None:
        """One statement up to its dot. A frame of the stack is [kind, subject, predicate]: what is open is a node with its predicates, or a list with its last cell."""
        top = nested = None
        if self.mark("["):
            nested = self.begin
        frames: list[list] = []
        term: tuple | None = None
        while True:
            if term is None:
                if self.mark("["):
                    self.step()
                    node = self.fresh()
                    if self.mark("]"):
                        self.step()
                        term = (node, "blank", None, None)
                        continue
                    frames.append(["node", node, self.verb()])
                    continue
                if self.mark("("):
                    self.step()
                    frames.append(["list", None, None])
                elif not (self.mark(")") and frames and frames[-1][0] == "list"):
                    term = self.plain()
                    continue
                if self.mark(")"):
                    self.step()
                    _, head, last = frames.pop()
                    if last is not None:
                        self.out.append((last, _RDF + "rest", _RDF + "nil", "iri", None, None))
                    term = (head or _RDF + "nil", "blank" if head else "iri", None, None)
                continue
            if not frames:
                if top is not None:
                    raise Fault("a statement goes on after its end")
                if term[1] == "literal":
                    raise Fault("a literal can't be a subject")
                top = term
                if nested is not None and self.mark("."):
                    self.dot()
                    return
                frames.append(["top", term[0], self.verb()])
                term = None
                continue
            frame = frames[-1]
            if frame[0] == "list":
                cell = self.fresh()
                if frame[1] is None:
                    frame[1] = cell
                else:
                    self.out.append((frame[2], _RDF + "rest", cell, "blank", None, None))
                self.out.append((cell, _RDF + "first", *term))
                frame[2], term = cell, None
                continue
            self.out.append((frame[1], frame[2], *term))
            if self.mark(","):
                self.step()
                term = None
                continue
            end = "." if frame[0] == "top" else "]"
            more = self.mark(";")
            while self.mark(";"):
                self.step()
            if more and not self.mark(end):
                frame[2], term = self.verb(), None
                continue
            self.take(end) if end == "]" else self.dot()
            frames.pop()
            if end == ".":
                return
            term = (frame[1], "blank", None, None)

    def dot(self) -> None:
        if not self.mark("."):
            raise Fault(f". expected, not {self.value or 'the end'}")
        # what comes next belongs to the next statement, and so does a fault in it
        self.kind, self.value = "ahead", ""

    def recover(self, begin: int) -> None:
        """On to behind the next dot that ends a line and is no part of a text."""
        self.at = self.begin if self.mark(".") else max(self.at, begin + 1)
        while self.at < len(self.text):
            m = _TOKEN.match(self.text, self.at)
            self.at = m.end() if m else self.at + 1
            if m and m[0] == "." and re.compile(r"[ \t]*(?:#[^\n]*)?(?:\r?\n|\Z)").match(self.text, self.at):
                break
        self.kind = "ahead"

    def rows(self) -> Iterator[tuple]:
        """(line, s, p, o, o_kind, o_datatype, o_lang, error). A statement with a fault gives one row with the error and none of its triples."""
        line, counted = 1, 0
        self.kind = "ahead"
        while True:
            begin = self.at
            try:
                if self.kind == "ahead":
                    self.step()
                begin = self.begin
                if self.kind == "end":
                    return
                if not self.directive():
                    self.statement()
                found, error = self.out, None
            except Fault as e:
                found, error = [], str(e)
            line, counted = line + self.text.count("\n", counted, begin), begin
            yield from ((line, *t, None) for t in found)
            self.out = []
            if error is not None:
                yield (line, *[None] * 6, error)
                self.recover(begin)


def triples(files: DataFrame, base: str = "", together: bool = False) -> DataFrame:
    """file, line, s, p, o, o_kind (iri, blank, literal), o_datatype, o_lang, error, of files (path, content). Plain texts have no datatype.

    A file is read in one task, statement by statement, and handed on in batches; a statement that can't be read is one row with an error, and reading goes on after the next dot at the end of a
    line. Blank nodes are called by the file that they are in, or by its folder if the files of a folder are told together, as parts of one graph. A file that is not UTF-8 is one row with an error; a null one gives nothing.
    """
    names = ["file", "line", "s", "p", "o", "o_kind", "o_datatype", "o_lang", "error"]
    kinds = [pa.int32() if n == "line" else pa.string() for n in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told() -> Iterator[tuple]:
            for batch in batches:
                for path, content in zip(batch.column("path"), batch.column("content")):
                    path, content = path.as_py(), content.as_py()
                    if content is None:
                        continue
                    try:
                        text = content.decode("utf-8-sig")
                    except UnicodeDecodeError as e:
                        yield (path, None, *[None] * 6, f"not UTF-8: {e.reason}")
                        continue
                    scope = lambda of: "f" + hashlib.sha1(of.encode()).hexdigest()[:12]
                    own = scope(path or "")
                    for row in _File(text, base, own, scope((path or "").rpartition("/")[0]) if together else own).rows():
                        yield (path, *row)

        held: list[tuple] = []
        pack = lambda: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)
        for row in told():
            held.append(row)
            if len(held) == _BATCH:
                yield pack()
                held = []
        if held:
            yield pack()

    return files.select("path", "content").mapInArrow(run, SCHEMA)


def read(spark: SparkSession, path: str, base: str = "", together: bool = False) -> DataFrame:
    return triples(spark.read.format("binaryFile").option("pathGlobFilter", "*.{ttl,txt}").option("recursiveFileLookup", "true").load(path), base, together)


def statements(rows: DataFrame, prefixes: Mapping[str, str]) -> DataFrame:
    """value: statements of s, p, o, o_kind (and o_datatype, o_lang), one a subject; those of a subject with more than a thousand triples are told in several, so that none is long. Rows with a null are left out."""
    has = lambda c: F.col(c) if c in rows.columns else F.lit(None).cast("string")
    given = rows.select("s", "p", "o", "o_kind", has("o_datatype").alias("t"), has("o_lang").alias("l")).filter("s IS NOT NULL AND p IS NOT NULL AND o IS NOT NULL")

    def name(c: Column) -> Column:
        odd = F.array_join(F.transform(F.split(c, ""), lambda x: F.when(x.rlike(_ODD), F.concat(F.lit("\\u"), F.lpad(F.hex(F.ascii(x)), 4, "0"))).otherwise(x)), "")
        out = F.concat(F.lit("<"), F.when(c.rlike(_ODD), odd).otherwise(c), F.lit(">"))
        for prefix, space in prefixes.items():
            local = F.substring(c, F.lit(len(space) + 1), F.char_length(c))
            out = F.when(c.startswith(space) & local.rlike(r"^[A-Za-z_][A-Za-z0-9_]*$"), F.concat(F.lit(prefix + ":"), local)).otherwise(out)
        return out

    text = F.col("o")
    for a, b in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        text = F.replace(text, F.lit(a), F.lit(b))
    literal = F.concat(F.lit('"'), text, F.lit('"'), F.when(F.col("l").isNotNull(), F.concat(F.lit("@"), "l")).when(F.col("t").isNotNull(), F.concat(F.lit("^^"), name(F.col("t")))).otherwise(""))
    subject = F.when(F.col("s").startswith("_:"), F.col("s")).otherwise(name(F.col("s")))
    o = F.when(F.col("o_kind") == "blank", F.col("o")).when(F.col("o_kind") == "iri", name(F.col("o"))).otherwise(literal)
    many = given.groupBy("s").agg(F.count("*").alias("_n")).filter(F.col("_n") > BLOCK)
    dealt = given.join(small(many), "s", "left").withColumn("_k", F.coalesce(F.pmod(F.xxhash64("p", "o"), F.ceil(F.col("_n") / BLOCK)), F.lit(0)))
    said = F.concat_ws(" ", F.when(F.col("p") == _RDF + "type", "a").otherwise(name(F.col("p"))), o)
    told = dealt.select(subject.alias("s"), "_k", said.alias("said")).groupBy("s", "_k").agg(F.array_join(F.array_sort(F.collect_list("said")), " ;\n    ").alias("said"))
    return told.select(F.concat("s", F.lit(" "), "said", F.lit(" .")).alias("value"))


def write(rows: DataFrame, path: str, prefixes: Mapping[str, str]) -> None:
    """statements() as text files, each with the prefixes at its head; to be read together, as blank nodes may be told in several of them."""
    head = "\n".join(f"@prefix {p}: <{space}> ." for p, space in prefixes.items())

    def headed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = True
        for batch in batches:
            if first and batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array([head], pa.string())], schema=batch.schema)
                first = False
            yield batch

    statements(rows, prefixes).mapInArrow(headed, "value string").write.text(path)
