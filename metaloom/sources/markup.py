"""XML metadata by dialect, and triples from N-Triples text."""

from __future__ import annotations

from collections.abc import Iterator
from xml.etree import ElementTree as X

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The dialects, by root element and, where given, an attribute that it must have with that beginning.
DIALECTS = [
    ("mbf", "mbf", None, None), ("neurolucida", "data", None, None), ("leica", "LMSDataContainerHeader", None, None), ("volume", "volumerendering", None, None),
    ("zen", "ImageDocument", None, None), ("cgw", "CGW", None, None), ("ome", "OME", None, None), ("imagej", "IJ", None, None), ("svg", "svg", None, None),
]
META = "subject struct<id: string, species: string, sex: string, age: string>, atlas struct<organ: string, label: string, rootid: string>, images array<string>, contours array<string>"


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def dialect(root: X.Element) -> str:
    """The dialect of a document, or generic."""
    for name, tag, attribute, begin in DIALECTS:
        if _local(root.tag) == tag and (attribute is None or root.get(attribute, "").startswith(begin)):
            return name
    return "generic"


def mbf(root: X.Element) -> dict:
    """What a tracing document tells; contours are distinct, without their ids."""
    find = lambda tag: next((e for e in root.iter() if _local(e.tag) == tag), None)
    of = lambda e, names: {k: (e.get(a) or None) if e is not None else None for k, a in names.items()}
    return {
        "subject": of(find("subject"), {"id": "subjectid", "species": "species", "sex": "sex", "age": "age"}),
        "atlas": of(find("atlas"), {"organ": "organ", "label": "label", "rootid": "rootid"}),
        "images": [e.text for e in root.iter() if _local(e.tag) == "filename" and e.text],
        "contours": sorted({e.get("name") for e in root if _local(e.tag) == "contour" and e.get("name")}),
    }


def read_xml(spark: SparkSession, path: str) -> DataFrame:
    return xml_metadata(spark.read.format("binaryFile").option("pathGlobFilter", "*.xml").option("recursiveFileLookup", "true").load(path))


def xml_metadata(files: DataFrame) -> DataFrame:
    """file, dialect, meta (of the mbf dialect), error, of files (path, content). Each file is parsed by itself, and one that is no XML is a row with an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for content in batch.column("content"):
                try:
                    root = X.fromstring(content.as_py())
                    name = dialect(root)
                    rows.append((name, mbf(root) if name == "mbf" else None, None))
                except (X.ParseError, ValueError, LookupError) as e:
                    rows.append((None, None, f"not XML: {e}"))
            names, metas, errors = zip(*rows) if rows else ((), (), ())
            text, texts = pa.string(), pa.list_(pa.string())
            kind = pa.struct([("subject", pa.struct([(k, text) for k in ("id", "species", "sex", "age")])), ("atlas", pa.struct([(k, text) for k in ("organ", "label", "rootid")])), ("images", texts), ("contours", texts)])
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(names, text), pa.array(metas, kind), pa.array(errors, text)], ["file", "dialect", "meta", "error"])

    schema = "file string, dialect string, meta struct<" + META.replace(" struct", ": struct").replace("images array", "images: array").replace("contours array", "contours: array") + ">, error string"
    return files.select("path", "content").mapInArrow(run, schema)


_TERM = r'(?:<([^>]*)>|(_:\S+)|"((?:[^"\\]|\\.)*)"(?:\^\^<([^>]*)>|@([A-Za-z0-9-]+))?)'


def parse_ntriples(lines: DataFrame, column: str = "value") -> DataFrame:
    """s, p, o, o_kind (iri, blank or literal), o_datatype, o_lang: a row for each line that is a triple; comments are left out."""
    pattern = rf"^\s*(<[^>]*>|_:\S+)\s+<([^>]*)>\s+{_TERM}\s*\.\s*(?:#.*)?$"
    part = lambda k: F.regexp_extract(column, pattern, k)
    text = lambda k: F.when(part(k) != "", part(k))
    value = F.replace(F.replace(F.replace(F.replace(part(5), F.lit("\\n"), F.lit("\n")), F.lit("\\t"), F.lit("\t")), F.lit('\\"'), F.lit('"')), F.lit("\\\\"), F.lit("\\"))
    kind = F.when(part(3) != "", "iri").when(part(4) != "", "blank").otherwise("literal")
    o = F.when(kind == "iri", part(3)).when(kind == "blank", part(4)).otherwise(value)
    return lines.filter(F.col(column).rlike(pattern)).select(F.regexp_replace(part(1), "^<|>$", "").alias("s"), part(2).alias("p"), o.alias("o"), kind.alias("o_kind"), text(6).alias("o_datatype"), text(7).alias("o_lang"))


def read_ntriples(spark: SparkSession, path: str) -> DataFrame:
    return parse_ntriples(spark.read.text(path))
