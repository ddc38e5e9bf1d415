"""Instruments' XML files as rows: the dialect of each, and what it tells, pulled from the text element by element; condensed by what a schema lets be a list, and told once."""

from __future__ import annotations

import io
from collections.abc import Collection, Iterator
from xml.etree import ElementTree as X

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Dialects by root element (with its namespace in braces), and their media types.
ROOTS = {
    "{http://www.mbfbioscience.com}mbf": "mbf",
    "{http://www.mbfbioscience.com/2007/neurolucida}mbf": "mbf",
    "{https://www.mbfbioscience.com/filespecification}mbf": "mbf",
    "mbf": "mbf",
    "CellCounter_Marker_File": "zen",
    "Data": "las",
    "SampleTable": "hystar-sample",
    "method": "hystar-submethods",
    "{https://www.bruker.com/compass/metadata}Metadata": "nanoelute",
    "PVScan": "pvscan",
    "VRecSessionEntry": "vrecsessionentry",
    "Experiment": "experiment",
    "METADATA": "zisrawsubblock",
    "{urn:schemas-microsoft-com:office:spreadsheet}Workbook": "excel",
    "Store": "keyence",
    "IntanRHX": "intan",
}
MEDIA = {
    "mbf": "application/x.vnd.mbfbioscience.metadata+xml",
    "zen": "application/x.vnd.unknown.zen+xml",
    "las": "application/x.vnd.leica.las+xml",
    "hystar-sample": "application/x.vnd.hystar.sample+xml",
    "hystar-submethods": "application/x.vnd.hystar.submethods+xml",
    "nanoelute": "application/x.vnd.bruker.nanoelute+xml",
    "pvscan": "application/x.vnd.bruker.pvscan+xml",
    "vrecsessionentry": "application/x.vnd.bruker.vrecsessionentry+xml",
    "experiment": "application/x.vnd.bruker.experiment+xml",
    "zisrawsubblock": "application/x.vnd.zeiss.czi.ZISRAWSUBBLOCK.METADATA+xml",
    "excel": "application/vnd.ms-excel+xml",
    "keyence": "application/x.vnd.keyence.metadata+xml",
}
#: Dialects that an attribute has to confirm: path under the root, attribute, and the test.
CONFIRMED = {
    "las": ("Image/Attachment", "Application", lambda v: v == "LAS AF"),
    "hystar-sample": ("SampleTableHeader", "HyStarVersion", lambda v: True),
    "hystar-submethods": ("submethods/submethod", "program", lambda v: v in ("HyStar_LC", "HyStar_Autosampler")),
    "keyence": ("", "Type", lambda v: v.startswith("Keyence.")),
}
#: Sections of which each different item is told once, and fields that stay lists when they hold one value.
TOLD_ONCE = ("contours", "trees", "vessels")
LISTS = ("path_mbf", "path_zen", "path_las")
#: Elements of a tracing whose attributes are told, as field and attribute.
_ONE = {"subject": {"id": "subjectid", "species": "species", "sex": "sex", "age": "age"}, "atlas": {"organ": "organ", "atlas_label": "label", "atlas_rootid": "rootid"}}
_MANY = {
    "contour": ("contours", {"name": "name"}, {"guid": "GUID", "id_ontology": "TraceAssociation"}),
    "tree": ("trees", {"entity_type": "type", "leaf": "leaf"}, {}),
    "vessel": ("vessels", {"entity_type": "type"}, {"channel": "Channel"}),
}
SCHEMA = "file string, dialect string, media string, section string, n long, fields map<string, array<string>>, error string"
_BATCH = 4096


def _attributes(e: X.Element, names: dict[str, str]) -> dict[str, list]:
    return {k: [e.get(a)] if e.get(a) is not None else [] for k, a in names.items()}


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def _texts(e: X.Element, path: tuple[str, ...]) -> list[str]:
    """Texts of the elements at a path of local names."""
    here = [e]
    for name in path:
        here = [c for x in here for c in x if _local(c.tag) == name]
    return [c.text for c in here if c.text]


def _tells(dialect: str, way: list[str], e: X.Element) -> tuple[str, dict] | list | None:
    """(section, fields) of an element that has ended, way being the local names from the root's child to it."""
    if dialect == "mbf":
        if len(way) == 1 and way[0] in _MANY:
            section, own, properties = _MANY[way[0]]
            held = {p.get("name"): p for p in e if _local(p.tag) == "property"}
            return section, _attributes(e, own) | {k: _texts(held[name], ("s",)) if name in held else [] for k, name in properties.items()}
        if len(way) == 2 and way[0] == "sparcdata" and way[1] in _ONE:
            return way[1], _attributes(e, _ONE[way[1]])
        if way == ["images", "image"]:
            return "images", {"path_mbf": _texts(e, ("filename",)), "channels": [c.get("id") for h in e if _local(h.tag) == "channels" for c in h if _local(c.tag) == "channel" and c.get("id")]}
        if way == ["images", "image", "channels", "channel"]:
            return "channels", _attributes(e, {"id": "id", "source": "source"})
    if dialect == "zen" and way == ["Image_Properties"]:
        return "images", {"path_zen": _texts(e, ("Image_Filename",))}
    if dialect == "las" and way == ["ImageDescription"]:
        return "images", {"path_las": _texts(e, ("FileLocation",))}
    if dialect == "intan" and way in (["GeneralConfig"], ["SignalGroup"], ["SignalGroup", "Channel"]):
        return way[-1], {k: [v] for k, v in e.items()}
    return None


#: Elements that are needed when what they lie in ends; all others are let go at once.
_HELD = {("contour", "property"), ("vessel", "property"), ("images", "image"), ("Image_Properties", "Image_Filename"), ("ImageDescription", "FileLocation")}


def _pulled(content: bytes) -> Iterator[tuple]:
    """(dialect, section, n, fields) of a file, then (dialect, None, None, None). Of the elements only open ones, and small ones of the item in hand, are in memory."""
    open_, dialect, confirmed, n, wait = [], "generic", True, 0, []
    for event, e in X.iterparse(io.BytesIO(content), events=("start", "end")):
        if event == "start":
            if not open_:
                dialect = ROOTS.get(e.tag, "generic")
                confirmed = dialect not in CONFIRMED
            open_.append(e)
            way = [_local(x.tag) for x in open_[1:]]
            if not confirmed:
                path, attribute, test = CONFIRMED[dialect]
                confirmed = "/".join(way) == path and e.get(attribute) is not None and test(e.get(attribute))
            if dialect == "mbf" and len(open_) == 1:
                yield dialect, "meta", 0, _attributes(e, {k: k for k in ("appname", "appversion", "apprrid", "insrrid")})
            continue
        way = [_local(x.tag) for x in open_[1:]]
        open_.pop()
        found = _tells(dialect, way, e)
        if found is not None:
            n += 1
            if confirmed:
                yield from wait
                wait = []
                yield dialect, found[0], n, found[1]
            else:
                wait.append((dialect, found[0], n, found[1]))
        if open_ and (len(way) == 1 or tuple(way[:2]) not in _HELD):
            open_[-1].remove(e)
    if confirmed:
        yield from wait
    yield dialect if confirmed else "generic", None, None, None


def items(files: DataFrame) -> DataFrame:
    """file, dialect, media, section, n, fields (each a list of texts, empty where absent), error, of files (path, content).

    A row for each item that a file tells, and one without a section for the file itself. A file is read in one task and handed on in batches, however many items it has. A file that is no XML ends
    with a row with an error; what it told before the fault stays, and condensed() leaves it out. A null content gives nothing.
    """
    names = ["file", "dialect", "media", "section", "n", "fields", "error"]
    text = pa.string()
    kinds = [text, text, text, text, pa.int64(), pa.map_(text, pa.list_(text)), text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told() -> Iterator[tuple]:
            for batch in batches:
                for path, content in zip(batch.column("path"), batch.column("content")):
                    path, content = path.as_py(), content.as_py()
                    if content is None:
                        continue
                    try:
                        for dialect, section, n, fields in _pulled(content):
                            yield path, dialect, MEDIA.get(dialect), section, n, None if fields is None else list(fields.items()), None
                    except (X.ParseError, ValueError, LookupError) as e:
                        yield path, None, None, None, None, None, f"not XML: {e}"

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


def _json(text: Column) -> Column:
    whole = F.to_json(F.array(text))
    return F.substring(whole, F.lit(2), F.char_length(whole) - 2)


def condensed(rows: DataFrame, lists: Collection[str] = LISTS, drop: Collection[str] = ("guid",)) -> DataFrame:
    """file, section, item (JSON, keys sorted), of items() of files without an error.

    Fields without a value go; a list of one value becomes that value unless the field is in lists, and longer ones stay. Sections of one item that tell nothing go. Contours, trees and vessels lose
    the fields in drop, and of equal ones in a file one is told.
    """
    faults = rows.filter("error IS NOT NULL").select("file").distinct()
    given = rows.filter("section IS NOT NULL").join(faults, "file", "left_anti")
    once = F.col("section").isin(*TOLD_ONCE)
    fields = F.map_filter("fields", lambda k, v: ((F.size(v) > 0) | k.isin(*lists)) & ~(once & k.isin(*drop)))
    value = lambda k, v: F.when((F.size(v) == 1) & ~k.isin(*lists), _json(v[0])).otherwise(F.to_json(v))
    told = F.transform(F.array_sort(F.map_entries(fields)), lambda e: F.concat(_json(e["key"]), F.lit(":"), value(e["key"], e["value"])))
    out = given.select("file", "section", F.concat(F.lit("{"), F.array_join(told, ","), F.lit("}")).alias("item"))
    out = out.filter(~(F.col("section").isin("meta", *_ONE) & (F.col("item") == "{}")))
    return out.filter(~F.col("section").isin(*TOLD_ONCE)).unionByName(out.filter(F.col("section").isin(*TOLD_ONCE)).distinct())
