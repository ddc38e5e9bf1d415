"""Normalisers of a column's values: lists, awards, identifiers, terms, dates. Column to Column."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import alias, anchor_href


def _trimmed(parts: Column) -> Column:
    return F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != "")


def keywords(value: Column) -> Column:
    """Parts at ; or, where there is none, at commas."""
    return F.when(value.contains(";"), _trimmed(F.split(value, ";"))).when(value.contains(","), _trimmed(F.split(value, ","))).otherwise(F.array(value))


def funding(value: Column, zero: str | None = "end") -> Column:
    """One award (zero as award() takes it) where OT is in the value, else parts at the first kind of separator found, of | then ; then ,."""
    parts = F.when(value.contains("|"), F.split(value, r"\|")).when(value.contains(";"), F.split(value, ";")).when(value.contains(","), F.split(value, ",")).otherwise(F.array(F.trim(value)))
    return F.when(value.contains("OT"), F.array(award(value, zero))).otherwise(parts)


#: An award that lost a zero, and what is taken out of awards, in this order.
AWARDS = {"1 OT2 OD23853": "OT2OD023853"}
AWARD_STEPS = [("‐", "-"), ("‑", "-"), ("–", "-"), ("(", ""), (")", ""), ("-01S1", ""), ("-01", ""), ("-02S2", ""), ("-02", ""), ("SPARC", ""), ("NIH-1", ""), ("NIH-", ""), ("-", ""), ("NIH ", ""), (" ", "")]


def award(value: Column, zero: str | None = "end") -> Column:
    """The bare number of an award. zero: where D23864 gets back the zero it lost: in an award that ends with it (end), wherever it stands (all), or not at all (None)."""
    if zero not in ("end", "all", None):
        raise ValueError("zero is end, all or None")
    out = alias(value, AWARDS)
    out = F.when(out.contains("OT2") & ~out.contains("OD"), F.replace(out, F.lit("-"), F.lit("-OD"))).otherwise(out)
    out = F.trim(out)
    for old, new in AWARD_STEPS:
        out = F.replace(out, F.lit(old), F.lit(new))
    out = F.regexp_replace(F.regexp_replace(out, "^[135]", ""), "S2$", "")
    if zero is None:
        return out
    mended = F.replace(out, F.lit("D23864"), F.lit("D023864"))
    return mended if zero == "all" else F.when(out.endswith("D23864"), mended).otherwise(out)


#: Other names and misspellings of species and sexes, and the terms of their names.
SPECIES = {
    "cat": "Felis catus", "rat": "Rattus norvegicus", "mouse": "Mus musculus", "sus scrofa domestica": "Sus scrofa domesticus", "ferret": "Mustela putorius furo", "mus muscus": "Mus musculus", "sus scofa": "Sus scrofa",
    "rattus noervegicus domestica": "Rattus norvegicus domestica", "rattus norvegicus domestica": "Rattus norvegicus domestica", "ratus norvegicus": "Rattus norvegicus", "norway rat": "Rattus norvegicus", "norway rats": "Rattus norvegicus",
}
SEXES = {"m": "male", "f": "female"}
SPECIES_TERMS = {
    "canis lupus familiaris": "NCBITaxon:9615", "felis catus": "NCBITaxon:9685", "guinea pig": "NCBITaxon:10141", "homo sapiens": "NCBITaxon:9606", "mus musculus": "NCBITaxon:10090", "mustela putorius furo": "NCBITaxon:9669",
    "rattus norvegicus": "NCBITaxon:10116", "suncus murinus": "NCBITaxon:9378", "sus scrofa": "NCBITaxon:9823", "sus scrofa domesticus": "NCBITaxon:9825", "turdus merula": "NCBITaxon:9187",
}
SEX_TERMS = {"female": "PATO:0000383", "male": "PATO:0000384"}
SUFFIXES = {".jpeg": ".jpg", ".tif": ".tiff"}


def species(value: Column) -> Column:
    return alias(F.lower(value), SPECIES)


def sex(value: Column) -> Column:
    return alias(F.lower(value), SEXES)


def suffix(value: Column) -> Column:
    return alias(F.lower(value), SUFFIXES)


def term(value: Column, terms: Mapping[str, str]) -> Column:
    """struct(term, unmapped): the term of a name in any case, or else the name as it is."""
    table = F.create_map(*(F.lit(x) for pair in terms.items() for x in pair))
    found = F.try_element_at(table, F.lower(value))
    return F.struct(found.alias("term"), F.when(found.isNull(), value).alias("unmapped"))


def _unlinked(value: Column) -> Column:
    return F.when(value.contains("<a "), anchor_href(value)).otherwise(value)


def bare_doi(value: Column) -> Column:
    """doi: and the DOI of an address, a name or a bare DOI; null if there is none."""
    found = F.regexp_extract(value, r"(10\.[0-9]{4,9}/\S+)$", 1)
    return F.when(found != "", F.concat(F.lit("doi:"), F.lower(found)))


def protocols(value: Column) -> Column:
    """Addresses and DOIs of a list at commas: what holds doi or begins with 10. as a DOI (left out if it is none), the rest as it is."""
    one = lambda x: F.when(x.contains("doi") | x.startswith("10."), bare_doi(x)).otherwise(x)
    return F.array_compact(F.transform(_trimmed(F.split(_unlinked(value), ",")), one))


def article_dois(value: Column) -> Column:
    return F.array_compact(F.transform(_trimmed(F.split(_unlinked(value), ",")), bare_doi))


def rrid(value: Column) -> Column:
    """RRID: and the identifier, UNKNOWN for the word (also misspelt), null for what is none."""
    text = F.trim(value)
    full = F.when(text.startswith("RRID:"), text).otherwise(F.concat(F.lit("RRID:"), text))
    return F.when(F.lower(text).isin("unknown", "uknown"), "UNKNOWN").when(full.rlike(r"^RRID:\s*[A-Za-z]+[_:][A-Za-z0-9_:.-]+$"), F.regexp_replace(full, r"^RRID:\s*", "RRID:"))


def id_list(value: Column) -> Column:
    """Identifiers at white space."""
    return F.filter(F.split(F.trim(value), r"\s+"), lambda x: x != "")


def locations(value: Column) -> Column:
    """Parts at | or, where there is none, at ;."""
    return F.when(value.contains("|"), _trimmed(F.split(value, r"\|"))).when(value.contains(";"), _trimmed(F.split(value, ";"))).otherwise(F.array(F.trim(value)))


def label_id(value: Column) -> Column:
    """The id of "label|id"; the value where there is no bar or no id."""
    found = F.trim(F.split_part(value, F.lit("|"), F.lit(2)))
    return F.when(value.contains("|") & (found != ""), found).otherwise(value)


def number_id(value: Column) -> Column:
    """Whole numbers as they are written, without a decimal part."""
    return F.regexp_replace(value.cast("string"), r"^([+-]?[0-9]+)\.0+$", "$1")


def undoubled(value: Column) -> Column:
    """Text without the quotes that were put around it."""
    inner = F.substring(value, F.lit(2), F.char_length(value) - 2)
    return F.when(value.startswith('"') & value.endswith('"') & (F.char_length(value) > 1) & ~inner.contains('"'), inner).otherwise(value)


def related_identifier(relation: Column, kind: Column, value: Column) -> Column:
    """struct(kind, value): typed by kind; a protocol's address or DOI is normalised as such."""
    of_protocol = (relation == "HasProtocol") & kind.isin("URL", "DOI")
    made = F.when(of_protocol, F.get(protocols(value), F.lit(0))).when(kind == "DOI", bare_doi(value)).when(kind == "RRID", rrid(value)).otherwise(value)
    return F.struct(kind.alias("kind"), F.coalesce(made, value).alias("value"))


def dataset_ids(value: Column) -> Column:
    """struct(ids, error): dataset ids at spaces; commas are taken out and reported."""
    parts = F.when(value.contains(" "), id_list(value)).otherwise(F.array(value))
    bare = F.transform(parts, lambda x: F.regexp_replace(F.replace(x, F.lit(","), F.lit("")), "^N:", ""))
    return F.struct(bare.alias("ids"), F.when(value.contains(" ") & value.contains(","), "comma in list").alias("error"))


def date_parts(year: Column, month: Column, day: Column) -> Column:
    """YYYY, YYYY-MM or YYYY-MM-DD, as far as parts are known."""
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    return F.concat_ws("-", year.cast("string"), two(month), F.when(month.isNotNull(), two(day)))


def latest_time(*texts: Column) -> Column:
    """The latest of ISO times, of which some may be missing or malformed; a comma may stand for the point."""
    return F.greatest(*(F.try_to_timestamp(F.replace(t, F.lit(","), F.lit("."))) for t in texts))


def uuid_shards(uuid: Column) -> Column:
    """struct(short, path): the 16 bytes in URL-safe base 64 without padding, and a folder path from its first characters."""
    short = F.rtrim(F.translate(F.base64(F.unhex(F.replace(uuid, F.lit("-"), F.lit("")))), "+/", "-_"), F.lit("="))
    return F.struct(short.alias("short"), F.concat_ws("/", F.substring(short, 1, 2), F.substring(short, 3, 2), short).alias("path"))


#: The size above which contents are not compared, a fixed value.
CHECKSUM_LIMIT = 2 * 1024**2


def same_content(size: Column, a: Column, b: Column, always: bool = False) -> Column:
    """Whether two contents agree; null where they are too large to be read."""
    same = F.sha2(a, 256) == F.sha2(b, 256)
    return same if always else F.when(size < CHECKSUM_LIMIT, same)


_ID = "[A-Za-z0-9]([A-Za-z0-9-]*[A-Za-z0-9])?$"
_DAY, _TIME = "[0-9]{4}-[0-1][0-9]-[0-3][0-9]", "T[0-2][0-9]:[0-6][0-9](:[0-6][0-9](,[0-9]{1,9})?)?(Z|[+-][0-2][0-9]:[0-6][0-9])"
#: The patterns of identifiers, names, dates and addresses.
PATTERNS = {
    "entity": f"^(pop-)?(sub|sam|site|perf)-{_ID}", "specimen": f"^(pop-)?(sub|sam)-{_ID}", "subject": f"^(pop-)?sub-{_ID}", "sample": f"^(pop-)?sam-{_ID}", "site": f"^(pop-)?site-{_ID}", "performance": f"^(pop-)?perf-{_ID}",
    "pool": "^pop-(sub|sam|site|perf)", "entity_prefix": "^(pop-)?(sub|sam|site|perf)[-_]", "safe_id": r"^[A-Za-z0-9][^ \n\t*|:\\/<>'\"?]+$", "path_chars": "^[A-Za-z0-9.,-_]([A-Za-z0-9.,-_ ]*[A-Za-z0-9.,-_])?$",
    "time": f"^{_DAY}{_TIME}$", "date": f"^{_DAY}$", "date_or_time": f"^{_DAY}({_TIME})?$", "doi": r"^https?://(dx\.)?doi\.org/10\.[0-9]{4,9}/\S+$", "orcid": r"^https://orcid\.org/[0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{3}[0-9X]$",
    "ror": r"^https://ror\.org/0[0-9a-z]{6}[0-9]{2}$", "award": "^(OT2OD|OT3OD|U18|TR|U01)", "contributor_name": "^((([Vv](an|on))|[Dd][ia]|([Dd]e( [Ll]os)?)) )?[^, ]+, [^,]+$", "url": r"^(https?)://([^\s/]+)/([^\s]*)", "formula": "^=",
    "outer_space": r"^\s|\s$", "inner_spaces": r"\s{2,}",
}


def matches(value: Column, name: str) -> Column:
    return value.rlike(PATTERNS[name])


def tidy(value: Column, formula: bool = False) -> Column:
    """No white space at the ends nor several in a row; no formula unless allowed."""
    bad = matches(value, "outer_space") | matches(value, "inner_spaces")
    return ~bad if formula else ~(bad | matches(value, "formula"))


def path_part_ok(value: Column, version: int = 3) -> Column:
    """Parts of a path: what begins like an entity must be a well-formed one; from version 3 on, only some characters."""
    entity = matches(value, "entity") | ~matches(value, "entity_prefix")
    return (matches(value, "path_chars") & ~matches(value, "inner_spaces") if version > 2 else tidy(value, formula=True)) & entity
