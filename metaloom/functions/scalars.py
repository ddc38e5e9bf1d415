"""Scalar normalisers: Column to Column, inside code generation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What stands for "not applicable".
NA_WORDS = ("NA", "n/a", "N/A", "none", "None", "no protocols", "na")


def split_name(name: Column) -> Column:
    """struct(last, first): "Last, First", "Last,First" or "First Last"; null where no separator is found."""
    comma = F.split(name, r",\s*", 2)
    space = F.split(name, " ", 2)
    return F.when(name.contains(","), F.struct(F.get(comma, F.lit(0)).alias("last"), F.get(comma, F.lit(1)).alias("first"))).when(
        name.contains(" "), F.struct(F.get(space, F.lit(1)).alias("last"), F.get(space, F.lit(0)).alias("first"))
    )


def multi_split(value: Column) -> Column:
    """Distinct trimmed parts in order, cut at the first kind of separator found, of | then ; then ,."""
    parts = F.when(value.contains("|"), F.split(value, r"\|")).when(value.contains(";"), F.split(value, ";")).otherwise(F.split(value, ","))
    return F.array_sort(F.array_distinct(F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != "")))


def alias(value: Column, names: Mapping[str, str]) -> Column:
    """The mapped name, or the value itself."""
    table = F.create_map(*(F.lit(x) for pair in names.items() for x in pair))
    return F.coalesce(F.try_element_at(table, value), value)


def drop_na(value: Column) -> Column:
    return F.when(~F.trim(value).isin(*NA_WORDS), value)


def replace_in_order(value: Column, steps: Sequence[tuple[str, str]]) -> Column:
    """Regular expressions and their replacements, one after another: later ones see what earlier ones made."""
    for pattern, text in steps:
        value = F.regexp_replace(value, pattern, text)
    return value


def try_int(value: Column) -> Column:
    """struct(value, original): the number, or null and the text as it was."""
    number = F.trim(value).try_cast("bigint")
    return F.struct(number.alias("value"), F.when(number.isNull(), value).alias("original"))


def yes_no(value: Column) -> Column:
    word = F.lower(F.trim(value))
    return F.when(word.isin("yes", "true"), True).when(word.isin("no", "false"), False)


def orcid_valid(value: Column) -> Column:
    """Whether the digits of an ORCID, with or without prefix and dashes, have the right ISO 7064 mod 11-2 check character."""
    digits = F.replace(F.regexp_extract(F.replace(value, F.lit(" "), F.lit("")), r"([0-9]{4}-?[0-9]{4}-?[0-9]{4}-?[0-9]{3}[0-9X])$", 1), F.lit("-"), F.lit(""))
    total = F.aggregate(F.split(F.substring(digits, 1, 15), ""), F.lit(0), lambda a, c: F.when(c == "", a).otherwise((a + F.coalesce(c.try_cast("int"), F.lit(0))) * 2))
    check = (F.lit(12) - total % 11) % 11
    return (F.char_length(digits) == 16) & (F.when(check == 10, "X").otherwise(check.cast("string")) == F.substring(digits, 16, 1))


#: Units, with the factor to their base unit and the base unit.
UNITS = {"year": (365.25, "day"), "month": (30.4375, "day"), "week": (7.0, "day"), "day": (1.0, "day"), "kg": (1000.0, "g"), "g": (1.0, "g"), "mg": (0.001, "g"), "cm": (0.01, "m"), "mm": (0.001, "m"), "m": (1.0, "m"), "in": (0.0254, "m")}
UNIT_NAMES = {"years": "year", "yr": "year", "y": "year", "months": "month", "weeks": "week", "wk": "week", "days": "day", "d": "day", "kilogram": "kg", "gram": "g", "inches": "in", "inch": "in"}


def quantity(value: Column) -> Column:
    """struct(kind, value, unit, lo, hi): numbers, ranges ("3-5 weeks") and approximations ("~3 weeks") with units; null if it is none of these."""
    number = r"([+-]?[0-9]+(?:\.[0-9]+)?)"
    unit = r"\s*([A-Za-z]*)\s*$"
    text = F.trim(value)
    about, between, plain = rf"^~\s*{number}{unit}", rf"^{number}\s*(?:-|to)\s*{number}{unit}", rf"^{number}{unit}"
    part = lambda pattern, k: F.regexp_extract(text, pattern, k)
    named = lambda x: F.when(x == "", "dimensionless").otherwise(alias(F.lower(x), UNIT_NAMES))
    none = F.lit(None).cast("double")

    def made(kind: str, v: Column, u: Column, lo: Column = none, hi: Column = none) -> Column:
        return F.struct(F.lit(kind).alias("kind"), v.alias("value"), named(u).alias("unit"), lo.alias("lo"), hi.alias("hi"))

    return (
        F.when(text.rlike(plain), made("quantity", part(plain, 1).try_cast("double"), part(plain, 2)))
        .when(text.rlike(between), made("range", none, part(between, 3), part(between, 1).try_cast("double"), part(between, 2).try_cast("double")))
        .when(text.rlike(about), made("approximate", part(about, 1).try_cast("double"), part(about, 2)))
    )


def to_base(value: Column, unit: Column) -> Column:
    """struct(value, unit) in the base unit; as it is where the unit is unknown."""
    factors = F.create_map(*(F.lit(x) for k, (f, _) in UNITS.items() for x in (k, f)))
    return F.struct((value * F.coalesce(F.try_element_at(factors, unit), F.lit(1.0))).alias("value"), alias(unit, {k: b for k, (_, b) in UNITS.items()}).alias("unit"))


def url_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)", 1))


def anchor_href(html: Column) -> Column:
    """The address of the first link."""
    return F.regexp_extract(html, r'<a\s[^>]*href="([^"]*)"', 1)


def html_text(html: Column) -> Column:
    """Text without scripts, styles, comments and tags, runs of white space as one space."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->|<[^>]*>", " ")
    return F.trim(F.regexp_replace(bare, r"\s+", " "))


def clean_text(value: Column) -> Column:
    """For reports: line feeds, tabs and no-break spaces to spaces, trimmed, lower case, without addresses."""
    return F.lower(F.trim(F.regexp_replace(F.translate(value, "\n\t\u00a0", "   "), r"https?://\S+", "")))


def curie_expand(value: Column, prefixes: Mapping[str, str]) -> Column:
    base = F.create_map(*(F.lit(x) for pair in prefixes.items() for x in pair))
    return F.coalesce(F.concat(F.try_element_at(base, F.split_part(value, F.lit(":"), F.lit(1))), F.substring(value, F.locate(":", value) + 1, F.char_length(value))), value)


def curie_contract(value: Column, prefixes: Mapping[str, str]) -> Column:
    """By the longest base address that value begins with."""
    out = value
    for name, base in sorted(prefixes.items(), key=lambda x: len(x[1])):
        out = F.when(value.startswith(base), F.concat(F.lit(f"{name}:"), F.substring(value, F.lit(len(base) + 1), F.char_length(value)))).otherwise(out)
    return out


def url_quote(value: Column) -> Column:
    return F.replace(F.url_encode(value), F.lit("+"), F.lit("%20"))


def truncate_bytes(value: Column, n: int) -> Column:
    """The longest beginning of at most n bytes of UTF-8 that breaks no character."""
    data = value.cast("binary")
    # at a byte that continues a character (80 to BF) no cut may be made; a character has four bytes at most
    inside = lambda k: F.hex(F.substring(data, k + 1, 1)).between("80", "BF")
    size = F.lit(max(n - 3, 0))
    for k in range(max(n - 2, 0), n + 1):
        size = F.when(inside(k), size).otherwise(k)
    return F.when(F.octet_length(value) <= n, value).otherwise(F.decode(F.substring(data, F.lit(1), size), "UTF-8"))


def number_set_similarity(a: Column, b: Column) -> Column:
    """1 - sum of logs of the numbers that both texts have, over that of a's own; 0 where a has none above 1."""
    numbers = lambda x: F.array_distinct(F.transform(F.regexp_extract_all(x, F.lit("[0-9]+"), F.lit(0)), lambda n: F.ltrim(n, F.lit("0"))))
    logs = lambda x: F.aggregate(F.array_sort(x), F.lit(0.0), lambda s, n: s + F.when(n != "", F.ln(n.cast("double"))).otherwise(0.0))
    own = logs(numbers(a))
    return F.when(own == 0, 0.0).otherwise(1 - logs(F.array_intersect(numbers(a), numbers(b))) / own)
