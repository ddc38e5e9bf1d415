"""Values of cells, normalised by their column's name; what can't be normalised is kept and reported with its cell's address.

A normaliser takes a column of text and gives struct(values: array of text, errors: array of struct(message, blame)).
Several are compiled into one projection over cells, so sheets of any kind and size cost one pass. A value that is no good
stays as it is beside its error, unless a list can do without it; nothing vanishes without an error but what stands for
"not applicable".
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import normalise as N
from ..functions.scalars import NA_WORDS, quantity, try_int
from .schemas import let

Normaliser = Callable[[Column], Column]
_RESULT = "struct<values:array<string>,errors:array<struct<message:string,blame:string>>>"


def _error(when: Column, message: Column, blame: str = "submission") -> Column:
    return F.when(F.coalesce(when, F.lit(False)), F.struct(message.alias("message"), F.lit(blame).alias("blame")))


def result(values: Column, *errors: Column) -> Column:
    """What a normaliser gives; errors that are null don't count."""
    found = F.array_compact(F.array(*errors)) if errors else F.array()
    return F.struct(values.alias("values"), found.alias("errors")).cast(_RESULT)


def result_of_parts(parts: Column, one: Callable[[Column], Column], message: str, keep: bool, blame: str = "submission") -> Column:
    """Each of a list's parts made into another by one; a part of which one makes null is an error, and stays if keep."""
    made = F.transform(parts, lambda x: F.struct(x.alias("was"), one(x).alias("now")))
    good = made if keep else F.filter(made, lambda p: p["now"].isNotNull())
    bad = F.filter(made, lambda p: p["now"].isNull())
    errors = F.transform(bad, lambda p: F.struct(F.concat(F.lit(f"{message}: "), p["was"]).alias("message"), F.lit(blame).alias("blame")))
    return F.struct(F.transform(good, lambda p: F.coalesce(p["now"], p["was"])).alias("values"), errors.alias("errors")).cast(_RESULT)


def plain(value: Column) -> Column:
    return result(F.array(value))


def _listed(f: Callable[[Column], Column]) -> Normaliser:
    return lambda value: result(f(value))


def _one(f: Callable[[Column], Column]) -> Normaliser:
    return lambda value: result(F.array(f(value)))


def _split(value: Column) -> Column:
    """Trimmed parts at the first kind of separator found, of | then ; then ,."""
    parts = F.when(value.contains("|"), F.split(value, r"\|")).when(value.contains(";"), F.split(value, ";")).otherwise(F.split(value, ","))
    return F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != "")


def whole_number(value: Column) -> Column:
    number = try_int(value)["value"]
    return result(F.array(F.coalesce(number.cast("string"), value)), _error(number.isNull(), F.concat(F.lit("not a whole number: "), value)))


#: The roles of contributors.
ROLES = (
    "ContactPerson", "Creator", "DataCollector", "DataCurator", "DataManager", "Distributor", "Editor", "HostingInstitution", "PrincipalInvestigator", "CoInvestigator", "Producer", "ProjectLeader", "ProjectManager", "ProjectMember",
    "RegistrationAgency", "RegistrationAuthority", "RelatedPerson", "Researcher", "ResearchGroup", "RightsHolder", "Sponsor", "Supervisor", "WorkPackageLeader", "Other", "CorrespondingAuthor",
)


def roles(value: Column) -> Column:
    """Roles in any case, with or without spaces and hyphens; distinct and sorted."""
    table = F.create_map(*(F.lit(x) for r in ROLES for x in (r.lower(), r)))
    made = result_of_parts(_split(value), lambda x: F.try_element_at(table, F.lower(F.regexp_replace(x, "[ -]", ""))), "unknown role", keep=True)
    return F.struct(F.array_sort(F.array_distinct(made["values"])).alias("values"), made["errors"].alias("errors"))


def yes(value: Column) -> Column:
    return result(F.array((F.lower(value) == "yes").cast("string")))


def _comma_parts(value: Column) -> Column:
    return F.filter(F.transform(F.split(N._unlinked(value), ","), lambda x: F.trim(x)), lambda x: x != "")


def protocols(value: Column) -> Column:
    """Addresses and DOIs of a list at commas; what should be a DOI and is none is left out and reported."""
    return result_of_parts(_comma_parts(value), lambda x: F.when(x.contains("doi") | x.startswith("10."), N.bare_doi(x)).otherwise(x), "malformed DOI", keep=False)


def article_dois(value: Column) -> Column:
    return result_of_parts(_comma_parts(value), N.bare_doi, "malformed DOI", keep=False)


def rrid(value: Column) -> Column:
    made = N.rrid(value)
    return result(F.array(F.coalesce(made, value)), _error(made.isNull(), F.concat(F.lit("malformed RRID: "), value)))


def orcid(value: Column) -> Column:
    from ..functions.scalars import orcid_valid

    bare = F.regexp_replace(N._unlinked(value), r"\s", "")
    return result(F.array(bare), _error(~orcid_valid(bare), F.concat(F.lit("malformed ORCID: "), value)))


def datasets(value: Column) -> Column:
    made = N.dataset_ids(value)
    return result(made["ids"], _error(made["error"].isNotNull(), F.concat(F.lit("comma in list: "), value)))


_UNKNOWN = ("unknown", "uknown")


def measured(unit: str = "", misplaced: Sequence[str] = (), instead: str = "") -> Normaliser:
    """A quantity, written as number and unit (ranges as lo-hi unit); unit is that of a bare number. misplaced: words that belong in another column, instead."""

    def f(value: Column) -> Column:
        return let(quantity(F.concat(value, F.lit(unit)) if unit else value), lambda q: told(value, q))

    def told(value: Column, q: Column) -> Column:
        number = lambda x: F.regexp_replace(x.cast("string"), r"\.0$", "")
        text = F.when(q["kind"] == "range", F.concat(number(q["lo"]), F.lit("-"), number(q["hi"]))).otherwise(F.concat(F.when(q["kind"] == "approximate", "~").otherwise(""), number(q["value"])))
        made = F.when(q["kind"].isNotNull(), F.concat_ws(" ", text, F.when(q["unit"] != "dimensionless", q["unit"])))
        unknown, elsewhere = F.lower(F.trim(value)).isin(*_UNKNOWN), value.isin(*misplaced) if misplaced else F.lit(False)
        out = F.when(unknown, "UNKNOWN").otherwise(F.coalesce(made, value))
        # a column with a unit of its own takes the word for granted; a quantity reports it
        bad = made.isNull() & ~elsewhere & (~unknown if unit else F.lit(True))
        return result(F.array(out), _error(elsewhere, F.concat(F.lit("value belongs in "), F.lit(instead), F.lit(": "), value)), _error(bad, F.concat(F.lit("no quantity: "), value), "pipeline"))

    return f


def _strain(value: Column) -> Column:
    return F.when(value == "DSH", "domestic shorthair").otherwise(value)


_AGE = measured(misplaced=("adult",), instead="age_category")
_RANGE_MAX = measured(misplaced=("Normal",), instead="age_category")
_SUBJECTS: dict[str, Normaliser] = {
    "protocol_url_or_doi": protocols, "also_in_dataset": datasets, "software_url": _one(N._unlinked), "software_rrid": rrid, "species": _one(N.species), "strain": _one(_strain), "sex": _one(N.sex), "gender": _one(N.sex), "age": _AGE,
    "age_years": measured("years"), "age_range_min": measured(), "age_range_max": _RANGE_MAX, "age_range_max_disease": _RANGE_MAX, "mass": measured(), "body_mass": measured(), "weight": measured(), "weight_kg": measured("kg"),
    "height_inches": measured("in"), "rrid_for_strain": rrid,
}
#: Each kind of sheet's columns that have a normaliser; all others are taken as they are.
KINDS: dict[str, dict[str, Normaliser]] = {
    "submission": {"sparc_award_number": _one(N.award)},
    "dataset_description": {
        "additional_links": _one(N._unlinked), "number_of_subjects": whole_number, "number_of_samples": whole_number, "number_of_sites": whole_number, "number_of_performances": whole_number, "funding": _listed(N.funding),
        "contributor_affiliation": _one(N._unlinked), "contributor_orcid": orcid, "contributor_role": roles, "is_contact_person": yes, "protocol_url_or_doi": protocols, "originating_article_doi": article_dois, "keywords": _listed(N.keywords),
    },
    "code_description": {"number_of_inputs": whole_number, "number_of_outputs": whole_number},
    "subjects": _SUBJECTS,
    "samples": _SUBJECTS | {"specimen_anatomical_location": _listed(N.locations), "was_derived_from": _listed(N.id_list)},
    "performances": _SUBJECTS | {c: _listed(N.id_list) for c in ("specimen", "participants", "subject", "sample", "site")},
    "manifest": {c: _listed(N.id_list) for c in ("entity", "specimen", "subject", "sample", "site")},
    "curation": {"organ": _one(N.label_id)},
}
#: The columns and rows of each kind that are left out, and the helper columns that hold records' keys.
IGNORED_COLUMNS: dict[str, tuple[str, ...]] = {"curation": ("metadata_element",)}
IGNORED_ROWS: dict[str, tuple[str, ...]] = {"curation": ("controlled_fields", "curator_notes"), "subjects": ("additional_fields_e_g__minds",), "samples": ("additional_fields_e_g__minds",), "performances": ("additional_fields_e_g__minds",)}


def drop_ignored(cells: DataFrame, columns: Sequence[str] = (), rows: Sequence[str] = ()) -> DataFrame:
    """cells (with name and row_name) without those of ignored columns and rows."""
    kept = cells.filter(~F.coalesce(F.col("name").isin(*columns), F.lit(False))) if columns else cells
    return kept.filter(~F.coalesce(F.col("row_name").isin(*rows), F.lit(False))) if rows else kept


def cleaned(cells: DataFrame) -> DataFrame:
    """cells without those that are empty, or stand for "not applicable"."""
    return cells.filter((F.col("value") != "") & ~F.trim("value").isin(*NA_WORDS))


def compiled(columns: Mapping[str, Normaliser], name: Column, value: Column) -> Column:
    """One expression for all columns: a value's normaliser is chosen by its column's name, the same normaliser's names together."""
    names: dict[Normaliser, list[str]] = {}
    for column, f in columns.items():
        names.setdefault(f, []).append(column)
    return reduce(lambda out, p: F.when(name.isin(*p[1]), p[0](value)).otherwise(out), names.items(), plain(value))


def normalised(cells: DataFrame, kind: str, transposed: bool = False) -> DataFrame:
    """file, row, col, name, row_name, values, errors: cells below the header that are worth a value. cells: file, row, col, value, name (of the column), original (its header as written), row_name, row_original.

    errors: struct(message, blame, stage, file, row, col, row_name, col_name, text): text is what a reader is told, with the address R<row>C<col> in the sheet as it lies,
    also where it was transposed to be read.
    """
    body = cleaned(drop_ignored(cells.filter("row > 0"), IGNORED_COLUMNS.get(kind, ()), IGNORED_ROWS.get(kind, ())))
    made = body.withColumn("_r", compiled(KINDS[kind], F.col("name"), F.col("value")))
    r, c, rn, cn = F.col("row") + 1, F.col("col").cast("bigint") + 1, F.col("row_original"), F.col("original")
    if transposed:
        r, c, rn, cn = c, r, cn, rn
    stage = F.concat(F.lit(f"{kind}."), F.col("name"))

    def addressed(e: Column) -> Column:
        text = F.concat(F.lit("Problem with tabular cell :at R"), r.cast("string"), F.lit("C"), c.cast("string"), F.lit(' "'), F.coalesce(rn, F.lit("")), F.lit('" "'), F.coalesce(cn, F.lit("")), F.lit('" :issue '), e["message"], F.lit(" :in "), F.col("file"))
        return F.struct(e["message"].alias("message"), e["blame"].alias("blame"), stage.alias("stage"), F.col("file").alias("file"), r.alias("row"), c.alias("col"), rn.alias("row_name"), cn.alias("col_name"), text.alias("text"))

    return made.select("file", "row", "col", "name", "row_name", F.col("_r.values").alias("values"), F.transform("_r.errors", addressed).alias("errors"))


def named(cells: DataFrame, names: DataFrame) -> DataFrame:
    """cells with their column's name and original, and their row's: the value in the sheet's first column, normalised like a header.

    Joined by (file, column) and (file, row): neither is as large as a file.
    """
    plain_name = F.regexp_replace(F.trim(F.lower(F.regexp_replace("value", r"[^\p{L}\p{N}]+", " "))), " ", "_")
    first = cells.filter("col = 0").select("file", "row", plain_name.alias("row_name"), F.col("value").alias("row_original"))
    return cells.join(names.select("file", "col", "name", "original"), ["file", "col"]).join(first, ["file", "row"], "left")


def cell_errors(values: DataFrame) -> DataFrame:
    """message, blame, stage, file, row, col, row_name, col_name, text: a row for each error of normalised()."""
    return values.select(F.explode("errors").alias("e")).select("e.*")


def value_records(values: DataFrame, singles: Sequence[str] = (), keys: Sequence[str] = ()) -> DataFrame:
    """file, row, attrs (map of name to its values), one (map of name to its value, for the names of singles that have just one). keys: helper columns that hold the records' keys; they are left out."""
    kept = values.filter(F.size("values") > 0)
    kept = kept.filter(~F.col("name").isin(*keys)) if keys else kept
    attrs = F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "values"))))
    out = kept.groupBy("file", "row").agg(attrs.alias("attrs"))
    alone = F.map_filter("attrs", lambda k, v: (F.size(v) == 1) & (k.isin(*singles) if singles else F.lit(False)))
    return out.select("file", "row", F.map_filter("attrs", lambda k, v: ~F.map_contains_key(alone, k)).alias("attrs"), F.transform_values(alone, lambda k, v: F.get(v, F.lit(0))).alias("one"))
