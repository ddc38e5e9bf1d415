"""JSON Schema, compiled to one expression over a VARIANT document: nested properties, items and choices, each violation with its path.

compile_schema() walks the schema when the query is built, never the data: objects are read as maps, arrays by higher-order
functions, so a document of any size is judged where it lies, without a shuffle, and a schema costs one pass.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .constraints import Rule

Schema = Mapping[str, object]
_ERRORS = "array<struct<path:array<string>,keyword:string,message:string>>"
#: Characters of a value that a message shows, and keywords that say nothing about validity.
SHOWN = 200
_ANNOTATIONS = {"$schema", "$id", "title", "description", "default", "examples", "definitions", "$defs", "format", "context_value", "version"}
_KINDS = {"string": ("STRING",), "number": ("BIGINT", "DOUBLE", "FLOAT", "DECIMAL"), "integer": ("BIGINT",), "boolean": ("BOOLEAN",), "null": ("VOID",), "object": ("OBJECT",), "array": ("ARRAY",)}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _none() -> Column:
    return F.array().cast(_ERRORS)


def _error(path: Column, keyword: str, message: Column) -> Column:
    return F.array(F.struct(path.alias("path"), F.lit(keyword).alias("keyword"), message.alias("message"))).cast(_ERRORS)


def _if(bad: Column, path: Column, keyword: str, message: Column) -> Column:
    return F.when(F.coalesce(bad, F.lit(False)), _error(path, keyword, message)).otherwise(_none())


def _shown(x: Column) -> Column:
    return F.left(F.to_json(x["v"]), F.lit(SHOWN))


def _as(v: Column, kind: str) -> Column:
    return F.try_variant_get(v, "$", kind)


def _seen(v: Column) -> Column:
    """struct(v, m, a, kind): a value with its fields if it is an object, its elements if it is an array, and else the kind of scalar; found out once for all keywords."""
    fields, elements = _as(v, "map<string,variant>"), _as(v, "array<variant>")
    kind = F.when(fields.isNotNull(), "OBJECT").when(elements.isNotNull(), "ARRAY").otherwise(F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0))
    return F.struct(v.alias("v"), fields.alias("m"), elements.alias("a"), kind.alias("kind"))


def _is(x: Column, kinds: object) -> Column:
    """Whether a value has one of the kinds that a schema's type names."""
    out = F.lit(False)
    for kind in [kinds] if isinstance(kinds, str) else kinds:
        here = x["kind"].isin(*_KINDS[kind])
        if kind == "integer":
            # 3.0 is a whole number too
            number = _as(x["v"], "double")
            here |= x["kind"].isin(*_KINDS["number"]) & F.coalesce(number == F.floor(number), F.lit(False))
        out |= here
    return out


def _same(x: Column, constant: object) -> Column:
    """Whether a value equals a schema's constant; numbers by their value."""
    v = x["v"]
    if isinstance(constant, bool):
        return _is(x, "boolean") & (_as(v, "boolean") == F.lit(constant))
    if isinstance(constant, (int, float)):
        return _is(x, "number") & (_as(v, "double") == F.lit(float(constant)))
    if isinstance(constant, str):
        return _is(x, "string") & (_as(v, "string") == F.lit(constant))
    if constant is None:
        return _is(x, "null")
    return F.to_json(v) == F.to_json(F.parse_json(F.lit(json.dumps(constant))))


def _resolved(schema: Schema, root: Schema, seen: tuple[str, ...]) -> tuple[Schema, tuple[str, ...]]:
    while "$ref" in schema:
        ref = schema["$ref"]
        if ref in seen:
            raise ValueError(f"a schema that contains itself can't be compiled: {ref}")
        seen += (ref,)
        schema = root
        for key in filter(None, ref.removeprefix("#").split("/")):
            schema = schema[key.replace("~1", "/").replace("~0", "~")]
    return schema, seen


def compile_schema(schema: Schema, v: Column, path: Column | None = None, root: Schema | None = None, seen: tuple[str, ...] = ()) -> Column:
    """The violations of a VARIANT value, as array of struct(path, keyword, message). A keyword applies to values of its own kind only; a value that isn't there has none."""
    root = schema if root is None else root
    path = F.array().cast("array<string>") if path is None else path
    schema, seen = _resolved(schema, root, seen)
    if unknown := set(schema) - _ANNOTATIONS - set(_CHECKS) - {"additionalProperties"}:
        raise ValueError(f"keywords that aren't known: {sorted(unknown)}")
    inner = lambda s, x, p: compile_schema(s, x, p, root, seen)

    def judged(x: Column) -> Column:
        found = [_CHECKS[k](schema[k], x, path, inner, schema) for k in _CHECKS if k in schema]
        if "additionalProperties" in schema:
            found.append(_additional(schema["additionalProperties"], x, path, inner, schema))
        return F.concat(*found) if found else _none()

    return F.when(v.isNotNull(), let(_seen(v), judged)).otherwise(_none())


def _type(a, v, path, inner, schema):
    names = a if isinstance(a, str) else ", ".join(a)
    return _if(~_is(v, a), path, "type", F.concat(_shown(v), F.lit(f" is not of type {names}")))


def _enum(a, v, path, inner, schema):
    same = F.lit(False)
    for constant in a:
        same |= F.coalesce(_same(v, constant), F.lit(False))
    return _if(~same, path, "enum", F.concat(_shown(v), F.lit(f" is not one of {json.dumps(list(a))}")))


def _const(a, v, path, inner, schema):
    return _if(~F.coalesce(_same(v, a), F.lit(False)), path, "const", F.concat(_shown(v), F.lit(f" is not {json.dumps(a)}")))


def _pattern(a, v, path, inner, schema):
    return _if(_is(v, "string") & ~_as(v["v"], "string").rlike(a), path, "pattern", F.concat(_shown(v), F.lit(f" does not match {a}")))


def _number(keyword: str, bad: Callable[[Column, object], Column]):
    return lambda a, v, path, inner, schema: _if(_is(v, "number") & bad(_as(v["v"], "double"), F.lit(float(a))), path, keyword, F.concat(_shown(v), F.lit(f" against {keyword} {a}")))


def _length(keyword: str, bad: Callable[[Column, object], Column]):
    return lambda a, v, path, inner, schema: _if(_is(v, "string") & bad(F.char_length(_as(v["v"], "string")), F.lit(a)), path, keyword, F.concat(_shown(v), F.lit(f" against {keyword} {a}")))


def _count(keyword: str, bad: Callable[[Column, object], Column]):
    return lambda a, v, path, inner, schema: _if(_is(v, "array") & bad(F.size(v["a"]), F.lit(a)), path, keyword, F.concat(F.size(v["a"]).cast("string"), F.lit(f" items against {keyword} {a}")))


def _object(v: Column, body: Callable[[Column], Column]) -> Column:
    """body of an object as a map; no error for other kinds."""
    return F.when(v["m"].isNotNull(), body(v["m"])).otherwise(_none())


def _required(a, v, path, inner, schema):
    one = lambda m, k: _if(~F.map_contains_key(m, F.lit(k)), path, "required", F.lit(f"'{k}' is a required property"))
    return _object(v, lambda m: F.concat(*(one(m, k) for k in a))) if a else _none()


def _below(path: Column, key: Column) -> Column:
    return F.concat(path, F.array(key.cast("string")))


def _properties(a, v, path, inner, schema):
    return _object(v, lambda m: F.concat(*(inner(s, F.try_element_at(m, F.lit(k)), _below(path, F.lit(k))) for k, s in a.items()))) if a else _none()


def _additional(a, v, path, inner, schema):
    known = list(schema.get("properties", {}))
    extra = lambda m: F.array_sort(F.filter(F.map_keys(m), lambda k: ~k.isin(*known) if known else F.lit(True)))
    if a is False:
        return _object(v, lambda m: _if(F.size(extra(m)) > 0, path, "additionalProperties", F.concat(F.lit("not allowed: "), F.array_join(extra(m), ", "))))
    if a is True:
        return _none()
    return _object(v, lambda m: F.flatten(F.transform(extra(m), lambda k: inner(a, F.try_element_at(m, k), _below(path, k)))))


def _items(a, v, path, inner, schema):
    return F.coalesce(F.flatten(F.transform(v["a"], lambda x, i: inner(a, x, _below(path, i)))), _none())


def _all_of(a, v, path, inner, schema):
    return F.concat(*(inner(s, v["v"], path) for s in a))


def _matching(a, v, path, inner) -> Column:
    """How many of several schemas a value satisfies."""
    out = F.lit(0)
    for s in a:
        out += (F.size(inner(s, v["v"], path)) == 0).cast("int")
    return out


def _any_of(a, v, path, inner, schema):
    return _if(_matching(a, v, path, inner) == 0, path, "anyOf", F.concat(_shown(v), F.lit(" is not valid under any of the given schemas")))


def _one_of(a, v, path, inner, schema):
    return let(_matching(a, v, path, inner), lambda n: _if(n != 1, path, "oneOf", F.concat(_shown(v), F.lit(" is valid under "), n.cast("string"), F.lit(" of the given schemas"))))


def _not(a, v, path, inner, schema):
    return _if(F.size(inner(a, v["v"], path)) == 0, path, "not", F.concat(_shown(v), F.lit(" is what it should not be")))


_CHECKS = {
    "type": _type, "enum": _enum, "const": _const, "pattern": _pattern, "minimum": _number("minimum", lambda x, a: x < a), "maximum": _number("maximum", lambda x, a: x > a), "exclusiveMinimum": _number("exclusiveMinimum", lambda x, a: x <= a),
    "exclusiveMaximum": _number("exclusiveMaximum", lambda x, a: x >= a), "minLength": _length("minLength", lambda n, a: n < a), "maxLength": _length("maxLength", lambda n, a: n > a), "minItems": _count("minItems", lambda n, a: n < a),
    "maxItems": _count("maxItems", lambda n, a: n > a), "required": _required, "properties": _properties, "items": _items, "allOf": _all_of, "anyOf": _any_of, "oneOf": _one_of, "not": _not,
}


def valid(schema: Schema, document: Column) -> Column:
    return F.size(compile_schema(schema, document)) == 0


def schema_violations(rows: DataFrame, keys: Sequence[str], document: Column, schema: Schema, stage: str = "input", blame: str = "submission") -> DataFrame:
    """keys, path (keys and indexes), pointer, keyword, message, stage, blame: a row for each violation of a VARIANT document."""
    found = rows.select(*keys, F.explode(compile_schema(schema, document)).alias("e"))
    pointer = F.concat(F.lit("#"), F.array_join(F.transform("e.path", lambda k: F.concat(F.lit("/"), F.replace(F.replace(k, F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1")))), ""))
    return found.select(*keys, "e.path", pointer.alias("pointer"), "e.keyword", "e.message", F.lit(stage).alias("stage"), F.lit(blame).alias("blame"))


#: Keywords of JSON Schema for kinds of rules that have another name, and the types that casts stand for.
_KEYWORDS = {"enum": "enum", "pattern": "pattern", "minimum": "minimum", "maximum": "maximum", "min_length": "minLength", "max_length": "maxLength", "min_items": "minItems"}
_TYPES = {"string": "string", "int": "integer", "bigint": "integer", "double": "number", "boolean": "boolean"}


def schema_of(rules: Sequence[Rule]) -> dict:
    """Flat rules as a JSON Schema of the rows that they judge; rules with a condition have no counterpart."""
    out: dict = {"type": "object", "properties": {}, "required": []}

    def of(rule: Rule) -> dict:
        if rule.when is not None:
            raise ValueError(f"no keyword for the condition of {rule.name}")
        if rule.kind == "type":
            return {"type": _TYPES[rule.argument]}
        if rule.kind == "not_":
            return {"not": of(rule.argument)}
        value = list(rule.argument) if isinstance(rule.argument, tuple) else rule.argument
        return {_KEYWORDS[rule.kind]: value}

    def at(rule: Rule) -> dict:
        return {"required": [rule.path]} if rule.kind == "required" else {"properties": {rule.path: of(rule)}}

    for rule in rules:
        if rule.kind in ("all_of", "any_of", "one_of"):
            out.setdefault("allOf", []).append({rule.kind[:3] + "Of": [at(r) for r in rule.argument]})
        elif rule.kind == "required":
            out["required"].append(rule.path)
        else:
            out["properties"].setdefault(rule.path, {"allOf": []})["allOf"].append(of(rule))
    return out


def schema_text(schema: Schema, title: str) -> str:
    """A schema as it is exported: with its draft and title, keys sorted."""
    return json.dumps({"$schema": "http://json-schema.org/draft-07/schema#", "title": title, **schema}, indent=2, sort_keys=True, ensure_ascii=False)
