"""JSON Schema documents as tests of a VARIANT column.

``load`` reads a schema's text and refuses what it does not know, so no rule is passed over in silence. ``satisfies`` turns it
into one predicate and ``breaches`` into the list of broken rules; both are plain Column expressions.

Meaning, where JSON Schema leaves room or VARIANT sets a limit: numbers are compared exactly where value and limit are whole and
fit 64 bits, else as doubles; ``5.0`` is an integer; lengths count code points; patterns are Java's, found anywhere in the text,
with ``$`` only at the very end; of keys that occur twice the last counts; ``enum`` and ``const`` take strings, numbers, booleans
and null; ``$ref`` points into the same document and must not come back to itself.
"""

from __future__ import annotations

import json
import math
import re
from functools import partial, reduce
from operator import add, and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedflow.functions.contract import Contract
from feedflow.functions.json_text import is_kind

Schema = dict | bool

TYPES = ("string", "number", "integer", "boolean", "object", "array", "null")
NOTES = ("$schema", "$id", "$comment", "$defs", "definitions", "title", "description", "default", "examples")
LIMITS = ("minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum")
COUNTS = ("minLength", "maxLength", "minItems", "maxItems", "minProperties", "maxProperties")
ONE_SCHEMA, SCHEMA_LISTS, SCHEMA_MAPS = ("items", "additionalProperties", "not"), ("allOf", "anyOf", "oneOf"), ("properties", "patternProperties")


class SchemaError(ValueError):
    """A schema document that says something this module cannot hold data to."""


# --- Reading a schema ---------------------------------------------------------------------------


def load(text: str | dict | bool) -> Schema:
    """The schema with its references put in place. Unknown keywords and ill-formed values raise ``SchemaError``."""
    whole = json.loads(text) if isinstance(text, str) else text
    return _read(whole, whole, "#", ())


def _read(schema, whole, at: str, open_refs: tuple) -> Schema:
    if isinstance(schema, bool):
        return schema
    _demand(isinstance(schema, dict), at, "is no schema")
    read = {}
    for word, value in schema.items():
        here = f"{at}/{word}"
        if word in NOTES:
            continue
        if word == "$ref":
            _demand(value not in open_refs, here, "comes back to itself")
            target = _read(_find(whole, value, here), whole, value, (*open_refs, value))
            read.setdefault("allOf", []).append(target)
        elif word in ONE_SCHEMA:
            read[word] = _read(value, whole, here, open_refs)
        elif word in SCHEMA_LISTS:
            _demand(isinstance(value, list) and value, here, "must be a list of schemas")
            read.setdefault(word, []).extend(_read(part, whole, f"{here}/{i}", open_refs) for i, part in enumerate(value))
        elif word in SCHEMA_MAPS:
            _demand(isinstance(value, dict), here, "must hold schemas by name")
            read[word] = {name: _read(part, whole, f"{here}/{name}", open_refs) for name, part in value.items()}
            for name in value:
                _demand(_pattern(name, here) if word == "patternProperties" else "'" not in name, here, f"cannot hold the name {name!r}")
        else:
            read[word] = _plain_keyword(word, value, here)
    if list(read) == ["allOf"] and len(read["allOf"]) == 1:
        return read["allOf"][0]
    return read


def _plain_keyword(word: str, value, here: str):
    number = isinstance(value, int | float) and not isinstance(value, bool) and math.isfinite(value)
    if word == "type":
        kinds = value if isinstance(value, list) else [value]
        _demand(kinds and all(kind in TYPES for kind in kinds), here, "must name JSON types")
    elif word == "required":
        _demand(isinstance(value, list) and all(isinstance(name, str) and "'" not in name for name in value), here, "must list names")
    elif word in ("enum", "const"):
        values = value if word == "enum" else [value]
        _demand(isinstance(values, list) and values and not any(isinstance(v, dict | list) for v in values), here, "must hold plain values")
    elif word in LIMITS:
        _demand(number, here, "must be a number")
    elif word in COUNTS:
        _demand(number and value >= 0 and value == int(value), here, "must be a count")
        value = int(value)
    elif word == "pattern":
        _demand(isinstance(value, str) and _pattern(value, here), here, "must be a pattern")
    else:
        raise SchemaError(f"{here}: unknown keyword")
    return value


def _find(whole, pointer, here: str):
    _demand(isinstance(pointer, str) and (pointer == "#" or pointer.startswith("#/")), here, "must point into the document")
    found = whole
    for step in pointer[2:].split("/") if len(pointer) > 1 else ():
        name = step.replace("~1", "/").replace("~0", "~")
        _demand(isinstance(found, dict) and name in found, here, f"points nowhere: {pointer}")
        found = found[name]
    return found


def _pattern(text: str, here: str) -> bool:
    try:
        re.compile(text)
    except re.error as error:
        raise SchemaError(f"{here}: {error}") from error
    return True


def _demand(right, at: str, message: str) -> None:
    if not right:
        raise SchemaError(f"{at}: {message}")


# --- Contracts ----------------------------------------------------------------------------------


def as_contract(schema: Schema) -> Contract | None:
    """The contract that says the same, or None if the schema asks for more or less than a contract can.

    Contracts are checked against a document's usual shape, which is cheaper than rule by rule.
    """
    if not isinstance(schema, dict):
        return None
    words = set(schema)
    if words == {"enum"} and all(isinstance(value, str) for value in schema["enum"]):
        return tuple(schema["enum"])
    kind = schema.get("type")
    if words == {"type"} and kind in ("string", "number", "integer", "boolean"):
        return kind
    if words == {"type", "items"} and kind == "array":
        # Elements of arrays are objects of plain fields: that is what has a usual shape.
        part = as_contract(schema["items"])
        return [part] if isinstance(part, dict) and not _has(part, (list, tuple)) else None
    if words == {"type", "properties", "required"} and kind == "object":
        parts = {name: as_contract(part) for name, part in schema["properties"].items()}
        words_only = all(re.fullmatch(r"[A-Za-z_]\w*", name, re.ASCII) for name in parts)
        if parts and words_only and set(schema["required"]) == set(parts) and None not in parts.values():
            return parts
    return None


def _has(contract: Contract, kinds: tuple) -> bool:
    return isinstance(contract, kinds) or (isinstance(contract, dict) and any(_has(part, kinds) for part in contract.values()))


def schema_of(contract: Contract) -> dict:
    """The JSON Schema document of a contract."""
    if isinstance(contract, dict):
        return {"type": "object", "properties": {name: schema_of(part) for name, part in contract.items()}, "required": list(contract)}
    if isinstance(contract, list):
        return {"type": "array", "items": schema_of(contract[0])}
    return {"enum": list(contract)} if isinstance(contract, tuple) else {"type": contract}


# --- Rules as columns ---------------------------------------------------------------------------


def satisfies(doc: Column, schema: Schema, path: str = "$") -> Column:
    """Whether the value at ``path``, which must be there, keeps every rule. Never NULL."""
    oks = [ok for ok, _ in _own_rules(doc, path, schema)]
    if isinstance(schema, dict):
        for name, part in _fields(schema).items():
            inner = f"{path}['{name}']"
            missing = _at(doc, inner).isNull()
            if name in schema.get("required", ()):
                oks.append(~(_is_object(doc, path) & missing))
            if part not in ({}, True):
                oks.append(missing | satisfies(doc, part, inner))
        if _rules(schema.get("items")):
            each = F.forall(_elements(doc, path), lambda item: satisfies(item, schema["items"]))
            oks.append(F.coalesce(each, F.lit(True)))
        for kept, part in _groups(schema):
            oks.append(F.coalesce(_every_member(doc, path, kept, part), F.lit(True)))
        oks += [satisfies(doc, part, path) for part in schema.get("allOf", ())]
    return reduce(and_, oks, F.lit(True))


def breaches(doc: Column, schema: Schema, path: str = "$", label: str | Column = "") -> Column:
    """Array of the rules that the value at ``path`` breaks, as ``place: rule``; with NULLs for those it keeps."""
    label = F.lit(label) if isinstance(label, str) else label
    place = F.when(label == "", F.lit("root")).otherwise(label)
    none = F.array().cast("array<string>")
    found = [F.array(F.when(~ok, F.concat(place, F.lit(f": {text}")))) for ok, text in _own_rules(doc, path, schema)]
    if isinstance(schema, dict):
        for name, part in _fields(schema).items():
            inner, inner_label = f"{path}['{name}']", _under(label, F.lit(name))
            missing, here = _at(doc, inner).isNull(), breaches(doc, part, inner, inner_label)
            absent = none
            if name in schema.get("required", ()):
                absent = F.array(F.when(_is_object(doc, path), F.concat(inner_label, F.lit(": missing"))))
            found.append(F.when(missing, absent).otherwise(here))
        if _rules(schema.get("items")):
            each = F.transform(_elements(doc, path), lambda item: breaches(item, schema["items"], "$", F.concat(label, F.lit("[]"))))
            found.append(F.coalesce(F.flatten(each), none))
        for kept, part in _groups(schema):
            found.append(F.coalesce(F.flatten(_member_breaches(doc, path, kept, part, label)), none))
        found += [breaches(doc, part, path, label) for part in schema.get("allOf", ())]
    return F.concat(*found) if found else none


def _every_member(doc: Column, path: str, kept, part: Schema) -> Column:
    return F.forall(F.map_values(_members(doc, path, kept)), lambda value: satisfies(value, part))


def _member_breaches(doc: Column, path: str, kept, part: Schema, label: Column) -> Column:
    members = F.map_entries(_members(doc, path, kept))
    return F.transform(members, lambda entry: breaches(entry["value"], part, "$", _under(label, entry["key"])))


def _under(label: Column, name: Column) -> Column:
    return F.when(label == "", name).otherwise(F.concat(label, F.lit("."), name))


def _rules(schema) -> bool:
    """Whether a sub-schema asks for anything."""
    return schema is not None and schema is not True and schema != {}


def _at(doc: Column, path: str) -> Column:
    return F.try_variant_get(doc, path, "variant")


def _is_object(doc: Column, path: str) -> Column:
    return is_kind(doc, path, "object")


def _elements(doc: Column, path: str) -> Column:
    return F.try_variant_get(doc, path, "array<variant>")


def _members(doc: Column, path: str, kept=None) -> Column:
    members = F.try_variant_get(doc, path, "map<string, variant>")
    return members if kept is None else F.map_filter(members, lambda name, _: kept(name))


def _fields(schema: dict) -> dict:
    """Sub-schemas by field, those that are only required behind those that are described."""
    described = schema.get("properties", {})
    return described | {name: True for name in schema.get("required", ()) if name not in described}


def _groups(schema: dict) -> list:
    """Pairs of a test of a field's name and the schema for the fields it picks."""
    patterns = schema.get("patternProperties", {})
    groups = [(partial(_named_like, pattern=p), part) for p, part in patterns.items() if _rules(part)]
    if _rules(schema.get("additionalProperties")):
        known = list(schema.get("properties", {}))

        def further(name: Column) -> Column:
            return reduce(and_, [~name.rlike(_java(p)) for p in patterns], ~name.isin(known) if known else F.lit(True))

        groups.append((further, schema["additionalProperties"]))
    return groups


def _named_like(name: Column, pattern: str) -> Column:
    return name.rlike(_java(pattern))


def _java(pattern: str) -> str:
    """``$`` as the very end of the text; Java's also matches before a last line feed."""
    return re.sub(r"\\.|\[(?:\\.|[^\]\\])*\]|\$", lambda m: r"\z" if m[0] == "$" else m[0], pattern, flags=re.DOTALL)


def _own_rules(doc: Column, path: str, schema: Schema) -> list[tuple[Column, str]]:
    """``(kept, text)`` for the rules about the value itself, not its parts."""
    if isinstance(schema, bool):
        return [] if schema else [(F.lit(False), "not allowed")]
    rules = []
    if "type" in schema:
        kinds = schema["type"] if isinstance(schema["type"], list) else [schema["type"]]
        rules.append((reduce(or_, [_is(doc, path, kind) for kind in kinds]), "not " + " or ".join(kinds)))
    for word in ("enum", "const"):
        if word in schema:
            values = schema[word] if word == "enum" else [schema[word]]
            shown = " or ".join(v if isinstance(v, str) else json.dumps(v) for v in values)
            rules.append((reduce(or_, [_equals(doc, path, v) for v in values]), f"not {shown}"))
    text = F.when(_is(doc, path, "string"), F.try_variant_get(doc, path, "string"))
    if "pattern" in schema:
        rules.append((_or_true(text.rlike(_java(schema["pattern"]))), f"not like {schema['pattern']}"))
    sizes = (
        ("Length", lambda: F.char_length(text), "characters"),
        ("Items", lambda: F.size(_elements(doc, path)), "items"),
        ("Properties", lambda: F.size(_members(doc, path)), "fields"),
    )
    for suffix, size, noun in sizes:
        if f"min{suffix}" in schema:
            least = schema[f"min{suffix}"]
            rules.append((_or_true(_counted(size()) >= least), f"under {least} {noun}"))
        if f"max{suffix}" in schema:
            most = schema[f"max{suffix}"]
            rules.append((_or_true(_counted(size()) <= most), f"over {most} {noun}"))
    for word, text_of in (("minimum", "below {}"), ("maximum", "above {}"), ("exclusiveMinimum", "not above {}"), ("exclusiveMaximum", "not below {}")):
        if word in schema:
            sign = _compare(doc, path, schema[word])
            ok = {"minimum": sign >= 0, "maximum": sign <= 0, "exclusiveMinimum": sign > 0, "exclusiveMaximum": sign < 0}[word]
            rules.append((_or_true(ok), text_of.format(json.dumps(schema[word]))))
    if "anyOf" in schema:
        rules.append((reduce(or_, [satisfies(doc, part, path) for part in schema["anyOf"]]), f"none of {len(schema['anyOf'])} forms"))
    if "oneOf" in schema:
        held = reduce(add, [satisfies(doc, part, path).cast("int") for part in schema["oneOf"]])
        rules.append((held == 1, f"not exactly one of {len(schema['oneOf'])} forms"))
    if "not" in schema:
        rules.append((~satisfies(doc, schema["not"], path), "of a forbidden form"))
    return rules


def _or_true(test: Column) -> Column:
    """Rules about one type pass values of another, for which the test is NULL."""
    return F.coalesce(test, F.lit(True))


def _counted(size: Column) -> Column:
    """``size`` of what is no collection may be -1."""
    return F.when(size >= 0, size)


def _is(doc: Column, path: str, kind: str) -> Column:
    if kind == "null":
        return F.coalesce(F.is_variant_null(_at(doc, path)), F.lit(False))
    return is_kind(doc, path, kind)


def _equals(doc: Column, path: str, value) -> Column:
    if value is None:
        return _is(doc, path, "null")
    if isinstance(value, bool):
        return F.coalesce(_is(doc, path, "boolean") & (F.try_variant_get(doc, path, "boolean") == F.lit(value)), F.lit(False))
    if isinstance(value, str):
        return F.coalesce(_is(doc, path, "string") & (F.try_variant_get(doc, path, "string") == F.lit(value)), F.lit(False))
    return F.coalesce(_compare(doc, path, value) == 0, F.lit(False))


def _compare(doc: Column, path: str, limit: int | float) -> Column:
    """-1, 0 or 1 as the number at ``path`` is below, at or above ``limit``; NULL if there is no number."""
    value = F.try_variant_get(doc, path, "double")
    sign = _sign(value, F.lit(float(limit)))
    if limit == int(limit) and -(2**63) <= limit < 2**63:
        whole = F.try_variant_get(doc, path, "bigint")
        exact = F.schema_of_variant(_at(doc, path)) == "BIGINT"
        sign = F.when(exact, _sign(whole, F.lit(int(limit)).cast("bigint"))).otherwise(sign)
    return F.when(_is(doc, path, "number"), sign)


def _sign(value: Column, limit: Column) -> Column:
    return F.when(value < limit, -1).when(value > limit, 1).otherwise(0)
