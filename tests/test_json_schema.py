"""JSON Schema documents as Column predicates."""

import json

import pytest

from feedflow.functions import contract
from feedflow.functions.json_schema import SchemaError, as_contract, breaches, load, satisfies, schema_of
from feedflow.operators.decode import decode, parse_variant
from feedflow.operators.validate import check_schema, rejected
from feedflow.sources.literal import messages
from pyspark.sql import functions as F
from tests.test_validate import TRANSACTIONS

BIG = 2**53 + 1
# schema, JSON texts that keep it, JSON texts that break it with their reason
CASES = [
    (True, ["1", "null"], {}),
    (False, [], {"1": "root: not allowed"}),
    ({"type": "string"}, ['"a"'], {"1": "root: not string", "null": "root: not string"}),
    ({"type": ["integer", "null"]}, ["5", "5.0", "null"], {"5.5": "root: not integer or null", "true": "root: not integer or null"}),
    ({"type": "array"}, ["[]", "[1]"], {"{}": "root: not array"}),
    ({"enum": ["a", 1, None, True]}, ['"a"', "1", "1.0", "null", "true"], {'"1"': "root: not a or 1 or null or true", "false": "root: not a or 1 or null or true"}),
    ({"const": "a"}, ['"a"'], {'"b"': "root: not a", "[]": "root: not a"}),
    ({"const": BIG}, [str(BIG)], {str(BIG - 1): f"root: not {BIG}", f'"{BIG}"': f"root: not {BIG}"}),
    ({"minimum": 3, "maximum": 5}, ["3", "5", "4.5", '"1"', "null"], {"2": "root: below 3", "5.001": "root: above 5", "1e300": "root: above 5"}),
    ({"minimum": BIG}, [str(BIG)], {str(BIG - 1): f"root: below {BIG}"}),
    ({"exclusiveMinimum": 0.5, "exclusiveMaximum": 1}, ["0.75"], {"0.5": "root: not above 0.5", "1": "root: not below 1"}),
    ({"minLength": 2, "maxLength": 3}, ['"ab"', '"\U0001f600é"', "1"], {'"a"': "root: under 2 characters", '"abcd"': "root: over 3 characters"}),
    ({"pattern": "^[a-f0-9$]+$"}, ['"0a$"', "7"], {'"0a\\n"': "root: not like ^[a-f0-9$]+$", '"x"': "root: not like ^[a-f0-9$]+$"}),
    ({"pattern": "b"}, ['"abc"'], {'""': "root: not like b"}),
    ({"minItems": 1, "maxItems": 2}, ["[1]", "{}", '"a"'], {"[]": "root: under 1 items", "[1,2,3]": "root: over 2 items"}),
    ({"minProperties": 1, "maxProperties": 1}, ['{"a":1}', "[]"], {"{}": "root: under 1 fields", '{"a":1,"b":2}': "root: over 1 fields"}),
    ({"items": {"type": "integer"}}, ["[]", "[1,2]", "{}"], {"[1,null]": "[]: not integer"}),
    ({"items": {"items": {"maximum": 1}}}, ["[[1],[]]", "[5]"], {"[[1],[2]]": "[][]: above 1"}),
    ({"properties": {"a": {"type": "string"}}}, ["{}", '{"a":"x"}', "3"], {'{"a":null}': "a: not string"}),
    ({"required": ["a", "b c"]}, ['{"a":null,"b c":0}', "3"], {'{"a":1}': "b c: missing"}),
    ({"properties": {"a": {"properties": {"b": {"minimum": 1}}, "required": ["b"]}}}, ['{"a":{"b":1}}', '{"a":2}'], {'{"a":{}}': "a.b: missing", '{"a":{"b":0}}': "a.b: below 1"}),
    ({"properties": {"a": True}, "additionalProperties": False}, ['{"a":1}', "{}", "4"], {'{"a":1,"z":2}': "z: not allowed"}),
    ({"properties": {"a": True}, "additionalProperties": {"type": "integer"}}, ['{"a":"x","b":1}'], {'{"b":"x"}': "b: not integer"}),
    ({"patternProperties": {"^n_": {"type": "number"}}, "additionalProperties": False}, ['{"n_a":1.5}'], {'{"n_a":"1"}': "n_a: not number", '{"m":1}': "m: not allowed"}),
    ({"allOf": [{"minimum": 1}, {"maximum": 2}]}, ["1"], {"0": "root: below 1", "3": "root: above 2"}),
    ({"anyOf": [{"type": "string"}, {"minimum": 5}]}, ['"a"', "6", "null"], {"4": "root: none of 2 forms"}),
    ({"oneOf": [{"type": "integer"}, {"type": "number", "minimum": 5}]}, ["4", "5.5"], {"6": "root: not exactly one of 2 forms", '"a"': "root: not exactly one of 2 forms"}),
    ({"not": {"required": ["a"]}}, ['{"b":1}'], {'{"a":1}': "root: of a forbidden form"}),
    ({"$defs": {"id": {"type": "string"}}, "properties": {"a": {"$ref": "#/$defs/id", "minLength": 1}}}, ['{"a":"x"}'], {'{"a":""}': "a: under 1 characters", '{"a":1}': "a: not string"}),
]


@pytest.mark.parametrize("schema, good, bad", CASES, ids=lambda case: json.dumps(case)[:40] if isinstance(case, dict) else "")
def test_keywords(spark, schema, good, bad):
    checked = check_schema(parse_variant(decode(messages(spark, [*good, *bad]))), json.dumps(schema))
    found = {row.json_data: "; ".join(row.errors) for row in checked.collect()}
    assert found == dict.fromkeys(good, "") | bad
    assert {row.json_data for row in checked.filter("valid").collect()} == set(good)


def test_malformed_text(spark):
    checked = check_schema(parse_variant(decode(messages(spark, ["{", '""', "null"]))), {"minLength": 0})
    assert {row.value: row.reason for row in rejected(checked).collect()} == {"{": "malformed JSON"}


@pytest.mark.parametrize("name", ["TRANSACTION_CONTRACT", "BLOCK_CONTRACT"])
def test_contracts_have_schemas(name):
    known = getattr(contract, name)
    assert as_contract(load(json.dumps(schema_of(known)))) == known


@pytest.mark.parametrize("schema", [
    {"type": "object"}, {"type": "object", "properties": {"a": {"type": "string"}}, "required": []},
    {"type": "string", "enum": ["a"]}, {"type": "array", "items": {"type": "string"}}, {"enum": [1]}, {"type": ["string"]}, True,
    {"type": "object", "properties": {"a b": {"type": "string"}}, "required": ["a b"]},
])
def test_what_no_contract_says(schema):
    assert as_contract(load(schema)) is None


def test_rule_by_rule_equals_the_contract(spark):
    """The general predicates give what the contract check gives, reasons included."""
    schema = load(schema_of(contract.TRANSACTION_CONTRACT))
    docs = parse_variant(decode(messages(spark, list(TRANSACTIONS))))
    doc = F.col("doc")
    rows = docs.filter("doc IS NOT NULL").select(
        "json_data", satisfies(doc, schema).alias("kept"), F.array_distinct(F.array_compact(breaches(doc, schema))).alias("errors")
    ).collect()
    found = {row.json_data: "; ".join(row.errors) or None for row in rows}
    # An object's own type is one rule among others here; a contract stops at it, and so do fields that are not there.
    assert found == {text: reason for text, reason in TRANSACTIONS.items() if reason != "malformed JSON"}
    assert {row.json_data for row in rows if row.kept} == {text for text, reason in found.items() if reason is None}


def test_schema_path_equals_the_contract(spark):
    checked = check_schema(parse_variant(decode(messages(spark, list(TRANSACTIONS)))), json.dumps(schema_of(contract.TRANSACTION_CONTRACT)))
    bad = {row.value: row.reason for row in rejected(checked).collect()}
    assert {text: bad.get(text) for text in TRANSACTIONS} == TRANSACTIONS


@pytest.mark.parametrize("schema, message", [
    ({"uniqueItems": True}, "#/uniqueItems: unknown keyword"),
    ({"properties": {"a": {"format": "date"}}}, "#/properties/a/format: unknown keyword"),
    ({"oneOf": [{"if": {}}]}, "#/oneOf/0/if: unknown keyword"),
    ({"type": "text"}, "#/type: must name"),
    ({"enum": [[1]]}, "#/enum: must hold plain"),
    ({"minimum": "3"}, "#/minimum: must be a number"),
    ({"maxLength": -1}, "#/maxLength: must be a count"),
    ({"pattern": "("}, "#/pattern"),
    ({"items": [{}]}, "#/items: is no schema"),
    ({"$ref": "#/$defs/a"}, "points nowhere"),
    ({"$ref": "other.json"}, "must point into the document"),
    ({"$defs": {"a": {"items": {"$ref": "#/$defs/a"}}}, "$ref": "#/$defs/a"}, "comes back to itself"),
    ({"properties": {"it's": {}}}, "cannot hold the name"),
])
def test_refused(schema, message):
    with pytest.raises(SchemaError) as error:
        load(schema)
    assert message in str(error.value)
