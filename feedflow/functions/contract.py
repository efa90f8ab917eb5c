"""Producer contracts and their check against a VARIANT document.

A contract is a nested Python value: a type name, a tuple of allowed strings, a dict for an object whose listed
fields are all required, or a one-element list for an array. Extra fields are allowed, an explicit null fails the
type test and arrays may be empty.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedflow.functions.json_text import is_kind, leaf_is

# --- Fixed values: fields and types the producers require. --------------------------------------

COIN = {
    "spent": "boolean", "tx_index": "integer", "type": "integer", "addr": "string",
    "value": "number", "n": "integer", "script": "string",
}
TRANSACTION_CONTRACT = {
    "op": ("utx",),
    "x": {
        "lock_time": "integer", "ver": "integer", "size": "integer",
        "inputs": [{"sequence": "integer", "prev_out": COIN, "script": "string"}],
        "time": "integer", "tx_index": "integer", "vin_sz": "integer", "hash": "string",
        "vout_sz": "integer", "relayed_by": "string",
        "out": [COIN],
    },
}
BLOCK_CONTRACT = {"id": "string", "height": "integer", "timestamp": "integer", "tx_count": "integer"}

# -----------------------------------------------------------------------------------------------

Contract = str | tuple | dict | list


def _elements(doc: Column, path: str) -> Column:
    return F.try_variant_get(doc, path, "array<variant>")


def usual_shape(contract: Contract) -> str:
    """What ``schema_of_variant`` says of an object that has just the required fields, all numbers plain integers.

    Lambdas are interpreted, so comparing an element's whole shape with this text is several times cheaper than a
    test per field, which is left for elements of any other shape. VARIANT keeps fields sorted by name and puts
    names that are not plain words in backticks, so no other object has the same text.
    """
    if isinstance(contract, dict):
        return "OBJECT<" + ", ".join(f"{name}: {usual_shape(contract[name])}" for name in sorted(contract)) + ">"
    return {"string": "STRING", "boolean": "BOOLEAN", "integer": "BIGINT", "number": "BIGINT"}[contract]


def conforms(doc: Column, contract: Contract, path: str = "$") -> Column:
    """Whether the value at ``path`` keeps the contract. Never NULL."""
    if isinstance(contract, dict):
        # A required field is only ever found inside an object, so the object itself needs no test.
        return reduce(and_, [conforms(doc, part, f"{path}.{name}") for name, part in contract.items()])
    if isinstance(contract, list):
        usual = usual_shape(contract[0])
        each = F.forall(
            _elements(doc, path), lambda item: (F.schema_of_variant(item) == usual) | conforms(item, contract[0])
        )
        return F.coalesce(each, F.lit(False))
    if isinstance(contract, tuple):
        return _allowed(doc, path, contract)
    return is_kind(doc, path, contract)


def shape_type(contract: Contract) -> str:
    """Type to cast a document to once, so that its leaves need no path of their own."""
    if isinstance(contract, dict):
        return "struct<" + ", ".join(f"{name}: {shape_type(part)}" for name, part in contract.items()) + ">"
    return "array<variant>" if isinstance(contract, list) else "variant"


def shape(doc: Column, contract: Contract) -> Column:
    """The document's required fields; what is missing or of another structure is NULL."""
    return F.try_variant_get(doc, "$", shape_type(contract))


def fits(shaped: Column, contract: Contract) -> Column:
    """Whether a document keeps the contract, told from its ``shape``. Never NULL."""
    if isinstance(contract, dict):
        return reduce(and_, [fits(shaped[name], part) for name, part in contract.items()])
    if isinstance(contract, list):
        usual = usual_shape(contract[0])
        each = F.forall(shaped, lambda item: (F.schema_of_variant(item) == usual) | conforms(item, contract[0]))
        return F.coalesce(each, F.lit(False))
    if isinstance(contract, tuple):
        named = F.try_variant_get(shaped, "$", "string").isin(*contract)
        return leaf_is(shaped, "string") & F.coalesce(named, F.lit(False))
    return leaf_is(shaped, contract)


def violations(doc: Column, contract: Contract, fitting: Column | None = None) -> Column:
    """Array of reasons why ``doc`` breaks the contract; empty when it keeps it, one reason when it is NULL.

    ``fitting`` is the plain test if it has been made. Reasons are only worked out for documents that fail it. Elements of
    an array share their reasons.
    """
    listed = F.array_distinct(F.array_compact(_reasons(doc, contract, "$", "")))
    return (
        F.when(doc.isNull(), F.array(F.lit("malformed JSON")))
        .when(conforms(doc, contract) if fitting is None else fitting, F.array().cast("array<string>"))
        .otherwise(listed)
    )


def _allowed(doc: Column, path: str, values: tuple) -> Column:
    return is_kind(doc, path, "string") & F.coalesce(
        F.try_variant_get(doc, path, "string").isin(*values), F.lit(False)
    )


def _reasons(doc: Column, contract: Contract, path: str, label: str) -> Column:
    """Array of reasons, with NULLs for fields that are right."""
    if isinstance(contract, dict):
        fields = [
            _reasons(doc, part, f"{path}.{name}", f"{label}.{name}" if label else name) for name, part in contract.items()
        ]
        broken = F.array(_reason(doc, path, label or "root", "object"))
        return F.when(is_kind(doc, path, "object"), F.concat(*fields)).otherwise(broken)
    if isinstance(contract, list):
        items = F.transform(_elements(doc, path), lambda item: _reasons(item, contract[0], "$", f"{label}[]"))
        return F.coalesce(F.flatten(items), F.array(_reason(doc, path, label, "array")))
    if isinstance(contract, tuple):
        return F.array(F.when(~_allowed(doc, path, contract), _reason(doc, path, label, " or ".join(contract))))
    return F.array(F.when(~is_kind(doc, path, contract), _reason(doc, path, label, contract)))


def _reason(doc: Column, path: str, label: str, expected: str) -> Column:
    found = F.try_variant_get(doc, path, "variant")
    return F.when(found.isNull(), F.lit(f"{label}: missing")).otherwise(F.lit(f"{label}: not {expected}"))
