"""JSON text as Spark columns: sealed parsing, VARIANT type tests, payload text."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType, VariantType

CORRUPT = "_corrupt_record"


def payload_text(value: Column | str = "value") -> Column:
    """The message payload as text."""
    return F.col(value).cast("string") if isinstance(value, str) else value.cast("string")


def is_blank(text: Column) -> Column:
    """NULL or whitespace only. JSON whitespace is space, tab, line feed and carriage return."""
    return F.coalesce(F.btrim(text, F.lit(" \t\n\r")) == "", F.lit(True))


def _seal(text: Column) -> Column:
    return F.xxhash64(text)


def text_leaves(kind: DataType) -> DataType | None:
    """The part of a type that holds its STRING leaves, with VARIANT in their place; None if there are none."""
    if isinstance(kind, StringType):
        return VariantType()
    if isinstance(kind, ArrayType):
        inner = text_leaves(kind.elementType)
        return inner and ArrayType(inner)
    if isinstance(kind, StructType):
        kept = [StructField(f.name, inner) for f in kind.fields if (inner := text_leaves(f.dataType))]
        return StructType(kept) if kept else None
    return None


def only_texts(leaves: Column, kind: DataType) -> Column:
    """Whether every leaf of ``text_leaves`` is a JSON string, null or missing. Never NULL."""
    if isinstance(kind, VariantType):
        return F.coalesce(F.schema_of_variant(leaves).isin("STRING", "VOID"), F.lit(True))
    if isinstance(kind, ArrayType):
        return F.coalesce(F.forall(leaves, lambda item: only_texts(item, kind.elementType)), F.lit(True))
    return reduce(and_, [only_texts(leaves[f.name], f.dataType) for f in kind.fields])


STRICT_JSON = {"columnNameOfCorruptRecord": CORRUPT, "allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def typed_record(text: Column, ddl: str, strict: bool) -> Column:
    """Parse JSON text into a struct.

    Lenient parsing is plain ``from_json``: fields that do not fit become NULL and malformed text becomes a
    struct of NULLs. Strict parsing returns ``struct<frame>``, to be judged by ``strictly_parsed``; the record is
    in ``frame.record``. It reads the text inside a frame, an object that holds it twice: as the record, and for the
    kinds of its STRING leaves, as Spark turns any JSON value into a string without complaint.

    Spark's JSON parser stops at the end of the first value, so text such as ``{"a":1} junk`` or two records glued
    together would pass; the frame's last field, a hash of the text, shows whether the parser read all of it. Text that
    goes on as further fields of the frame (``{"a":1},"record":{}``) is malformed where the frame holds it the second
    time, as the item of an array; text that goes on as further items is malformed the first time, as a field.
    """
    if not strict:
        return F.from_json(text, ddl)
    leaves = text_leaves(StructType.fromDDL(ddl))
    framed = F.concat(
        F.lit('{"record":'), text, F.lit(',"texts":['), text, F.lit('],"seal":'), _seal(text).cast("string"), F.lit("}"),
    )
    kinds = f", texts array<{leaves.simpleString()}>" if leaves else ""
    shape = f"record struct<{ddl}>{kinds}, seal bigint, {CORRUPT} string"
    return F.struct(F.from_json(framed, shape, STRICT_JSON).alias("frame"))


def strictly_parsed(parsed: Column, text: Column, ddl: str) -> Column:
    """Whether a strict ``typed_record`` read the whole text as one value and every field fitted its type."""
    frame, leaves = parsed["frame"], text_leaves(StructType.fromDDL(ddl))
    whole = frame["seal"].eqNullSafe(_seal(text))
    fitting = frame[CORRUPT].isNull() & frame["record"].isNotNull()
    if leaves:
        fitting = fitting & only_texts(frame["texts"][0], leaves)
    return F.coalesce(whole & fitting, F.lit(False))


def variant_frame(text: Column) -> Column:
    """``[document, hash of the text]`` as VARIANT, NULL for malformed text. See ``typed_record`` for the hash."""
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit(","), _seal(text).cast("string"), F.lit("]")))


def document(frame: Column, text: Column) -> Column:
    """The VARIANT document inside ``variant_frame``; NULL unless the parser read all of the text."""
    whole = F.try_variant_get(frame, "$[1]", "bigint").eqNullSafe(_seal(text))
    return F.when(whole, F.try_variant_get(frame, "$[0]", "variant"))


def json_type(doc: Column, path: str) -> Column:
    """Spark's name for the JSON type at ``path``; NULL where nothing is there, VOID for a JSON null."""
    return F.schema_of_variant(F.try_variant_get(doc, path, "variant"))


def is_kind(doc: Column, path: str, kind: str) -> Column:
    """JSON-Schema type test at ``path``; false where nothing is there.

    Casting is no type test: VARIANT turns ``"7"`` and ``true`` into integers on request.
    """
    if kind == "object":
        # Only an object casts to a struct, and one without fields takes nothing out of it.
        test = F.try_variant_get(doc, path, "struct<>").isNotNull()
    elif kind == "array":
        test = F.try_variant_get(doc, path, "array<variant>").isNotNull()
    else:
        found = json_type(doc, path)
        fractional = found.startswith("DECIMAL") | (found == "DOUBLE")
        if kind == "string":
            test = found == "STRING"
        elif kind == "boolean":
            test = found == "BOOLEAN"
        elif kind == "number":
            test = (found == "BIGINT") | fractional
        elif kind == "integer":
            # 5.0 and 1e3 count as integers; infinity does not.
            whole = F.try_variant_get(doc, path, "double") % 1 == 0
            test = (found == "BIGINT") | (fractional & whole)
        else:
            raise ValueError(f"unknown JSON type: {kind}")
    return F.coalesce(test, F.lit(False))


def leaf_is(value: Column, kind: str) -> Column:
    """The same test for a VARIANT that is no object and no array; its type is looked up once."""
    found = F.schema_of_variant(value)
    if kind in ("string", "boolean"):
        return F.coalesce(found == kind.upper(), F.lit(False))
    fractional = found.startswith("DECIMAL") | (found == "DOUBLE")
    if kind == "integer":
        fractional = fractional & (F.try_variant_get(value, "$", "double") % 1 == 0)
    return F.coalesce((found == "BIGINT") | fractional, F.lit(False))


def row_to_json(columns: list, ignore_nulls: bool = True) -> Column:
    """Columns packed into one JSON object. NULL fields are left out unless ``ignore_nulls`` is false."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": str(ignore_nulls).lower()})
