"""Payload decoding and JSON parsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedflow.functions.json_text import (
    document,
    is_blank,
    payload_text,
    strictly_parsed,
    typed_record,
    variant_frame,
)
from feedflow.functions.once import compute_once

COMPAT, STRICT = "compat", "strict"


def check_mode(mode: str) -> bool:
    """True for strict, false for compat."""
    if mode not in (COMPAT, STRICT):
        raise ValueError(f"mode must be {COMPAT!r} or {STRICT!r}, not {mode!r}")
    return mode == STRICT


def decode(messages: DataFrame, keep: tuple = ("topic", "partition", "offset")) -> DataFrame:
    """Envelope to text: ``json_data`` next to those lineage columns in ``keep`` that the input has."""
    lineage = [name for name in keep if name in messages.columns]
    return messages.select(*lineage, payload_text("value").alias("json_data"))


def refusal(parsed: Column, text: Column, ddl: str) -> Column:
    """Why a strict parse fails; NULL when it succeeds."""
    return (
        F.when(is_blank(text), "blank message")
        .when(~F.is_valid_utf8(text), "not valid UTF-8")
        .when(~strictly_parsed(parsed, text, ddl), "malformed or mistyped JSON")
    )


def parse(texts: DataFrame, ddl: str, mode: str = STRICT, refuse: Column | None = None) -> DataFrame:
    """Parse ``json_data`` into ``parsed``, next to ``raw_json``, ``schema_valid`` and (strict) ``reason``.

    Compat counts a row as valid when ``from_json`` returns non-NULL, which holds for all but blank text. Strict
    asks for whole, well-formed, well-typed JSON, and for ``refuse`` to be NULL: an expression over ``parsed``
    that names a further reason.
    """
    strict = check_mode(mode)
    rest = [name for name in texts.columns if name != "json_data"]
    text = F.col("json_data")
    if not strict:
        rows = compute_once(texts, parsed=typed_record(text, ddl, strict=False))
        return rows.select(*rest, "parsed", text.alias("raw_json"), F.col("parsed").isNotNull().alias("schema_valid"))
    rows = compute_once(texts, attempt=typed_record(text, ddl, strict=True))
    rows = rows.select(
        *rest, F.col("attempt.frame.record").alias("parsed"), text.alias("raw_json"), refusal(F.col("attempt"), text, ddl).alias("_refused")
    )
    # Judging walks through arrays, so it is done once as well.
    reason = F.col("_refused") if refuse is None else F.coalesce("_refused", refuse)
    return compute_once(rows, reason=reason).drop("_refused").withColumn("schema_valid", F.col("reason").isNull())


def parse_variant(texts: DataFrame, column: str = "json_data", alias: str = "doc") -> DataFrame:
    """Append the text in ``column`` as VARIANT; NULL for malformed text or text with anything behind the value."""
    text = F.col(column)
    framed = compute_once(texts, _frame=variant_frame(text))
    return framed.withColumn(alias, document(F.col("_frame"), text)).drop("_frame")
