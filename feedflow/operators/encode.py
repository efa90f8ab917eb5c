"""Rows to messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedflow.functions.json_text import row_to_json


def to_message(df: DataFrame, key: str | None = None, ignore_nulls: bool = True, lineage: tuple = ()) -> DataFrame:
    """The whole row as JSON text in ``value``.

    ``key`` names a column that becomes the message key. Columns in ``lineage`` stay outside the JSON.
    """
    body = [name for name in df.columns if name not in lineage]
    columns = [*lineage, row_to_json(body, ignore_nulls).alias("value")]
    if key is not None:
        columns.insert(0, F.col(key).cast("string").alias("key"))
    return df.select(*columns)


def variant_text(document: Column | str) -> Column:
    """A VARIANT as compact JSON text."""
    return F.to_json(document)


def utf8(text: Column | str) -> Column:
    """Text as UTF-8 bytes, the form a message value has on the wire. Spark keeps text as UTF-8, so this copies
    nothing, unlike ``encode``."""
    return (F.col(text) if isinstance(text, str) else text).cast("binary")


def with_headers(messages: DataFrame, names: tuple = ("reason", "partition", "offset")) -> DataFrame:
    """Columns that describe a message as its headers, the form a Kafka topic takes them in."""
    present = [name for name in names if name in messages.columns]
    if not present:
        return messages
    pairs = [F.when(F.col(name).isNotNull(), F.struct(F.lit(name).alias("key"), utf8(F.col(name).cast("string")).alias("value"))) for name in present]
    return messages.withColumn("headers", F.array_compact(F.array(*pairs))).drop(*present)
