"""Decide what kind of record a message holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedflow.operators.decode import STRICT, check_mode
from feedflow.settings import FeedSettings

# The texts that mark the two record kinds.
TRANSACTION_MARKER = '"op":"utx"'
BLOCK_MARKER = '"height"'


def is_transaction(mode: str = STRICT, settings: FeedSettings = FeedSettings()) -> Column:
    """Predicate over ``json_data`` (compat), or over ``topic`` with ``json_data`` behind it (strict)."""
    if not check_mode(mode):
        return F.col("json_data").contains(TRANSACTION_MARKER)
    return _by_topic(settings.transaction_topic, _names_transaction())


def is_block(mode: str = STRICT, settings: FeedSettings = FeedSettings()) -> Column:
    if not check_mode(mode):
        return F.col("json_data").contains(BLOCK_MARKER)
    named = F.get_json_object("json_data", "$.height").isNotNull() | _malformed_with(BLOCK_MARKER)
    return _by_topic(settings.block_topic, named & ~_names_transaction())


def _by_topic(topic: str, by_text: Column) -> Column:
    """The topic decides; the text decides for messages that carry none. Never NULL.

    Written as an OR of topic tests so that a table laid out by topic is read for the wanted topic only.
    """
    return F.col("topic").eqNullSafe(topic) | (F.col("topic").isNull() & F.coalesce(by_text, F.lit(False)))


def _names_transaction() -> Column:
    named = F.get_json_object("json_data", "$.op") == "utx"
    return F.coalesce(named, F.lit(False)) | _malformed_with(TRANSACTION_MARKER)


def _malformed_with(marker: str) -> Column:
    """Text without readable keys that shows a marker, which makes it a dead letter of that kind."""
    return F.col("json_data").contains(marker) & F.get_json_object("json_data", "$").isNull()


def with_topic(texts: DataFrame) -> DataFrame:
    """Strict routing reads ``topic``; a source without one routes by keys alone."""
    return texts if "topic" in texts.columns else texts.withColumn("topic", F.lit(None).cast("string"))


def of_topic(texts: DataFrame, topic: str, mode: str = STRICT) -> DataFrame:
    """What strict routing to ``topic`` may take: its own messages and those without a topic; compat takes any.

    A test of the topic alone, which Spark moves below the decoding of texts, so that other topics' texts are never made.
    """
    return texts.filter(F.coalesce("topic", F.lit(topic)) == topic) if check_mode(mode) else texts


def route(texts: DataFrame, mode: str = STRICT, settings: FeedSettings = FeedSettings()) -> DataFrame:
    """Append ``route``: tx, block, both or unrouted. Strict routing never gives both."""
    texts = with_topic(texts)
    tx, block = is_transaction(mode, settings), is_block(mode, settings)
    kind = F.when(tx & block, "both").when(tx, "tx").when(block, "block").otherwise("unrouted")
    return texts.withColumn("route", kind)
