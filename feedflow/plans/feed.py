"""The feed's dataflows as plans over the message envelope."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedflow.functions.json_text import row_to_json, typed_record
from feedflow.functions.once import compute_once
from feedflow.operators.decode import COMPAT, STRICT, check_mode, decode, parse, refusal
from feedflow.operators.encode import utf8, variant_text
from feedflow.operators.route import is_block, is_transaction, of_topic, with_topic
from feedflow.operators.shape import BLOCK_FIELDS, flatten, normalized_block
from feedflow.operators.validate import accepted, check_blocks, check_transactions, conforming_transactions, rejected
from feedflow.schemas import BLOCK_DDL, BLOCK_STRICT_DDL, TRANSACTION_DDL, TRANSACTION_STRICT_DDL
from feedflow.settings import FeedSettings

# --- From raw feed messages to validated topics -------------------------------------------------


def ingest_transactions(messages: DataFrame, settings: FeedSettings = FeedSettings()) -> DataFrame:
    """Messages that keep the transaction contract, with their original text."""
    valid = conforming_transactions(decode(messages))
    return valid.select(F.lit(settings.transaction_topic).alias("topic"), utf8("json_data").alias("value"))


def ingest_blocks(messages: DataFrame, settings: FeedSettings = FeedSettings()) -> DataFrame:
    """The ``block`` object of messages that keep the block contract, written out again as JSON."""
    valid = accepted(check_blocks(decode(messages)))
    return valid.select(F.lit(settings.block_topic).alias("topic"), utf8(variant_text("block")).alias("value"))


def transaction_rejects(messages: DataFrame) -> DataFrame:
    return rejected(check_transactions(decode(messages)))


def block_rejects(messages: DataFrame) -> DataFrame:
    return rejected(check_blocks(decode(messages)))


# --- From validated topics to typed records -----------------------------------------------------


def _op_refusal(record: Column) -> Column:
    return F.when(~record["op"].eqNullSafe(F.lit("utx")), "op: not utx")


def _height_refusal(record: Column) -> Column:
    return F.when(record["height"].isNull(), "height: missing")


def transaction_attempts(
    messages: DataFrame, mode: str = STRICT, settings: FeedSettings = FeedSettings(), fields: str | None = None
) -> DataFrame:
    """Every message routed as a transaction, parsed, with its validity.

    ``fields`` is DDL of the fields that are wanted, for compat: a parse of those alone gives the same values and is cheaper.
    Strict judges whole records, so it reads them whole.
    """
    strict = check_mode(mode)
    if strict and fields:
        raise ValueError("strict parsing judges whole records; fields are for compat")
    texts = of_topic(with_topic(decode(messages)), settings.transaction_topic, mode).filter(is_transaction(mode, settings))
    ddl = TRANSACTION_STRICT_DDL if strict else fields or TRANSACTION_DDL
    return parse(texts, ddl, mode, _op_refusal(F.col("parsed")) if strict else None)


def block_attempts(messages: DataFrame, mode: str = STRICT, settings: FeedSettings = FeedSettings()) -> DataFrame:
    """Every message routed as a block, parsed, with its validity."""
    strict = check_mode(mode)
    texts = of_topic(with_topic(decode(messages)), settings.block_topic, mode).filter(is_block(mode, settings))
    return parse(texts, BLOCK_STRICT_DDL if strict else BLOCK_DDL, mode, _height_refusal(F.col("parsed")) if strict else None)


def transactions(
    messages: DataFrame, mode: str = STRICT, settings: FeedSettings = FeedSettings(), fields: str | None = None
) -> DataFrame:
    """Typed transactions: ``op``, ``x``, or the ``fields`` asked for (compat)."""
    return flatten(transaction_attempts(messages, mode, settings, fields).filter("schema_valid"), "parsed")


def blocks(messages: DataFrame, mode: str = STRICT, settings: FeedSettings = FeedSettings()) -> DataFrame:
    """Typed blocks under native names, and ``schema_valid``."""
    valid = block_attempts(messages, mode, settings).filter("schema_valid")
    if mode == STRICT:
        valid = valid.withColumn("parsed", normalized_block(F.col("parsed")))
    return flatten(valid, "parsed", "schema_valid")


def dead_letters(attempts: DataFrame, *keep: str) -> DataFrame:
    """The original text of every failed attempt, followed by the columns in ``keep``; strict adds lineage and the reason."""
    extra = [name for name in ("topic", "partition", "offset", "reason") if name in attempts.columns]
    extra = extra if "reason" in extra else []
    return attempts.filter("NOT schema_valid").select(F.col("raw_json").cast("string").alias("value"), *extra, *keep)


def block_dead_letters(messages: DataFrame, mode: str = STRICT, settings: FeedSettings = FeedSettings()) -> DataFrame:
    return dead_letters(block_attempts(messages, mode, settings))


def block_dead_letters_both_ways(messages: DataFrame, settings: FeedSettings = FeedSettings()) -> DataFrame:
    """``value, routed``: compat dead letters of messages routed as blocks (``routed``) and of a direct parse of every message.

    A message routed as a block fails both ways or neither, so one scan and one parse per record serve both.
    """
    texts = decode(messages)
    attempts = parse(texts.withColumn("_is_block", is_block(COMPAT, settings)), BLOCK_DDL, COMPAT)
    ways = F.array_compact(F.array(F.when(F.col("_is_block"), True), F.lit(False)))
    return dead_letters(attempts, "_is_block").select("value", F.explode(ways).alias("routed"))


def transaction_dead_letters(messages: DataFrame, settings: FeedSettings = FeedSettings()) -> DataFrame:
    return dead_letters(transaction_attempts(messages, STRICT, settings))


# --- All branches in one pass -------------------------------------------------------------------


def classify(messages: DataFrame, mode: str = STRICT, settings: FeedSettings = FeedSettings()) -> DataFrame:
    """Every output message of the feed with its target ``topic``, from one scan and one parse per record.

    Columns: ``topic``, ``value``, ``reason``, and the input's ``partition`` and ``offset`` if it has them. A sink that takes the topic from a column, or a file sink
    partitioned by it, publishes all branches in a single query. Compat leaves unrouted messages out and may
    send one message to both outputs; strict gives exactly one row per message.
    """
    strict = check_mode(mode)
    texts, text = with_topic(decode(messages)), F.col("json_data")
    rest = [name for name in ("partition", "offset") if name in texts.columns]
    tx_ddl, block_ddl = (TRANSACTION_STRICT_DDL, BLOCK_STRICT_DDL) if strict else (TRANSACTION_DDL, BLOCK_DDL)
    routed = compute_once(
        texts.select("json_data", *rest, is_transaction(mode, settings).alias("_is_tx"), is_block(mode, settings).alias("_is_block")),
        _tx=F.when(F.col("_is_tx"), typed_record(text, tx_ddl, strict)),
        _block=F.when(F.col("_is_block"), typed_record(text, block_ddl, strict)),
    )
    # Each kind is judged for its own rows only.
    def tx_rows(value: Column) -> Column:
        return F.when(F.col("_is_tx"), value)

    def block_rows(value: Column) -> Column:
        return F.when(F.col("_is_block"), value)

    if strict:
        tx, block = F.col("_tx"), F.col("_block")
        judged = routed.select(
            "json_data", "_is_tx", "_is_block", *rest, tx["frame"]["record"].alias("_tx"),
            block_rows(normalized_block(block["frame"]["record"])).alias("_block"),
            tx_rows(F.coalesce(refusal(tx, text, tx_ddl), _op_refusal(tx["frame"]["record"]))).alias("_tx_reason"),
            block_rows(F.coalesce(refusal(block, text, block_ddl), _height_refusal(block["frame"]["record"]))).alias("_block_reason"),
        )
    else:
        judged = routed.withColumns({
            "_tx_reason": tx_rows(F.when(F.col("_tx").isNull(), "blank message")),
            "_block_reason": block_rows(F.when(F.col("_block").isNull(), "blank message")),
        })

    def out(when: Column, topic: str, value: Column, reason: Column = F.lit(None).cast("string")) -> Column:
        return F.when(when, F.struct(F.lit(topic).alias("topic"), value.alias("value"), reason.alias("reason")))

    is_tx, is_blk = F.col("_is_tx"), F.col("_is_block")
    tx_ok, block_ok = F.col("_tx_reason").isNull(), F.col("_block_reason").isNull()
    block_row = [F.col("_block")[name].alias(name) for name in BLOCK_FIELDS]
    tx_out = out(is_tx & tx_ok, settings.processed_transaction_topic, row_to_json(["_tx.op", "_tx.x"]))
    block_out = F.coalesce(
        out(is_blk & block_ok, settings.processed_block_topic, row_to_json([*block_row, F.lit(True).alias("schema_valid")])),
        out(is_blk & ~block_ok, settings.invalid_block_topic, text, F.col("_block_reason")),
    )
    if strict:
        tx_out = F.coalesce(tx_out, out(is_tx & ~tx_ok, settings.invalid_transaction_topic, text, F.col("_tx_reason")))
        block_out = F.coalesce(block_out, out(~is_tx & ~is_blk, settings.unrouted_topic, text, F.lit("unrouted")))
    # An array of a fixed length: for one of unknown length Spark would first filter on its size, computing it twice.
    outputs = judged.select(*rest, tx_out.alias("_tx_out"), block_out.alias("_block_out"))
    return outputs.select(F.inline(F.array("_tx_out", "_block_out")), *rest).filter(F.col("topic").isNotNull())
