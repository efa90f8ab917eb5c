"""The registered queries: ``(spark, sf_dir) -> DataFrame``, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedflow.functions.json_text import is_blank, json_type, row_to_json, typed_record
from feedflow.functions.once import compute_once
from feedflow.operators import bursts, confirm, delivery, encode, ledger, logs, rollup, shape, sketches
from feedflow.operators.decode import COMPAT, STRICT, decode, parse, parse_variant
from feedflow.operators.route import route
from feedflow.operators.validate import check_schema, well_formed
from feedflow.plans import feed
from feedflow.plans.table_feed import (
    block_messages,
    feed_table_stream,
    log_lines,
    mixed_message_stream,
    mixed_messages,
    producer_block_messages,
    table,
    transaction_messages,
)
from feedflow.schemas import TRANSACTION_STRICT_DDL
from feedflow.settings import FeedSettings, configure, large_state, shared_dir
from feedflow.sources.files import land, landed_stream, landed_table, log_files
from feedflow.streaming.progress import ProgressLog
from feedflow.streaming.runs import (
    finish,
    finish_all,
    start_branches,
    start_fan_out_files,
    start_ingest,
    start_logs,
    start_single_pass_files,
)
from feedflow.streaming.sinks import block_batch_sink, date_batch_sink, to_batches, to_files, transaction_batch_sink, write_json

Query = Callable[[SparkSession, str], DataFrame]

# Fields of a transaction that most queries report.
HEADER = ("x.hash", "x.tx_index", "x.time", "x.size", "x.vout_sz")
# What compat queries read of a transaction.
HEADER_DDL = "x struct<hash: string, tx_index: bigint, time: bigint, size: int, vout_sz: int>"
COIN_DDL = "struct<spent: boolean, tx_index: bigint, type: int, addr: string, value: bigint, n: int, script: string>"
OUTPUTS_DDL = f"x struct<hash: string, out: array<{COIN_DDL}>>"
SPENDS_DDL = f"x struct<hash: string, inputs: array<struct<sequence: bigint, prev_out: {COIN_DDL}>>, out: array<{COIN_DDL}>>"
TIMED_OUTPUTS_DDL = f"x struct<time: bigint, out: array<{COIN_DDL}>>"
TIMED_DDL = "x struct<hash: string, time: bigint>"
INPUTS_DDL = f"x struct<hash: string, inputs: array<struct<sequence: bigint, prev_out: {COIN_DDL}>>>"
# Bytes of each table's files, whole files, that a micro-batch of the fan-out takes and keeps on disk; the rest follows in further batches.
FAN_OUT_BYTES = 512 << 20


def _tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transaction_messages(table(spark, sf_dir, "lineitem"))


def _blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_messages(table(spark, sf_dir, "orders"))


def _producer_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return producer_block_messages(table(spark, sf_dir, "orders"))


# --- Transactions -------------------------------------------------------------------------------


def tx_parse(spark, sf_dir):
    return feed.transactions(_tx(spark, sf_dir), COMPAT, fields=HEADER_DDL).select(*HEADER)


def tx_parse_strict(spark, sf_dir):
    return feed.transactions(_tx(spark, sf_dir), STRICT).select(*HEADER, "x.ver")


def tx_dead_letter(spark, sf_dir):
    return feed.transaction_dead_letters(_tx(spark, sf_dir)).select("partition", "offset", "reason")


def tx_route_counts(spark, sf_dir):
    """Routes in both modes, from one scan."""
    texts = decode(mixed_messages(spark, sf_dir))
    for mode in (COMPAT, STRICT):
        texts = route(texts, mode).withColumnRenamed("route", mode)
    routes = F.array(*[F.struct(F.lit(mode).alias("mode"), F.col(mode).alias("route")) for mode in (COMPAT, STRICT)])
    return texts.select(F.inline(routes)).groupBy("mode", "route").agg(F.count("*").alias("n"))


def tx_outputs(spark, sf_dir):
    return shape.transaction_outputs(feed.transactions(_tx(spark, sf_dir), COMPAT, fields=OUTPUTS_DDL)).select("hash", "n", "addr", "value")


def tx_inputs(spark, sf_dir):
    inputs = shape.transaction_inputs(feed.transactions(_tx(spark, sf_dir), COMPAT, fields=INPUTS_DDL))
    return inputs.select("hash", "sequence", "addr", "value")


def tx_output_state(spark, sf_dir):
    """Every output with the number of inputs that spend it."""
    out = shared_dir(spark, "spends")
    # Outputs are read twice and inputs once: the parsed transactions are stored, so no message is derived or parsed again.
    feed.transactions(_tx(spark, sf_dir), COMPAT, fields=SPENDS_DDL).write.parquet(out)
    transactions = spark.read.parquet(out)
    return ledger.output_state(shape.transaction_outputs(transactions), shape.transaction_inputs(transactions)).select("hash", "n", "value", "spends")


def tx_top_addresses(spark, sf_dir):
    """The three addresses that received most on each day."""
    transactions = feed.transactions(_tx(spark, sf_dir), COMPAT, fields=TIMED_OUTPUTS_DDL)
    day = F.floor(F.unix_seconds(shape.event_time("x.time")) / 86400)
    coins = transactions.select(day.alias("day"), F.inline("x.out"))
    return ledger.top_addresses(coins.select("day", "addr", "value"), 3)


def _confirmations(tx: DataFrame, blocks: DataFrame, late: str | None = None) -> DataFrame:
    seen = confirm.transaction_times(feed.transactions(tx, COMPAT, fields=TIMED_DDL))
    listed = confirm.block_listings(feed.blocks(blocks, STRICT))
    found = confirm.confirmations(seen, listed, within="100 days", ahead="150 days", late=late)
    return found.select("hash", "height", "delay_seconds")


def tx_confirmations(spark, sf_dir):
    """Every transaction with the blocks that list it in time, and the delay."""
    return _confirmations(_tx(spark, sf_dir), _blocks(spark, sf_dir))


def _timed_coins(messages: DataFrame) -> DataFrame:
    """``event_time, addr, value`` of every output."""
    transactions = feed.transactions(messages, COMPAT, fields=TIMED_OUTPUTS_DDL)
    return transactions.select(shape.event_time("x.time").alias("event_time"), F.inline("x.out")).select("event_time", "addr", "value")


def _runs(coins: DataFrame, late: str | None = None) -> DataFrame:
    found = bursts.bursts(coins, "addr", 5 * 86400, late=late)
    return found.select("addr", F.unix_seconds("start").alias("start"), F.unix_seconds("last").alias("last"), "n", "value_sum")


def tx_bursts(spark, sf_dir):
    """Runs of an address' outputs that are at most five days apart."""
    return _runs(_timed_coins(_tx(spark, sf_dir)))


def tx_addresses_by_day(spark, sf_dir):
    """Distinct addresses of each day, from sketches stored by hour; whether they are within two per cent of the exact count."""
    out = shared_dir(spark, "address-sketches")
    coins = _timed_coins(_tx(spark, sf_dir))
    sketches.distinct_sketches(coins, "event_time", "addr").write.parquet(out)
    estimated = sketches.distinct_counts(spark.read.parquet(out)).withColumnRenamed("n", "estimate")
    known = coins.filter("event_time IS NOT NULL AND addr IS NOT NULL")
    exact = known.groupBy(F.date_trunc("day", "event_time").alias("bucket")).agg(F.count_distinct("addr").alias("n"))
    close = F.abs(F.col("estimate") - F.col("n")) <= 0.02 * F.col("n")
    return exact.join(estimated, "bucket", "full").select(F.col("bucket").cast("timestamp_ntz").alias("bucket"), "n", close.alias("close"))


def tx_lost_offsets(spark, sf_dir):
    """Ranges of offsets that no message has; small blocks, so that both levels have work."""
    # Places of messages only: the plan would derive every text, as nothing moves below the one evaluation of a text.
    return delivery.lost_offsets(transaction_messages(table(spark, sf_dir, "lineitem"), payload=False), block=1000)


def tx_encode_roundtrip(spark, sf_dir):
    encoded = encode.to_message(feed.transactions(_tx(spark, sf_dir), STRICT)).withColumnRenamed("value", "json_data")
    decoded = parse(encoded, TRANSACTION_STRICT_DDL, STRICT).filter("schema_valid")
    return decoded.select("parsed.x.hash", "parsed.x.time", shape.output_sum("parsed.x.out").alias("value_sum"))


def tx_valid_passthrough(spark, sf_dir):
    kept = feed.ingest_transactions(_tx(spark, sf_dir))
    return kept.select("topic", F.md5("value").alias("text_md5"))


def tx_invalid(spark, sf_dir):
    return feed.transaction_rejects(_tx(spark, sf_dir)).select("partition", "offset", "reason")


def tx_hash_default(spark, sf_dir):
    transactions = feed.transactions(_tx(spark, sf_dir), COMPAT, fields=HEADER_DDL)
    return transactions.select("x.tx_index", shape.hash_or_na("x.hash").alias("hash_or_na"))


def tx_utf8(spark, sf_dir):
    """Payload text to bytes and back."""
    place = ("partition", "offset")
    wire = decode(_tx(spark, sf_dir), keep=place).select(*place, encode.utf8("json_data").alias("value"))
    return decode(wire, keep=place).select(
        *place, F.octet_length("json_data").alias("n_bytes"), is_blank(F.col("json_data")).alias("blank")
    )


def tx_well_formed(spark, sf_dir):
    """Messages that hold one well-formed JSON value, by partition."""
    kept = well_formed(decode(_tx(spark, sf_dir)), "json_data")
    return kept.groupBy("partition").agg(F.count("*").alias("n"))


# --- Blocks -------------------------------------------------------------------------------------


def block_parse_strict(spark, sf_dir):
    return feed.blocks(_blocks(spark, sf_dir), STRICT).select("height", "n_tx", "time", "nonce", "schema_valid")


def block_parse_compat(spark, sf_dir):
    return feed.blocks(_blocks(spark, sf_dir), COMPAT).select("hash", "height", "n_tx", "time", "nonce", "schema_valid")


def block_dead_letter(spark, sf_dir):
    return feed.block_dead_letters(_blocks(spark, sf_dir), STRICT).select("value", "reason")


def block_dead_letter_compat(spark, sf_dir):
    """The lenient parse fails for blank text only. Routing by marker keeps that away from it, so a direct parse shows it."""
    return feed.block_dead_letters_both_ways(mixed_messages(spark, sf_dir))


def block_extract_normalize(spark, sf_dir):
    kept = feed.ingest_blocks(_producer_blocks(spark, sf_dir))
    return feed.blocks(kept, STRICT).select("hash", "height", "time", "n_tx")


def block_ingest_compat(spark, sf_dir):
    """Producer-form blocks read with native names only: the height alone survives."""
    kept = feed.ingest_blocks(_producer_blocks(spark, sf_dir))
    return feed.blocks(kept, COMPAT).select("hash", "height", "time", "n_tx")


def block_ingest_text(spark, sf_dir):
    kept = feed.ingest_blocks(_producer_blocks(spark, sf_dir))
    return kept.select("topic", F.col("value").cast("string").alias("value"))


def block_invalid(spark, sf_dir):
    return feed.block_rejects(_producer_blocks(spark, sf_dir)).select("offset", "reason")


def block_tx_explode(spark, sf_dir):
    return shape.block_transactions(feed.blocks(_blocks(spark, sf_dir), STRICT))


# --- The whole feed -----------------------------------------------------------------------------


def feed_outputs(spark, sf_dir):
    """All outputs of the strict feed, from one pass, counted by topic and reason."""
    outputs = feed.classify(mixed_messages(spark, sf_dir), STRICT)
    return outputs.groupBy("topic", "reason").agg(F.count("*").alias("n"))


def _texts(outputs: DataFrame) -> DataFrame:
    return outputs.select("topic", F.md5(F.col("value").cast("binary")).alias("text_md5"), "reason", "partition", "offset")


def feed_texts(spark, sf_dir):
    """Every output of the strict feed: the text published or refused, the reason, and the message it comes from."""
    return _texts(feed.classify(mixed_messages(spark, sf_dir), STRICT))


def feed_outputs_compat(spark, sf_dir):
    outputs = feed.classify(mixed_messages(spark, sf_dir), COMPAT)
    return outputs.groupBy("topic", "reason").agg(F.count("*").alias("n"))


def feed_block_values(spark, sf_dir):
    """The published text of every valid block."""
    outputs = feed.classify(_blocks(spark, sf_dir), STRICT)
    published = outputs.filter(F.col("topic") == FeedSettings().processed_block_topic)
    return published.select(F.get_json_object("value", "$.height").cast("bigint").alias("height"), F.md5("value").alias("text_md5"))


# --- JSON in tables we did not build -------------------------------------------------------------


def events_json_props(spark, sf_dir):
    """``props`` read both ways: with a schema and as a schema-free document."""
    rows = parse_variant(table(spark, sf_dir, "events").select("event_id", "props"), "props")
    return rows.select(
        "event_id",
        typed_record(F.col("props"), "k int", strict=False)["k"].alias("k"),
        F.try_variant_get("doc", "$.k", "bigint").alias("k_document"),
        json_type(F.col("doc"), "$.k").alias("k_type"),
        encode.variant_text("doc").alias("compact"),
    )


def events_encode(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    encoded = compute_once(events, json=row_to_json(events.columns))
    back = compute_once(encoded.select("json"), row=F.from_json("json", "event_id bigint, user_id bigint, event_type string, value double"))
    return back.select("row.*")


EVENT_SCHEMA = """
{
  "type": "object",
  "properties": {
    "event_id": {"type": "integer", "minimum": 0},
    "user_id": {"type": "integer", "exclusiveMaximum": 140},
    "event_type": {"type": "string", "pattern": "^[^v]", "maxLength": 6},
    "value": {"oneOf": [{"maximum": 50}, {"minimum": 25}]},
    "props": {"type": "object", "properties": {"k": {"type": "integer", "minimum": 10}}, "required": ["k"], "additionalProperties": false}
  },
  "required": ["event_id", "event_type", "value"],
  "additionalProperties": {"type": "string"}
}
"""


def events_schema_check(spark, sf_dir):
    """Every event as a JSON message, judged by a schema document: all its reasons, or none."""
    fields = ("event_id", "user_id", "event_type", "value")
    events = table(spark, sf_dir, "events")
    texts = events.select("event_id", row_to_json([*fields, F.try_parse_json("props").alias("props")]).alias("json_data"))
    return check_schema(parse_variant(texts), EVENT_SCHEMA).select("event_id", "valid", F.array_join("errors", "; ").alias("reason"))


def events_valid_filter(spark, sf_dir):
    kept = well_formed(table(spark, sf_dir, "events"), "props")
    return kept.groupBy("event_type").agg(F.count("*").alias("n"))


# --- Streams ------------------------------------------------------------------------------------


def stream_tx_available_now(spark, sf_dir):
    """The table as a file stream, through the feed, into Parquet files."""
    out = shared_dir(spark, "stream-tx")
    messages = transaction_messages(feed_table_stream(spark, sf_dir, "lineitem"))
    parsed = feed.transactions(messages, COMPAT, fields=HEADER_DDL).select(*HEADER)
    finish(to_files(parsed, f"{out}/data", f"{out}/checkpoint", once=True))
    return spark.read.schema(parsed.schema).parquet(f"{out}/data")


def stream_single_pass(spark, sf_dir):
    """Every output of the feed from one streaming query with one scan."""
    out = shared_dir(spark, "stream-single-pass")
    finish(start_single_pass_files(mixed_message_stream(spark, sf_dir), f"{out}/data", f"{out}/checkpoint", once=True))
    return _texts(spark.read.parquet(f"{out}/data"))


def stream_fan_out(spark, sf_dir):
    """The same outputs through a callback with one sink per topic."""
    out = shared_dir(spark, "stream-fan-out")
    messages = mixed_message_stream(spark, sf_dir, maxBytesPerTrigger=FAN_OUT_BYTES)
    finish(start_fan_out_files(messages, f"{out}/data", f"{out}/checkpoint", once=True))
    return _texts(spark.read.parquet(f"{out}/data"))


def stream_restart(spark, sf_dir):
    """Stop after the first half of a landed feed, land the second half, go on from the checkpoint."""
    out = shared_dir(spark, "stream-restart")
    lineitem = table(spark, sf_dir, "lineitem")
    first_half = F.col("l_linestatus").eqNullSafe("O")
    for half in (first_half, ~first_half):
        land(transaction_messages(lineitem.filter(half)), f"{out}/landed")
        parsed = feed.transactions(landed_stream(spark, f"{out}/landed"), COMPAT, fields=HEADER_DDL).select(*HEADER)
        finish(to_files(parsed, f"{out}/data", f"{out}/checkpoint", once=True))
    return spark.read.schema(parsed.schema).parquet(f"{out}/data")


def stream_replay(spark, sf_dir):
    """A feed of which the first half is delivered again, with the second half, after a restart: each message once.

    The tables are in no order of time, so a delivery may be as late as the whole table is long.
    """
    out = shared_dir(spark, "stream-replay")
    lineitem = table(spark, sf_dir, "lineitem")
    for part in (lineitem.filter("l_linestatus = 'F'"), lineitem):
        land(transaction_messages(part), f"{out}/landed")
        once = delivery.unique_messages(landed_stream(spark, f"{out}/landed"), late="4000 days")
        finish(to_files(once.select("topic", "partition", "offset"), f"{out}/data", f"{out}/checkpoint", once=True))
    return spark.read.parquet(f"{out}/data")


def stream_confirmations(spark, sf_dir):
    """Both feeds as streams: pairs, and transactions that stayed unconfirmed until the watermark was past their time."""
    out = shared_dir(spark, "stream-confirmations")
    tx = transaction_messages(feed_table_stream(spark, sf_dir, "lineitem"))
    found = _confirmations(tx, block_messages(feed_table_stream(spark, sf_dir, "orders")), late="36 hours")
    with large_state(spark):
        query = to_files(found, f"{out}/data", f"{out}/checkpoint", once=True)
    finish(query)
    return spark.read.schema(found.schema).parquet(f"{out}/data")


def stream_bursts(spark, sf_dir):
    """Runs of a stream that its watermark has closed."""
    out = shared_dir(spark, "stream-bursts")
    found = _runs(_timed_coins(transaction_messages(feed_table_stream(spark, sf_dir, "lineitem"))), late="36 hours")
    finish(to_files(found, f"{out}/data", f"{out}/checkpoint", once=True))
    return spark.read.schema(found.schema).parquet(f"{out}/data")


def stream_by_date(spark, sf_dir):
    """Events of a stream stored by date, then compacted; every row from the compacted days."""
    out = shared_dir(spark, "stream-by-date")
    events = feed_table_stream(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    finish(to_batches(events, date_batch_sink(f"{out}/batches", "ts"), f"{out}/checkpoint", once=True))
    rollup.compact_days(spark.read.parquet(f"{out}/batches"), f"{out}/days", "event_id")
    return spark.read.parquet(f"{out}/days").select("event_date", "event_id", "event_type", "value")


def _published(spark: SparkSession, settings: FeedSettings) -> DataFrame:
    """What streams have published as files, every topic."""
    return spark.read.format(settings.message_format).load(settings.message_path)


def _file_settings(spark: SparkSession, name: str) -> FeedSettings:
    out = shared_dir(spark, name)
    return FeedSettings(checkpoint_base=f"{out}/checkpoints", message_format="parquet", message_path=f"{out}/messages")


def stream_publish_batches(spark, sf_dir):
    """Typed records published by the callbacks, one per kind."""
    settings = _file_settings(spark, "publish")
    messages = mixed_message_stream(spark, sf_dir)
    finish_all({
        "tx": to_batches(feed.transactions(messages), transaction_batch_sink(settings), settings.checkpoint("tx"), once=True),
        "block": to_batches(feed.blocks(messages), block_batch_sink(settings), settings.checkpoint("block"), once=True),
    })
    return _published(spark, settings).select("topic", F.md5(F.col("value").cast("binary")).alias("text_md5"))


def stream_three_queries(spark, sf_dir):
    """The feed as one query per output, side by side, each with its own checkpoint; dead letters with their reason."""
    settings = _file_settings(spark, "branches")
    finish_all(start_branches(mixed_message_stream(spark, sf_dir), settings, STRICT, once=True))
    topics = (settings.processed_transaction_topic, settings.processed_block_topic, settings.invalid_block_topic, settings.invalid_transaction_topic)
    parts = [spark.read.parquet(settings.topic_path(topic)).withColumn("topic", F.lit(topic)) for topic in topics]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return rows.select("topic", F.md5(F.col("value").cast("binary")).alias("text_md5"), "reason")


def stream_ingest(spark, sf_dir):
    """Producers' messages to validated topics as streams, then through the feed."""
    settings = _file_settings(spark, "ingest")
    raw_transactions = transaction_messages(feed_table_stream(spark, sf_dir, "lineitem"))
    raw_blocks = producer_block_messages(feed_table_stream(spark, sf_dir, "orders"))
    finish_all(start_ingest(raw_transactions, raw_blocks, settings, once=True))
    outputs = feed.classify(_published(spark, settings), STRICT)
    return outputs.select("topic", F.md5(F.col("value").cast("binary")).alias("text_md5"), "reason")


def stream_logs(spark, sf_dir):
    """Log files as they are rotated in, parsed, without debug messages, to the log topic."""
    settings = _file_settings(spark, "logs")
    files = shared_dir(spark, "log-files")
    log_lines(table(spark, sf_dir, "events")).write.text(files)
    finish(start_logs(log_files(spark, files), settings, once=True))
    return _published(spark, settings).select("value")


def stream_metrics(spark, sf_dir):
    """Rows read by a query, from the table of its micro-batches."""
    out = shared_dir(spark, "metrics")
    progress = ProgressLog(spark, f"{out}/metrics")
    spark.streams.addListener(progress)
    try:
        parsed = feed.transactions(transaction_messages(feed_table_stream(spark, sf_dir, "lineitem")), COMPAT).select("x.hash")
        query = finish(to_files(parsed, f"{out}/data", f"{out}/checkpoint", once=True))
        progress.wait_for(str(query.id))
    finally:
        spark.streams.removeListener(progress)
    own = progress.metrics().filter(F.col("query") == str(query.id))
    return own.agg(F.sum("input_rows").alias("input_rows"), F.min("batch_id").alias("first_batch"))


def stream_tx_rollup(spark, sf_dir):
    """The hourly rollup of a stream: buckets that its watermark has closed."""
    out = shared_dir(spark, "stream-rollup")
    messages = transaction_messages(feed_table_stream(spark, sf_dir, "lineitem"))
    rolled = rollup.transaction_rollup(feed.transactions(messages), late="3 days")
    finish(to_files(rolled, f"{out}/data", f"{out}/checkpoint", once=True))
    return spark.read.schema(rolled.schema).parquet(f"{out}/data").withColumn("bucket", F.col("bucket").cast("timestamp_ntz"))


def blocks_json_files(spark, sf_dir):
    """Typed blocks as JSON files, read back under their schema."""
    out = shared_dir(spark, "json")
    blocks = feed.blocks(_blocks(spark, sf_dir), STRICT)
    write_json(blocks, out)
    return spark.read.schema(blocks.schema).json(out).select("height", "n_tx", "time", "nonce", "schema_valid")


def landed_blocks(spark, sf_dir):
    """Both feeds landed as raw messages, then one of them read back and parsed."""
    out = shared_dir(spark, "landed")
    land(mixed_messages(spark, sf_dir), out)
    return feed.blocks(landed_table(spark, out), STRICT).select("height", "n_tx", "time", "nonce", "schema_valid")


# --- Logs ---------------------------------------------------------------------------------------


def log_parse(spark, sf_dir):
    records = logs.drop_debug(logs.parse_lines(log_lines(table(spark, sf_dir, "events")), STRICT))
    return records.groupBy("level", "thread", "parsed").agg(F.count("*").alias("n"))


def log_parse_compat(spark, sf_dir):
    records = logs.drop_debug(logs.parse_lines(log_lines(table(spark, sf_dir, "events")), COMPAT))
    return records.select("timestamp", "thread", "level", "logger", "message", "log")


def log_messages(spark, sf_dir):
    records = logs.drop_debug(logs.parse_lines(log_lines(table(spark, sf_dir, "events")), STRICT))
    return logs.log_messages(records)


# --- Rollups ------------------------------------------------------------------------------------


def tx_hourly_rollup(spark, sf_dir):
    rolled = rollup.transaction_rollup(feed.transactions(_tx(spark, sf_dir), STRICT))
    return rolled.withColumn("bucket", F.col("bucket").cast("timestamp_ntz"))


def tx_rollup_rejects(spark, sf_dir):
    """Transactions that no bucket of the rollup holds."""
    rejects = rollup.transaction_rollup_rejects(feed.transactions(_tx(spark, sf_dir), STRICT))
    return rejects.select("x.tx_index", "reason")


def events_hourly_rollup(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return rollup.bucket_rollup(events, "ts", "1 hour", ("event_type",), n=F.count("*"))


def log_level_rollup(spark, sf_dir):
    records = logs.parse_lines(log_lines(table(spark, sf_dir, "events")), STRICT)
    return rollup.log_rollup(records).withColumn("bucket", F.col("bucket").cast("timestamp_ntz"))


def events_by_date(spark, sf_dir):
    """Events stored by date, then read back; the date is a directory, not a column of the files."""
    out = shared_dir(spark, "events-by-date")
    rollup.store_by_date(table(spark, sf_dir, "events"), "ts", out)
    stored = spark.read.parquet(out)
    return stored.groupBy("event_date", "event_type").agg(F.count("*").alias("n"), F.max("value").alias("value_max"))


def events_percentiles(spark, sf_dir):
    """Percentiles of each day and kind of event, from sketches stored by hour; whether their rank is within one per cent."""
    out = shared_dir(spark, "value-sketches")
    events = table(spark, sf_dir, "events")
    sketches.quantile_sketches(events, "ts", "value", keys=("event_type",)).write.parquet(out)
    found = sketches.quantiles(spark.read.parquet(out), (0.5, 0.95, 0.99), keys=("event_type",)).withColumnRenamed("value", "estimate")
    values = events.select(F.date_trunc("day", "ts").alias("bucket"), "event_type", "value").filter("value IS NOT NULL AND NOT isnan(value)")
    keys = ("bucket", "event_type", "n", "fraction")
    ranks = found.join(values, ["bucket", "event_type"]).groupBy(*keys).agg(
        F.count_if(F.col("value") < F.col("estimate")).alias("below"), F.count_if(F.col("value") <= F.col("estimate")).alias("upto")
    )
    # One row is the least by which a rank can be off.
    slack = F.greatest(0.01 * F.col("n"), F.lit(1))
    close = F.col("fraction").between((F.col("below") - slack) / F.col("n"), (F.col("upto") + slack) / F.col("n"))
    return ranks.select(F.col("bucket").cast("timestamp_ntz").alias("bucket"), "event_type", "n", "fraction", close.alias("close"))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        tx_parse, tx_parse_strict, tx_dead_letter, tx_route_counts, tx_outputs, tx_inputs, tx_output_state, tx_top_addresses, tx_lost_offsets,
        tx_confirmations, tx_bursts, tx_addresses_by_day, tx_encode_roundtrip,
        tx_valid_passthrough, tx_invalid, tx_hash_default, tx_utf8, tx_well_formed,
        block_parse_strict, block_parse_compat, block_dead_letter, block_dead_letter_compat, block_extract_normalize,
        block_ingest_compat, block_ingest_text, block_invalid, block_tx_explode,
        feed_outputs, feed_texts, feed_outputs_compat, feed_block_values,
        events_json_props, events_encode, events_schema_check, events_valid_filter,
        stream_tx_available_now, stream_single_pass, stream_fan_out, stream_restart, stream_replay, stream_confirmations, stream_bursts, stream_by_date, landed_blocks,
        stream_publish_batches, stream_three_queries, stream_ingest, stream_logs, stream_metrics, stream_tx_rollup, blocks_json_files,
        log_parse, log_parse_compat, log_messages,
        tx_hourly_rollup, tx_rollup_rejects, events_hourly_rollup, log_level_rollup, events_by_date, events_percentiles,
    )
}


def run(name: str) -> Query:
    """The query with the session settings the operators rely on."""
    return lambda spark, sf_dir: QUERIES[name](configure(spark), sf_dir)
