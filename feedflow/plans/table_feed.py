"""Feed messages derived from the driver's tables.

Each row of ``lineitem`` becomes one transaction message, each row of ``orders`` one block message and
each row of ``events`` one log line. Every derivation is row-local: no join, no grouping, no shuffle, and
tables are read as they lie. A share of the messages is
malformed on purpose. Which one depends on the row's own attributes, so plain SQL over the same table can
state the expected outcome.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedflow.functions.once import compute_once
from feedflow.operators.encode import utf8
from feedflow.settings import FeedSettings

# l_quantity -> what is unusual about the message. Other quantities give a plain message.
TRANSACTION_DEFECTS = {
    1: "truncated",
    2: "missing_addr",
    3: "spaced_marker",
    4: "no_op",
    5: "numeric_hash",
    6: "unsigned_ver",
    7: "fractional_value",
    8: "wrong_op",
    9: "no_outputs",
    10: "boolean_ver",
    11: "null_addr",
    12: "extra_property",
    13: "height_word",
    14: "trailing_text",
    15: "blank",
    16: "array_root",
    17: "duplicate_key",
    18: "no_hash",
    19: "no_time",
    20: "far_time",
    21: "huge_value",
    22: "more_fields",
    23: "second_record",
    24: "not_a_number",
    25: "object_relay",
    26: "boolean_hash",
    30: "topicless",
    32: "topicless_no_op",
    33: "topicless_spaced",
}
LARGEST = 9223372036854775807

# o_orderpriority -> what is unusual about the block message of an order with status P.
BLOCK_DEFECTS = {
    "1-URGENT": "truncated",
    "2-HIGH": "text_height",
    "3-MEDIUM": "unsigned_nonce",
    "4-NOT SPECIFIED": "numeric_hash",
    "5-LOW": "boolean_height",
}

# The same for the producer form of the block message.
PRODUCER_DEFECTS = {
    "1-URGENT": "truncated",
    "2-HIGH": "text_height",
    "3-MEDIUM": "no_tx_count",
    "4-NOT SPECIFIED": "empty_block",
    "5-LOW": "null_block",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def feed_table_stream(spark: SparkSession, sf_dir: str, name: str, **options: object) -> DataFrame:
    """A table as a file stream.

    The last letter stands in brackets to make the path a pattern: a pattern may name a single file as well
    as a directory of part files, while a plain path must be a directory.
    """
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).options(**options).parquet(f"{sf_dir}/{name}.parque[t]")


def _cases(key: Column, names: dict) -> Column:
    column = F.lit("none")
    for value, name in names.items():
        column = F.when(key == F.lit(value), F.lit(name)).otherwise(column)
    return column


def _cents(amount: str) -> Column:
    return F.round(F.col(amount) * 100).cast("bigint")


def _epoch_seconds(column: str) -> Column:
    """Seconds since the epoch of a zone-less timestamp read as UTC."""
    return F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(column))


def _coin(addr: Column, tx_index: Column, value: Column, n: int) -> Column:
    return F.struct(
        F.lit(False).alias("spent"),
        tx_index.alias("tx_index"),
        F.lit(0).alias("type"),
        addr.alias("addr"),
        value.alias("value"),
        F.lit(n).alias("n"),
        F.lit("").alias("script"),
    )


def transaction_messages(lineitem: DataFrame, settings: FeedSettings = FeedSettings(), payload: bool = True) -> DataFrame:
    """One transaction message per line item, in the Kafka envelope; without ``payload`` the same messages with their ``value`` not derived (NULL)."""
    defect = F.col("defect")
    cents = _cents("l_extendedprice")
    tax = F.floor(cents * F.round(F.col("l_tax") * 100).cast("bigint") / 100).cast("bigint")
    paid = F.when(defect == "huge_value", F.lit(LARGEST)).otherwise(cents)
    supplier = F.when(defect != "missing_addr", F.concat(F.lit("s"), "l_suppkey"))
    outputs = (
        F.when(defect == "no_outputs", F.array())
        .when(F.col("l_tax") > 0, F.array(_coin(supplier, F.col("l_orderkey"), paid, 0),
                                          _coin(F.lit("tax"), F.col("l_orderkey"), tax, 1)))
        .otherwise(F.array(_coin(supplier, F.col("l_orderkey"), paid, 0)))
    )
    spend = F.struct(
        F.lit(4294967295).alias("sequence"),
        _coin(F.concat(F.lit("p"), "l_partkey"), F.col("l_partkey"), cents + 1, 0).alias("prev_out"),
        F.lit("").alias("script"),
    )
    transaction = F.struct(
        F.when(defect == "wrong_op", "block").when(~defect.isin("no_op", "topicless_no_op"), "utx").alias("op"),
        F.struct(
            F.lit(0).alias("lock_time"),
            F.when(defect == "unsigned_ver", F.lit(4294967295)).otherwise(F.lit(1)).alias("ver"),
            (F.lit(100) + F.col("l_quantity").cast("int")).alias("size"),
            F.array(spend).alias("inputs"),
            F.when(defect == "far_time", F.lit(LARGEST)).when(defect != "no_time", _epoch_seconds("l_shipdate")).alias("time"),
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("tx_index"),
            F.lit(1).alias("vin_sz"),
            F.when(defect != "no_hash", F.col("hash")).alias("hash"),
            F.size("outputs").alias("vout_sz"),
            F.when(defect == "height_word", "height").otherwise("0.0.0.0").alias("relayed_by"),
            F.col("outputs").alias("out"),
        ).alias("x"),
    )
    plain, marker = F.col("plain"), F.lit('"op":"utx"')
    text = (
        F.when(defect == "truncated", F.expr("substring(plain, 1, length(plain) - 7)"))
        .when(defect.isin("spaced_marker", "topicless_spaced"), F.replace(plain, marker, F.lit('"op": "utx"')))
        .when(defect == "numeric_hash", F.replace(plain, F.concat(F.lit('"hash":"'), "hash", F.lit('"')), F.lit('"hash":12')))
        .when(defect == "fractional_value", F.replace(plain, F.concat(F.lit('"value":'), cents, F.lit(",")),
                                                      F.concat(F.lit('"value":'), cents, F.lit(".5,"))))
        .when(defect == "boolean_ver", F.replace(plain, F.lit('"ver":1,'), F.lit('"ver":true,')))
        .when(defect == "null_addr", F.replace(plain, F.concat(F.lit('"addr":"s'), "l_suppkey", F.lit('"')), F.lit('"addr":null')))
        .when(defect == "extra_property", F.replace(plain, marker, F.lit('"op":"utx","note":{"seen":1}')))
        .when(defect == "not_a_number", F.replace(plain, marker, F.lit('"op":"utx","note":NaN')))
        .when(defect == "object_relay", F.replace(plain, F.lit('"relayed_by":"0.0.0.0"'), F.lit('"relayed_by":{"a":1}')))
        .when(defect == "boolean_hash", F.replace(plain, F.concat(F.lit('"hash":"'), "hash", F.lit('"')), F.lit('"hash":true')))
        .when(defect == "more_fields", F.concat(plain, F.lit(',"zzz":1')))
        .when(defect == "second_record", F.concat(plain, F.lit(',"record":{"op":"utx","x":{"hash":"other"}}')))
        .when(defect == "trailing_text", F.concat(plain, F.lit(" trailing")))
        .when(defect == "blank", F.lit("   "))
        .when(defect == "array_root", F.concat(F.lit("["), plain, F.lit("]")))
        .when(defect == "duplicate_key", F.replace(plain, marker, F.lit('"op":"old","op":"utx"')))
        .otherwise(plain)
    )
    rows = (
        lineitem.withColumn("defect", _cases(F.col("l_quantity").cast("int"), TRANSACTION_DEFECTS))
        .withColumn("hash", F.concat(F.lit("tx"), "l_orderkey", F.lit("-"), "l_linenumber"))
        .withColumn("outputs", outputs)
    )
    topic = F.when(~defect.startswith("topicless"), settings.transaction_topic)
    place = (topic, F.col("l_linenumber") - 1, F.col("l_orderkey"), F.col("l_shipdate"))
    if not payload:
        return _placed(rows.withColumn("value", F.lit(None).cast("binary")), *place)
    return _envelope(rows.withColumn("plain", F.to_json(transaction)), text, *place)


def block_messages(orders: DataFrame, settings: FeedSettings = FeedSettings()) -> DataFrame:
    """One block message per order, under native field names, in the Kafka envelope."""
    defect, n_tx = F.col("defect"), F.substring("o_orderpriority", 1, 1).cast("int")
    block = F.struct(
        F.concat(F.lit("b"), "o_orderkey").alias("hash"),
        F.lit(2).alias("ver"),
        F.concat(F.lit("b"), F.col("o_orderkey") - 1).alias("prev_block"),
        F.concat(F.lit("m"), "o_custkey").alias("mrkl_root"),
        _epoch_seconds("o_orderdate").alias("time"),
        F.lit(400000000).alias("bits"),
        _cents("o_totalprice").alias("fee"),
        F.when(defect == "unsigned_nonce", F.lit(4294967295)).otherwise(F.col("o_custkey")).alias("nonce"),
        n_tx.alias("n_tx"),
        (n_tx * 250).alias("size"),
        F.col("o_orderkey").alias("block_index"),
        (F.col("o_orderstatus") == "F").alias("main_chain"),
        F.col("o_orderkey").alias("height"),
        (n_tx * 1000).alias("weight"),
        F.transform(F.sequence(F.lit(1), n_tx),
                    lambda i: F.concat(F.lit("tx"), "o_orderkey", F.lit("-"), i)).alias("tx"),
    )
    height = F.concat(F.lit('"height":'), "o_orderkey", F.lit(","))
    plain = F.col("plain")
    text = (
        F.when(defect == "truncated", F.expr("substring(plain, 1, length(plain) - 7)"))
        .when(defect == "text_height", F.replace(plain, height, F.lit('"height":"tall",')))
        .when(defect == "numeric_hash", F.replace(plain, F.concat(F.lit('"hash":"b'), "o_orderkey", F.lit('"')), F.lit('"hash":12')))
        .when(defect == "boolean_height", F.replace(plain, height, F.lit('"height":true,')))
        .otherwise(plain)
    )
    rows = orders.withColumn("defect", _block_defect(BLOCK_DEFECTS))
    return _envelope(rows.withColumn("plain", F.to_json(block)), text, F.lit(settings.block_topic),
                     F.lit(0), F.col("o_orderkey"), F.col("o_orderdate"))


def producer_block_messages(orders: DataFrame, settings: FeedSettings = FeedSettings()) -> DataFrame:
    """One websocket-style block message per order: the block sits under the key ``block``."""
    defect = F.col("defect")
    block = F.struct(
        F.concat(F.lit("b"), "o_orderkey").alias("id"),
        F.col("o_orderkey").alias("height"),
        _epoch_seconds("o_orderdate").alias("timestamp"),
        F.when(defect != "no_tx_count", F.substring("o_orderpriority", 1, 1).cast("int")).alias("tx_count"),
    )
    plain = F.col("plain")
    text = (
        F.when(defect == "truncated", F.expr("substring(plain, 1, length(plain) - 7)"))
        .when(defect == "text_height", F.replace(plain, F.concat(F.lit('"height":'), "o_orderkey", F.lit(",")),
                                                 F.lit('"height":"tall",')))
        .when(defect == "empty_block", F.lit('{"block":{}}'))
        .when(defect == "null_block", F.lit('{"block":null}'))
        .otherwise(plain)
    )
    rows = orders.withColumn("defect", _block_defect(PRODUCER_DEFECTS))
    return _envelope(rows.withColumn("plain", F.to_json(F.struct(block.alias("block")))), text,
                     F.lit(settings.block_topic), F.lit(0), F.col("o_orderkey"), F.col("o_orderdate"))


def mixed_messages(spark: SparkSession, sf_dir: str, settings: FeedSettings = FeedSettings()) -> DataFrame:
    """Transactions and blocks together, as one subscription to both topics sees them."""
    transactions = transaction_messages(table(spark, sf_dir, "lineitem"), settings)
    return transactions.unionByName(block_messages(table(spark, sf_dir, "orders"), settings))


def mixed_message_stream(spark: SparkSession, sf_dir: str, settings: FeedSettings = FeedSettings(),
                         **options: object) -> DataFrame:
    transactions = transaction_messages(feed_table_stream(spark, sf_dir, "lineitem", **options), settings)
    return transactions.unionByName(block_messages(feed_table_stream(spark, sf_dir, "orders", **options), settings))


def log_lines(events: DataFrame) -> DataFrame:
    """One application log line per event. Levels, padding and layout follow the event type."""
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    thread = F.concat(F.lit("["), F.lit("worker "), "user_id", F.lit("]"))
    message = F.concat(F.lit("event "), "event_id", F.lit(" props "), "props")
    line = (
        F.when(F.col("event_type") == "error", F.concat_ws(" ", stamp, thread, F.lit("ERROR feed.Sink -"), message))
        .when(F.col("event_type") == "click", F.concat_ws(" ", stamp, thread, F.lit("DEBUG feed.Click -"), message))
        .when(F.col("event_type") == "purchase", F.concat_ws(" ", stamp, thread, F.lit("INFO  feed.Cart -"), message))
        .when(F.col("event_type") == "signup", F.concat(stamp, F.lit(",123 - WARNING - DEBUG "), message))
        .otherwise(F.concat(F.lit("at feed.View("), "event_id", F.lit(")")))
    )
    return events.select(line.alias("value"))


def _block_defect(names: dict) -> Column:
    return F.when(F.col("o_orderstatus") == "P", _cases(F.col("o_orderpriority"), names)).otherwise("none")


def _envelope(rows: DataFrame, text: Column, topic: Column, partition: Column, offset: Column, stamp: Column) -> DataFrame:
    """The Kafka envelope; partition and offset name a message of a topic."""
    # A filter on the text must not derive the message a second time.
    return _placed(compute_once(rows, value=utf8(text)), topic, partition, offset, stamp)


def _placed(rows: DataFrame, topic: Column, partition: Column, offset: Column, stamp: Column) -> DataFrame:
    return rows.select(
        F.lit(None).cast("binary").alias("key"),
        "value",
        topic.alias("topic"),
        partition.cast("int").alias("partition"),
        offset.cast("bigint").alias("offset"),
        stamp.cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
