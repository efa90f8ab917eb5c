"""Flatten, extract, normalise and unnest records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Native block fields in output order, with the producer's name for those that have one.
PRODUCER_NAMES = {"hash": "id", "time": "timestamp", "n_tx": "tx_count"}
BLOCK_FIELDS = (
    "hash", "ver", "prev_block", "mrkl_root", "time", "bits", "fee", "nonce", "n_tx",
    "size", "block_index", "main_chain", "height", "weight", "tx",
)


def flatten(df: DataFrame, struct: str, *keep: str) -> DataFrame:
    """One struct level becomes columns, followed by the columns in ``keep``."""
    return df.select(f"{struct}.*", *keep)


def normalized_block(block: Column) -> Column:
    """A strictly parsed block under native names; the producer's names fill the gaps."""
    fields = [
        F.coalesce(block[name], block[PRODUCER_NAMES[name]]).alias(name) if name in PRODUCER_NAMES else block[name].alias(name)
        for name in BLOCK_FIELDS
    ]
    return F.struct(*fields)


def hash_or_na(column: str = "x.hash", default: str = "N/A") -> Column:
    """A nested text field, or ``default`` when it is missing or empty."""
    return F.coalesce(F.nullif(F.col(column), F.lit("")), F.lit(default))


# Epoch seconds of the years 1 to 9999; beyond them Spark's conversion fails the job.
FIRST_SECOND, LAST_SECOND = -62_135_596_800, 253_402_300_799


def event_time(column: str = "time") -> Column:
    """Epoch seconds as a timestamp; NULL outside the years 1 to 9999."""
    return F.timestamp_seconds(F.when(F.col(column).between(FIRST_SECOND, LAST_SECOND), F.col(column)))


def output_sum(outputs: str = "x.out") -> Column:
    """Summed value of a transaction's outputs, wide enough for any of them."""
    wide = "decimal(38,0)"
    return F.aggregate(outputs, F.lit(0).cast(wide), lambda total, coin: (total + F.coalesce(coin["value"], F.lit(0)).cast(wide)).cast(wide))


def transaction_outputs(transactions: DataFrame) -> DataFrame:
    """One row per output. Transactions without outputs give none."""
    outputs = transactions.select(F.col("x.hash").alias("hash"), F.inline("x.out"))
    return outputs.select("hash", "n", "addr", "value", "spent", "tx_index", "type", "script")


def transaction_inputs(transactions: DataFrame) -> DataFrame:
    """One row per input, with the spent coin's fields beside the input's own."""
    inputs = transactions.select(F.col("x.hash").alias("hash"), F.explode("x.inputs").alias("input"))
    return inputs.select("hash", "input.sequence", "input.prev_out.*")


def block_transactions(blocks: DataFrame) -> DataFrame:
    """One row per transaction hash listed in a block."""
    return blocks.select("height", F.explode("tx").alias("tx_hash"))
