"""Transactions with the block that lists them, and how long that took."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedflow.operators.skew import left_join
from feedflow.operators.shape import event_time

# Transactions of one hash beyond which they are dealt over salts.
HOT_ROWS = 1_000_000


def transaction_times(transactions: DataFrame) -> DataFrame:
    """``hash, seen_at`` of parsed transactions; without a usable time ``seen_at`` is NULL."""
    return transactions.select(F.col("x.hash").alias("hash"), event_time("x.time").alias("seen_at"))


def block_listings(blocks: DataFrame) -> DataFrame:
    """``tx_hash, height, confirmed_at``: one row per transaction hash listed in a block."""
    return blocks.select(F.explode("tx").alias("tx_hash"), "height", event_time("time").alias("confirmed_at"))


def confirmations(
    transactions: DataFrame, listings: DataFrame, within: str, ahead: str = "0 seconds", late: str | None = None, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``transactions`` (``hash, seen_at``, ...) with ``height, confirmed_at, delay_seconds`` of each block that lists them in time.

    A block counts if its time is at most ``within`` after the transaction's and at most ``ahead`` before it (the feeds' clocks differ).
    A transaction that several blocks list gives a row for each; one that none lists gives one row of NULLs, as does one without
    a hash or a time.

    Streams need ``late``: how long either side waits for late rows. Both sides are kept until the watermark, which is the slower
    side's, has passed whatever could still match, so state is bounded by ``within + ahead + late``. Pairs come out at once, unconfirmed
    transactions once, when the watermark is past ``within`` after them. Transactions without a time are never past anything; they are left
    out of streams. Repeats of a hash share a state partition, so pass the feed through ``delivery.unique_messages`` if it repeats itself.

    Tables are joined by a shuffle on the hash; hashes with more than ``hot_rows`` transactions are dealt over salts.
    """
    seen, confirmed = F.col("seen_at"), F.col("confirmed_at")
    in_time = (confirmed >= seen - F.expr(f"INTERVAL {ahead}")) & (confirmed <= seen + F.expr(f"INTERVAL {within}"))
    if transactions.isStreaming or listings.isStreaming:
        if late is None:
            raise ValueError("a stream of confirmations needs late, or it keeps every transaction for ever")
        known = transactions.filter("seen_at IS NOT NULL").withWatermark("seen_at", late)
        listed = listings.filter("confirmed_at IS NOT NULL AND tx_hash IS NOT NULL").withWatermark("confirmed_at", late)
        joined = known.join(listed, (F.col("hash") == F.col("tx_hash")) & in_time, "left")
    else:
        joined = left_join(transactions, listings, {"hash": "tx_hash"}, hot_rows, in_time)
    delay = F.unix_seconds("confirmed_at") - F.unix_seconds("seen_at")
    return joined.select(*transactions.columns, "height", "confirmed_at", delay.alias("delay_seconds"))
