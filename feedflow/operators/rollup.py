"""Time-bucket rollups over parsed feeds and logs.

Every aggregate here is a count, sum or average, which Spark combines inside each map task before the shuffle, so
a bucket that holds most of the rows reaches its reducer as one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedflow.operators.shape import event_time, output_sum


def bucket_rollup(
    df: DataFrame, time: str, width: str, keys: tuple = (), late: str | None = None, **aggregates: Column
) -> DataFrame:
    """``aggregates`` per time bucket and ``keys``. ``bucket`` is the start of the bucket.

    ``late`` is for streams: how long a bucket waits for late rows before it is final. Without it a stream keeps the
    state of every bucket for ever.
    """
    if late is not None:
        df = df.withWatermark(time, late)
    grouped = df.groupBy(F.window(time, width).alias("_window"), *keys).agg(
        *[column.alias(name) for name, column in aggregates.items()]
    )
    return grouped.select(F.col("_window.start").alias("bucket"), *keys, *aggregates)


def transaction_rollup(transactions: DataFrame, width: str = "1 hour", late: str | None = None) -> DataFrame:
    """Transactions, summed output value and average size per bucket. Sums are decimals, so no message overflows them.

    Transactions without a usable time are in no bucket; ``transaction_rollup_rejects`` accounts for them.
    """
    rows = transactions.select(event_time("x.time").alias("event_time"), output_sum().alias("value"), F.col("x.size").alias("size"))
    return bucket_rollup(
        rows.filter("event_time IS NOT NULL"), "event_time", width, late=late, n=F.count("*"), value_sum=F.sum("value").cast("decimal(38,0)"),
        size_avg=F.avg("size"),
    )


def transaction_rollup_rejects(transactions: DataFrame) -> DataFrame:
    """The transactions that no bucket holds, with the reason."""
    reason = F.when(F.col("x.time").isNull(), "time: missing").when(event_time("x.time").isNull(), "time: out of range")
    return transactions.withColumn("reason", reason).filter("reason IS NOT NULL")


def log_rollup(records: DataFrame, width: str = "1 hour", late: str | None = None) -> DataFrame:
    """Parsed log records per bucket and level. Lines without a time have no bucket; count ``event_time IS NULL`` for them."""
    return bucket_rollup(records.filter("event_time IS NOT NULL"), "event_time", width, ("level",), late, n=F.count("*"))


def store_by_date(df: DataFrame, time: Column | str, path: str, mode: str = "append") -> None:
    """Time-series layout: Parquet partitioned by ``event_date``, so a time filter reads only its days.

    The rebalance brings a day's rows together, which keeps the number of files near the number of days instead
    of days times tasks. Adaptive execution splits a day that is much larger than the others over several tasks.
    """
    dated = df.withColumn("event_date", F.to_date(time)).hint("rebalance", "event_date")
    dated.write.mode(mode).partitionBy("event_date").parquet(path)


def compact_days(batches: DataFrame, path: str, look_up: str, row_group_bytes: int = 128 << 20) -> None:
    """Days of a table written by ``date_batch_sink`` as few large files at ``path``; a day that is compacted again replaces itself.

    ``batches`` is that table, or the days of it that are wanted. Files are sorted by ``look_up`` and carry Bloom filters of it, so a search for one
    value opens few row groups. Adaptive execution splits days that are too large for one task.
    """
    whole = batches.drop("run", "batch_id").hint("rebalance", "event_date").sortWithinPartitions("event_date", look_up)
    writer = whole.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("parquet.block.size", row_group_bytes)
    writer.option(f"parquet.bloom.filter.enabled#{look_up}", "true").partitionBy("event_date").parquet(path)
