"""Bursts: runs of one key's rows with less than a given gap between one and the next."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

WIDE = "decimal(38,0)"


def bursts(rows: DataFrame, key: str, gap_seconds: int, time: str = "event_time", value: str = "value", late: str | None = None) -> DataFrame:
    """``key, start, last, n, value_sum`` of each run of a key's rows that are at most ``gap_seconds`` apart.

    Rows without a key or a time are in no run. Times count in microseconds; sums are decimals.

    Streams (``late``: how long a run waits for rows that come late) keep a session window per run in their state; a late row that
    bridges two runs merges them, and a run comes out once the watermark is past its end.

    Tables need no session state: rows of one cell of ``gap_seconds`` belong to one run whatever lies between, so cells are summed inside
    map tasks and only cells are put in order. A key has at most its time span divided by the gap of them, however many rows it holds.
    """
    if gap_seconds <= 0:
        raise ValueError("gap_seconds must be positive")
    known = rows.filter(F.col(key).isNotNull() & F.col(time).isNotNull())
    measures = [
        F.min(time).alias("start"), F.max(time).alias("last"), F.count("*").alias("n"),
        F.coalesce(F.sum(F.col(value).cast(WIDE)), F.lit(0)).cast(WIDE).alias("value_sum"),
    ]
    if rows.isStreaming:
        if late is None:
            raise ValueError("a stream of bursts needs late, or no run ever ends")
        session = F.session_window(time, f"{gap_seconds} seconds")
        return known.withWatermark(time, late).groupBy(key, session).agg(*measures).select(key, "start", "last", "n", "value_sum")
    gap = gap_seconds * 1_000_000
    cells = known.groupBy(key, F.floor(F.unix_micros(F.col(time).cast("timestamp")) / gap).alias("cell")).agg(*measures)
    order = Window.partitionBy(key).orderBy("cell")
    apart = F.unix_micros(F.col("start").cast("timestamp")) - F.unix_micros(F.lag("last").over(order).cast("timestamp"))
    runs = cells.withColumn("opens", F.coalesce((apart > gap).cast("int"), F.lit(1))).withColumn("run", F.sum("opens").over(order))
    merged = [F.min("start").alias("start"), F.max("last").alias("last"), F.sum("n").alias("n"), F.sum("value_sum").cast(WIDE).alias("value_sum")]
    return runs.groupBy(key, "run").agg(*merged).select(key, "start", "last", "n", "value_sum")
