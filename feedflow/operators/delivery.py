"""What a topic delivered: ranges of offsets that are missing, and each message once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Offsets of one block of a partition.
BLOCK = 1 << 20


def lost_offsets(messages: DataFrame, block: int = BLOCK) -> DataFrame:
    """``topic, partition, from_offset, to_offset``: offsets between the first and the last one of a partition that no message has.

    Gaps inside blocks of offsets are found in each block by itself; then each block's first and last offset are compared with those of
    the block before. So a partition's messages are never sorted in one task, only its blocks, which are ``block`` times fewer. Repeated
    offsets make no gap; messages without an offset or a partition take no part. Compacted topics have gaps of their own.
    """
    place = ["topic", "partition"]
    seen = messages.select(*place, "offset", F.floor(F.col("offset") / block).alias("block")).filter("offset IS NOT NULL AND partition IS NOT NULL").distinct()
    inside = Window.partitionBy(*place, "block").orderBy("offset")
    within = seen.withColumn("before", F.lag("offset").over(inside))
    borders = seen.groupBy(*place, "block").agg(F.min("offset").alias("offset"), F.max("offset").alias("last"))
    across = borders.withColumn("before", F.lag("last").over(Window.partitionBy(*place).orderBy("block")))
    columns = [*place, "offset", "before"]
    gaps = within.select(columns).unionByName(across.select(columns)).filter("offset > before + 1")
    return gaps.select(*place, (F.col("before") + 1).alias("from_offset"), (F.col("offset") - 1).alias("to_offset"))


def unique_messages(messages: DataFrame, late: str, time: str = "timestamp") -> DataFrame:
    """Each message once, by topic, partition and offset, though a stream's source may deliver it again, also after a restart.

    A stream keeps the places of messages in its state, until its watermark (the latest ``time`` less ``late``) is past their time by
    ``late`` again. Two deliveries of a message must therefore lie within ``late`` of each other in message time, and a message that is older
    than the watermark is left out as late: choose ``late`` above both the replay's and the disorder's span. A table keeps no state.
    """
    place = ["topic", "partition", "offset"]
    if not messages.isStreaming:
        return messages.dropDuplicates(place)
    return messages.withWatermark(time, late).dropDuplicatesWithinWatermark(place)
