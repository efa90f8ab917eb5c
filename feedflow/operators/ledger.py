"""What became of transactions' outputs, and who received most."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Outputs of one (tx_index, n) beyond which they are dealt over ``SALTS`` keys.
HOT_ROWS = 1_000_000
SALTS = 64


def output_state(outputs: DataFrame, inputs: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``outputs`` with ``spends``: the number of inputs whose ``prev_out`` names the output's ``tx_index`` and ``n`` (0: unspent).

    Spends are counted inside map tasks first, so they arrive as one row per coin. Outputs are joined by a shuffle on the coin; coins with
    more than ``hot_rows`` outputs are dealt over salts, and only their one row of spends is repeated for each salt. A coin without an
    index or a number is never spent.
    """
    coin = ["tx_index", "n"]
    spends = inputs.groupBy(*coin).agg(F.count("*").alias("spends"))
    hot = outputs.groupBy(*coin).agg(F.count("*").alias("rows")).filter(F.col("rows") > hot_rows).select(*coin, F.lit(SALTS).alias("salts"))
    # Few coins can be so frequent: at most the number of outputs divided by ``hot_rows``.
    dealt = outputs.join(F.broadcast(hot), coin, "left").withColumn("salt", F.pmod(F.xxhash64("hash"), F.coalesce("salts", F.lit(1))).cast("int"))
    each = F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)).alias("salt")
    spread = spends.join(F.broadcast(hot), coin, "left").select(*coin, "spends", each)
    joined = dealt.join(spread.hint("shuffle_hash"), [*coin, "salt"], "left")
    return joined.select(*outputs.columns, F.coalesce("spends", F.lit(0)).cast("bigint").alias("spends"))


def top_addresses(outputs: DataFrame, k: int) -> DataFrame:
    """``day, rank, addr, value_sum``: the ``k`` addresses that received most on each day (days since the epoch); ties by address.

    ``outputs``: ``day, addr, value``. Sums are combined inside map tasks, and a limited rank hands on ``k`` rows per task and day.
    """
    known = outputs.filter("day IS NOT NULL AND addr IS NOT NULL AND value IS NOT NULL")
    sums = known.groupBy("day", "addr").agg(F.sum(F.col("value").cast("decimal(38,0)")).cast("decimal(38,0)").alias("value_sum"))
    order = Window.partitionBy("day").orderBy(F.desc("value_sum"), "addr")
    return sums.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("day", "rank", "addr", "value_sum")
