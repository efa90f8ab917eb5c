"""Joins of tables in which one key may hold much of the rows."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 64


def left_join(left: DataFrame, right: DataFrame, on: dict[str, str], hot_rows: int, condition: Column | None = None, salts: int = SALTS) -> DataFrame:
    """All of ``left`` with the rows of ``right`` that agree on ``on`` (left name to right name) and keep ``condition``.

    ``left`` is counted by key, inside map tasks first. Rows of keys with more than ``hot_rows`` rows are dealt over ``salts`` by their own
    content and only those keys' rows of ``right`` are repeated for each salt. At most rows / ``hot_rows`` keys can be hot, which bounds
    what is broadcast. Equal rows of ``left`` get one salt, so a key whose rows are all equal is not dealt; NULL keys match nothing and
    are dealt as well.
    """
    keys = list(on)
    hot = left.groupBy(*keys).agg(F.count("*").alias("__rows")).filter(F.col("__rows") > hot_rows)
    left_hot = F.broadcast(hot.select(*[F.col(a).alias(f"__{a}") for a in keys], F.lit(salts).alias("__salts")))
    same = reduce(and_, [F.col(a).eqNullSafe(F.col(f"__{a}")) for a in keys])
    dealt = left.join(left_hot, same, "left").withColumn("__salt", F.pmod(F.xxhash64(*left.columns), F.coalesce("__salts", F.lit(1))).cast("int"))
    right_hot = F.broadcast(hot.select(*[F.col(a).alias(f"__{a}") for a in keys], F.lit(salts).alias("__salts_right")))
    listed = right.join(right_hot, reduce(and_, [F.col(on[a]) == F.col(f"__{a}") for a in keys]), "left").select(
        *right.columns, F.explode(F.sequence(F.lit(0), F.coalesce("__salts_right", F.lit(1)) - 1)).alias("__salt_right")
    )
    matching = reduce(and_, [F.col(a) == F.col(b) for a, b in on.items()], F.col("__salt") == F.col("__salt_right"))
    if condition is not None:
        matching &= condition
    return dealt.join(listed, matching, "left").select(*left.columns, *[c for c in right.columns if c not in left.columns])
