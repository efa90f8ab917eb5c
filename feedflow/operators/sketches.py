"""Mergeable summaries per time bucket: distinct values and percentiles that days get from stored hours.

A sketch has a bounded size whatever its bucket holds, is built inside map tasks and merged after the shuffle, so a bucket that
holds most of the rows arrives as one sketch per task. Stored sketches are united later without reading the messages again.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Registers of a distinct sketch as a power of two: standard error 0.6 per cent, at most 32 KB each.
LG_REGISTERS = 15
# Accuracy of a quantile sketch: rank error about 0.4 per cent at 99 per cent confidence, some 10 KB each.
QUANTILE_K = 800


def _bucket(time: str, width: str) -> list:
    return [F.window(time, width).getField("start").alias("bucket")]


def distinct_sketches(df: DataFrame, time: str, value: str, width: str = "1 hour", keys: tuple = ()) -> DataFrame:
    """``bucket, keys, sketch``: a sketch of the distinct values of each bucket. Rows without a time or a value are in none."""
    known = df.filter(F.col(time).isNotNull() & F.col(value).isNotNull())
    return known.groupBy(*_bucket(time, width), *keys).agg(F.hll_sketch_agg(value, LG_REGISTERS).alias("sketch"))


def distinct_counts(sketches: DataFrame, width: str = "1 day", keys: tuple = ()) -> DataFrame:
    """``bucket, keys, n``: estimated distinct values of wider buckets, from stored sketches of narrower ones."""
    merged = sketches.groupBy(*_bucket("bucket", width), *keys).agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.select("bucket", *keys, F.hll_sketch_estimate("sketch").alias("n"))


def quantile_sketches(df: DataFrame, time: str, value: str, width: str = "1 hour", keys: tuple = ()) -> DataFrame:
    """``bucket, keys, sketch``: a quantile sketch of each bucket's values. Rows without a time, or with a value that is NULL or no number, are in none."""
    known = df.select(F.col(time).alias("__time"), F.col(value).cast("double").alias("__value"), *keys).filter(
        "__time IS NOT NULL AND __value IS NOT NULL AND NOT isnan(__value)"
    )
    return known.groupBy(*_bucket("__time", width), *keys).agg(F.kll_sketch_agg_double("__value", QUANTILE_K).alias("sketch"))


def quantiles(sketches: DataFrame, fractions: Iterable[float], width: str = "1 day", keys: tuple = ()) -> DataFrame:
    """``bucket, keys, n, fraction, value``: estimated quantiles of wider buckets, from stored sketches, a row per fraction."""
    merged = sketches.groupBy(*_bucket("bucket", width), *keys).agg(F.kll_merge_agg_double("sketch", QUANTILE_K).alias("sketch"))
    each = [
        F.struct(F.lit(float(f)).alias("fraction"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(f))).alias("value")) for f in fractions
    ]
    return merged.select("bucket", *keys, F.kll_sketch_get_n_double("sketch").alias("n"), F.inline(F.array(*each)))
