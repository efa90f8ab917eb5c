"""Connected components of an edge table, by alternating large-star and small-star steps.

A large-star step hangs the larger neighbours of every node on its smallest neighbour, a small-star step its smaller ones; both
keep the components. After a few rounds every node hangs on its component's smallest one. Each step is a grouped minimum and a
join on the node, so a node with very many edges is combined in map tasks and split by adaptive joins. Every round's edges
are written as a table: a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedflow.llm.shared import written


def with_least(edges: DataFrame) -> DataFrame:
    """``u, v, m``: each edge with the smallest neighbour of its first node."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "of")
    return edges.join(least, F.col("u") == F.col("of")).drop("of")


def large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    starred = with_least(both).filter("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
    return starred.distinct()


def small_star(edges: DataFrame) -> DataFrame:
    starred = with_least(edges)
    hung = starred.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
    return hung.select("e.*").filter("u <> v").distinct()


def state(edges: DataFrame) -> tuple:
    """Equal for equal edge sets: their number and a sum of hashes."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(pairs: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``pairs`` (two columns of bigint); the root is the smallest node it is connected with."""
    spark = pairs.sparkSession
    a, b = pairs.columns
    edges = pairs.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    edges = written(spark, edges, "edges")
    before = None
    while (now := state(edges)) != before:
        before = now
        edges = written(spark, small_star(large_star(edges)), "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
