"""Centroid clustering with a bisector tournament.

Vectors become integers, and every step is exact. Between two centroids lies a bisecting plane: for centroids i < j a vector x is nearer
to j if and only if ``x . 2(cj - ci) > |cj|^2 - |ci|^2``. The normals and thresholds of all pairs are computed once a round. A vector
then passes a tournament: the champion meets the next centroid, one linear sign test each, so k - 1 tests leave the nearest one;
zero keeps the champion, which has the smaller number. Only the winner's distance is computed, and exactly.

Tasks add up their own vectors by cluster and hand on one row per cluster, which Spark sums further; what reaches the driver
are k centroids. The model (k * k normals) is sent with each round's tasks; k and the width of vectors are fixed, so it does not grow.

Defined results: vectors that are null, have another width, or a null or non-finite component take no part and have no row, nor
have rows without an id; fewer than k vectors are all centroids; repeated ids and equal vectors each count as a vector; equal
hashes (repeated ids) are ordered by the vector; an empty cluster keeps its centroid; an empty table gives no rows; extra
columns are ignored. A component of 2**27 or more after scaling is refused with an error, since distances would leave 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedflow.llm.shared import prepared, scratch, written

LARGEST = 1 << 27


@dataclass(frozen=True)
class Plan:
    """``k`` centroids of ``width`` components, scaled by ``scale``, moved in ``rounds`` rounds; ``seed`` picks the first ones."""

    k: int = 40
    width: int = 64
    scale: int = 256
    rounds: int = 5
    seed: int = 2


def integers(vector: Column, plan: Plan) -> Column:
    """Components as floor(scale * x); null for a vector that takes no part."""
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    scaled = lambda x: F.lit(float(plan.scale)) * x.cast("double")
    whole = lambda x: F.when(F.abs(scaled(x)) < LARGEST, F.floor(scaled(x)).cast("int")).otherwise(
        F.raise_error(F.lit(f"a component of {LARGEST} or more after scaling")).cast("int"))
    return F.when((F.size(vector) == plan.width) & finite, F.transform(vector, whole))


def kept(embeddings: DataFrame, plan: Plan) -> DataFrame:
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), integers(F.col("embedding"), plan).alias("v"))
    return rows.filter("vec_id IS NOT NULL AND v IS NOT NULL")


def first_centroids(vectors: DataFrame, plan: Plan) -> np.ndarray:
    picked = F.sha2(F.concat(F.lit(f"{plan.seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.select(picked.alias("picked"), "v").orderBy("picked", "v").limit(plan.k).collect()
    return np.array([r["v"] for r in rows], np.int64).reshape(len(rows), plan.width)


class Tournament:
    """Normals and thresholds of all pairs of centroids."""

    def __init__(self, centroids: np.ndarray) -> None:
        self.centroids = centroids
        self.normals = 2 * (centroids[None, :, :] - centroids[:, None, :])
        squares = (centroids * centroids).sum(axis=1)
        self.thresholds = squares[None, :] - squares[:, None]

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of the nearest centroid of each vector."""
        champion = np.zeros(len(vectors), np.int64)
        for rival in range(1, len(self.centroids)):
            side = np.einsum("ij,ij->i", vectors, self.normals[champion, rival]) - self.thresholds[champion, rival]
            champion[side > 0] = rival
        away = vectors - self.centroids[champion]
        return champion, np.einsum("ij,ij->i", away, away)


def matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(batch.num_rows, width)


def moved(vectors: DataFrame, centroids: np.ndarray, plan: Plan) -> np.ndarray:
    """The centroids after one round: the exact floor of each cluster's mean."""
    tournament, k = Tournament(centroids), len(centroids)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, plan.width), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            own = matrix(batch, plan.width)
            cluster, _ = tournament.nearest(own)
            np.add.at(sums, cluster, own)
            counts += np.bincount(cluster, minlength=k)
        found = np.flatnonzero(counts)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1) * plan.width, pa.int32()), pa.array(sums[found].ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts[found]), lists], names=["cluster", "n", "sums"])

    parts = vectors.mapInArrow(run, "cluster bigint, n bigint, sums array<bigint>")
    whole = parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[
        F.sum(F.col("sums")[i].cast("decimal(20,0)")) for i in range(plan.width)]).alias("sums"))
    after = centroids.copy()
    for row in whole.collect():
        after[row["cluster"]] = [int(total) // row["n"] for total in row["sums"]]
    return after


def assigned(vectors: DataFrame, centroids: np.ndarray, plan: Plan) -> DataFrame:
    """``vec_id, cluster, distance`` of every vector."""
    tournament = Tournament(centroids)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster, distance = tournament.nearest(matrix(batch, plan.width))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(cluster.astype(np.int32)), pa.array(distance)],
                                             names=["vec_id", "cluster", "distance"])

    return vectors.mapInArrow(run, "vec_id bigint, cluster int, distance bigint")


def cluster(embeddings: DataFrame, plan: Plan | None = None) -> tuple[DataFrame, np.ndarray]:
    """Every vector with its cluster and distance (a written table), and the centroids behind them."""
    plan = plan or Plan()
    spark = prepared(embeddings.sparkSession)
    with scratch(spark):
        vectors = written(spark, kept(embeddings, plan), "cluster-vectors")
        centroids = first_centroids(vectors, plan)
        if not len(centroids):
            return spark.createDataFrame([], "vec_id bigint, cluster int, distance bigint"), centroids
        for _ in range(plan.rounds):
            centroids = moved(vectors, centroids, plan)
        return written(spark, assigned(vectors, centroids, plan), "clusters", outlives=True), centroids


def report(embeddings: DataFrame, plan: Plan | None = None) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256``."""
    spark = embeddings.sparkSession
    found, centroids = cluster(embeddings, plan)
    sums = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    small = spark.createDataFrame([(c, s, sum(sums.values()), digests[c]) for c, s in sorted(sums.items())],
                                  "of int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return found.join(F.broadcast(small), F.col("cluster") == F.col("of")).drop("of")
