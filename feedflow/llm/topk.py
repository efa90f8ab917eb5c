"""Exact top-k search by exhaustive term-at-a-time accumulation.

Vectors become integer rows, packed a few hundred at a time. Candidates are dealt to stripes of bounded size, one held by a task at
a time; every query block comes past every stripe. There each dimension is a term: its posting list (which rows, what weights),
times the queries' weights, goes into dense arrays of scores, one per query, some candidates at a time. Terms that most rows
have are accumulated together, as one matrix product; the others one by one. Partition selection, then the least score that still
counts, keep each query's best of the stripe, and the stripes' bests are merged.

The work is queries times candidates; what a task holds is a stripe, a query block and their scores. Candidates are stored packed once and
shuffled once, queries once a stripe; the stripes' bests are queries times k times stripes. Neither side is broadcast or gathered.

Scores are exact: products are added up in single floats if no sum can reach 2**24, in double ones below 2**52, in integers beyond.

Defined results: vectors that are null or have null or non-finite components take no part; a shorter vector has zeros behind its
end; an id that occurs more than once is taken once as a query (its smallest vector) and all its rows count as its own, never as
candidates of that query; rows without an id are left out; ties go to the smaller id; fewer than k candidates give fewer rows;
empty tables give no rows; extra columns are ignored. A vector whose integers have a length of 2**31 or more is refused with an error: inner
products of shorter ones, and all sums on the way to them, stay within 62 bits.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from feedflow.functions.once import compute_once
from feedflow.llm.shared import prepared, scratch, written

# Rows of a query block, and of the candidates it is scored against at once; scores take 4 or 8 bytes for each pair of rows of the two.
QUERY_BLOCK, CANDIDATE_BLOCK = 512, 1024
# Components of a stripe, about; a task holds one, in 4 or 8 bytes each.
STRIPE = 1 << 24
# Terms of at least this share of a stripe's rows are accumulated together.
FULL = 0.25
SCALE = 1024
# Squared length that a vector of integers may not reach.
LARGEST = float(1 << 62)
# Rows in bytes: how many, their components, the largest squared length, the integers' type, ids, lengths, all components.
PACKED = "n int, parts bigint, square double, kind string, ids binary, sizes binary, weights binary"


def integers(vector: Column) -> Column:
    """Components as floor(1024 * x); null if the vector is null or has a component that is null or no finite number."""
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    whole = lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")).cast("bigint")
    square = F.aggregate(vector, F.lit(0.0), lambda total, x: total + F.pow(whole(x).cast("double"), F.lit(2.0)))
    refused = F.raise_error(F.lit("a vector of length 2**31 or more after scaling")).cast("array<bigint>")
    return F.when(finite, F.when(square < LARGEST, F.transform(vector, whole)).otherwise(refused))


class Block:
    """Some vectors as numpy arrays: ids, lengths, all components, and the largest squared length."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, weights: np.ndarray, square: float) -> None:
        self.ids, self.sizes, self.weights, self.square = ids, sizes, weights, square

    def postings(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(dimension, row, weight)`` of the non-zero components, row by row."""
        row = np.repeat(np.arange(len(self.ids)), self.sizes)
        dimension = np.arange(len(self.weights)) - np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)
        kept = np.flatnonzero(self.weights)
        return dimension[kept], row[kept], self.weights[kept]


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal values start and end."""
    cuts = np.flatnonzero(np.diff(values)) + 1
    return (np.concatenate([[0], cuts]), np.concatenate([cuts, [len(values)]])) if len(values) else (cuts, cuts)


def exact(square: float) -> type:
    """Numbers that hold every sum of products of two vectors; ``square`` is the product of their squared lengths (of one vector: its components)."""
    return np.float32 if square < 2.0**48 else np.float64 if square < 2.0**104 else np.int64


def packed(vectors: DataFrame, rows: int) -> DataFrame:
    """The vectors (``vec_id, v``) as they lie, at most so many rows in one."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for first in range(0, batch.num_rows, rows):
                ids, listed = (batch.column(i).slice(first, rows) for i in range(2))
                weights, sizes = listed.flatten().to_numpy(zero_copy_only=False), np.diff(listed.offsets.to_numpy())
                squares = np.bincount(np.repeat(np.arange(len(sizes)), sizes), np.square(weights.astype(np.float64)), len(sizes))
                most = max(-int(weights.min(initial=0)), int(weights.max(initial=0)))
                kind = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8"
                numbers = (ids.to_numpy(zero_copy_only=False).astype("<i8"), sizes.astype("<i8"), weights.astype(kind))
                made.append((len(ids), len(weights), float(squares.max()), kind, *(x.tobytes() for x in numbers)))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*made, strict=True), KINDS, strict=True)], names=NAMES)

    return vectors.select("vec_id", "v").mapInArrow(run, PACKED)


NAMES = [part.split()[0] for part in PACKED.split(", ")]
KINDS = [pa.int32(), pa.int64(), pa.float64(), pa.string(), pa.binary(), pa.binary(), pa.binary()]


def unpacked(batch: pa.RecordBatch, i: int) -> Block:
    square, kind = (batch.column(name)[i].as_py() for name in ("square", "kind"))
    kinds = {"ids": "<i8", "sizes": "<i8", "weights": kind}
    return Block(*(np.frombuffer(batch.column(name)[i].as_buffer(), k) for name, k in kinds.items()), square)


def strongest(total: np.ndarray, k: int) -> np.ndarray:
    """Which are the k highest of each row, ties to the one further left."""
    least = np.partition(total, total.shape[1] - k, axis=1)[:, total.shape[1] - k][:, None]
    above, tied = total > least, total == least
    return above | (tied & (np.cumsum(tied, axis=1) <= k - np.count_nonzero(above, axis=1)[:, None]))


def merged(found: list[tuple[np.ndarray, ...]], k: int) -> tuple[np.ndarray, ...]:
    """Of ``(query, candidate, score)`` each query's k best, ties to the smaller candidate, and the rank of each from 0."""
    query, candidate, score = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((candidate, -score, query))
    query, candidate, score = query[order], candidate[order], score[order]
    starts, ends = runs(query)
    rank = np.arange(len(query)) - np.repeat(starts, ends - starts)
    kept = rank < k
    return query[kept], candidate[kept], score[kept], rank[kept]


class Stripe:
    """The candidates that a task holds, by ascending id, as posting lists; those of most rows side by side as a matrix for each part."""

    def __init__(self, blocks: list[Block], width: int) -> None:
        ids = np.concatenate([b.ids for b in blocks])
        order = np.argsort(ids, kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        self.ids, self.width, self.square = ids[order], width, max(b.square for b in blocks)
        rows_of = np.zeros(max(int(b.sizes.max()) for b in blocks), np.int64)
        for b in blocks:
            seen = np.bincount(b.postings()[0])
            rows_of[: len(seen)] += seen
        full = np.flatnonzero(rows_of >= max(1, FULL * len(ids)))
        self.at = np.full(len(rows_of), -1)
        self.at[full] = np.arange(len(full))
        self.full = np.zeros((-(-len(ids) // width), len(full), width), exact(self.square))
        others, first = [], 0
        for b in blocks:
            dimension, row, weight = b.postings()
            row, at = place[first + row], self.at[dimension]
            first += len(b.ids)
            of_most = at >= 0
            self.full[row[of_most] // width, at[of_most], row[of_most] % width] = weight[of_most]
            others.append(tuple(x[~of_most] for x in (dimension, row, weight)))
        dimension, row, weight = (np.concatenate(x) for x in zip(*others, strict=True))
        # Posting lists of the other terms, by part of the stripe.
        order = np.lexsort((row, dimension, row // width))
        dimension, row, weight = dimension[order], row[order], weight[order].astype(np.int64)
        self.others: dict[int, list[tuple[int, np.ndarray, np.ndarray]]] = {}
        for a, z in zip(*runs(row // width * len(rows_of) + dimension), strict=True):
            self.others.setdefault(int(row[a]) // width, []).append((int(dimension[a]), row[a:z] % width, weight[a:z]))

    def asked(self, queries: Block, kind: type) -> tuple[np.ndarray, dict[int, tuple[np.ndarray, np.ndarray]]]:
        """The queries' weights of the terms that most rows have, as a matrix, and of the other terms by dimension."""
        dimension, row, weight = queries.postings()
        met = dimension < len(self.at)
        dimension, row, weight = dimension[met], row[met], weight[met]
        at = self.at[dimension]
        matrix = np.zeros((len(queries.ids), self.full.shape[1]), kind)
        matrix[row[at >= 0], at[at >= 0]] = weight[at >= 0]
        rest = np.flatnonzero(at < 0)
        rest = rest[np.argsort(dimension[rest], kind="stable")]
        return matrix, {int(dimension[rest[a]]): (row[rest[a:z]], weight[rest[a:z]].astype(np.int64)) for a, z in zip(*runs(dimension[rest]), strict=True)}

    def scores(self, matrix: np.ndarray, wanted: dict, part: int, total: np.ndarray) -> None:
        """Inner products of the queries with the candidates of a part, into ``total``."""
        weights = self.full[part].astype(total.dtype, copy=False)
        if total.dtype != np.int64:
            np.matmul(matrix, weights, out=total)
        else:
            total[:] = 0
            for term, factors in zip(weights, matrix.T, strict=True):
                total += factors[:, None] * term
        for dimension, rows, weight in self.others.get(part, ()) if wanted else ():
            if dimension in wanted:
                asking, factors = wanted[dimension]
                total[np.ix_(asking, rows)] += (factors[:, None] * weight).astype(total.dtype)

    def best(self, queries: Block, k: int) -> pa.RecordBatch:
        """``query_id, vec_id, score``: each query's k best of the stripe."""
        kind, n = exact(queries.square * self.square), len(queries.ids)
        none = -np.inf if kind is not np.int64 else np.iinfo(np.int64).min
        matrix, wanted = self.asked(queries, kind)
        starts, ends = (np.searchsorted(self.ids, queries.ids, side) for side in ("left", "right"))
        own = np.flatnonzero(starts < ends)
        # What a candidate must exceed: the query's k-th score so far. Ids ascend, so a tie with it comes too late.
        least, space = np.full((n, 1), none, kind), np.empty((n, self.width), kind)
        found, waiting = [], 0
        for first in range(0, len(self.ids), self.width):
            last = min(first + self.width, len(self.ids))
            self.scores(matrix, wanted, first // self.width, space)
            total = space[:, : last - first]
            for q in own[(starts[own] < last) & (ends[own] > first)]:
                total[q, max(starts[q] - first, 0) : ends[q] - first] = none
            kept = total > least
            if last - first > k and np.count_nonzero(kept) > 2 * k * n:
                kept &= strongest(total, k)
            query, candidate = np.divmod(np.flatnonzero(kept), last - first)
            found.append((query, first + candidate, total[query, candidate]))
            waiting += len(query)
            if waiting > k * n:
                *best, rank = merged(found, k)
                found, waiting = [tuple(best)], 0
                least[best[0][rank == k - 1], 0] = best[2][rank == k - 1]
        query, candidate, score, _ = merged(found, k)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (queries.ids[query], self.ids[candidate], score.astype(np.int64))], names=["query_id", "vec_id", "score"])


def stripes_needed(held: DataFrame) -> int:
    """As many as bounded sizes ask for, and enough for all cores."""
    rows, parts = held.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("parts"), F.lit(0))).first()
    return max(1, -(-parts // STRIPE), min(-(-rows // CANDIDATE_BLOCK), 4 * held.sparkSession.sparkContext.defaultParallelism))


def search(queries: DataFrame, candidates: DataFrame, k: int = 10) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k candidates (``vec_id, v``) with the highest inner product with each query.

    The result is a written table.
    """
    spark, width = prepared(queries.sparkSession), CANDIDATE_BLOCK

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, blocks, stripe = None, [], None
        for batch in batches:
            for i, (place, asks) in enumerate(zip(batch.column("stripe").to_pylist(), batch.column("asks").to_pylist(), strict=True)):
                if place != here:
                    here, blocks, stripe = place, [], None
                if not asks:
                    blocks.append(unpacked(batch, i))
                    continue
                if blocks:
                    stripe, blocks = Stripe(blocks, width), []
                if stripe:
                    yield stripe.best(unpacked(batch, i), k)

    with scratch(spark):
        held = written(spark, packed(candidates, CANDIDATE_BLOCK), "top-k-candidates")
        n = stripes_needed(held)
        asked = packed(queries.groupBy("vec_id").agg(F.min("v").alias("v")), QUERY_BLOCK)
        dealt = held.select(F.pmod(F.xxhash64("ids"), F.lit(n)).cast("int").alias("stripe"), F.lit(False).alias("asks"), *NAMES)
        dealt = dealt.unionByName(asked.select(F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("stripe"), F.lit(True).alias("asks"), *NAMES))
        # A stripe's candidates come first, then the queries. Four times the partitions: few hold two stripes.
        meetings = dealt.repartition(4 * n, "stripe").sortWithinPartitions("stripe", "asks")
        found = meetings.mapInArrow(run, "query_id bigint, vec_id bigint, score bigint")
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        ranked = found.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= k)
        return written(spark, ranked.select("query_id", "rank", "vec_id", "score"), "top-k", outlives=True)


def report(embeddings: DataFrame, k: int = 10, every: int = 100) -> DataFrame:
    """The rows whose id ``every`` divides, searched against all rows."""
    named = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding").filter("vec_id IS NOT NULL")

    def usable(rows: DataFrame) -> DataFrame:
        return compute_once(rows, v=integers(F.col("embedding"))).drop("embedding").filter("v IS NOT NULL")

    return search(usable(named.filter(F.col("vec_id") % every == 0)), usable(named), k)
