"""Top-k against sorting all scores."""

import math
import random

import numpy as np
import pytest

from feedflow.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, v string, score long"


def plain(rows, k, every):
    usable = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in usable if i % every == 0}):
        own = min(v for i, v in usable if i == q)
        scored = sorted((-sum(a * b for a, b in zip(own, v, strict=False)), i) for i, v in usable if i != q)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return out


def rows():
    rng = random.Random(5)
    made = [(i, [rng.choice([0.0, 0.5, -0.25, rng.random()]) for _ in range(6)]) for i in range(300)]
    made += [(1000 + i, [0.5] * 6) for i in range(200)]
    made += [(400, None), (500, [float("nan")] * 6), (600, [None] * 6), (700, [1.0, float("inf")]), (800, []), (900, [1.0, 2.0]), (None, [1.0] * 6), (100, [0.5] * 6)]
    return made


def check(spark, made, k=10, every=100):
    df = spark.createDataFrame([(i, v, None, None, None) for i, v in made], SCHEMA)
    found = sorted(tuple(r) for r in topk.report(df, k, every).collect())
    # Vectors come back as single floats.
    exact = [(i, None if v is None else list(v)) for i, v in ((r["vec_id"], r["embedding"]) for r in df.collect())]
    assert found == plain(exact, k, every)


def test_equals_sorting(spark):
    check(spark, rows())


def test_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 17)
    check(spark, rows(), every=20)


def test_few_and_no_candidates(spark):
    check(spark, [(0, [1.0]), (1, [2.0]), (2, [2.0])])
    check(spark, [(0, [1.0])])
    check(spark, [])


def test_vectors_whose_scores_could_leave_64_bits_are_refused(spark):
    longest = 1_048_575 * 1.999
    check(spark, [(0, [longest, 1.0]), (100, [-longest]), (1, [0.5, longest]), (2, [longest])])
    for vector in ([1e300], [2.0**21], [1.6e6, 1.6e6], [-1e300, 1.0]):
        rows = spark.createDataFrame([(0, vector), (1, [3.0])], "vec_id long, embedding array<double>")
        with pytest.raises(Exception, match="2\\*\\*31 or more"):
            topk.report(rows).collect()


@pytest.mark.parametrize("longest, kind", [(500, np.float32), (1 << 20, np.float64), (1 << 29, np.int64)])
def test_a_held_stripe_gives_exact_scores(longest, kind):
    """Each part of a stripe, full and rare terms, ragged rows, ties and the queries' own rows, in the numbers that hold all sums."""
    rng = np.random.default_rng(longest)
    rows = [(int(i), rng.integers(-longest, longest, int(rng.choice([2, 3, 3, 3, 9])))) for i in rng.integers(0, 60, 150)]
    rows += [(70 + i, np.full(3, longest)) for i in range(60)] + [(200, np.zeros(0, np.int64)), (201, np.zeros(40, np.int64))]

    def block(part):
        squares = [float((v.astype(float) ** 2).sum()) for _, v in part]
        return topk.Block(np.array([i for i, _ in part]), np.array([len(v) for _, v in part]), np.concatenate([v for _, v in part]), max(squares))

    queries = block([(7, rows[0][1]), (71, np.full(12, longest - 1)), (300, rows[3][1] // 2), (301, np.zeros(0, np.int64))])
    held = topk.Stripe([block(rows[:50]), block(rows[50:51]), block(rows[51:])], 16)
    assert topk.exact(queries.square * held.square) is kind and held.others
    found, ends = held.best(queries, 5).to_pylist(), np.cumsum(queries.sizes)
    for query_id, size, end in zip(queries.ids.tolist(), queries.sizes, ends, strict=True):
        own = queries.weights[end - size : end].tolist()
        scored = sorted((-sum(a * b for a, b in zip(own, v.tolist(), strict=False)), i) for i, v in rows if i != query_id)[:5]
        assert [(-r["score"], r["vec_id"]) for r in found if r["query_id"] == query_id] == scored


def test_stripes_are_bounded_and_queries_pass_them_whole(spark, monkeypatch):
    """A task holds a bounded part of the candidates, also where one id has most rows, and no candidate is moved once a query block."""
    monkeypatch.setattr(topk, "STRIPE", 300)
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 50)
    made = rows() + [(7, [i / 100, -0.5]) for i in range(1500)]
    vectors = spark.createDataFrame([(i, [1, 2]) for i in [7] * 900 + list(range(100))], "vec_id long, v array<long>")
    held = topk.packed(vectors, 50).cache()
    assert held.agg({"n": "max"}).first()[0] <= 50 and held.agg({"n": "sum"}).first()[0] == 1000
    assert topk.stripes_needed(held) == max(7, min(20, 4 * spark.sparkContext.defaultParallelism))
    held.unpersist()
    check(spark, made, every=20)
