"""Clusters against distances to all centroids, in exact integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from feedflow.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, label int, cluster int, v string, of int"


def plain(rows, plan):
    kept = [(i, [math.floor(plan.scale * float(x)) for x in v]) for i, v in rows
            if i is not None and v is not None and len(v) == plan.width and all(x is not None and math.isfinite(x) for x in v)]
    middle = [v for _, v in sorted(kept, key=lambda r: (hashlib.sha256(f"{plan.seed}:{r[0]}".encode()).hexdigest(), r[1]))[: plan.k]]
    away = lambda v, m: sum((a - b) ** 2 for a, b in zip(v, m, strict=True))
    nearest = lambda v: min(range(len(middle)), key=lambda c: (away(v, middle[c]), c))
    for _ in range(plan.rounds):
        own = [[] for _ in middle]
        for _, v in kept:
            own[nearest(v)].append(v)
        middle = [[sum(column) // len(column) for column in zip(*o, strict=True)] if o else m for o, m in zip(own, middle, strict=True)]
    placed = [(i, nearest(v), v) for i, v in kept]
    found = [(i, c, away(v, middle[c])) for i, c, v in placed]
    sums = {c: sum(d for _, own, d in found if own == c) for _, c, _ in found}
    digest = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in middle]
    return sorted((i, c, d, sums[c], sum(sums.values()), digest[c]) for i, c, d in found)


def check(spark, rows, plan):
    df = spark.createDataFrame([(i, v, None, None, None, None) for i, v in rows], SCHEMA)
    exact = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    assert sorted(map(tuple, centroids.report(df, plan).collect())) == plain(exact, plan)


def test_equals_plain_clustering_with_ties(spark):
    rng = random.Random(1)
    plan = centroids.Plan(k=7, width=4, scale=4)
    rows = [(i, [rng.choice([-1.0, -0.5, 0.0, 0.3, 2.0]) for _ in range(4)]) for i in range(400)]
    odd = [(900, None), (901, []), (902, [1.0] * 3), (903, [1.0] * 5), (904, [None] * 4), (905, [float("nan")] * 4), (906, [float("inf")] * 4), (None, [1.0] * 4), (5, [0.25] * 4), (5, [0.25] * 4)]
    check(spark, rows + odd, plan)


def test_fewer_vectors_than_centroids_and_empty_tables(spark):
    check(spark, [(1, [0.5, 1.0]), (2, [0.5, 1.0]), (3, [-9.0, 1.0])], centroids.Plan(width=2))
    check(spark, [], centroids.Plan())
    check(spark, [(1, None)], centroids.Plan())


def test_components_that_are_too_large_are_refused(spark):
    df = spark.createDataFrame([(1, [1e30] * 64)], "vec_id long, embedding array<float>")
    with pytest.raises(Exception, match="after scaling"):
        centroids.report(df).collect()


def test_the_tournament_finds_the_nearest():
    rng = np.random.default_rng(2)
    middle, vectors = rng.integers(-3, 4, (25, 5)), rng.integers(-4, 5, (2000, 5))
    middle[9], middle[17] = middle[3], middle[3]
    away = ((vectors[:, None, :] - middle[None]) ** 2).sum(axis=2)
    champion, distance = centroids.Tournament(middle).nearest(vectors)
    assert (champion == away.argmin(axis=1)).all() and (distance == away.min(axis=1)).all()
