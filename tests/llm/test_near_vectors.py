"""Links and components of near vectors against all cosines."""

import numpy as np
from pyspark.sql import functions as F

from feedflow.llm import near_vectors
from feedflow.llm.near_vectors import Search
from feedflow.llm.shared import written

SCHEMA = "vec_id long, embedding array<float>, label int, node long, v string, half string, root string"


def plain(rows, threshold=0.95):
    """Like the operator's rows, for ids that occur once."""
    width = max((len(v) for _, v in rows if v is not None), default=0)
    good = [(i, np.array([*v, *[0.0] * (width - len(v))], np.float64)) for i, v in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    unit = np.array([v / np.abs(v).max() for _, v in good]).reshape(len(good), width)
    unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
    linked = unit @ unit.T >= threshold
    np.fill_diagonal(linked, False)
    label, before = np.array([i for i, _ in good]), None
    while before is None or (label != before).any():
        before = label.copy()
        for a, b in zip(*np.nonzero(linked), strict=True):
            label[a] = min(label[a], label[b])
    found = {i: (int(n), int(c)) for (i, _), n, c in zip(good, linked.sum(axis=1), label, strict=True)}
    return sorted((i, *found.get(i, (0, i)), found.get(i, (0, i))[1] == i) for i, _ in rows)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, None, None, None, None, None) for i, v in rows], SCHEMA)


def check(spark, rows, search=None):
    df = frame(spark, rows)
    exact = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    assert sorted(map(tuple, near_vectors.join(df, search).collect())) == plain(exact)


def planted(rng, alone, groups, width=24, near=0.03):
    """Random vectors, and groups of vectors around one."""
    rows = list(rng.standard_normal((alone, width)))
    for size in groups:
        middle = rng.standard_normal(width)
        rows += [middle + near * rng.standard_normal(width) * np.sqrt(width) / 5 for _ in range(size)]
    order = rng.permutation(len(rows))
    return [(int(i), [float(x) for x in rows[at]]) for i, at in enumerate(order)]


def test_equals_all_cosines(spark):
    rng = np.random.default_rng(4)
    rows = planted(rng, 500, [2] * 30 + [3] * 5 + [9, 40])
    copies = [(2000 + i, rows[i // 20][1]) for i in range(60)] + [(3000, [-0.0 if x == 0 else x * 2 for x in rows[0][1]])]
    odd = [(4000, None), (4001, []), (4002, [0.0] * 24), (4003, [float("nan")] * 24), (4004, [float("inf"), 1.0]), (4005, [None, 1.0]), (4006, rows[5][1][:23] + [0.0]),
           (4007, rows[5][1][:23]), (4008, [1e-42] * 24), (4009, [3e38] * 24)]
    check(spark, rows + copies + odd, Search(room=12, most=48, start=16))


def test_dense_and_chained_clusters_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_vectors, "BLOCK", 16)
    rng = np.random.default_rng(5)
    chain = [[float(np.cos(0.25 * i)), float(np.sin(0.25 * i)), 0.0, *[0.0] * 13] for i in range(5)]
    ring = [[0.0] * 14 + [float(np.cos(0.05 * i)), float(np.sin(0.05 * i))] for i in range(40)]
    rows = planted(rng, 150, [70], width=16) + [(1000 + i, v) for i, v in enumerate(chain + ring)]
    check(spark, rows, Search(room=8, most=24, start=16, meet=20))


def test_rows_without_and_with_repeated_ids_and_empty_tables(spark):
    rows = [(7, [1.0, 0.0]), (7, [0.0, 1.0]), (7, [1.0, 0.01]), (None, [0.0, 2.0]), (None, [1.0, 1.0]), (3, [0.02, 1.0])]
    found = sorted(map(tuple, near_vectors.join(frame(spark, rows)).collect()), key=str)
    assert found == sorted([(7, 1, 7, True), (7, 1, 7, True), (7, 2, 3, False), (None, 2, 3, False), (None, 0, None, True), (3, 2, 3, True)], key=str)
    check(spark, [])
    check(spark, [(1, None)])
    check(spark, [(1, [1.0])])


def test_the_descent_finds_what_its_start_does_not(spark):
    """From lists that hold a fraction of the links, rounds of neighbours of neighbours find nearly all; the audit measures it."""
    rng = np.random.default_rng(6)
    rows = planted(rng, 1000, [2] * 100, width=16, near=0.2)
    search, width = Search(room=16, start=8), 16
    ids = near_vectors.identified(frame(spark, rows), width)
    vectors = written(spark, near_vectors.halved(near_vectors.distinct(ids), width), "v")
    n = vectors.count()
    blocks = near_vectors.first_blocks(spark, vectors, n, width, search)
    lists = written(spark, near_vectors.merged(None, near_vectors.offers(blocks, 2 * n, width, search), search), "l")
    linked = lambda found: found.filter(F.col("sim") >= search.near).select("node").distinct().count()
    first, last = linked(lists), linked(near_vectors.descended(spark, lists, vectors, width, search, 3))
    wanted = sum(r[1] > 0 for r in plain(rows))
    assert first < 0.8 * wanted and last >= 0.98 * wanted
    assert near_vectors.near_links(spark, vectors, n, width, search)[2] >= 0.98
