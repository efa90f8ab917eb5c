"""The join against comparing all pairs; PartEnum's promise; components."""

import random
import re

import numpy as np
import pytest

from feedflow.llm import components, jaccard
from tests.llm.conftest import LONG

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain(rows, words=3, numerator=90, denominator=100):
    sets = []
    for _, text in rows:
        w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        n = min(words, len(w))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set())
    label = list(range(len(rows)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and denominator * both >= numerator * len(sets[i] | sets[j]):
                label[top(i)] = top(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[top(i)] = min(doc, least.get(top(i), doc))
    return [(doc, len(s), least.get(top(i), doc) if s else doc) for i, ((doc, _), s) in enumerate(zip(rows, sets, strict=True))]


def case(seed=4, base=12, copies=12):
    rng = random.Random(seed)
    rows, at = [], 0
    for _ in range(base):
        words = [rng.choice("abcdefghij") + rng.choice("klmnop") + str(rng.randrange(60)) for _ in range(rng.choice([1, 2, 5, 11, 19, 40, 120, 400]))]
        for _ in range(rng.randint(1, copies)):
            own = list(words)
            for _ in range(rng.choice([0, 0, 1, 2, len(words) // 40, len(words) // 20])):
                own[rng.randrange(len(own))] = str(rng.randrange(10**6))
            rows.append((at, rng.choice([" ", "\n", "  "]).join(own).replace("a", rng.choice("aA"))))
            at += 1
    rows += [(at, None), (at + 1, ""), (at + 2, " \n"), (at + 3, LONG), (at + 4, LONG + "x"), (3, rows[3][1]), (at + 5, "\x1f\x1f")]
    return rows


def test_the_looser_rule_equals_comparing_all_pairs(spark, documents):
    """The pipeline's rule, with sketches, on groups whose texts share passages as well."""
    rng = random.Random(9)
    passage = " ".join(f"shared{i}" for i in range(40))
    rows = [(i, f"{text} {passage}" if text and rng.random() < 0.5 else text) for i, (_, text) in enumerate(case(7, 30, 10))]
    rule = jaccard.Rule(words=5, numerator=80, denominator=100, likely=0.55)
    assert sorted(tuple(r) for r in jaccard.join(documents(rows), rule).collect()) == sorted(plain(rows, 5, 80))


def test_linked_sets_under_one_signature_are_candidates_though_others_lie_between(spark, monkeypatch):
    """All pairs of different components under a signature, in parts of any size, not only those that follow each other by key."""
    rng, rule = np.random.default_rng(3), jaccard.Rule(words=5, numerator=80, denominator=100, likely=0.55)
    rows, linked = [], set()
    for group in range(20):
        own = np.unique(rng.integers(0, 1 << 63, int(rng.integers(20, 900))).astype(np.uint64))
        near = np.concatenate([own[: len(own) - len(own) // 12], rng.integers(0, 1 << 63, len(own) // 12).astype(np.uint64)])
        rows += [(1000 + group, own), (5000 - group, np.unique(near))]
        linked.add((1000 + group, 5000 - group))
    sets = spark.createDataFrame([(k, len(s), bytearray(jaccard.sketch(s))) for k, s in rows], "key long, n long, sketch binary")
    signatures = spark.createDataFrame([(k, [7]) for k, _ in rows], "key long, signatures array<long>")
    for part in (3, 64):
        monkeypatch.setattr(jaccard, "PART", part)
        assert linked <= {tuple(r) for r in jaccard.likely_candidates(signatures, sets, rule).collect()}


def test_pairs_of_an_open_signature_never_become_rows(spark, monkeypatch):
    """All pairs are compared inside tasks; only those that may be linked come out, each once for a pair of parts."""
    rng, rule = np.random.default_rng(6), jaccard.Rule(words=5, numerator=80, denominator=100, likely=0.55)
    rows = [(k, np.unique(rng.integers(0, 1 << 63, 200 + k % 50).astype(np.uint64))) for k in range(90)]
    rows.append((500, np.concatenate([rows[5][1][:-4], rng.integers(0, 1 << 63, 4).astype(np.uint64)])))
    sets = spark.createDataFrame([(k, len(s), bytearray(jaccard.sketch(s))) for k, s in rows], "key long, n long, sketch binary")
    monkeypatch.setattr(jaccard, "SKETCH_BYTES", 1 << 12)
    for part in (7, 1024):
        keys = sorted(k for k, _ in rows)
        parts = [[{"key": k, "component": k} for k in keys[i : i + part]] for i in range(0, len(keys), part)]
        met = [(a, b if i < j else []) for i, a in enumerate(parts) for j, b in enumerate(parts) if i <= j]
        kind = "array<struct<key: long, component: long>>"
        found = jaccard.alike_apart(spark.createDataFrame(met, f"sets {kind}, others {kind}"), sets, rule)
        assert {tuple(r) for r in found.collect()} == {(5, 500)}
        assert "Generate explode" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_sketches_differ_in_no_more_bits_than_sets_in_shingles():
    rng = np.random.default_rng(5)
    for _ in range(500):
        a = np.unique(rng.integers(0, 1 << 63, int(rng.integers(1, 3000))).astype(np.uint64))
        b = np.unique(np.concatenate([a[int(rng.integers(0, len(a))) :], rng.integers(0, 1 << 63, int(rng.integers(0, 2000))).astype(np.uint64)]))
        x, y = (np.frombuffer(jaccard.sketch(s), np.uint64)[None] for s in (a, b))
        width = min(x.shape[1], y.shape[1])
        assert np.bitwise_count(jaccard.folded(x, width) ^ jaccard.folded(y, width)).sum() <= len(np.setxor1d(a, b))


def test_equals_comparing_all_pairs(spark, documents):
    rows = case()
    found = sorted(tuple(r) for r in jaccard.join(documents(rows)).collect())
    assert found == sorted(plain(rows))
    assert len({c for _, _, c in found}) < len(rows) - 20


def test_small_blocks(spark, documents, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 3)
    monkeypatch.setattr(jaccard, "BROADCAST_IDS", 0)
    rows = case(seed=8, copies=25)
    assert sorted(tuple(r) for r in jaccard.join(documents(rows)).collect()) == sorted(plain(rows))


def test_other_rules(spark, documents):
    rows = case(seed=9)
    rule = jaccard.Rule(words=5, numerator=80)
    assert sorted(tuple(r) for r in jaccard.join(documents(rows), rule).collect()) == sorted(plain(rows, 5, 80))


def test_one_of_each(spark, documents):
    rows = case()
    kept = jaccard.one_of_each(documents([*rows, (None, "no id")]))
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted({d for d, _, c in plain(rows) if d == c})
    assert kept.filter("doc_id IS NULL").count() == 1


@pytest.mark.parametrize(("numerator", "denominator"), [(90, 100), (80, 100), (1, 2)])
def test_similar_sets_share_a_signature(numerator, denominator):
    rule = jaccard.Rule(numerator=numerator, denominator=denominator)
    signer, rng = jaccard.Signer(rule), np.random.default_rng(7)
    tried = 0
    for _ in range(6000):
        size = int(rng.integers(2, 120))
        a = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
        gone, new = rng.integers(0, max(1, size // 3)), rng.integers(0, max(1, size // 3))
        b = np.unique(np.concatenate([a[gone:], rng.integers(0, 1 << 63, new).astype(np.uint64)]))
        both = len(a) - int(gone)
        if not both or denominator * both < numerator * (len(a) + len(b) - both) or np.array_equal(a, b):
            continue
        tried += 1
        assert np.intersect1d(signer.sign(a), signer.sign(b)).size
    assert tried > 200


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(1000, 1100)] + [(5000, i) for i in range(5001, 5100)]
    label = {}

    def top(x):
        while label.setdefault(x, x) != x:
            x = label[x]
        return x

    for a, b in edges:
        x, y = sorted((top(a), top(b)))
        label[y] = x
    found = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in found} == {x: top(x) for a, b in edges if a != b for x in (a, b)}
    assert len(found) == len({r["node"] for r in found})


def test_empty_table(spark, documents):
    assert jaccard.join(documents([])).isEmpty()
    assert jaccard.one_of_each(documents([])).isEmpty()
