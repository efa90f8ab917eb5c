"""The kernel against its definition, and what the machine finds."""

import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np

from feedflow.llm import toxicity
from tests.llm.conftest import LONG


def block(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])


def spelled(text):
    words = toxicity.words_of(*block([text]))
    return toxicity.spelled(words) if len(words) else []


def test_words():
    assert spelled("You are an ID-iot, i d i o t!") == ["you", "are", "an", "idiot", "idiot"]
    words = toxicity.words_of(*block(["a", "b c", "", "über 12 x"]))
    assert words.rows.tolist() == [0, 1, 3, 3] and len(toxicity.words_of(*block(["", " 12 "]))) == 0


def features(word):
    out = {}
    for a, b, c in itertools.combinations(range(len(word)), 3):
        if c - a <= 4:
            out[word[a] + word[b] + word[c]] = out.get(word[a] + word[b] + word[c], 0) + toxicity.DECAY ** (c - a - 2)
    norm = sum(toxicity.DECAY ** (2 * (c - a - 2)) for a, b, c in itertools.combinations(range(len(word)), 3) if c - a <= 4)
    return out, max(norm, toxicity.LEAST_NORM) ** 0.5


def test_kernel_is_the_sum_over_shared_subsequences():
    names = ["idiot", "moron", "banana", "abc"]
    table = toxicity.landmark_table(names)
    for word in ["idiot", "iddiot", "idot", "anana", "xy", "abcabc"]:
        value, _ = toxicity.kernel(toxicity.as_words([word]), table)
        mine, scale = features(word)
        for name, got in zip(names, value[0], strict=True):
            other, other_scale = features(name)
            assert np.isclose(got, sum(w * other.get(u, 0) for u, w in mine.items()) / scale / other_scale, atol=1e-5)


def corpus():
    rng = random.Random(2)
    syllables = ["the", "on", "er", "tion", "ly", "wh", "ha", "ea", "st"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    rows, labels = [], []
    for i in range(400):
        text = [word() for _ in range(rng.randint(20, 60))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(4):
                text.insert(rng.randrange(len(text)), rng.choice(["idiot", "scumbag", "moron"]))
        rows.append((i, " ".join(text)))
        labels.append((i, None, int(toxic)))
    return rows, labels


def test_finds_plain_gapped_and_inserted(spark, documents):
    rows, labels = corpus()
    clean = rows[1][1]
    rows += [(1000, clean + " idddiot"), (1001, clean + " i d i o t"), (1002, clean + " id-iot!"), (1003, clean), (1004, None), (1005, ""), (1006, LONG), (1006, LONG)]
    labels += [(1003, None, None), (5000, None, 1)]
    found = toxicity.report(documents(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(found) == len(rows)
    by_id = {r["doc_id"]: r for r in found}
    assert [by_id[i]["predicted"] for i in range(1000, 1007)] == [1, 1, 1, 0, 0, 0, 0]
    held = [(by_id[i]["predicted"], t) for i, _, t in labels[:400] if by_id[i]["held_out"]]
    assert sum(a == b for a, b in held) >= 0.98 * len(held) > 50
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in found)
    kept = toxicity.without_toxic(documents(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert kept.columns == documents(rows).columns and kept.count() == sum(r["predicted"] == 0 for r in found)


def test_nothing_to_learn_from(spark, documents):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.report(documents([]), none).isEmpty()
    assert [tuple(r) for r in toxicity.report(documents([(1, "a")]), none).select("score", "predicted").collect()] == [(0.0, 0)]


def test_cut_is_for_the_mix_of_the_corpus_not_of_the_sample():
    rng = np.random.default_rng(3)
    margin = np.concatenate([rng.normal(0, 1, 8000), rng.normal(1.5, 1, 1000)])
    label = np.repeat([0.0, 1.0], [8000, 1000])
    picked = np.concatenate([np.arange(0, 8000, 8), np.arange(8000, 9000)])
    whole, sample = toxicity.calibrated(margin, label), toxicity.calibrated(margin[picked], label[picked], 1 / 8, 1.0)
    assert abs(whole[1] / whole[0] - sample[1] / sample[0]) < 0.3


def test_sample_knows_its_shares(spark, documents, monkeypatch):
    monkeypatch.setattr(toxicity, "CLEAN_TEXTS", 60)
    rows, labels = corpus()
    sample, shares = toxicity.sampled(documents(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    usable = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").filter(toxicity.fold(toxicity.FOLDS) != toxicity.HELD_OUT)
    assert shares == (60 / usable.filter("toxic = 0").count(), 1.0) and sample.filter("label = 0").count() < 120


def test_landmarks_cover_every_toxic_word():
    rng = random.Random(4)
    forms = ["".join(rng.choice("aeiou") if c == "*" else c for c in "b*st*rdl*k*") for _ in range(400)]
    rare = ["xwqzvy", "jkqpxz", "vzzxjw"]
    toxic = [*dict.fromkeys(forms)][:100] + rare
    clean = ["".join(rng.choices("abcdefghilmnorstu", k=rng.randint(3, 9))) for _ in range(500)]
    assert len(toxic) == 103
    added = toxicity.pivots(toxic, clean[:64])
    assert set(rare) <= set(added) and len(added) < len(toxic)
    table = toxicity.landmark_table([*clean[:64], *added]).astype(np.float64)
    basis = np.linalg.svd(table, full_matrices=False)[0]
    words = toxicity.landmark_table(toxic).astype(np.float64)
    covered = ((basis.T @ words) ** 2).sum(axis=0) / (words**2).sum(axis=0)
    assert covered.min() > 1 - toxicity.RESIDUAL - 1e-6
    machine = toxicity.fitted(toxic, clean)
    assert (toxicity.kernel(toxicity.as_words(rare), machine.weights)[0] + machine.bias > 0).all()


def plain_margin(machine, text):
    """The worst word by the definition: normalised sums over the triples that begin in three cells of four letters."""
    best = machine.bias
    for word in spelled(text):
        cells = -(-len(word) // toxicity.CELL)
        starting = [[] for _ in range(cells)]
        for a, b, c in itertools.combinations(range(len(word)), 3):
            if c - a <= 4:
                code = sum((ord(word[i]) - 96) << shift for i, shift in ((a, 10), (b, 5), (c, 0)))
                starting[a // toxicity.CELL].append((code, toxicity.DECAY ** (c - a - 2)))
        for first in range(max(1, cells - 2)):
            held = [pair for cell in starting[first : first + 3] for pair in cell]
            norm = max(sum(w * w for _, w in held), toxicity.LEAST_NORM) ** 0.5
            best = max(best, sum(w * float(machine.weights[code]) for code, w in held) / norm + machine.bias)
    return best


def plain_words(texts):
    """``word -> (toxic, clean)``: how many different words stand before it, in ``(text, label)`` of either class."""
    seen = set()
    for text, label in texts:
        own = spelled(text)
        seen |= {(word, before, label) for before, word in zip([None, *own], own, strict=False) if len(word) >= 3}
    counts = Counter((word, label) for word, _, label in seen)
    return {word: (counts[word, 1], counts[word, 0]) for word, _, _ in seen}


def plain_support(words, toxic, clean):
    found = {}
    for word, (t, c) in words.items():
        parts = ((t, toxic / (toxic + clean)), (c, clean / (toxic + clean)))
        g = 2 * sum(n * math.log(n / ((t + c) * p)) for n, p in parts if n)
        if g >= max(toxicity.LEAST_G, 2 * math.log(len(words))) and (t / toxic) / ((c + 0.5) / clean) >= toxicity.LEAST_RATIO:
            found[word] = g
    return sorted(found, key=lambda word: (-found[word], word))


def plain_curve(margins, labels):
    """Every cut between two margins tried, then every slope."""
    values = sorted(set(margins))
    middles = [values[0], *((a + b) / 2 for a, b in itertools.pairwise(values)), values[-1] + 1]
    errors = [sum((m >= cut) != bool(label) for m, label in zip(margins, labels, strict=True)) for cut in middles]
    cut = middles[errors.index(min(errors))]
    signs = [2 * label - 1 for label in labels]
    loss = lambda slope: sum(np.logaddexp(0, -slope * s * (m - cut)) for s, m in zip(signs, margins, strict=True))
    return min(np.geomspace(1, 256, 33), key=loss), cut


def test_report_equals_brute_force(spark, documents):
    rows, labels = corpus()
    rows += [(1001, rows[1][1] + " i d i o t"), (1002, rows[2][1] + " scumbaggery-and-more"), (1003, ""), (1004, "12 ?")]
    found = {r["doc_id"]: r["score"] for r in toxicity.report(documents(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    label = {i: toxic for i, _, toxic in labels if zlib.crc32(str(i).encode()) % 5}
    learned = [(text, label[i]) for i, text in rows if i in label]
    words = plain_words(learned)
    n_toxic = sum(toxic for _, toxic in learned)
    toxic = plain_support(words, n_toxic, len(learned) - n_toxic)
    assert {"idiot", "scumbag", "moron"} <= set(toxic)
    # Fewer clean words than the bounds of the sample of words: all of them are examples.
    clean = sorted((word for word, (_, c) in words.items() if c and word not in toxic), key=lambda word: (-words[word][1], word))
    assert len(clean) < toxicity.HARD
    machine = toxicity.fitted(toxic, clean)
    slope, cut = plain_curve([plain_margin(machine, text) for text, _ in learned], [toxic for _, toxic in learned])
    for i, text in rows:
        wanted = 1 / (1 + math.exp(-max(-500, min(500, slope * (plain_margin(machine, text) - cut)))))
        assert math.isclose(found[i], wanted, abs_tol=2e-3), (i, found[i], wanted)
        assert (found[i] >= 0.5) == (wanted >= 0.5)


def test_words_and_support_equal_plain_counts(spark, documents):
    rows, labels = corpus()
    label = {i: toxic for i, _, toxic in labels}
    sample = spark.createDataFrame([(i, text, label[i]) for i, text in rows], "doc_id long, text string, label int")
    words = toxicity.vocabulary(sample)
    plain = plain_words([(text, label[i]) for i, text in rows])
    assert {r["word"]: (r["toxic"], r["clean"]) for r in words.collect()} == plain
    ordered = [r["word"] for r in toxicity.support(words, 100, 300).orderBy(toxicity.F.desc("g"), "word").collect()]
    assert ordered == plain_support(plain, 100, 300)
