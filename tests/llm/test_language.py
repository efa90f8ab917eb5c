"""Code lengths against a walk through the tree, and predictions."""

import math
from collections import Counter, defaultdict

import numpy as np

from feedflow.llm import language
from tests.llm.conftest import LONG

ENGLISH = ["the cat sat on the mat and the dog ran to the house", "this is what they said when the rain came"]
GERMAN = ["der Hund lief über die Straße und die Katze schlief", "das ist was sie sagten als der Regen kam"]


def block(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])


def counted(texts):
    codes, n = np.unique(language.strings(*block(texts)), return_counts=True)
    return codes, n.astype(float)


def walked(texts, text):
    """Bits of a text under one language, context by context."""
    tree = defaultdict(Counter)
    for t in texts:
        raw = b"\n" * language.ORDER + t.encode()
        for i in range(language.ORDER, len(raw)):
            for k in range(language.ORDER + 1):
                tree[raw[i - k : i]][raw[i]] += 1
    raw, bits = b"\n" * language.ORDER + text.encode(), 0.0
    for i in range(language.ORDER, len(raw)):
        for k in range(language.ORDER, -1, -1):
            seen = tree.get(raw[i - k : i])
            if seen is None:
                continue
            total, kinds = sum(seen.values()), len(seen)
            if raw[i] in seen:
                bits -= math.log2(seen[raw[i]] / (total + kinds))
                break
            bits -= math.log2(kinds / (total + kinds))
        else:
            bits += 8
    return bits


def test_tables_price_what_the_trees_say():
    trees = language.compiled(["de", "en"], [counted(GERMAN), counted(ENGLISH)])
    for text in ["the Regen", "quite other words, 42", "ß", "the cat sat on the mat"]:
        bits = trees.price(language.strings(*block([text]))).sum(axis=0)
        assert np.allclose(bits, [walked(GERMAN, text), walked(ENGLISH, text)], rtol=1e-4)


def test_predictions_and_edge_cases(spark, documents):
    rows = [(i, (ENGLISH + GERMAN)[i % 4] + f" {i}", "en" if i % 4 < 2 else "de") for i in range(80)]
    rows += [(100, None, "en"), (101, "", "de"), (102, "123 ?!", "en"), (103, "der Hund " * 30_000, None), (104, "the house", None), (104, "the house", None), (None, "der Hund", "de")]
    found = language.report(documents(rows)).collect()
    assert len(found) == len(rows)
    by_id = {r["doc_id"]: r for r in found}
    assert [by_id[i]["lang_pred"] for i in (100, 101, 102)] == ["und"] * 3 and by_id[100]["score"] == 0
    assert by_id[103]["lang_pred"] == "de" and by_id[104]["lang_pred"] == "en"
    assert all(by_id[i]["lang_pred"] == rows[i][2] for i in range(80))
    assert all(0 <= r["score"] <= 1 and r["held_out"] is not None for r in found)


def test_nothing_to_learn_from(spark, documents):
    assert language.report(documents([])).isEmpty()
    assert [r["lang_pred"] for r in language.report(documents([(1, LONG), (2, "a")])).collect()] == ["und", "und"]


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    joined = language.report(docs).filter("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    assert joined.filter("lang = lang_pred").count() >= 0.95 * joined.count()
