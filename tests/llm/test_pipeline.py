"""The corpus pipeline: stages by name, their columns, and run() against the stages' operators on collected rows."""

import hashlib

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from feedflow.llm import jaccard, toxicity
from feedflow.llm.queries import table, tokenizer_path
from tests.llm.test_decontaminate import plain as contaminated
from tests.llm.test_jaccard import plain as near_copies
from tests.llm.test_lines import plain_copies_once


def test_run_equals_brute_force(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.report(docs, table(spark, sf_dir, "labels")).filter("predicted = 0").select("doc_id")
    rows = plain_copies_once([(r["doc_id"], r["text"], r["source"]) for r in docs.join(scored, "doc_id").orderBy("doc_id").collect()])
    firsts = {d for d, _, c in near_copies(rows, 5, 80) if d == c}
    rows = [r for r in rows if r[0] in firsts]
    items = [tuple(r) for r in table(spark, sf_dir, "benchmark").select("item_id", "text").collect()]
    clean = {r[0] for r in contaminated(rows, items) if not r[5]}
    tokenizer = Tokenizer.from_file(tokenizer_path())
    wanted = set()
    for doc, text in rows:
        if doc in clean:
            ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
            wanted.add((doc, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert {tuple(r) for r in corpus_pipeline.run(spark, sf_dir).collect()} == wanted
    assert 0 < len(wanted) < docs.count()


def test_stages_keep_the_columns(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).columns == docs.columns, name


def test_stages_take_empty_tables_and_nulls(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").limit(0)
    odd = spark.createDataFrame([(1, None, None, None, None), (None, "", None, "s", 0), (2, "a b c", "en", None, 5), (2, "a b c", "en", None, 5)], docs.schema)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).isEmpty(), name
        assert stage(spark, odd, sf_dir).count() == (3 if name == "jaccard_join" else 4), name


def test_near_copies_of_five_words_and_80_per_cent_go(spark, sf_dir):
    """Two separate changes in 100 words: 0.81 by five words (and under 0.9 by three)."""
    schema = table(spark, sf_dir, "documents").schema
    own = [hashlib.md5(str(i).encode()).hexdigest()[:6] for i in range(100)]
    changed = [*own[:30], "x", *own[31:70], "y", *own[71:]]
    docs = spark.createDataFrame([(i, " ".join(words), "en", "s", 0) for i, words in ((5, changed), (4, own), (6, own[::-1]))], schema)
    assert sorted(r["doc_id"] for r in corpus_pipeline.keep_one_copy(spark, docs, sf_dir).collect()) == [4, 6]


def test_repeated_ids_lose_no_text_and_names_do_not_clash(spark, sf_dir):
    rows = [(1, "one text of its own"), (1, "another text under the same id"), (1, "one text of its own"), (2, "another text under the same id"), (3, None), (None, "one text of its own")]
    docs = spark.createDataFrame([(i, text, "g", 1, 2, 3, 4) for i, text in rows], "doc_id long, text string, gone string, __copy_id int, id int, key int, row int")
    kept = jaccard.one_of_each(docs, corpus_pipeline.NEAR_COPIES)
    assert kept.columns == docs.columns
    assert sorted(((r[0], r[1]) for r in kept.collect()), key=str) == sorted([(1, rows[0][1]), (1, rows[1][1]), (3, None), (None, rows[0][1])], key=str)
    unique = jaccard.one_of_each(docs.filter("doc_id = 2 OR doc_id = 3 OR text LIKE 'another%'").dropDuplicates(["doc_id"]))
    assert unique.columns == docs.columns and unique.count() == 2


def copied():
    """A source in which copies and near copies of one text are two thirds of the pages; all pages but two have the same menu."""
    word = lambda *at: hashlib.md5(repr(at).encode()).hexdigest()[:6]
    page = lambda i: [[word(i, line, k) for k in range(12)] for line in range(10)]
    rows = [(i, "\n".join(["Menu", *map(" ".join, page(i))])) for i in range(10)]
    for i in range(20):
        own = page(-1)
        if i % 2:
            own[i // 2][5] = word("changed", i)
        rows.append((100 + i, "\n".join(map(" ".join, own))))
    return rows


def test_one_of_a_group_of_copies_comes_out_whole(spark, sf_dir):
    schema = table(spark, sf_dir, "documents").schema
    rows = copied()
    docs = spark.createDataFrame([(i, text, "en", "s", len(text)) for i, text in rows], schema)
    for stage in (corpus_pipeline.drop_boilerplate_lines, corpus_pipeline.keep_one_copy):
        docs = stage(spark, docs, sf_dir)
    kept = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert kept == {**{i: text.removeprefix("Menu\n") for i, text in rows if i < 100}, 100: rows[10][1]}
