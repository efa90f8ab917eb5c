"""The registered queries of the operators over whole small tables: against SQL, the tokenizer, or the pages' own articles."""

import hashlib
import html
import re

import numpy as np
import pytest
from tokenizers import Tokenizer

from feedflow.llm.oracles import ORACLES
from feedflow.llm.queries import QUERIES, table, tokenizer_path
from tests.conftest import SF_DIR
from tests.oracle import database, difference


@pytest.fixture(scope="module")
def connection():
    return database(SF_DIR)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, connection, name):
    assert difference(spark, connection, name, SF_DIR) == ""


def test_one_query_per_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


def test_bpe_equals_the_tokenizer(spark):
    tokenizer = Tokenizer.from_file(tokenizer_path())
    texts = {r["doc_id"]: r["text"] or "" for r in table(spark, SF_DIR, "documents").collect()}
    found = QUERIES["op5_bpe"](spark, SF_DIR).collect()
    assert len(found) == len(texts)
    for row in found:
        ids = tokenizer.encode(texts[row["doc_id"]], add_special_tokens=False).ids
        text = tokenizer.decode(ids, skip_special_tokens=False)
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest() and row["n_tokens"] == len(ids)
        assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_extraction_equals_the_articles(spark):
    pages = {r["page_id"]: r["html"] for r in table(spark, SF_DIR, "pages").collect()}
    for row in QUERIES["op2_html_text"](spark, SF_DIR).collect():
        article = pages[row["page_id"]].split("<article>")[1].split("</article>")[0].replace("<br>", " ")
        parts = [" ".join(html.unescape(re.sub("<[^>]+>", "", part)).split()) for part in re.split("</?(?:p|h1)>", article)]
        assert row["text"] == "\n\n".join(part for part in parts if part)


@pytest.mark.parametrize("name, columns", [
    ("op1_language", ["doc_id", "held_out", "lang_pred", "score"]), ("op3_toxicity", ["doc_id", "held_out", "score", "predicted"]),
])
def test_predictions_cover_every_document(spark, name, columns):
    found = QUERIES[name](spark, SF_DIR)
    rows = found.collect()
    assert found.columns == columns and len(rows) == table(spark, SF_DIR, "documents").count()
    assert all(0 <= r["score"] <= 1 for r in rows)
