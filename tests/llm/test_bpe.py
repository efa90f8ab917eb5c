"""Chunked encoding against the tokenizer itself."""

import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from feedflow.llm import bpe
from feedflow.llm.queries import tokenizer_path
from tests.llm.conftest import LONG


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


TEXTS = [
    "", " ", "a", "don't they're 'll  x", "tab\tand\n\n line  ends  ", "<|endoftext|>", "a<|endoftext|> b<|endoftext|>", "日本語 テキスト " * 300,
    "x" * 9000, "é à ü " * 2000, "\x1c \x85 　 mixed\r\nspace " * 200, LONG, "1234567890 " * 1500, "'s 't 're 've " * 900,
]


def block(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])


def test_ids_equal_the_tokenizers(tokenizer):
    codec = bpe.Codec(bpe.Vocabulary.load(tokenizer_path()), chunk_bytes=128)
    rng = random.Random(1)
    shared = " ".join(rng.choice(["the", "of", "Ünder", "42", "x,", "end.\n"]) for _ in range(3000))
    texts = TEXTS + [shared, "before " + shared, shared + " after", shared[1:]]
    found = list(codec.encode_block(*block(texts)))
    for text, ids in zip(texts, found, strict=True):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids
        assert codec.decode(ids) == tokenizer.decode(ids.tolist(), skip_special_tokens=False)
    assert codec.reused > 100


def test_digests_and_separate_steps_agree(spark, documents, tokenizer):
    docs = documents([(i, t) for i, t in enumerate(TEXTS)] + [(100, None), (None, "a b"), (1, " ")])
    rows = bpe.digests(docs, tokenizer_path()).collect()
    assert len(rows) == docs.count()
    by_id = {r["doc_id"]: r for r in rows}
    for i, text in enumerate(TEXTS):
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert by_id[i]["n_tokens"] == len(ids)
        assert by_id[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert by_id[i]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert by_id[100]["n_tokens"] == 0
    encoded = bpe.encode(docs, tokenizer_path())
    assert sorted(r["text"] for r in bpe.decode(encoded, tokenizer_path()).collect()) == sorted([*TEXTS, "", "a b", " "])


def test_empty_table(spark, documents):
    assert bpe.digests(documents([]), tokenizer_path()).isEmpty()
