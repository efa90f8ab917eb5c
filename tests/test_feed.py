"""The feed's dataflows on literal messages."""

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from feedflow.operators.decode import decode, parse
from feedflow.operators.rollup import transaction_rollup, transaction_rollup_rejects
from feedflow.operators.shape import block_transactions, hash_or_na, transaction_inputs, transaction_outputs
from feedflow.plans import feed
from feedflow.schemas import BLOCK_DDL
from feedflow.sources.literal import literal, messages
from tests.examples import BLOCK, COIN, TRANSACTION, transaction, without

TRUNCATED = '{"hash":"a","height":5'
MIXED = [
    json.dumps(TRANSACTION, separators=(",", ":")),
    json.dumps(BLOCK),
    TRUNCATED,
    '{"op":"utx","x":{"hash":"height"}}',
    '{"op":"utx","x":{"hash":"h"},"height":1}',
    '{"op": "utx","x":{"hash":"spaced"}}',
    '{"kind": "quote", "price": 17.25, "pair": "A/B"}',
]


@pytest.fixture(scope="module")
def mixed(spark):
    return messages(spark, MIXED)


def test_compat_transactions(mixed):
    rows = feed.transactions(mixed, "compat").collect()
    assert sorted(row.x.hash for row in rows) == ["h", "height", "t-77"]
    assert rows[0].asDict(recursive=True).keys() == {"op", "x"}


def test_compat_blocks_let_malformed_text_through(mixed):
    rows = feed.blocks(mixed, "compat").collect()
    assert sorted(str(row.height) for row in rows) == ["1", "811000", "None", "None"]
    assert all(row.schema_valid for row in rows)
    assert feed.block_dead_letters(mixed, "compat").isEmpty()


def test_compat_dead_letters_both_ways_equal_each_way_alone(spark):
    texts = messages(spark, [*MIXED, "   ", "", None, "  ", " \t", '"height"'])
    routed = feed.block_dead_letters(texts, "compat").withColumn("routed", F.lit(True))
    direct = feed.dead_letters(parse(decode(texts), BLOCK_DDL, "compat")).withColumn("routed", F.lit(False))
    found, expected = ([tuple(row) for row in df.collect()] for df in (feed.block_dead_letters_both_ways(texts), routed.unionByName(direct)))
    assert Counter(found) == Counter(expected) and len(found) >= 3 and ("  ", False) in found



def test_strict_diverts_malformed_text(mixed):
    assert [row.height for row in feed.blocks(mixed, "strict").collect()] == [811000]
    dead = feed.block_dead_letters(mixed, "strict").collect()
    assert [(row.value, row.reason) for row in dead] == [(TRUNCATED, "malformed or mistyped JSON")]


def test_strict_transactions(mixed):
    assert sorted(row.x.hash for row in feed.transactions(mixed).collect()) == ["h", "height", "spaced", "t-77"]


def test_strict_keeps_unsigned_numbers(spark):
    text = json.dumps(dict(BLOCK, nonce=4294967295, bits=4294967295))
    for mode, expected in {"compat": None, "strict": 4294967295}.items():
        assert feed.blocks(messages(spark, [text]), mode).first().nonce == expected


def test_strict_rejects_fractional_value(spark):
    dead = feed.transaction_dead_letters(messages(spark, [transaction(out=[dict(COIN, value=1.5)])]))
    assert dead.first().reason == "malformed or mistyped JSON"


def test_producer_blocks_are_normalised(spark):
    raw = messages(spark, ['{"block":{"id":"z","height":7,"timestamp":1,"tx_count":2}}'])
    strict = feed.blocks(feed.ingest_blocks(raw)).first()
    assert (strict.hash, strict.height, strict.time, strict.n_tx) == ("z", 7, 1, 2)
    compat = feed.blocks(feed.ingest_blocks(raw), "compat").first()
    assert (compat.hash, compat.height, compat.time, compat.n_tx) == (None, 7, None, None)


@pytest.mark.parametrize("mode", ["compat", "strict"])
def test_one_pass_gives_the_branches_outputs(mixed, mode):
    outputs = [(row.topic, row.value) for row in feed.classify(mixed, mode).collect()]
    by_topic = {}
    for topic, value in outputs:
        by_topic.setdefault(topic, []).append(value)
    from feedflow.operators.encode import to_message

    def values(df):
        return sorted(row.value for row in df.collect())

    assert sorted(by_topic["processed_transactions"]) == values(to_message(feed.transactions(mixed, mode)))
    assert sorted(by_topic["processed_confirmed_blocks"]) == values(to_message(feed.blocks(mixed, mode)))
    assert sorted(by_topic.get("invalid_confirmed_blocks", [])) == values(feed.block_dead_letters(mixed, mode))
    if mode == "strict":
        assert by_topic["unrouted_messages"] == [MIXED[-1]]
        assert len(outputs) == len(MIXED)


def test_one_pass_accounts_for_every_message(spark):
    texts = ["", None, "x", "[]", "{}", *MIXED]
    for topic in ("confirmed_blocks", "unconfirmed_transactions", "other", None):
        assert feed.classify(messages(spark, texts, topic)).count() == len(texts)


def test_unnesting(spark):
    transactions = feed.transactions(messages(spark, [transaction(hash="h"), transaction(hash="e", inputs=[], out=[])]))
    outputs = transaction_outputs(transactions)
    assert [(row.hash, row.n, row.addr, row.value) for row in outputs.orderBy("n").collect()] == [("h", 0, "addr-7", 5), ("h", 1, "addr-7", 5)]
    assert [(row.hash, row.sequence, row.value) for row in transaction_inputs(transactions).collect()] == [("h", 1, 5)]
    blocks = feed.blocks(messages(spark, [json.dumps(BLOCK)]))
    assert sorted(block_transactions(blocks).collect()) == [(811000, "t-77"), (811000, "t-78"), (811000, "t-79")]


def test_hash_default(spark):
    rows = literal(spark, [(("a",),), (("",),), ((None,),), (None,)], "x struct<hash: string>")
    assert [row[0] for row in rows.select(hash_or_na()).collect()] == ["a", "N/A", "N/A", "N/A"]


@pytest.mark.parametrize("tail", [',"zzz":1', ',"seal":5', ',"_corrupt_record":"x"', ',"record":{"op":"utx","x":{"hash":"evil"},"height":7}', " x"])
def test_text_that_goes_on_is_a_dead_letter(spark, tail):
    for record, topic, target in ((TRANSACTION, "unconfirmed_transactions", "invalid_transactions"), (BLOCK, "confirmed_blocks", "invalid_confirmed_blocks")):
        text = json.dumps(record) + tail
        raw = messages(spark, [text], topic)
        assert [tuple(r)[:3] for r in feed.classify(raw).collect()] == [(target, text, "malformed or mistyped JSON")]
        assert feed.transactions(raw).isEmpty() and feed.blocks(raw).isEmpty()


def test_rollup_survives_any_message(spark):
    most = 9223372036854775807
    texts = [
        transaction(hash="a", out=[dict(COIN, value=most), dict(COIN, value=1)]), transaction(hash="b", out=[dict(COIN, value=most)]),
        transaction(hash="c", time=most), transaction(hash="d", time=-most), without(transaction(hash="e"), "x", "time"),
    ]
    transactions = feed.transactions(messages(spark, texts, "unconfirmed_transactions"))
    assert [(r.n, int(r.value_sum)) for r in transaction_rollup(transactions).collect()] == [(2, 2 * most + 1)]
    rejects = {r.x.hash: r.reason for r in transaction_rollup_rejects(transactions).collect()}
    assert rejects == {"c": "time: out of range", "d": "time: out of range", "e": "time: missing"}
