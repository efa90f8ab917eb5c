import json

import pytest

from feedflow.operators.decode import decode
from feedflow.operators.validate import accepted, check_blocks, check_transactions, conforming_transactions, rejected, well_formed
from feedflow.plans import feed
from feedflow.sources.literal import literal, messages
from tests.examples import COIN, TRANSACTION, transaction, without

# text -> reason; None when valid
TRANSACTIONS = {
    json.dumps(TRANSACTION): None,
    transaction(): None,
    transaction(extra={"a": 1}): None,
    transaction(ver=4294967295): None,
    transaction(ver=1.0): None,
    transaction().replace('"ver":1', '"ver":1e3'): None,
    transaction().replace('"ver":1', '"ver":99999999999999999999999999999999999999999'): None,
    transaction().replace('"ver":1', '"ver":1.5'): "x.ver: not integer",
    transaction().replace('"ver":1', '"ver":1e400'): "x.ver: not integer",
    transaction(out=[dict(COIN, value=1.5)]): None,
    transaction(out=[dict(COIN, note=1), COIN]): None,
    transaction(ver=True): "x.ver: not integer",
    transaction(ver="7"): "x.ver: not integer",
    transaction(hash=12): "x.hash: not string",
    transaction(hash=None): "x.hash: not string",
    transaction(inputs={}): "x.inputs: not array",
    transaction(inputs=None): "x.inputs: not array",
    transaction(inputs=[5]): "x.inputs[]: not object",
    transaction(out=[dict(COIN, spent=0)]): "x.out[].spent: not boolean",
    transaction(out=[dict(COIN, addr=None)]): "x.out[].addr: not string",
    transaction(out=[dict(COIN, n="0"), dict(COIN, n="1")]): "x.out[].n: not integer",
    without(transaction(), "x", "out", 1, "addr"): "x.out[].addr: missing",
    without(transaction(), "x", "inputs", 0, "prev_out", "script"): "x.inputs[].prev_out.script: missing",
    without(transaction(), "x", "inputs", 0, "prev_out"): "x.inputs[].prev_out: missing",
    without(transaction(), "x", "out"): "x.out: missing",
    without(transaction(), "op"): "op: missing",
    without(transaction(), "x"): "x: missing",
    transaction().replace('"op":"utx"', '"op":"block"'): "op: not utx",
    transaction().replace('"op":"utx"', '"op":["utx"]'): "op: not utx",
    transaction().replace('"op":"utx"', '"op":"old","op":"utx"'): None,
    "[" + transaction() + "]": "root: not object",
    "5": "root: not object",
    "null": "root: not object",
    transaction()[:-3]: "malformed JSON",
    transaction() + transaction(): "malformed JSON",
    "": "malformed JSON",
    without(transaction(hash=1, size="2"), "op"): "op: missing; x.size: not integer; x.hash: not string",
}

GOOD = {"id": "z", "height": 7, "timestamp": 1, "tx_count": 2}
BLOCKS = {
    json.dumps({"block": GOOD}): None,
    json.dumps({"block": dict(GOOD, more=[1]), "other": 1}): None,
    json.dumps({"block": dict(GOOD, height="7")}): "height: not integer",
    json.dumps({"block": {k: v for k, v in GOOD.items() if k != "tx_count"}}): "tx_count: missing",
    json.dumps({"block": {}}): "block: missing or empty",
    json.dumps({"block": None}): "block: missing or empty",
    json.dumps(GOOD): "block: missing or empty",
    json.dumps({"block": 5}): "block: not object",
    json.dumps([GOOD]): "root: not object",
    "{": "malformed JSON",
}


@pytest.mark.parametrize("cases, check", [(TRANSACTIONS, check_transactions), (BLOCKS, check_blocks)])
def test_reasons(spark, cases, check):
    checked = check(decode(messages(spark, list(cases))))
    bad = {row.value: row.reason for row in rejected(checked).collect()}
    assert {text: bad.get(text) for text in cases} == cases
    assert {row.json_data for row in accepted(checked).collect()} == {text for text, reason in cases.items() if reason is None}


def test_conforming_is_the_check_without_reasons(spark):
    texts = decode(messages(spark, list(TRANSACTIONS)))
    assert {row.json_data for row in conforming_transactions(texts).collect()} == {text for text, reason in TRANSACTIONS.items() if reason is None}


def test_transactions_pass_on_their_original_text(spark):
    spaced = json.dumps(TRANSACTION, indent=1)
    out = feed.ingest_transactions(messages(spark, [spaced, "{}"])).collect()
    assert [(row.topic, bytes(row.value).decode()) for row in out] == [("unconfirmed_transactions", spaced)]


def test_blocks_are_written_out_again(spark):
    out = feed.ingest_blocks(messages(spark, list(BLOCKS)))
    values = [json.loads(bytes(row.value)) for row in out.collect()]
    assert sorted(values, key=len) == [GOOD, dict(GOOD, more=[1])]


def test_reject_table_has_lineage(spark):
    rows = rejected(check_transactions(decode(messages(spark, ["x"], "feed"))))
    assert rows.columns == ["topic", "partition", "offset", "value", "reason"]
    assert rows.first().topic == "feed"


def test_well_formed(spark):
    table = literal(spark, [(1, '{"k": 1}'), (2, "{"), (3, None)], "id int, props string")
    assert [row.asDict() for row in well_formed(table, "props").collect()] == [{"id": 1, "props": '{"k": 1}'}]
