from feedflow.operators.decode import decode
from feedflow.operators.route import route
from feedflow.sources.literal import messages

# text -> (compat route, strict route without a topic)
CASES = {
    '{"hash":"a","height":5}': ("block", "block"),
    '{"id":"z","height": 7,"timestamp":1,"tx_count":2}': ("block", "block"),
    '{"op":"utx","x":{"hash":"height"}}': ("both", "tx"),
    '{"op":"utx","x":{"hash":"h"},"height":1}': ("both", "tx"),
    '{"op": "utx","x":{"hash":"spaced"}}': ("unrouted", "tx"),
    '{"hash":"tx-1","tx_index":1,"time":2,"inputs":[],"outputs":[]}': ("unrouted", "unrouted"),
    '{"kind": "quote", "price": 17.25, "pair": "A/B"}': ("unrouted", "unrouted"),
    "": ("unrouted", "unrouted"),
}


def test_routes_without_topic(spark):
    texts = decode(messages(spark, list(CASES)))
    for index, mode in enumerate(("compat", "strict")):
        found = {row.json_data: row.route for row in route(texts, mode).collect()}
        assert found == {text: expected[index] for text, expected in CASES.items()}


def test_truncated_block_routes_by_marker(spark):
    texts = decode(messages(spark, ['{"hash":"a","height":5']))
    assert route(texts, "compat").first().route == "block"


def test_topic_decides_in_strict(spark):
    for topic, expected in {"confirmed_blocks": "block", "unconfirmed_transactions": "tx", "other": "unrouted"}.items():
        texts = decode(messages(spark, ['{"op":"utx","height":1}', "broken"], topic))
        assert {row.route for row in route(texts, "strict").collect()} == {expected}


def test_strict_routing_without_topic_column(spark):
    texts = decode(messages(spark, list(CASES))).drop("topic")
    assert route(texts, "strict").filter("route = 'tx'").count() == 3
