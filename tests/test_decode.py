import pytest
from pyspark.sql import functions as F

from feedflow.operators.decode import decode, parse, parse_variant
from feedflow.sources.literal import literal

DDL = "hash string, nonce int, height bigint, main_chain boolean, tx array<string>"

# text -> (compat fields hash, nonce, height, tx), strictly valid
CASES = {
    '{"hash":"a","nonce":1,"height":5}': (("a", 1, 5, None), True),
    '{"hash":"a","zzz":1,"height":5}': (("a", None, 5, None), True),
    '{"hash":"a","height":5': ((None,) * 4, False),
    'not json "height"': ((None,) * 4, False),
    '{"hash":"a","height":"tall"}': (("a", None, None, None), False),
    '{"hash":"a","nonce":4294967295,"height":5}': (("a", None, 5, None), False),
    '{"hash":"a","height":5.0}': (("a", None, None, None), False),
    '{"hash":12,"height":"7"}': (("12", None, None, None), False),
    '{"height":true}': ((None,) * 4, False),
    '{"height":1,"tx":[{"a":1},2]}': ((None, None, 1, ['{"a":1}', "2"]), False),
    '{"height":1,"tx":["a",null]}': ((None, None, 1, ["a", None]), True),
    # A string field takes strings and null only.
    '{"hash":12}': (("12", None, None, None), False),
    '{"hash":{"a":1}}': (('{"a":1}', None, None, None), False),
    '{"hash":true}': (("true", None, None, None), False),
    '{"hash":null,"height":3}': ((None, None, 3, None), True),
    '{"height":4,"zzz":NaN}': ((None, None, 4, None), False),
    # Text that would go on as fields of the frame it is parsed in.
    '{"hash":"a"},"zzz":1': (("a", None, None, None), False),
    '{"hash":"a"},"seal":5': (("a", None, None, None), False),
    '{"hash":"a"},"texts":{"hash":"a"}': (("a", None, None, None), False),
    '{"hash":"a"},"_corrupt_record":"x"': (("a", None, None, None), False),
    '{"hash":"a"},"record":{"hash":"b"}': (("a", None, None, None), False),
    '{"hash":"a","record":1,"seal":2,"_corrupt_record":3}': (("a", None, None, None), True),
    '[{"height":1}]': ((None,) * 4, False),
    "null": ((None,) * 4, False),
    '{"height":1,"height":2}': ((None, None, 2, None), True),
    '{"Height":9,"HASH":"q"}': ((None,) * 4, True),
    # Spark's parser stops after the first value; strict notices what follows.
    '{"hash":"a","height":5} junk': (("a", None, 5, None), False),
    '{"hash":"a","height":5}{"hash":"b"}': (("a", None, 5, None), False),
    '{"hash":"a","height":5}} junk': (("a", None, 5, None), False),
    "{'hash':'a'}": (("a", None, None, None), False),
}
BLANK = ["", "  \t\n", None]


@pytest.fixture(scope="module")
def texts(spark):
    return literal(spark, [(text,) for text in [*CASES, *BLANK]], "json_data string").cache()


def test_compat_parse(texts):
    rows = {row.raw_json: row for row in parse(texts, DDL, "compat").collect()}
    for text, (fields, _) in CASES.items():
        found = rows[text]
        assert found.schema_valid, text
        assert (found.parsed.hash, found.parsed.nonce, found.parsed.height, found.parsed.tx) == fields, text
    for text in BLANK:
        assert rows[text].parsed is None and not rows[text].schema_valid


def test_strict_parse(texts):
    rows = {row.raw_json: row for row in parse(texts, DDL, "strict").collect()}
    for text, (_, valid) in CASES.items():
        assert rows[text].schema_valid is valid, text
        assert (rows[text].reason is None) is valid, text
    for text in BLANK:
        assert rows[text].reason == "blank message"


def test_strict_parse_reports_further_reasons(texts):
    refuse = F.when(F.col("parsed.hash").isNull(), "hash: missing")
    rows = {row.raw_json: row.reason for row in parse(texts, DDL, "strict", refuse).collect()}
    assert rows['{"Height":9,"HASH":"q"}'] == "hash: missing"
    assert rows["null"] == "malformed or mistyped JSON"


def test_invalid_utf8(spark):
    messages = literal(spark, [(bytearray(b'{"hash":"\xff"}'),)], "value binary")
    assert parse(decode(messages), DDL, "strict").first().reason == "not valid UTF-8"


def test_decode_keeps_lineage_that_exists(spark):
    messages = literal(spark, [(bytearray(b"x"), "t", 3)], "value binary, topic string, offset bigint")
    assert decode(messages).columns == ["topic", "offset", "json_data"]


def test_variant_wants_one_whole_value(spark):
    texts = ['{"a":1}', " [1] ", "5", '{"a":1} x', '{"a":1},2', '{"a":1}] [', "", "{", "NaN", '{"a":1,"a":2}']
    df = literal(spark, [(text,) for text in texts], "json_data string")
    rows = {row.json_data: row.text for row in parse_variant(df).select("json_data", F.to_json("doc").alias("text")).collect()}
    assert rows == {
        '{"a":1}': '{"a":1}', " [1] ": "[1]", "5": "5", '{"a":1} x': None, '{"a":1},2': None, '{"a":1}] [': None,
        "": None, "{": None, "NaN": None, '{"a":1,"a":2}': '{"a":2}',
    }


def test_unknown_mode(texts):
    with pytest.raises(ValueError, match="mode"):
        parse(texts, DDL, "loose")
