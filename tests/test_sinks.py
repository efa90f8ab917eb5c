import json
from types import SimpleNamespace
from unittest.mock import patch

import pytest

from feedflow.operators.encode import to_message, utf8, variant_text, with_headers
from feedflow.settings import FeedSettings, shared_dir
from feedflow.sources import kafka
from feedflow.sources.files import land, landed_stream, landed_table, text_table
from feedflow.sources.literal import literal, messages
from feedflow.schemas import BLOCK_DDL, TRANSACTION_DDL
from feedflow.streaming import sinks
from tests.examples import BLOCK, TRANSACTION

SETTINGS = FeedSettings(bootstrap_servers="broker:9092", checkpoint_base="/shared/checkpoints/", kafka_options={"kafka.security.protocol": "SSL"})


@pytest.mark.parametrize(
    "record, ddl, sink, topic",
    [(TRANSACTION, TRANSACTION_DDL, sinks.transaction_batch_sink, "processed_transactions"),
     (BLOCK, BLOCK_DDL, sinks.block_batch_sink, "processed_confirmed_blocks")],
)
def test_batch_sinks_publish_what_they_get_and_skip_empty_batches(spark, tmp_path, record, ddl, sink, topic):
    settings = FeedSettings(message_format="parquet", message_path=str(tmp_path / "m"))
    df = literal(spark, [record, record], ddl)
    sink(settings)(df, 0)
    sink(settings)(df.limit(0), 1)
    rows = spark.read.parquet(str(tmp_path / "m")).collect()
    assert [(json.loads(row.value), row.topic, row.batch_id) for row in rows] == [(record, topic, 0)] * 2
    sinks.topic_batch_sink("t", settings, skip_empty=False)(df.limit(0), 2)
    assert (tmp_path / "m" / "topic=t" / "run=none" / "batch_id=2").exists()


@patch("pyspark.sql.DataFrameWriter.save")
def test_batch_sinks_write_to_kafka_by_default(save, spark):
    sinks.transaction_batch_sink(SETTINGS)(literal(spark, [TRANSACTION], TRANSACTION_DDL), 0)
    save.assert_called_once()


def test_headers(spark):
    df = literal(spark, [("v", "bad", 3, 9), ("w", None, None, None)], "value string, reason string, partition int, offset bigint")
    rows = with_headers(df).collect()
    assert rows[0].asDict(recursive=True) == {"value": "v", "headers": [
        {"key": "reason", "value": bytearray(b"bad")}, {"key": "partition", "value": bytearray(b"3")}, {"key": "offset", "value": bytearray(b"9")}]}
    assert rows[1].headers == [] and with_headers(df.select("value")).columns == ["value"]


def test_settings_name_shared_places():
    with pytest.raises(ValueError, match="checkpoint_base"):
        FeedSettings().checkpoint("x")
    with pytest.raises(ValueError, match="message_path"):
        FeedSettings().topic_path("x")


@pytest.mark.parametrize("record, ddl", [(TRANSACTION, TRANSACTION_DDL), (BLOCK, BLOCK_DDL)])
def test_published_payload(spark, record, ddl):
    assert json.loads(to_message(literal(spark, [record], ddl)).first().value) == record


def test_json_file_round_trip(spark, tmp_path):
    df = literal(spark, [BLOCK], BLOCK_DDL)
    for _ in range(2):
        sinks.write_json(df, str(tmp_path / "out"))
    assert spark.read.schema(BLOCK_DDL).json(str(tmp_path / "out")).collect() == df.collect()


def test_nulls_in_messages(spark):
    df = literal(spark, [(None, 1, (None,), [None], "k")], "a string, b int, s struct<c: string>, arr array<string>, id string")
    assert to_message(df.drop("id")).first().value == '{"b":1,"s":{},"arr":[null]}'
    assert to_message(df.drop("id"), ignore_nulls=False).first().value == '{"a":null,"b":1,"s":{"c":null},"arr":[null]}'
    keyed = to_message(df.select("b", "id"), key="id", lineage=("id",)).first()
    assert keyed.asDict() == {"key": "k", "id": "k", "value": '{"b":1}'}


def test_text_and_document_encoding(spark):
    df = literal(spark, [('{"b": "ü", "a": 1.0}',)], "t string").selectExpr("t", "parse_json(t) AS v")
    row = df.select(utf8("t").alias("t"), variant_text("v").alias("v")).first()
    assert bytes(row.t) == '{"b": "ü", "a": 1.0}'.encode() and row.v == '{"a":1,"b":"ü"}'


def test_kafka_options():
    assert kafka.stream_options(SETTINGS) == {
        "kafka.bootstrap.servers": "broker:9092", "subscribe": "unconfirmed_transactions,confirmed_blocks",
        "startingOffsets": "latest", "failOnDataLoss": "false", "kafka.security.protocol": "SSL",
    }
    limited = kafka.stream_options(SETTINGS, ("t",), "earliest", True, max_offsets_per_trigger=5, min_partitions=7)
    assert limited["startingOffsets"] == "earliest" and limited["failOnDataLoss"] == "true"
    assert limited["maxOffsetsPerTrigger"] == "5" and limited["minPartitions"] == "7" and limited["subscribe"] == "t"
    assert kafka.batch_options(SETTINGS, "t")["startingOffsets"] == "earliest"
    assert kafka.batch_options(SETTINGS, "t")["endingOffsets"] == "latest"
    assert sinks.kafka_sink_options(SETTINGS, "t")["topic"] == "t"
    assert "topic" not in sinks.kafka_sink_options(SETTINGS, None)
    assert SETTINGS.checkpoint("confirmed") == "/shared/checkpoints/confirmed"


@patch("pyspark.sql.DataFrameReader.load")
def test_topic_texts_are_whole(load, spark):
    load.return_value = messages(spark, ["a", "b", "c"] * 20)
    assert len(kafka.topic_texts(spark, SETTINGS, "t").collect()) == 60


def test_replayed_batch_is_written_once(spark, tmp_path):
    sink = sinks.file_batch_sink(str(tmp_path / "t"))
    df = literal(spark, [(1,), (2,)], "id int")
    for batch_id in (0, 1, 1):
        sink(df, batch_id)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 4


def test_fan_out_releases_its_batch_when_a_sink_fails(spark):
    def broken(batch, batch_id):
        assert batch.is_cached
        raise RuntimeError("sink")

    df, seen = literal(spark, [(1,)], "id int"), []
    sink = sinks.fan_out(lambda batch: batch, {"a": (lambda p: seen.append(p) or p, broken)})
    with pytest.raises(RuntimeError, match="sink"):
        sink(df, 0)
    assert not seen[0].is_cached


def test_landing_keeps_the_envelope(spark, tmp_path):
    raw = messages(spark, ["a"], "t1").unionByName(messages(spark, ["b"], "t2"))
    land(raw, str(tmp_path / "l"))
    back = landed_table(spark, str(tmp_path / "l"))
    assert sorted((row.topic, bytes(row.value)) for row in back.collect()) == [("t1", b"a"), ("t2", b"b")]
    assert landed_stream(spark, str(tmp_path / "l"), max_files_per_trigger=1, max_bytes_per_trigger=None).isStreaming


def test_text_feed(spark, tmp_path):
    (tmp_path / "feed.jsonl").write_text('{"a":1}\n{"b":2}\n')
    assert sorted(bytes(row.value) for row in text_table(spark, str(tmp_path), "t").collect()) == [b'{"a":1}', b'{"b":2}']


def session_with(master, **conf):
    return SimpleNamespace(conf=SimpleNamespace(get=conf.get), sparkContext=SimpleNamespace(master=master))


def test_shared_dir():
    named = session_with("yarn", **{"spark.checkpoint.dir": "hdfs:///shared/"})
    first, second = shared_dir(named, "x"), shared_dir(named, "x")
    assert first.startswith("hdfs:///shared/x-") and first != second
    assert shared_dir(session_with("local[2]"), "x")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session_with("yarn"), "x")


def test_smoke_table_shows(spark, capsys):
    literal(spark, [("one row, shown",)], "message string").show()
    assert "one row, shown" in capsys.readouterr().out
