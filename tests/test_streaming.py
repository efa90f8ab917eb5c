import json

import pytest
from pyspark.sql import functions as F

from feedflow.operators.rollup import transaction_rollup
from feedflow.operators.shape import event_time
from feedflow.plans import feed, queries
from feedflow.plans.table_feed import mixed_messages, table, transaction_messages
from feedflow.settings import FeedSettings
from feedflow.sources.files import land, landed_stream, landed_table, log_files
from feedflow.sources.literal import messages
from feedflow.streaming import runs, sinks
from feedflow.streaming.progress import METRICS_DDL, ProgressLog, undelivered
from tests.examples import transaction


@pytest.fixture(scope="module")
def landed_path(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("landed") / "l")
    land(mixed_messages(spark, "/root/testdata/sf0.001"), path)
    return path


@pytest.mark.parametrize("mode", ["compat", "strict"])
def test_stream_equals_batch(spark, landed_path, tmp_path, mode):
    runs.finish(
        runs.start_single_pass_files(
            landed_stream(spark, landed_path, max_files_per_trigger=3), f"{tmp_path}/d", f"{tmp_path}/c", mode, once=True
        )
    )
    batch = feed.classify(landed_table(spark, landed_path), mode)
    streamed = spark.read.parquet(f"{tmp_path}/d").select(batch.columns)
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch).isEmpty() and batch.exceptAll(streamed).isEmpty()


def test_fan_out_equals_single_pass(spark, landed_path, tmp_path):
    runs.finish(runs.start_fan_out_files(landed_stream(spark, landed_path), f"{tmp_path}/d", f"{tmp_path}/c", once=True))
    batch = feed.classify(landed_table(spark, landed_path))
    streamed = spark.read.parquet(f"{tmp_path}/d").select(batch.columns)
    assert streamed.exceptAll(batch).isEmpty() and batch.exceptAll(streamed).isEmpty()


def test_restart_neither_loses_nor_repeats(spark, tmp_path):
    for n in range(3):
        texts = [transaction(hash=f"{n}-{i}") for i in range(5)]
        land(messages(spark, texts, "unconfirmed_transactions"), f"{tmp_path}/l")
        parsed = feed.transactions(landed_stream(spark, f"{tmp_path}/l"))
        runs.finish(sinks.to_files(parsed, f"{tmp_path}/d", f"{tmp_path}/c", once=True))
    found = spark.read.parquet(f"{tmp_path}/d").select("x.hash").collect()
    assert sorted(row.hash for row in found) == sorted(f"{n}-{i}" for n in range(3) for i in range(5))


def test_callback_sink_runs_per_batch(spark, landed_path, tmp_path):
    transactions = feed.transactions(landed_stream(spark, landed_path, max_files_per_trigger=2))
    runs.finish(sinks.to_batches(transactions, sinks.file_batch_sink(f"{tmp_path}/d"), f"{tmp_path}/c", once=True))
    written = spark.read.parquet(f"{tmp_path}/d")
    assert written.count() == feed.transactions(landed_table(spark, landed_path)).count()
    assert written.select("batch_id").distinct().count() > 1


def test_progress_rows_are_all_kept(spark, landed_path, tmp_path):
    listener = ProgressLog(spark, f"{tmp_path}/m", flush_rows=2)
    spark.streams.addListener(listener)
    try:
        stream = landed_stream(spark, landed_path, max_files_per_trigger=1)
        query = runs.finish(sinks.to_files(stream, f"{tmp_path}/d", f"{tmp_path}/c", once=True))
        listener.wait_for(str(query.id))
    finally:
        spark.streams.removeListener(listener)
    metrics = listener.metrics()
    assert metrics.columns == [part.split()[0] for part in METRICS_DDL.split(", ")]
    assert metrics.agg(F.sum("input_rows")).first()[0] == landed_table(spark, landed_path).count()
    assert metrics.select("batch_id").distinct().count() == metrics.count() > 2


def test_new_checkpoint_keeps_what_was_published(spark, landed_path, tmp_path):
    def publish(checkpoint):
        blocks = feed.blocks(landed_stream(spark, landed_path))
        runs.finish(sinks.to_batches(blocks, sinks.file_batch_sink(f"{tmp_path}/d"), checkpoint, once=True))
        return spark.read.parquet(f"{tmp_path}/d").count()

    once = publish(f"{tmp_path}/c1")
    assert publish(f"{tmp_path}/c1") == once
    assert publish(f"{tmp_path}/c2") == 2 * once
    assert spark.read.parquet(f"{tmp_path}/d").filter("run = 'none'").isEmpty()


def test_undelivered_rows():
    source = {"startOffset": {"t": {"0": 100, "1": 5}}, "endOffset": {"t": {"0": 160, "1": 5}}, "numInputRows": 40}
    assert undelivered(source) == 20
    assert undelivered({**source, "numInputRows": 60}) == 0
    assert undelivered({**source, "startOffset": None}) == 0


def test_branches_have_own_topics_and_checkpoints(spark, landed_path, monkeypatch):
    started = []
    monkeypatch.setattr(runs, "to_topic", lambda df, checkpoint, topic=None, settings=None, once=False: started.append((df.columns, checkpoint, topic)))
    monkeypatch.setattr(runs, "to_batches", lambda df, sink, checkpoint, once=False: started.append((df.columns[:2], checkpoint, None)))
    settings = FeedSettings(checkpoint_base="/c")
    stream = landed_stream(spark, landed_path)
    assert set(runs.start_branches(stream, settings, "compat")) == {"unconfirmed", "confirmed", "invalid_confirmed"}
    assert started == [
        (["value"], "/c/invalid_confirmed", "invalid_confirmed_blocks"),
        (["op", "x"], "/c/unconfirmed", None),
        (["hash", "ver"], "/c/confirmed", None),
    ]
    started.clear()
    runs.start_branches(stream, settings, "strict")
    assert started[-1] == (["value", "partition", "offset", "reason"], "/c/invalid_unconfirmed", "invalid_transactions")
    started.clear()
    runs.start_single_pass(stream, settings)
    assert started == [(["topic", "value", "reason", "partition", "offset"], "/c/feed", None)]
    started.clear()
    runs.start_logs(log_files(spark, landed_path), settings)
    assert started == [(["value"], "/c/logs", "spark-logs")]


def test_one_failure_stops_all(spark, landed_path, tmp_path):
    def broken(batch, batch_id):
        raise RuntimeError("sink failed")

    stream = landed_stream(spark, landed_path)
    healthy = sinks.to_files(stream, f"{tmp_path}/d", f"{tmp_path}/c1")
    failing = sinks.to_batches(stream, broken, f"{tmp_path}/c2")
    with pytest.raises(Exception, match="sink failed"):
        runs.await_any({"healthy": healthy, "failing": failing}, 1)
    assert not healthy.isActive and not failing.isActive


def test_console(spark, landed_path, tmp_path):
    runs.finish(sinks.to_console(landed_stream(spark, landed_path).select("offset"), f"{tmp_path}/c", rows=1, once=True))


def test_rollup_of_a_stream_gives_final_buckets(spark, sf_dir, tmp_path):
    land(transaction_messages(table(spark, sf_dir, "lineitem")), f"{tmp_path}/l")
    rolled = transaction_rollup(feed.transactions(landed_stream(spark, f"{tmp_path}/l")), late="3 days")
    runs.finish(sinks.to_files(rolled, f"{tmp_path}/d", f"{tmp_path}/c", once=True))
    transactions = feed.transactions(landed_table(spark, f"{tmp_path}/l"))
    last = transactions.agg(F.max(event_time("x.time"))).first()[0]
    final = F.col("bucket") + F.expr("INTERVAL 1 HOUR") <= F.lit(last) - F.expr("INTERVAL 3 DAYS")
    expected = transaction_rollup(transactions).filter(final)
    streamed = spark.read.schema(rolled.schema).parquet(f"{tmp_path}/d")
    assert expected.count() > 100
    assert streamed.exceptAll(expected).isEmpty() and expected.exceptAll(streamed).isEmpty()


def test_published_values_are_json(spark, landed_path):
    values = feed.classify(landed_table(spark, landed_path)).filter("topic = 'processed_transactions'")
    assert set(json.loads(values.first().value)) == {"op", "x"}


def test_metrics_of_a_file_source_reach_the_table_while_the_query_runs(spark, sf_dir, tmp_path):
    """Offsets of a file source are plain numbers; the listener keeps no more rows than it may and counts each input row once."""
    from pyspark.sql import functions as F

    from feedflow.streaming.progress import ProgressLog, undelivered

    assert undelivered({"startOffset": {"logOffset": 0}, "endOffset": {"logOffset": 1}, "numInputRows": 1}) == 0
    assert undelivered({"startOffset": {"t": {"0": 5}}, "endOffset": {"t": {"0": 9, "1": 3}}, "numInputRows": 1}) == 3
    spark.range(70).repartition(7).write.parquet(f"{tmp_path}/in")
    progress = ProgressLog(spark, f"{tmp_path}/metrics", flush_rows=2)
    spark.streams.addListener(progress)
    try:
        rows = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        query = rows.writeStream.option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).format("parquet").start(f"{tmp_path}/out")
        query.awaitTermination()
        early = spark.read.parquet(f"{tmp_path}/metrics").count()
        progress.wait_for(str(query.id))
    finally:
        spark.streams.removeListener(progress)
    own = progress.metrics().filter(F.col("query") == str(query.id))
    assert early >= 2 and len(progress.rows) == 0
    assert own.count() == own.select("batch_id").distinct().count() == 7 and own.agg(F.sum("input_rows")).first()[0] == 70


def test_fan_out_keeps_its_batch_on_disk_in_small_parts(spark, landed_path, tmp_path):
    """Memory must not grow with the batch: it is kept on disk only, in parts of few rows."""
    kept = []

    def look(batch, batch_id):
        size = batch.sparkSession.conf.get("spark.sql.inMemoryColumnarStorage.batchSize")
        kept.append((batch.storageLevel.useMemory, batch.storageLevel.useDisk, int(size) <= 500, batch.count()))

    sink = sinks.fan_out(lambda batch: batch.select("value"), {"a": (lambda prepared: prepared, look)})
    runs.finish(sinks.to_batches(landed_stream(spark, landed_path), sink, f"{tmp_path}/c", once=True))
    assert kept == [(False, True, True, landed_table(spark, landed_path).count())]


def test_fan_out_takes_a_table_in_parts_and_whole(spark, sf_dir, tmp_path, monkeypatch):
    for name in ("lineitem", "orders"):
        table(spark, sf_dir, name).repartition(3).write.parquet(f"{tmp_path}/{name}.parquet")
    monkeypatch.setattr(queries, "FAN_OUT_BYTES", 1)
    found = queries.stream_fan_out(spark, str(tmp_path))
    assert {int(path.split("batch_id=")[1].split("/")[0]) for path in found.inputFiles()} == {0, 1, 2}
    expected = queries.feed_texts(spark, sf_dir)
    assert found.count() == expected.count() and found.exceptAll(expected).isEmpty()
