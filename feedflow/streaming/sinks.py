"""Where messages go: Kafka topics, files, the console; as streams or per micro-batch."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from feedflow.operators.encode import to_message, with_headers
from feedflow.settings import FeedSettings

log = logging.getLogger(__name__)

BatchSink = Callable[[DataFrame, int], None]


def kafka_sink_options(settings: FeedSettings, topic: str | None) -> dict:
    """Writer options. Without a topic, the rows' own ``topic`` column decides."""
    options = {"kafka.bootstrap.servers": settings.bootstrap_servers, **settings.kafka_options}
    return options if topic is None else {**options, "topic": topic}


# --- Per micro-batch ----------------------------------------------------------------------------


def topic_batch_sink(topic: str, settings: FeedSettings = FeedSettings(), skip_empty: bool = True) -> BatchSink:
    """Callback that publishes each row of a micro-batch as JSON: to a Kafka topic, or to files in the settings' format.

    Kafka delivery is at least once, a replayed batch is published again; files hold each batch once. An empty batch sends Kafka nothing
    and, with ``skip_empty``, leaves no directory.
    """

    def publish(batch: DataFrame, batch_id: int) -> None:
        log.info("batch %s goes to %s", batch_id, topic)
        messages = to_message(batch)
        if settings.message_format == "kafka":
            messages.write.format("kafka").options(**kafka_sink_options(settings, topic)).save()
        else:
            file_batch_sink(settings.topic_path(topic), settings.message_format, skip_empty)(messages, batch_id)

    return publish


def transaction_batch_sink(settings: FeedSettings = FeedSettings()) -> BatchSink:
    return topic_batch_sink(settings.processed_transaction_topic, settings)


def block_batch_sink(settings: FeedSettings = FeedSettings()) -> BatchSink:
    return topic_batch_sink(settings.processed_block_topic, settings)


def query_id(batch: DataFrame) -> str:
    """The id of the streaming query a micro-batch belongs to. It lies in the query's checkpoint, so a restart keeps it and a
    new checkpoint has another one."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"


def date_batch_sink(path: str, time: str) -> BatchSink:
    """Callback that adds each micro-batch to a Parquet table laid out by ``event_date``, the day of ``time``.

    Below each date lies one directory per query and batch, and a batch overwrites its own directories only. So late rows find their day
    whenever they come, a batch that is delivered again replaces itself, and no other batch or query is touched. Rows without a
    time lie under the default partition. Many batches make many small files: see ``rollup.compact_days``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        own = {"event_date": F.to_date(time), "run": F.lit(query_id(batch)), "batch_id": F.lit(batch_id)}
        dated = batch.withColumns(own).hint("rebalance", "event_date")
        dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*own).parquet(path)

    return write


def file_batch_sink(path: str, fmt: str = "parquet", skip_empty: bool = False) -> BatchSink:
    """Callback that writes each micro-batch to its own ``run=<query id>/batch_id=<n>`` directory.

    A replay of the same query overwrites its directory, so the table holds every batch once; a query with a new
    checkpoint counts its batches from 0 again, but in a directory of its own. The write itself counts its rows; with
    ``skip_empty`` the directory of an empty batch is taken away again, nothing is scanned to find out beforehand.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        target = f"{path}/run={query_id(batch)}/batch_id={batch_id}"
        batch.write.format(fmt).mode("overwrite").save(target)
        spark = batch.sparkSession
        if skip_empty and spark.read.format(fmt).schema(batch.schema).load(target).isEmpty():
            log.info("batch %s for %s is empty", batch_id, path)
            place = spark._jvm.org.apache.hadoop.fs.Path(target)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)

    return write


def fan_out(prepare: Callable[[DataFrame], DataFrame], branches: dict[str, tuple[Callable[[DataFrame], DataFrame], BatchSink]]) -> BatchSink:
    """Callback that feeds several sinks from one evaluation of ``prepare``.

    Each branch is a selection over the prepared batch and the sink it goes to. The prepared batch is kept for
    the length of the micro-batch, on the executors' disks only: in memory a task's part, which may be some GB of messages, would
    crowd out what parsing and writing need. So give the source a rate; a lost executor's part is
    worked out again from the source. A failure replays all branches, so their sinks should be idempotent.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        prepared = prepare(batch).persist(StorageLevel.DISK_ONLY)
        try:
            for select, sink in branches.values():
                sink(select(prepared), batch_id)
        finally:
            prepared.unpersist()

    return write


# --- Streams ------------------------------------------------------------------------------------


def _append(df: DataFrame, checkpoint: str, once: bool) -> DataStreamWriter:
    """Append mode and a checkpoint of its own. ``once`` processes what is there and stops; otherwise each
    micro-batch follows the one before without a pause."""
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True) if once else writer


def to_topic(df: DataFrame, checkpoint: str, topic: str | None = None, settings: FeedSettings = FeedSettings(), once: bool = False) -> StreamingQuery:
    """Stream of messages (``value``, perhaps ``key``, ``topic`` and what describes them) to Kafka, or to files.

    In Kafka, ``reason``, ``partition`` and ``offset`` become headers; the value stays the text. Without a topic, the rows' own
    ``topic`` column decides.
    """
    if settings.message_format == "kafka":
        messages = with_headers(df)
        return _append(messages, checkpoint, once).format("kafka").options(**kafka_sink_options(settings, topic)).start()
    by = ("topic",) if topic is None else ()
    return to_files(df, settings.topic_path(topic), checkpoint, settings.message_format, by, once)


def to_files(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", partition_by: tuple = (), once: bool = False) -> StreamingQuery:
    """Stream to files, each row exactly once for readers of the directory through Spark."""
    writer = _append(df, checkpoint, once).format(fmt).option("path", path)
    return (writer.partitionBy(*partition_by) if partition_by else writer).start()


def to_batches(df: DataFrame, sink: BatchSink, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Stream to a callback per micro-batch."""
    return _append(df, checkpoint, once).foreachBatch(sink).start()


def to_console(df: DataFrame, checkpoint: str, rows: int = 20, once: bool = False) -> StreamingQuery:
    """The first ``rows`` of every micro-batch on the driver's console: a display aid, no output to work with."""
    return _append(df, checkpoint, once).format("console").option("numRows", rows).option("truncate", False).start()


# --- Tables -------------------------------------------------------------------------------------


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def write_kafka(messages: DataFrame, topic: str | None = None, settings: FeedSettings = FeedSettings()) -> None:
    messages.write.format("kafka").options(**kafka_sink_options(settings, topic)).save()
