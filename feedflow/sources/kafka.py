"""Kafka topics. Needs Spark's Kafka connector on the classpath."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedflow.settings import FeedSettings

EARLIEST, LATEST = "earliest", "latest"


def stream_options(
    settings: FeedSettings,
    topics: tuple = (),
    starting_offsets: str = LATEST,
    fail_on_data_loss: bool = False,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict:
    """Reader options of a streaming scan.

    ``starting_offsets`` applies to a query's first start only; later starts go on from the checkpoint.
    With ``fail_on_data_loss`` off, offsets the broker has purged are skipped; ``ProgressLog`` in
    ``feedflow.streaming.progress`` reports them. Kafka partitions give one task each, so a topic with few or with
    one very full partition needs ``min_partitions`` to be read in parallel.
    """
    options = {
        "kafka.bootstrap.servers": settings.bootstrap_servers,
        "subscribe": ",".join(topics or (settings.transaction_topic, settings.block_topic)),
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
        **settings.kafka_options,
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def batch_options(settings: FeedSettings, topic: str, starting_offsets: str = EARLIEST, ending_offsets: str = LATEST) -> dict:
    """Reader options of a bounded scan over one topic."""
    return {
        "kafka.bootstrap.servers": settings.bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "endingOffsets": ending_offsets,
        **settings.kafka_options,
    }


def kafka_stream(spark: SparkSession, settings: FeedSettings, topics: tuple = (), **options: object) -> DataFrame:
    """Unbounded scan over several topics (by default the two feed topics)."""
    return spark.readStream.format("kafka").options(**stream_options(settings, topics, **options)).load()


def kafka_table(spark: SparkSession, settings: FeedSettings, topic: str, **offsets: str) -> DataFrame:
    """Bounded scan over what a topic holds now."""
    return spark.read.format("kafka").options(**batch_options(settings, topic, **offsets)).load()


def topic_texts(spark: SparkSession, settings: FeedSettings, topic: str) -> DataFrame:
    """The text of all messages a topic holds, to look at; the caller may limit it. To watch new messages, send
    ``kafka_stream(..., starting_offsets="latest")`` to ``feedflow.streaming.sinks.to_console``."""
    return kafka_table(spark, settings, topic).selectExpr("CAST(value AS STRING) AS value")
