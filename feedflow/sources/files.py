"""Landed messages and log files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedflow.schemas import ENVELOPE_DDL


def landed_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Messages landed as files that carry the envelope columns."""
    return spark.read.schema(ENVELOPE_DDL).format(fmt).load(path)


def landed_stream(
    spark: SparkSession, path: str, fmt: str = "parquet", max_files_per_trigger: int | None = None, max_bytes_per_trigger: int | None = None
) -> DataFrame:
    """The same directory as a stream: files already there first, then new ones, each once per checkpoint."""
    reader = spark.readStream.schema(ENVELOPE_DDL).format(fmt)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return reader.load(path)


def land(messages: DataFrame, path: str, mode: str = "append") -> None:
    """Write messages to a landing directory, one sub-directory per topic, so a strict reader of one topic
    skips the others' files."""
    messages.write.mode(mode).partitionBy("topic").parquet(path)


def text_messages(lines: DataFrame, topic: str | None = None) -> DataFrame:
    """Lines of text (column ``value``) as envelope rows, for feeds landed as plain JSON lines."""
    return lines.select(
        F.lit(None).cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit(topic).cast("string").alias("topic"),
        F.lit(None).cast("int").alias("partition"),
        F.lit(None).cast("bigint").alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
        F.lit(None).cast("int").alias("timestampType"),
    )


def text_table(spark: SparkSession, path: str, topic: str | None = None) -> DataFrame:
    return text_messages(spark.read.text(path), topic)


def text_stream(spark: SparkSession, path: str, topic: str | None = None) -> DataFrame:
    return text_messages(spark.readStream.text(path), topic)


def log_files(spark: SparkSession, path: str, streaming: bool = True) -> DataFrame:
    """Lines of the log files under ``path``.

    A stream picks up whole new files, so a logger should rotate into the directory. Lines end at a line feed
    only, as for the log agent.
    """
    reader = spark.readStream if streaming else spark.read
    return reader.option("lineSep", "\n").text(path)
