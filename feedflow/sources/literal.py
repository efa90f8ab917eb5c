"""Small bounded tables written out in code."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedflow.sources.files import text_messages


def literal(spark: SparkSession, rows: list, ddl: str) -> DataFrame:
    """``rows`` under an explicit schema; nested values may be dicts, lists or Rows."""
    return spark.createDataFrame(rows, ddl)


def messages(spark: SparkSession, texts: list, topic: str | None = None) -> DataFrame:
    """Message texts as envelope rows."""
    return text_messages(literal(spark, [(text,) for text in texts], "value string"), topic)
