"""The date layout: late rows, batches delivered again, compaction and look-ups."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from feedflow.operators.rollup import compact_days
from feedflow.streaming.runs import finish
from feedflow.streaming.sinks import date_batch_sink, to_batches

START = datetime(2024, 1, 1)
SCHEMA = "hash string, event_time timestamp, size int"
QUERY = "sql.streaming.queryId"


def rows(first, last):
    """Ten a day over five days, again and again, so that every batch holds late rows; some have no time."""
    return [(f"h{i}", None if i % 50 == 7 else START + timedelta(hours=2.4 * (i % 50)), i) for i in range(first, last)]


def plain(df):
    return sorted(tuple(r) for r in df.select("hash", "size", F.col("event_date").cast("string")).na.fill("none").collect())


def wanted(n):
    return sorted((h, i, str(t.date()) if t else "none") for h, t, i in rows(0, n))


def test_late_rows_and_restarts(spark, tmp_path):
    for first, last in ((0, 120), (120, 200), (200, 333)):
        spark.createDataFrame(rows(first, last), SCHEMA).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in")
        finish(to_batches(stream, date_batch_sink(f"{tmp_path}/days", "event_time"), f"{tmp_path}/c", once=True))
    stored = spark.read.parquet(f"{tmp_path}/days")
    assert plain(stored) == wanted(333)
    for _ in range(2):  # a day that is compacted again replaces itself
        compact_days(stored, f"{tmp_path}/whole", "hash")
        assert plain(spark.read.parquet(f"{tmp_path}/whole")) == wanted(333)
    files = list((tmp_path / "whole").glob("event_date=*/*.parquet"))
    assert len(files) == 6 < len(list((tmp_path / "days").glob("event_date=*/run=*/batch_id=*/*.parquet")))


def test_a_batch_delivered_again_replaces_itself_only(spark, tmp_path):
    sink, context = date_batch_sink(f"{tmp_path}/days", "event_time"), spark.sparkContext
    try:
        context.setLocalProperty(QUERY, "a")
        sink(spark.createDataFrame(rows(0, 100), SCHEMA), 0)
        sink(spark.createDataFrame(rows(100, 150), SCHEMA), 1)
        context.setLocalProperty(QUERY, "b")  # another query counts its batches from 0 as well
        sink(spark.createDataFrame(rows(150, 200), SCHEMA), 0)
        sink(spark.createDataFrame([], SCHEMA), 1)
        context.setLocalProperty(QUERY, "a")
        sink(spark.createDataFrame(rows(100, 150), SCHEMA), 1)
        sink(spark.createDataFrame(rows(0, 100), SCHEMA), 0)
    finally:
        context.setLocalProperty(QUERY, None)
    assert plain(spark.read.parquet(f"{tmp_path}/days")) == wanted(200)


def test_a_look_up_reads_few_rows(spark, tmp_path):
    table = spark.range(200_000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("hash"), F.lit(START).alias("event_time"), F.col("id").cast("int").alias("size")
    )
    table.withColumn("event_date", F.to_date("event_time")).withColumns({"run": F.lit("r"), "batch_id": F.lit(0)}).write.parquet(f"{tmp_path}/b")
    compact_days(spark.read.parquet(f"{tmp_path}/b"), f"{tmp_path}/d", "hash", row_group_bytes=1 << 20)
    days = spark.read.parquet(f"{tmp_path}/d")
    for key, found in ((123, 1), (-5, 0)):
        search = days.filter(F.col("hash") == F.sha2(F.lit(str(key)), 256))
        result = search._jdf.queryExecution()
        assert result.executedPlan().executeCollect().__len__() == found
        read = result.executedPlan().collectLeaves().head().metrics().apply("numOutputRows").value()
        assert read <= 20_000 * found
