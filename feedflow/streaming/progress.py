"""Per-batch metrics of running queries."""

from __future__ import annotations

import json
import logging
import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from feedflow.operators.sketches import quantile_sketches

log = logging.getLogger(__name__)

METRICS_DDL = "query string, batch_id bigint, started string, input_rows bigint, rows_per_second double, duration_ms bigint"


def metrics_row(progress: dict) -> tuple:
    """One micro-batch's numbers, in the order of ``METRICS_DDL``, from a query's progress report."""
    return (
        progress.get("name") or progress["id"],
        progress["batchId"],
        progress["timestamp"],
        progress["numInputRows"],
        float(progress.get("processedRowsPerSecond") or 0.0),
        int((progress.get("durationMs") or {}).get("triggerExecution", 0)),
    )


def latency_sketches(metrics: DataFrame, width: str = "1 hour") -> DataFrame:
    """``bucket, query, sketch``: quantile sketches of micro-batches' durations, to be stored and merged by ``sketches.quantiles``."""
    timed = metrics.withColumn("at", F.try_to_timestamp("started"))
    return quantile_sketches(timed, "at", "duration_ms", width, keys=("query",))


def undelivered(source: dict) -> int:
    """How many rows fewer than its offset range a Kafka source delivered in one micro-batch.

    ``source`` is one entry of a progress report's ``sources``. With ``failOnDataLoss`` off this is how purged
    offsets show up. Compacted or transactional topics have gaps of their own, and a callback that reads its batch
    twice counts the rows twice, so a positive number is a lower bound on topics without such gaps.
    """
    start, end = source.get("startOffset"), source.get("endOffset")
    if not isinstance(start, dict) or not isinstance(end, dict):
        return 0
    promised = sum(
        offset - start[topic][partition]
        for topic, partitions in end.items()
        if isinstance(partitions, dict) and isinstance(start.get(topic), dict)  # a file source has one number for all
        for partition, offset in partitions.items()
        if partition in start[topic]
    )
    return max(0, promised - source.get("numInputRows", 0))


class ProgressLog(StreamingQueryListener):
    """Logs every micro-batch and appends its numbers to a table at ``path``.

    Rows are written ``flush_rows`` at a time, when a query ends, and by ``flush``; none is dropped, and what is held in
    memory is bounded by ``flush_rows``.
    """

    def __init__(self, spark: SparkSession, path: str, flush_rows: int = 100) -> None:
        self.spark, self.path, self.flush_rows = spark, path, flush_rows
        self.rows: list[tuple] = []
        self.lock = threading.Lock()
        self.ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        log.info("query %s started", event.name or event.id)

    def onQueryProgress(self, event) -> None:
        progress = json.loads(event.progress.json)
        row = metrics_row(progress)
        with self.lock:
            self.rows.append(row)
            full = len(self.rows) >= self.flush_rows
        if full:
            self.flush()
        log.info("query %s batch %s: %s rows in %s ms", row[0], row[1], row[3], row[5])
        for source in progress.get("sources", []):
            if lost := undelivered(source):
                log.warning("query %s batch %s: %s rows of %s were not delivered", row[0], row[1], lost, source.get("description"))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        log.info("query %s ended: %s", event.id, event.exception or "stopped")
        self.flush()
        self.ended.add(str(event.id))

    def wait_for(self, query: str, seconds: float = 60) -> None:
        """Until the end of a query, by its id, has reached this listener: reports arrive after the query's own end."""
        deadline = time.monotonic() + seconds
        while query not in self.ended and time.monotonic() < deadline:
            time.sleep(0.05)

    def flush(self) -> None:
        """Write the rows held so far."""
        with self.lock:
            if self.rows:
                self.spark.createDataFrame(self.rows, METRICS_DDL).coalesce(1).write.mode("append").parquet(self.path)
                self.rows = []

    def metrics(self) -> DataFrame:
        """All micro-batches seen, from the table."""
        self.flush()
        return self.spark.read.schema(METRICS_DDL).parquet(self.path)
