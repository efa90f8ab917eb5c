"""Feed and session settings. Everything a deployment may want to change is a field, not a constant."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class FeedSettings:
    """Topics, broker and checkpoint locations of one deployment."""

    # Topic names of the feed.
    transaction_topic: str = "unconfirmed_transactions"
    block_topic: str = "confirmed_blocks"
    processed_transaction_topic: str = "processed_transactions"
    processed_block_topic: str = "processed_confirmed_blocks"
    invalid_block_topic: str = "invalid_confirmed_blocks"
    log_topic: str = "spark-logs"

    # Outputs the feed gains in strict mode.
    invalid_transaction_topic: str = "invalid_transactions"
    unrouted_topic: str = "unrouted_messages"

    bootstrap_servers: str = field(
        default_factory=lambda: os.environ.get("KAFKA_BOOTSTRAP_SERVERS", "localhost:9092")
    )
    # A folder that driver and executors share. There is no default: a relative one would be the driver's own disk.
    checkpoint_base: str | None = None
    # Where messages are published: Kafka topics, or files of another format in one directory per topic below the path.
    message_format: str = "kafka"
    message_path: str | None = None
    # Extra options for every Kafka reader and writer, for example TLS or SASL settings.
    kafka_options: dict = field(default_factory=dict)

    def checkpoint(self, query: str) -> str:
        """One checkpoint directory per query."""
        if not self.checkpoint_base:
            raise ValueError("checkpoint_base must name a folder that driver and executors share")
        return f"{self.checkpoint_base.rstrip('/')}/{query}"

    def topic_path(self, topic: str | None) -> str:
        """Where a topic's messages go if they go to files; without a topic, the directory of all."""
        if not self.message_path:
            raise ValueError("message_path must be set for messages that go to files")
        return self.message_path if topic is None else f"{self.message_path.rstrip('/')}/topic={topic}"


# Runtime settings the operators rely on.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # A repeated JSON key keeps its last value.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    # HotSpot never compiles methods of more bytecode than this; generated stages beyond it are split into small methods instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Messages are repetitive text.
    "spark.sql.parquet.compression.codec": "zstd",
    # Messages are dealt to their topics' files as they come; beyond so many open files a task sorts its rows by directory first.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
    # Kept batches go to disk and back through object streams that hold on to a hundred parts; a part is at most so many rows.
    "spark.sql.inMemoryColumnarStorage.batchSize": "500",
    "spark.sql.streaming.forceDeleteTempCheckpointLocation": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply ``SESSION_CONF`` to a session that already exists."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark


# State outside the heap: a join of streams keeps every row until the watermark passes it, which may be all of a backlog.
LARGE_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    # One store for both sides of a join.
    "spark.sql.streaming.join.stateFormatVersion": "3",
}


@contextmanager
def large_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, on the executors' disks. A checkpoint keeps the store it began with."""
    before = {key: spark.conf.get(key, None) for key in LARGE_STATE}
    try:
        for key, value in LARGE_STATE.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def build_session(app_name: str = "feedflow", **conf: str) -> SparkSession:
    """A session with the settings above; master and sizing come from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh directory for checkpoints and written tables that every executor can reach.

    It lies under ``spark.checkpoint.dir``, the shared folder a cluster names. Only a local session,
    where driver and executors are one process, may fall back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        base = tempfile.mkdtemp(prefix="feedflow-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
