"""Start and await the feed's queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from feedflow.operators.decode import STRICT
from feedflow.operators.logs import drop_debug, log_messages, parse_lines
from feedflow.plans.feed import (
    block_dead_letters,
    blocks,
    classify,
    ingest_blocks,
    ingest_transactions,
    transaction_dead_letters,
    transactions,
)
from feedflow.settings import FeedSettings
from feedflow.streaming.sinks import (
    block_batch_sink,
    file_batch_sink,
    fan_out,
    to_batches,
    to_files,
    to_topic,
    transaction_batch_sink,
)


def start_branches(messages: DataFrame, settings: FeedSettings, mode: str = STRICT, once: bool = False) -> dict[str, StreamingQuery]:
    """One query per output, each with its own scan of the source and its own checkpoint, to the settings' topics.

    Strict adds a dead-letter query for transactions; dead letters carry their reason and where they come from.
    """
    started = {
        "invalid_confirmed": to_topic(
            block_dead_letters(messages, mode, settings).drop("topic"),
            settings.checkpoint("invalid_confirmed"), settings.invalid_block_topic, settings, once,
        ),
        "unconfirmed": to_batches(
            transactions(messages, mode, settings), transaction_batch_sink(settings), settings.checkpoint("unconfirmed"), once
        ),
        "confirmed": to_batches(blocks(messages, mode, settings), block_batch_sink(settings), settings.checkpoint("confirmed"), once),
    }
    if mode == STRICT:
        started["invalid_unconfirmed"] = to_topic(
            transaction_dead_letters(messages, settings).drop("topic"),
            settings.checkpoint("invalid_unconfirmed"), settings.invalid_transaction_topic, settings, once,
        )
    return started


def start_single_pass(messages: DataFrame, settings: FeedSettings, mode: str = STRICT, once: bool = False) -> StreamingQuery:
    """All outputs from one query: one scan, one parse, the topic taken from each row. The one to prefer."""
    return to_topic(classify(messages, mode, settings), settings.checkpoint("feed"), None, settings, once)


def start_ingest(raw_transactions: DataFrame, raw_blocks: DataFrame, settings: FeedSettings, once: bool = False) -> dict[str, StreamingQuery]:
    """Producers' messages, checked against their contracts, to the topics that the feed reads."""
    return {
        "ingest_transactions": to_topic(
            ingest_transactions(raw_transactions, settings).drop("topic"),
            settings.checkpoint("ingest_transactions"), settings.transaction_topic, settings, once,
        ),
        "ingest_blocks": to_topic(
            ingest_blocks(raw_blocks, settings).drop("topic"), settings.checkpoint("ingest_blocks"), settings.block_topic, settings, once
        ),
    }


def start_single_pass_files(
    messages: DataFrame, path: str, checkpoint: str, mode: str = STRICT, settings: FeedSettings = FeedSettings(), once: bool = False
) -> StreamingQuery:
    """The same into one directory per topic."""
    return to_files(classify(messages, mode, settings), path, checkpoint, partition_by=("topic",), once=once)


def start_fan_out_files(
    messages: DataFrame, path: str, checkpoint: str, mode: str = STRICT, settings: FeedSettings = FeedSettings(), once: bool = False
) -> StreamingQuery:
    """The same through a callback, which lets every output have a sink of its own. Outputs lie under
    ``path/<topic>``."""

    def of(topic: str):
        return lambda prepared: prepared.filter(F.col("topic") == topic).drop("topic")

    topics = [
        settings.processed_transaction_topic, settings.processed_block_topic, settings.invalid_block_topic,
        *((settings.invalid_transaction_topic, settings.unrouted_topic) if mode == STRICT else ()),
    ]
    branches = {topic: (of(topic), file_batch_sink(f"{path}/topic={topic}")) for topic in topics}
    return to_batches(messages, fan_out(lambda batch: classify(batch, mode, settings), branches), checkpoint, once)


def start_logs(lines: DataFrame, settings: FeedSettings, mode: str = STRICT, once: bool = False) -> StreamingQuery:
    """Log lines, parsed and without debug messages, as JSON to the log topic."""
    return to_topic(log_messages(drop_debug(parse_lines(lines, mode))), settings.checkpoint("logs"), settings.log_topic, settings, once)


def await_any(queries: dict[str, StreamingQuery] | list[StreamingQuery], check_seconds: int = 5) -> None:
    """Block until one of ``queries`` ends, then stop the others and raise what ended it.

    Awaiting them one after the other would leave the failure of a later one unseen, and the session's own
    ``awaitAnyTermination`` also answers for queries that ended earlier.
    """
    running = list(queries.values()) if isinstance(queries, dict) else list(queries)
    try:
        while all(query.isActive for query in running):
            running[0].awaitTermination(check_seconds)
        for query in running:
            if query.exception() is not None:
                raise query.exception()
    finally:
        for query in running:
            query.stop()


def finish(query: StreamingQuery) -> StreamingQuery:
    """Wait for a query that was started with ``once``."""
    query.awaitTermination()
    return query


def finish_all(queries: dict[str, StreamingQuery]) -> None:
    """Wait for queries that run side by side and were started with ``once``."""
    for query in queries.values():
        finish(query)
