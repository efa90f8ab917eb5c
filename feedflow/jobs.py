"""Jobs for spark-submit: ``feed``, ``ingest`` and ``logs``.

    spark-submit --py-files feedflow.zip feedflow/jobs.py feed --checkpoint-base hdfs:///checkpoints --bootstrap-servers broker:9092

Each job builds its session, reads its settings from arguments or the environment, starts its queries and waits until one of
them ends, which stops the others. A source's rate bounds a micro-batch, so a first run over a backlog takes it in parts and
drops nothing; ``--once`` takes all there is, in such parts, and ends.
"""

from __future__ import annotations

import argparse
import logging
import os

from pyspark.sql import DataFrame, SparkSession

from feedflow.operators.decode import COMPAT, STRICT
from feedflow.settings import FeedSettings, build_session
from feedflow.sources.files import landed_stream, log_files
from feedflow.sources.kafka import EARLIEST, LATEST, kafka_stream
from feedflow.streaming.progress import ProgressLog
from feedflow.streaming.runs import await_any, finish_all, start_branches, start_ingest, start_logs, start_single_pass


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="feedflow.jobs", description=__doc__.split("\n")[0])
    parser.add_argument("job", choices=("feed", "ingest", "logs"))
    parser.add_argument("--checkpoint-base", default=os.environ.get("FEED_CHECKPOINT_BASE"), help="folder that driver and executors share")
    parser.add_argument("--bootstrap-servers", default=os.environ.get("KAFKA_BOOTSTRAP_SERVERS", "localhost:9092"))
    parser.add_argument("--source-path", help="landed messages or log files to read instead of topics")
    parser.add_argument("--raw-topics", nargs=2, metavar=("TRANSACTIONS", "BLOCKS"), default=("raw_transactions", "raw_blocks"), help="what ingest reads")
    parser.add_argument("--message-format", default="kafka", help="kafka, or a file format for --message-path")
    parser.add_argument("--message-path", help="directory of the published messages, if they go to files")
    parser.add_argument("--mode", choices=(STRICT, COMPAT), default=STRICT)
    parser.add_argument("--starting-offsets", choices=(LATEST, EARLIEST), default=LATEST)
    parser.add_argument("--fail-on-data-loss", action="store_true")
    parser.add_argument("--min-partitions", type=int, help="tasks to read topics with, at least")
    parser.add_argument("--max-offsets-per-batch", type=int, default=20_000_000, help="messages a micro-batch takes from topics")
    parser.add_argument("--max-bytes-per-batch", type=int, default=64 << 30, help="bytes a micro-batch takes from files")
    parser.add_argument("--branches", action="store_true", help="a query per output instead of one for all")
    parser.add_argument("--metrics-path", help="table that micro-batch metrics are appended to")
    parser.add_argument("--once", action="store_true", help="take what is there and end")
    found = parser.parse_args(argv)
    if not found.checkpoint_base:
        parser.error("--checkpoint-base or FEED_CHECKPOINT_BASE must name a shared folder")
    if found.message_format != "kafka" and not found.message_path:
        parser.error("--message-path is needed for messages that go to files")
    if found.job == "logs" and not found.source_path:
        parser.error("--source-path must name the directory of log files")
    return found


def messages(spark: SparkSession, args: argparse.Namespace, settings: FeedSettings, topics: tuple = (), directory: str = "") -> DataFrame:
    """The job's input: landed files if a path is given, else topics."""
    if args.source_path:
        return landed_stream(spark, args.source_path + directory, max_bytes_per_trigger=args.max_bytes_per_batch)
    return kafka_stream(
        spark, settings, topics, starting_offsets=args.starting_offsets, fail_on_data_loss=args.fail_on_data_loss,
        max_offsets_per_trigger=args.max_offsets_per_batch, min_partitions=args.min_partitions,
    )


def start(spark: SparkSession, args: argparse.Namespace) -> dict:
    """The job's queries by name."""
    settings = FeedSettings(
        bootstrap_servers=args.bootstrap_servers, checkpoint_base=args.checkpoint_base,
        message_format=args.message_format, message_path=args.message_path,
    )
    if args.job == "logs":
        return {"logs": start_logs(log_files(spark, args.source_path), settings, args.mode, args.once)}
    if args.job == "ingest":
        raw_transactions, raw_blocks = args.raw_topics
        return start_ingest(
            messages(spark, args, settings, (raw_transactions,), f"/topic={raw_transactions}"),
            messages(spark, args, settings, (raw_blocks,), f"/topic={raw_blocks}"), settings, args.once,
        )
    feed = messages(spark, args, settings)
    if args.branches:
        return start_branches(feed, settings, args.mode, args.once)
    return {"feed": start_single_pass(feed, settings, args.mode, args.once)}


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    logging.basicConfig(level=logging.INFO)
    spark = build_session(f"feedflow-{args.job}")
    progress = ProgressLog(spark, args.metrics_path) if args.metrics_path else None
    if progress:
        spark.streams.addListener(progress)
    try:
        queries = start(spark, args)
        if args.once:
            finish_all(queries)
            for query in queries.values() if progress else ():
                progress.wait_for(str(query.id))
        else:
            await_any(queries)
    finally:
        if progress:
            spark.streams.removeListener(progress)
            progress.flush()


if __name__ == "__main__":
    main()
