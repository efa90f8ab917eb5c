"""The jobs that spark-submit runs, over landed files."""

import pytest

from feedflow import jobs
from feedflow.plans import feed
from feedflow.plans.table_feed import log_lines, mixed_messages, producer_block_messages, table, transaction_messages
from feedflow.settings import FeedSettings
from feedflow.sources.files import land, landed_table


def base(tmp_path, *more):
    return ["--checkpoint-base", f"{tmp_path}/c", "--message-format", "parquet", "--message-path", f"{tmp_path}/m", "--once", *more]


@pytest.mark.parametrize("branches", [False, True])
def test_feed(spark, sf_dir, tmp_path, branches):
    land(mixed_messages(spark, sf_dir), f"{tmp_path}/l")
    more = ["--branches"] if branches else []
    jobs.main(["feed", "--source-path", f"{tmp_path}/l", "--metrics-path", f"{tmp_path}/metrics", "--max-bytes-per-batch", "200000", *base(tmp_path, *more)])
    wanted = feed.classify(landed_table(spark, f"{tmp_path}/l")).groupBy("topic").count()
    for topic, n in wanted.collect():
        if branches and topic == "unrouted_messages":
            continue
        assert spark.read.parquet(f"{tmp_path}/m/topic={topic}").count() == n, topic
    metrics = spark.read.parquet(f"{tmp_path}/metrics")
    assert metrics.select("batch_id").distinct().count() > 1
    # A branch reads its own topic's files and those of no topic, which it routes by content; the single pass reads all; each message once.
    landed = {t: n for t, n in landed_table(spark, f"{tmp_path}/l").groupBy("topic").count().collect()}
    names = FeedSettings()
    transactions, blocks = (landed[topic] + landed[None] for topic in (names.transaction_topic, names.block_topic))
    wanted = sorted([transactions, transactions, blocks, blocks] if branches else [sum(landed.values())])
    assert sorted(n for _, n in metrics.groupBy("query").sum("input_rows").collect()) == wanted


def test_ingest(spark, sf_dir, tmp_path):
    raw = {"raw_transactions": transaction_messages(table(spark, sf_dir, "lineitem")), "raw_blocks": producer_block_messages(table(spark, sf_dir, "orders"))}
    for topic, messages in raw.items():
        messages.drop("topic").write.parquet(f"{tmp_path}/l/topic={topic}")
    jobs.main(["ingest", "--source-path", f"{tmp_path}/l", *base(tmp_path)])
    for topic, wanted in (("unconfirmed_transactions", feed.ingest_transactions(raw["raw_transactions"])), ("confirmed_blocks", feed.ingest_blocks(raw["raw_blocks"]))):
        assert spark.read.parquet(f"{tmp_path}/m/topic={topic}").count() == wanted.count() > 0


def test_logs(spark, sf_dir, tmp_path):
    log_lines(table(spark, sf_dir, "events")).write.text(f"{tmp_path}/l")
    jobs.main(["logs", "--source-path", f"{tmp_path}/l", *base(tmp_path)])
    assert spark.read.parquet(f"{tmp_path}/m/topic={FeedSettings().log_topic}").count() > 0


@pytest.mark.parametrize("argv", [["feed"], ["logs", "--checkpoint-base", "x"], ["feed", "--checkpoint-base", "x", "--message-format", "json"], ["other"]])
def test_missing_settings_are_refused(argv, monkeypatch, capsys):
    monkeypatch.delenv("FEED_CHECKPOINT_BASE", raising=False)
    with pytest.raises(SystemExit):
        jobs.main(argv)
    assert "error" in capsys.readouterr().err
