"""Lost offsets, messages delivered twice, spent outputs."""

from datetime import datetime, timedelta

from feedflow.operators import delivery, ledger
from feedflow.streaming.runs import finish
from feedflow.streaming.sinks import to_files


def test_gaps_inside_and_across_blocks(spark):
    rows = [("t", 0, o) for o in (3, 4, 4, 9, 10, 11, 35, 36)] + [("t", 1, 7), (None, 0, 1), (None, 0, 3), ("t", 0, None), ("t", None, 5)]
    df = spark.createDataFrame(rows, "topic string, partition int, offset long")
    wanted = [("t", 0, 12, 34), ("t", 0, 5, 8), (None, 0, 2, 2)]
    for block in (1, 4, 10, 1 << 20):
        assert sorted(map(tuple, delivery.lost_offsets(df, block).collect()), key=str) == wanted
    assert delivery.lost_offsets(df.limit(0)).isEmpty()


def test_a_replay_across_a_restart_comes_out_once(spark, tmp_path):
    start = datetime(2024, 1, 1)
    row = lambda i: ("t", i % 3, i, f"text {i}", start + timedelta(minutes=i))
    schema = "topic string, partition int, offset long, value string, timestamp timestamp"
    for batch in (range(50), range(30, 90), range(90)):
        spark.createDataFrame([row(i) for i in batch], schema).write.mode("append").parquet(f"{tmp_path}/in")
        messages = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        finish(to_files(delivery.unique_messages(messages, "1 day"), f"{tmp_path}/out", f"{tmp_path}/c", once=True))
    found = sorted(r["offset"] for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert found == list(range(90))
    assert delivery.unique_messages(spark.read.parquet(f"{tmp_path}/in"), "1 day").count() == 90


def coins(spark, rows):
    return spark.createDataFrame(rows, "hash string, n int, tx_index long, value long")


def test_a_hot_coin_is_dealt_over_salts(spark):
    outputs = [(f"h{i}", 0, 7, i) for i in range(300)] + [(f"o{i}", i % 2, i, i) for i in range(600)] + [("x", None, 1, 1), ("y", 0, None, 1)]
    inputs = [("i", 0, 7, 0)] * 40 + [("i", 1, 3, 0), ("i", None, 1, 0), ("i", 0, None, 0), ("i", 0, 9999, 0)]
    for hot_rows in (10, 10_000):
        found = ledger.output_state(coins(spark, outputs), coins(spark, inputs), hot_rows)
        assert found.columns == ["hash", "n", "tx_index", "value", "spends"]
        spends = {r["hash"]: r["spends"] for r in found.collect()}
        assert len(spends) == len(outputs)
        assert {h for h, s in spends.items() if s == 40} == {f"h{i}" for i in range(300)}
        assert {h: s for h, s in spends.items() if 0 < s < 40} == {"o3": 1}
    assert ledger.output_state(coins(spark, []), coins(spark, inputs)).isEmpty()


def test_top_addresses_break_ties_by_address_and_limit_before_the_shuffle(spark):
    rows = [(1, "b", 5), (1, "a", 5), (1, "c", 4), (1, "d", None), (1, None, 9), (None, "a", 9), (2, "z", 2**62), (2, "z", 2**62)]
    found = ledger.top_addresses(spark.createDataFrame(rows, "day long, addr string, value long"), 2)
    assert sorted((r[0], r[1], r[2], int(r[3])) for r in found.collect()) == [(1, 1, "a", 5), (1, 2, "b", 5), (2, 1, "z", 2**63)]
    assert found._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") >= 2
