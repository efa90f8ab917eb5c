"""Transactions with their blocks, as tables and as streams."""

from datetime import datetime, timedelta

import pytest

from feedflow.operators.confirm import confirmations
from feedflow.plans import queries
from feedflow.streaming.runs import finish
from feedflow.streaming.sinks import to_files

START = datetime(2024, 1, 1)
SEEN, LISTED = "hash string, seen_at timestamp, fee int", "tx_hash string, height long, confirmed_at timestamp"


def at(minutes):
    return None if minutes is None else START + timedelta(minutes=minutes)


def wanted(seen, listed, within, ahead):
    rows = []
    for h, t, fee in seen:
        found = [(k, c) for x, k, c in listed if h is not None and x == h and t is not None and c is not None and -ahead <= c - t <= within]
        rows += [(h, at(t), fee, k, at(c), (c - t) * 60) for k, c in found] or [(h, at(t), fee, None, None, None)]
    return sorted(rows, key=str)


def frames(spark, seen, listed):
    return (
        spark.createDataFrame([(h, at(t), f) for h, t, f in seen], SEEN),
        spark.createDataFrame([(h, k, at(c)) for h, k, c in listed], LISTED),
    )


CASES = [("a", 0, 1), ("a", 0, 1), ("a", 500, 2), ("b", 10, 3), ("c", 10, 4), ("d", None, 5), (None, 10, 6), (None, None, 7), ("e", 100, 8)]
BLOCKS = [("a", 1, 5), ("a", 2, 60), ("a", 3, 61), ("b", 4, 5), ("c", 5, 4), ("d", 6, 10), (None, 7, 10), ("e", 8, None), ("x", 9, 9)]


@pytest.mark.parametrize("hot_rows", [0, 1, 1000])
def test_bounds_repeats_and_nulls(spark, hot_rows):
    found = confirmations(*frames(spark, CASES, BLOCKS), "60 minutes", "5 minutes", hot_rows=hot_rows)
    assert found.columns == ["hash", "seen_at", "fee", "height", "confirmed_at", "delay_seconds"]
    assert sorted(map(tuple, found.collect()), key=str) == wanted(CASES, BLOCKS, 60, 5)
    empty, blocks = frames(spark, [], BLOCKS)
    assert confirmations(empty, blocks, "1 hour").isEmpty()


def test_a_hot_hash_is_dealt(spark):
    seen = [("hot", i, i) for i in range(600)] + [(f"h{i}", i, i) for i in range(600)]
    listed = [("hot", 1, 100), ("hot", 2, 400)] + [(f"h{i}", i, i + 3) for i in range(0, 600, 2)]
    found = confirmations(*frames(spark, seen, listed), "200 minutes", hot_rows=100)
    assert sorted(map(tuple, found.collect()), key=str) == wanted(seen, listed, 200, 0)


def test_stream_equals_table_behind_its_watermark(spark, tmp_path):
    seen = [(f"h{i % 70}", i * 3, i) for i in range(100)] + [("n", None, 1), (None, 30, 2)]
    listed = [(f"h{i}", i, i * 3 + 20) for i in range(0, 70, 2)] + [(f"h{i}", 100 + i, i * 3 + 25) for i in range(0, 70, 4)]
    end = [("end", 2000, 0)], [("end", 0, 2000)]
    # Blocks come before, with and after their transactions; a restart lies between all batches.
    batches = [(seen[:40], listed[:10]), ([], listed[10:50]), (seen[40:], []), ([], listed[50:]), end, end]
    for part, blocks in batches:
        for rows, name in zip(frames(spark, part, blocks), "sb", strict=True):
            rows.write.mode("append").parquet(f"{tmp_path}/{name}")
        streams = [spark.readStream.schema(schema).parquet(f"{tmp_path}/{name}") for schema, name in ((SEEN, "s"), (LISTED, "b"))]
        found = confirmations(*streams, "40 minutes", "10 minutes", late="6 hours")
        finish(to_files(found, f"{tmp_path}/out", f"{tmp_path}/c", once=True))
    rows = [tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").collect() if r["hash"] != "end"]
    assert sorted(rows, key=str) == wanted([r for r in seen if r[1] is not None], listed, 40, 10)
    with pytest.raises(ValueError):
        confirmations(*streams, "1 hour")


def test_the_query_keeps_its_state_outside_the_heap(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "shared_dir", lambda spark, purpose: str(tmp_path / purpose))
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    assert queries.run("stream_confirmations")(spark, sf_dir).count() > 0
    assert "RocksDB" in (tmp_path / "stream-confirmations/checkpoint/offsets/0").read_text()
    assert spark.conf.get(key) == before
