"""Sketches and bursts against exact computations."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from feedflow.operators import bursts, sketches
from feedflow.streaming.progress import METRICS_DDL, latency_sketches
from feedflow.streaming.runs import finish
from feedflow.streaming.sinks import to_files

START = datetime(2024, 1, 1)


def test_days_of_stored_hours_count_distinct_values_within_two_per_cent(spark, tmp_path):
    # Three of four rows lie in one hour; every value stands in two hours.
    rows = spark.range(400_000).select(
        F.expr("timestamp'2024-01-01' + make_interval(0, 0, 0, 0, cast(if(id % 4 = 0, id % 48, 5) as int))").alias("at"),
        F.expr("concat('a', id % 150000)").alias("addr"),
    )
    rows = rows.unionByName(spark.createDataFrame([(None, "x"), (START, None)], "at timestamp, addr string"))
    sketches.distinct_sketches(rows, "at", "addr").write.parquet(f"{tmp_path}/hours")
    stored = spark.read.parquet(f"{tmp_path}/hours")
    found = {r["bucket"]: r["n"] for r in sketches.distinct_counts(stored).collect()}
    exact = rows.filter("at IS NOT NULL").groupBy(F.date_trunc("day", "at").alias("day")).agg(F.count_distinct("addr").alias("n"))
    wanted = {r["day"]: r["n"] for r in exact.collect()}
    assert set(found) == set(wanted) and all(abs(found[d] - n) <= 0.02 * n for d, n in wanted.items())
    assert max(r[0] for r in stored.select(F.length("sketch")).collect()) < 40_000
    assert sketches.distinct_counts(sketches.distinct_sketches(rows.limit(0), "at", "addr")).isEmpty()


def test_quantiles_of_merged_hours_within_one_per_cent_of_rank(spark):
    rng = random.Random(3)
    rows = [(START + timedelta(minutes=i % 2000), "ab"[i % 3 == 0], rng.lognormvariate(3, 2)) for i in range(40_000)]
    rows += [(START, "a", None), (None, "a", 1.0), (START, "a", float("nan")), (START + timedelta(days=9), "z", 7.0)]
    df = spark.createDataFrame(rows, "at timestamp, kind string, ms double")
    found = sketches.quantiles(sketches.quantile_sketches(df, "at", "ms", keys=("kind",)), (0, 0.5, 0.95, 0.99, 1), keys=("kind",)).collect()
    exact = defaultdict(list)
    for at, kind, ms in rows:
        if at and ms is not None and ms == ms:
            exact[at.replace(hour=0, minute=0), kind].append(ms)
    assert len(found) == 5 * len(exact)
    for r in found:
        values = exact[r["bucket"], r["kind"]]
        assert r["n"] == len(values)
        below, upto = sum(v < r["value"] for v in values), sum(v <= r["value"] for v in values)
        assert below / len(values) - 0.01 <= r["fraction"] <= upto / len(values) + 0.01


def test_batch_latencies(spark):
    rows = [("feed", i, f"2024-01-01T{i % 20:02d}:00:01.5Z", 10, 1.0, i) for i in range(1000)] + [("feed", 1, "never", 1, 1.0, 9)]
    stored = latency_sketches(spark.createDataFrame(rows, METRICS_DDL))
    assert stored.count() == 20
    (row,) = sketches.quantiles(stored, [0.95], keys=("query",)).collect()
    assert row["query"] == "feed" and row["n"] == 1000 and abs(row["value"] - 950) <= 10


def runs_of(rows, gap):
    by_key = defaultdict(list)
    for key, at, value in rows:
        if key is not None and at is not None:
            by_key[key].append((at, value or 0))
    out = []
    for key, items in by_key.items():
        items.sort()
        run = [items[0]]
        for item in items[1:]:
            if item[0] - run[-1][0] > timedelta(seconds=gap):
                out.append((key, run[0][0], run[-1][0], len(run), sum(v for _, v in run)))
                run = []
            run.append(item)
        out.append((key, run[0][0], run[-1][0], len(run), sum(v for _, v in run)))
    return sorted(out)


SCHEMA = "addr string, event_time timestamp, value long"


def plain(df):
    return sorted((*r[:4], int(r[4])) for r in df.collect())


@pytest.mark.parametrize("gap", [1, 10, 60, 5000])
def test_runs_equal_gaps_and_islands(spark, gap):
    rng = random.Random(gap)
    # One address holds half of the rows; some rows are exactly one gap apart.
    rows = [(rng.choice(["hot", f"a{i % 9}"]), START + timedelta(seconds=rng.randrange(-9000, 9000), microseconds=rng.choice([0, 0, 1])), i) for i in range(800)]
    rows += [("edge", START + timedelta(seconds=gap * i), 2**62) for i in range(4)] + [("late", START + timedelta(seconds=(gap + 1) * i), None) for i in range(3)]
    rows += [(None, START, 1), ("x", None, 1)]
    assert plain(bursts.bursts(spark.createDataFrame(rows, SCHEMA), "addr", gap)) == runs_of(rows, gap)


def test_no_rows_and_no_gap(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert bursts.bursts(empty, "addr", 5).isEmpty()
    with pytest.raises(ValueError):
        bursts.bursts(empty, "addr", 0)


def test_a_late_row_bridges_runs_of_a_stream(spark, tmp_path):
    at = lambda s: START + timedelta(seconds=s)
    batches = [
        [("a", at(0), 1), ("a", at(50), 2), ("b", at(10), 3), ("edge", at(0), 1)],
        [("a", at(25), 4), ("b", at(100), 5), ("edge", at(30), 1)],  # 25 bridges 0 and 50
        [("b", at(60), 6), (None, at(1), 1), ("c", None, 1)],
        [("end", at(90_000), 0)],
        [("end", at(90_001), 0)],
    ]
    for batch in batches:
        spark.createDataFrame(batch, SCHEMA).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in")
        finish(to_files(bursts.bursts(stream, "addr", 30, late="1 hour"), f"{tmp_path}/out", f"{tmp_path}/c", once=True))
    rows = [r for batch in batches[:3] for r in batch]
    assert plain(spark.read.parquet(f"{tmp_path}/out")) == runs_of(rows, 30)
    assert plain(bursts.bursts(spark.createDataFrame(rows, SCHEMA), "addr", 30)) == runs_of(rows, 30)
    with pytest.raises(ValueError):
        bursts.bursts(stream, "addr", 30)
