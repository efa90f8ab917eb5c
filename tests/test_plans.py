"""What the plans must look like to hold at scale."""

import pytest

import __spark_entry__ as contract
from feedflow.operators.decode import decode
from feedflow.operators.logs import parse_lines
from feedflow.operators.rollup import store_by_date
from feedflow.operators.validate import check_transactions
from feedflow.plans import feed
from feedflow.plans.table_feed import mixed_message_stream, transaction_messages
from feedflow.sources.files import land, landed_table
from feedflow.sources.literal import messages


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("landed") / "l")
    land(messages(spark, ["{}"], "unconfirmed_transactions").unionByName(messages(spark, ["{}"], "confirmed_blocks")), path)
    return landed_table(spark, path)


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


FLOWS = {
    "transactions compat": lambda m: feed.transactions(m, "compat"),
    "transactions strict": lambda m: feed.transactions(m, "strict"),
    "blocks compat": lambda m: feed.blocks(m, "compat"),
    "blocks strict": lambda m: feed.blocks(m, "strict"),
    "dead letters": feed.block_dead_letters,
    "one pass": feed.classify,
    "one pass compat": lambda m: feed.classify(m, "compat"),
    "ingest transactions": feed.ingest_transactions,
    "ingest blocks": feed.ingest_blocks,
    "rejects": feed.transaction_rejects,
    "logs": lambda m: parse_lines(m.selectExpr("CAST(value AS STRING) AS value")),
}


@pytest.mark.parametrize("flow", FLOWS)
def test_no_shuffle_and_no_python(landed, flow):
    plan = physical(FLOWS[flow](landed))
    for word in ("Exchange", "Sort", "Python", "Arrow", "Join", "Window"):
        assert word not in plan, word


@pytest.mark.parametrize("flow, parses", [("transactions compat", 1), ("transactions strict", 1), ("blocks strict", 1), ("dead letters", 1), ("one pass", 2)])
def test_each_record_is_parsed_once(landed, flow, parses):
    assert physical(FLOWS[flow](landed)).count("from_json(") == parses


def test_document_is_parsed_once(landed):
    assert physical(check_transactions(decode(landed)).filter("valid").select("json_data")).count("parseJson") == 1


def test_marker_test_comes_before_the_parse(landed):
    plan = physical(feed.transactions(landed, "compat"))
    assert plan.index("from_json(") < plan.index("Contains(")


def test_topic_prunes_partitions_and_columns(landed):
    plan = physical(feed.blocks(landed, "strict"))
    scan = plan[plan.index("FileScan"):]
    assert "topic" in scan[scan.index("PartitionFilters: ["):].split("]")[0]
    assert "timestamp" not in scan[scan.index("ReadSchema"):]


def test_messages_are_derived_without_a_shuffle(spark, sf_dir):
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    plan = physical(transaction_messages(lineitem).filter("CAST(value AS STRING) LIKE '%utx%'"))
    assert "Exchange" not in plan and plan.count("StructsToJson") == 1


PASSES = ("tx_parse", "tx_parse_strict", "tx_dead_letter", "tx_outputs", "tx_invalid", "tx_valid_passthrough", "block_parse_strict",
          "block_invalid", "feed_texts", "events_json_props", "events_schema_check", "log_messages", "tx_rollup_rejects")


@pytest.mark.parametrize("name", PASSES)
def test_registered_feed_queries_do_not_shuffle(spark, sf_dir, name):
    assert "Exchange" not in physical(contract.queries()[name](spark, sf_dir))


@pytest.mark.parametrize("name", ["tx_parse", "tx_outputs", "tx_hash_default"])
def test_compat_queries_parse_what_they_report(spark, sf_dir, name):
    plan = physical(contract.queries()[name](spark, sf_dir))
    shape = plan[plan.index("from_json(StructField(x"):].split("StringType")[0]
    assert "relayed_by" not in shape and "lock_time" not in shape


def test_strict_reads_whole_records(landed):
    with pytest.raises(ValueError, match="compat"):
        feed.transactions(landed, "strict", fields="op string")


def test_route_counts_scan_each_table_once(spark, sf_dir):
    assert physical(contract.queries()["tx_route_counts"](spark, sf_dir)).count("FileScan") == 2


def test_streams_are_not_dealt_again(spark, sf_dir):
    stream = feed.classify(mixed_message_stream(spark, sf_dir))
    assert "Repartition" not in stream._jdf.queryExecution().analyzed().toString()


def test_store_by_date(spark, tmp_path):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(id % 3 AS int)) AS ts, id FROM range(0, 300, 1, 8)")
    store_by_date(df, "ts", str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert stored.count() == 300 and len(stored.inputFiles()) < 3 * 8
    plan = physical(stored.filter("event_date = date'2024-01-02'"))
    assert "event_date" in plan[plan.index("PartitionFilters: ["):].split("]")[0]


def test_texts_of_other_topics_are_never_made(spark, sf_dir):
    """A topic's strict parse takes the messages of that topic or of none; the test lies below the derivation of the text."""
    plan = physical(feed.blocks(transaction_messages(spark.read.parquet(f"{sf_dir}/lineitem.parquet")), "strict"))
    assert "confirmed_blocks" in plan[plan.index("StructsToJson"):]


def test_generated_methods_stay_within_what_is_compiled(spark):
    """HotSpot interprets methods of more than 8000 bytes of code for ever."""
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000


def test_messages_are_stored_compactly(spark, tmp_path):
    land(messages(spark, ['{"op":"utx"}'], "unconfirmed_transactions"), str(tmp_path / "l"))
    assert any(".zstd." in name for name in landed_table(spark, str(tmp_path / "l")).inputFiles())


def test_lost_offsets_derive_no_texts(spark, sf_dir):
    assert "StructsToJson" not in physical(contract.queries()["tx_lost_offsets"](spark, sf_dir))
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    whole, placed = (transaction_messages(lineitem, payload=payload) for payload in (True, False))
    assert placed.schema == whole.schema
    assert whole.drop("value").exceptAll(placed.drop("value")).isEmpty() and placed.count() == whole.count()


def test_topics_are_landed_without_a_sort(spark):
    """A sort of all messages by topic spills them; as many files stay open as there are topics."""
    assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) >= 6


def test_strict_parse_lists_no_keys(landed):
    """The frame itself shows text that goes on as fields of it, so no text is read a further time for its keys."""
    assert "json_object_keys" not in physical(feed.transactions(landed, "strict"))


def test_compat_dead_letters_derive_and_parse_once(spark, sf_dir):
    plan = physical(contract.queries()["block_dead_letter_compat"](spark, sf_dir))
    assert plan.count("FileScan") == 2 and plan.count("StructsToJson") == 2


def test_output_state_reads_stored_transactions(spark, sf_dir):
    """Outputs are read for their counts and again for the join, inputs once; no message is derived or parsed for each of them."""
    plan = physical(contract.queries()["tx_output_state"](spark, sf_dir))
    assert "StructsToJson" not in plan and "from_json" not in plan
