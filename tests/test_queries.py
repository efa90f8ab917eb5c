"""Every registered query of the feed against its SQL, over whole tables."""

import pytest

import __spark_entry__ as contract
from feedflow.plans import feed, queries
from feedflow.plans.queries import QUERIES
from feedflow.plans.table_feed import table, transaction_messages
from tests.conftest import SF_DIR
from tests.oracle import database, difference


@pytest.fixture(scope="module")
def connection():
    return database(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, connection, name):
    assert difference(spark, connection, name, SF_DIR) == ""


WANTED = {
    "HEADER_DDL": ("x.hash", "x.tx_index", "x.time", "x.size", "x.vout_sz"), "OUTPUTS_DDL": ("x.hash", "x.out"),
    "SPENDS_DDL": ("x.hash", "x.inputs.sequence", "x.inputs.prev_out", "x.out"), "TIMED_DDL": ("x.hash", "x.time"),
}


@pytest.mark.parametrize("ddl", WANTED)
def test_wanted_fields_equal_the_full_parse(spark, sf_dir, ddl):
    messages = transaction_messages(table(spark, sf_dir, "lineitem"))
    some = feed.transactions(messages, "compat", fields=getattr(queries, ddl)).select(*WANTED[ddl])
    full = feed.transactions(messages, "compat").select(*WANTED[ddl])
    assert some.dtypes == full.dtypes and not some.isEmpty()
    assert some.exceptAll(full).isEmpty() and full.exceptAll(some).isEmpty()


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == ["hash", "tx_index", "time", "size", "vout_sz"]
    assert not result.isEmpty()
