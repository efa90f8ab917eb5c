"""Compare registered queries with their SQL on the same tables.

``python -m tests.oracle [sf_dir] [query ...]`` prints one line per query.
"""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

import __spark_entry__ as contract

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def spark_type(field) -> str:
    names = {"string": "VARCHAR", "int": "INTEGER", "timestamp_ntz": "TIMESTAMP"}
    return names.get(field.dataType.simpleString(), field.dataType.simpleString().upper())


def difference(spark: SparkSession, connection, name: str, sf_dir: str) -> str:
    """Empty when names, types and the multiset of rows agree."""
    result = contract.queries()[name](spark, sf_dir)
    columns = sorted(result.columns)
    types = [spark_type(result.schema[column]) for column in columns]
    found = Counter(tuple(row) for row in result.select(*[f"`{c}`" for c in columns]).collect())
    cursor = connection.execute(contract.oracle_sql()[name])
    described = {d[0]: str(d[1]) for d in cursor.description}
    rows = cursor.fetchall()
    if sorted(described) != columns:
        return f"columns {columns} != {sorted(described)}"
    if [described[c] for c in columns] != types:
        return f"types {list(zip(columns, types))} != {[described[c] for c in columns]}"
    order = [list(described).index(column) for column in columns]
    expected = Counter(tuple(row[i] for i in order) for row in rows)
    if found != expected:
        return f"{found.total()} vs {expected.total()} rows, extra {list((found - expected).items())[:3]}, missing {list((expected - found).items())[:3]}"
    return "" if found.total() else "no rows"


if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = database(sf_dir)
    bad = 0
    for name in sys.argv[2:] or contract.oracle_sql():
        started = time.time()
        try:
            problem = difference(spark, connection, name, sf_dir)
        except Exception as error:  # noqa: BLE001 - a report must go on to the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += bool(problem)
        print(f"{name:28} {time.time() - started:6.2f}s {'ok' if not problem else problem}", flush=True)
    print("bad:", bad)
