"""Archives: what is read is what was written, also with magic inside payloads and with splits inside records."""

import hashlib

import pytest

from feedflow.llm import warc
from feedflow.settings import shared_dir

SCHEMA = "page_id long, url string, html string, digest string, file string"


def plain(rows):
    size = {}
    for page, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 100 and page is not None:
            size[data] = min(page, size.get(data, page))
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        first = size.get(data)
        revisit = first is not None and first != page
        out.append((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


def pages(spark, rows):
    return spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA)


INNER = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
ROWS = [
    (1, "http://a/", "x" * 150), (2, None, "x" * 150), (3, "http://b/\r\nX: y", "short"), (4, "u", "short"), (5, "u", None), (6, "u", ""),
    (7, "u", INNER), (8, "u", "pre WARC/1.0\r\n post" + "é" * 300), (9, "u", INNER * 3 + "WARC/1.0\r\n"), (10, "u", INNER), (11, "u", "\r\n\r\n" * 9),
    (12, "u", "WARC/1.0\r\nContent-Length: 99999\r\n\r\n" + "y" * 200), (13, "u", "long " * 50_000), (None, "u", "x" * 150), (1, "u", "x" * 150),
]


def test_round_trip(spark):
    assert sorted((tuple(r) for r in warc.round_trip(pages(spark, ROWS)).collect()), key=str) == plain(ROWS)


def test_splits_anywhere(spark):
    limit = spark.conf.get("spark.sql.files.maxPartitionBytes")
    path = shared_dir(spark, "warc-test")
    warc.write(pages(spark, ROWS).coalesce(1), path)
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "97")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        small = path + "-small"
        warc.write(pages(spark, [r for r in ROWS if r[0] != 13]).coalesce(1), small)
        assert sorted((tuple(r) for r in warc.read(spark, small).collect()), key=str) == plain([r for r in ROWS if r[0] != 13])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", limit)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted((tuple(r) for r in warc.read(spark, path).collect()), key=str) == plain(ROWS)


def test_large_side_is_joined_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(warc, "BROADCAST_ROWS", 0)
    assert sorted((tuple(r) for r in warc.round_trip(pages(spark, ROWS)).collect()), key=str) == plain(ROWS)


def test_damage_is_refused(spark):
    path = shared_dir(spark, "warc-broken")
    value = warc.MAGIC + "WARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\nContent-Length: 500\r\n\r\nshort"
    spark.createDataFrame([(value,)], "value string").coalesce(1).write.option("lineSep", warc.END).text(path)
    with pytest.raises(ValueError, match="file's end"):
        warc.read(spark, path)


def test_empty_table(spark):
    assert warc.round_trip(pages(spark, [])).isEmpty()
