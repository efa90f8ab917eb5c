"""WARC archives: written from pages, and read back by boundary-chain verification.

Writing: equal payloads of at least ``MIN_PAYLOAD`` bytes are stored once, by the row with the smallest id; the others become
revisit records that name it. Records go through the text writer, with the blank lines behind a record as line separator, so
any file system of Spark's takes them. Reading: files are split anywhere; tasks cut them at the magic ``WARC/1.0`` and emit, for
each candidate, its offset and the offset where its header says that the next record begins. Magic inside a payload gives
false candidates; pointer jumping from offset 0 of each file keeps the reachable ones only. A payload that holds magic lies in
several cuts and is put together from them in a second scan of the files concerned.

Defined results: null html is an empty payload; rows that repeat an id and payload are each a record, all responses if their id
is the smallest; rows without an id refer to the smallest id of their payload if there is one; null urls are left out; line
breaks in urls are written as %0D and %0A; an empty table gives no records; further columns are ignored. A file whose chain does
not end at its last byte is refused.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from feedflow.llm.shared import written
from feedflow.settings import shared_dir

MIN_PAYLOAD = 100
MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
# A set of repeated digests is broadcast up to this many rows of about 100 bytes; beyond it, the join shuffles.
BROADCAST_ROWS = 200_000
RECORDS_PER_FILE = 4096


def repeated(pages: DataFrame) -> DataFrame:
    """Digests of payloads that occur more than once, with the smallest id of each; a few dozen bytes a row."""
    return (
        pages.filter(F.octet_length("html") >= MIN_PAYLOAD)
        .groupBy(F.sha2("html", 256).alias("digest"))
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
        .filter("n > 1").select("digest", "first_id")
    )


def records(pages: DataFrame) -> DataFrame:
    """One WARC record per page as text, without the blank lines that end it."""
    spark = pages.sparkSession
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce("html", F.lit("")).alias("html"))
    firsts = written(spark, repeated(rows), "warc-repeated")
    if firsts.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        firsts = F.broadcast(firsts)
    # Only long payloads carry a join key, so the short and the empty ones do not meet in one partition.
    key = F.when(F.octet_length("html") >= MIN_PAYLOAD, F.sha2("html", 256))
    joined = rows.withColumn("digest", key).join(firsts, "digest", "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("first_id").eqNullSafe(F.col("page_id"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    size = F.octet_length("html").cast("string")
    header = F.concat(
        F.lit(MAGIC),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">"))),
        F.coalesce(line("WARC-Target-URI", url), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.sha2("html", 256))),
        line("WARC-Payload-Bytes", size),
        F.when(revisit, line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("first_id").cast("string"), F.lit(">")))).otherwise(""),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(revisit, "0").otherwise(size)),
        F.lit("\r\n"),
    )
    return joined.select(F.concat(header, F.when(revisit, "").otherwise(F.col("html"))).alias("value"))


def write(pages: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write the archives below ``path``: as many files as the table has tasks, or more."""
    (records(pages).write.option("lineSep", END).option("maxRecordsPerFile", records_per_file).text(path))


def cuts(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Archive files cut at the magic: ``file, split, at`` (order in the split), ``cut`` (text behind the magic), ``bytes``."""
    lines = spark.read.option("lineSep", MAGIC).text(paths)
    return lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("cut"), F.octet_length("value").cast("bigint").alias("bytes"),
    )


def placed(found: DataFrame) -> DataFrame:
    """Add ``offset``, the position of a cut's magic in its file, from the lengths before it: within a split, and of whole splits.

    Windows hold lengths of one split, and one row for each split of a file. A file's first cut lies before any magic, at a
    negative offset.
    """
    length = F.col("bytes") + len(MAGIC)
    in_split = Window.partitionBy("file", "split").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    in_file = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = found.groupBy("file", "split").agg(F.sum(length).alias("whole"))
    bases = splits.select(F.col("file").alias("f"), F.col("split").alias("s"), F.coalesce(F.sum("whole").over(in_file), F.lit(0)).alias("base"))
    inner = found.withColumn("before", F.coalesce(F.sum(length).over(in_split), F.lit(0)))
    joined = inner.join(bases, (F.col("file") == F.col("f")) & (F.col("split") == F.col("s")))
    return joined.withColumn("offset", F.col("base") + F.col("before") - len(MAGIC)).drop("f", "s", "base", "before", "at", "split")


def field(header: Column, name: str, pattern: str) -> Column:
    """A header field's value; null if it is missing."""
    return F.nullif(F.regexp_extract(header, rf"(?im)^{name}:[ \t]*{pattern}[ \t]*$", 1), F.lit(""))


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """Every place of the magic with its header fields, the length of its cut, and the offset of its successor (null if its
    header names no length). ``own_digest`` is that of a payload that lies in this cut as a whole."""
    found = cuts(spark, path)
    header = F.substring_index("cut", END, 1)
    content = field(header, "Content-Length", r"(\d{1,18})").cast("bigint")
    found = found.select(
        "file", "split", "at", "bytes",
        F.when(F.octet_length(header) < F.col("bytes"), F.octet_length(header) + len(END)).cast("bigint").alias("head"),
        content.alias("content"),
        field(header, "WARC-Type", r"(\S+)").alias("record_type"),
        field(header, "WARC-Record-ID", r"<urn:page:(-?\d*)>").cast("bigint").alias("page_id"),
        field(header, "WARC-Refers-To", r"<urn:page:(-?\d*)>").cast("bigint").alias("refers_to"),
        field(header, "WARC-Payload-Digest", r"sha256:([0-9a-f]{64})").alias("said_digest"),
        field(header, "WARC-Payload-Bytes", r"(\d{1,18})").cast("bigint").alias("said_bytes"),
        F.sha2(F.expr("substring(cast(cut AS binary), octet_length(substring_index(cut, '\\r\\n\\r\\n', 1)) + 5, "
                      "octet_length(cut) - octet_length(substring_index(cut, '\\r\\n\\r\\n', 1)) - 8)"), 256).alias("own_digest"),
    )
    following = F.col("offset") + len(MAGIC) + F.col("head") + F.col("content") + len(END)
    return placed(found).withColumn("next", following)


def reachable(spark: SparkSession, found: DataFrame) -> DataFrame:
    """``file, offset`` of the candidates that the chain from each file's start reaches, by pointer jumping.

    Every round doubles the steps a pointer jumps over and marks the places that marked ones point to, so the rounds are the
    logarithm of the records in the longest file. The table of a round is written; a lost executor costs one round at most.
    """
    nodes = found.filter("offset >= 0").select("file", "offset", F.col("next").alias("jump"), (F.col("offset") == 0).alias("marked"))
    nodes = written(spark, nodes, "warc-chain")
    most = nodes.groupBy("file").count().agg(F.max("count")).first()[0] or 0
    for _ in range(max(0, most - 1).bit_length()):
        jumps = nodes.select(F.col("file").alias("f"), F.col("offset").alias("o"), F.col("jump").alias("far"))
        reached = nodes.filter("marked").select(F.col("file").alias("g"), F.col("jump").alias("p"), F.lit(True).alias("hit")).distinct()
        nodes = written(
            spark,
            nodes.join(jumps, (F.col("file") == F.col("f")) & (F.col("jump") == F.col("o")), "left")
            .join(reached, (F.col("file") == F.col("g")) & (F.col("offset") == F.col("p")), "left")
            .select("file", "offset", F.col("far").alias("jump"), (F.col("marked") | F.coalesce("hit", F.lit(False))).alias("marked")),
            "warc-chain",
        )
    return nodes.filter("marked").select("file", "offset")


def in_pieces(spark: SparkSession, records_in_pieces: DataFrame) -> DataFrame:
    """``file, offset, pieced_digest`` of records whose payloads hold magic, from a second scan of their files."""
    files = [row[0] for row in records_in_pieces.select("file").distinct().toLocalIterator()]
    owners = records_in_pieces.select(F.col("file").alias("f"), F.col("offset").alias("owner"), "next", "head", "content")
    pieces = placed(cuts(spark, files)).filter("offset >= 0")
    inside = pieces.join(owners, (F.col("file") == F.col("f")) & (F.col("offset") >= F.col("owner")) & (F.col("offset") < F.col("next")))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("offset", "cut"))), lambda x: x["cut"]), MAGIC).cast("binary")
    joined = inside.groupBy("file", "owner", "head", "content").agg(text.alias("text"))
    return joined.select(
        F.col("file").alias("f"), F.col("owner").alias("o"),
        F.sha2(F.substring("text", (F.col("head") + 1).cast("int"), F.col("content").cast("int")), 256).alias("pieced_digest"),
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of every record of the archives below ``path``.

    Digests of responses are computed from the payloads read and must be those that the headers name.
    """
    found = written(spark, candidates(spark, path), "warc-candidates")
    kept = reachable(spark, found)
    real = found.join(kept, ["file", "offset"])
    ends = found.groupBy("file").agg((F.sum(F.col("bytes") + len(MAGIC)) - len(MAGIC)).alias("size"))
    open_ends = ends.join(real.groupBy("file").agg(F.max("next").alias("last")), "file", "left").filter("size > 0 AND NOT size <=> last")
    broken = open_ends.limit(1).collect()
    if broken:
        raise ValueError(f"{broken[0]['file']}: the chain of records does not reach the file's end")
    pieced = F.col("head") + F.col("content") + len(END) != F.col("bytes")
    parts = written(spark, real.filter(pieced), "warc-pieces")
    digest = F.when(F.col("record_type") == "revisit", F.col("said_digest")).otherwise(F.col("own_digest"))
    if not parts.isEmpty():
        more = in_pieces(spark, parts)
        real = real.join(more, (F.col("file") == F.col("f")) & (F.col("offset") == F.col("o")), "left")
        digest = F.when(F.col("record_type") == "revisit", F.col("said_digest")).otherwise(F.coalesce("pieced_digest", "own_digest"))
    checked = F.when(digest == F.col("said_digest"), digest).otherwise(
        F.raise_error(F.concat(F.lit("payload of page "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(" is damaged"))))
    return real.select(
        "page_id", F.when(F.col("record_type") == "revisit", F.col("said_bytes")).otherwise(F.col("content")).alias("payload_bytes"),
        checked.alias("payload_digest"), "record_type", "refers_to",
    )


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages as archives in the shared folder and read them back."""
    path = shared_dir(pages.sparkSession, "warc")
    write(pages, path)
    return read(pages.sparkSession, path)
