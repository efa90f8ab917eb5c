"""Line dedup by site-relative frequency, in DataFrame functions only.

For each host, the pages that contain a line are divided by all pages of the host; lines above ``MAX_RATIO`` that stand on at
least ``MIN_PAGES`` pages are boilerplate and are dropped wherever they occur on that host. Lines are compared with white space
at both ends removed; blank lines are neither counted nor dropped.

A host has at most (lines per page / ``MAX_RATIO``) boilerplate lines, so they fit into one array per host. Counting sends one
small row per line, host and task; a frequent line arrives as one row per task. Pages meet their host's array by a broadcast
where all arrays together are proven small, else by a join in which a host's pages are dealt over ``SALTS`` keys.

Copies of one text would make all their lines frequent. With ``copies_once`` (the pipeline, which drops copies later) a line is
therefore counted once for each group of copies of a host, and so are the pages. A line belongs to the first page (by a hash) of the host that
has it. A page is a copy of another one if lines that belong to that one make up ``COPY_SHARE`` of its characters, or ``LINES_SHARE`` in
``COPY_LINES`` lines or more; copies of copies are one group. Only sharing whole lines matters here, since only lines are counted: copies
with a change in every line share none. Without it (the registered query, as its SQL has it) every row is a page.

The pipeline also has lower ratios: ``LINE_RATIO``, and ``LONG_RATIO`` for lines of ``LONG_WORDS`` words, which do not repeat by chance.

Defined results: null text stays null and counts as a page without lines; pages without a host share the host null; repeated
rows are pages of their own (a row's repeated line counts once); an empty table gives an empty result; other columns pass
through untouched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedflow.llm.components import components
from feedflow.llm.shared import column, scratch, written

MAX_RATIO = 0.1
MIN_PAGES = 3
# The pipeline's ratios, of groups of copies: for lines in general, and for those of ``LONG_WORDS`` words or more.
LINE_RATIO, LONG_RATIO, LONG_WORDS = 1 / 16, 1 / 100, 50
# Boilerplate lines (8 bytes each) of all hosts that are broadcast at most; beyond it, pages are joined by host.
BROADCAST_LINES = 1_000_000
SALTS = 32
# What share of a page's characters stands in another's lines if it is its copy: at all, and in several lines.
COPY_SHARE, LINES_SHARE, COPY_LINES = 0.8, 0.5, 4
# Pages (16 bytes each) with a group that are broadcast at most.
BROADCAST_PAGES = 1_000_000
BREAK = "\n"


def code(line: Column) -> Column:
    """Identity of a line: its 64-bit hash; null for a blank one."""
    return F.when(F.trim(line) != "", F.xxhash64(F.trim(line)))


def codes(text: Column) -> Column:
    """Distinct identities of a text's lines."""
    return F.array_compact(F.array_distinct(F.transform(F.split(text, BREAK), code)))


def sized_codes(text: Column) -> Column:
    """Distinct ``line, long`` of a text: identities, and whether the line has ``LONG_WORDS`` words."""
    sized = lambda line: F.struct(code(line).alias("line"), (F.size(F.split(F.trim(line), r"\s+")) >= LONG_WORDS).alias("long"))
    return F.array_distinct(F.filter(F.transform(F.split(text, BREAK), sized), lambda own: own["line"].isNotNull()))


def page() -> Column:
    """Identity of a text on its host."""
    return F.xxhash64("host", "text")


def measured(text: Column) -> Column:
    """Distinct ``line, chars`` of a text: identities and lengths of its lines."""
    own = lambda line: F.struct(code(line).alias("line"), F.char_length(F.trim(line)).alias("chars"))
    return F.array_distinct(F.filter(F.transform(F.split(text, BREAK), own), lambda own: own["line"].isNotNull()))


def groups(own: DataFrame) -> DataFrame:
    """``node, root``: texts (as ``page``) that are copies of another of their host, and the one that stands for their group.

    Each line meets its first page by a join on host and line, whose hot keys adaptive execution splits; no page meets all of another's lines.
    """
    lines = own.select("host", page().alias("page"), F.explode(measured(F.col("text"))).alias("own")).select("host", "page", "own.*").distinct()
    firsts = lines.groupBy(F.col("host").alias("of"), F.col("line").alias("of_line")).agg(F.min("page").alias("first"), F.count("*").alias("n")).filter("n > 1")
    met = lines.join(firsts, F.col("host").eqNullSafe(F.col("of")) & (F.col("line") == F.col("of_line"))).filter("first <> page")
    shared = met.groupBy("page", "first").agg(F.sum("chars").alias("shared"), F.count("*").alias("lines"))
    wholes = lines.groupBy(F.col("page").alias("whole_of")).agg(F.sum("chars").alias("whole"))
    both = shared.join(wholes, F.col("page") == F.col("whole_of"))
    alike = (F.col("shared") >= F.col("whole") * COPY_SHARE) | ((F.col("shared") >= F.col("whole") * LINES_SHARE) & (F.col("lines") >= COPY_LINES))
    return components(both.filter(alike).select("page", "first"))


def counts(own: DataFrame, copies_once: bool) -> tuple[DataFrame, DataFrame]:
    """``host, pages`` and ``host, line, n``: pages of each host, and those that contain each line."""
    if not copies_once:
        counted = own.select("host", F.explode(codes(F.col("text"))).alias("line")).groupBy("host", "line").agg(F.count("*").alias("n"))
        return own.groupBy("host").agg(F.count("*").alias("pages")), counted
    found = groups(own)
    found = F.broadcast(found) if found.limit(BROADCAST_PAGES + 1).count() <= BROADCAST_PAGES else found
    rows = own.withColumn("page", page()).join(found, F.col("page") == F.col("node"), "left").withColumn("of", F.coalesce("root", "page"))
    totals = rows.select("host", "of").distinct().groupBy("host").agg(F.count("*").alias("pages"))
    lines = rows.select("host", "of", F.explode(sized_codes(F.col("text"))).alias("own")).select("host", "of", "own.*").distinct()
    return totals, lines.groupBy("host", "line").agg(F.count("*").alias("n"), F.max("long").alias("long"))


def boilerplate(docs: DataFrame, host: str, text: str, max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES, copies_once: bool = False) -> DataFrame:
    """``host, pages, frequent``: hosts that have boilerplate, their page totals and the identities of those lines."""
    own = docs.select(column(docs, host).alias("host"), column(docs, text).alias("text"))
    totals, counted = counts(own, copies_once)
    totals = totals.withColumnRenamed("host", "of")
    joined = counted.filter(F.col("n") >= min_pages).join(totals, F.col("host").eqNullSafe(F.col("of")))
    ratio = F.when(F.col("long"), LONG_RATIO).otherwise(LINE_RATIO) if copies_once else F.lit(max_ratio)
    above = joined.filter(F.col("n") > F.col("pages") * ratio)
    return above.groupBy("host").agg(F.first("pages").alias("pages"), F.collect_list("line").alias("frequent"))


def marked(docs: DataFrame, host: str = "source", text: str = "text", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES,
           copies_once: bool = False) -> DataFrame:
    """``row`` (all columns), ``lines`` (null for null text) and ``kept``, the lines that stay."""
    spark = docs.sparkSession
    with scratch(spark):
        found = written(spark, boilerplate(docs, host, text, max_ratio, min_pages, copies_once), "line-boilerplate", outlives=True)
    size = found.agg(F.sum(F.size("frequent")).alias("n")).first()["n"] or 0
    rows = docs.select(F.struct(*[column(docs, c).alias(c) for c in docs.columns]).alias("row"), column(docs, host).alias("host"),
                       column(docs, text).alias("text"))
    if size <= BROADCAST_LINES:
        small = F.broadcast(found.select(F.col("host").alias("of"), "frequent"))
        joined = rows.join(small, F.col("host").eqNullSafe(F.col("of")), "left")
    else:
        salted = found.select(F.col("host").alias("of"), "frequent", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("of_salt"))
        dealt = rows.withColumn("salt", F.pmod(F.xxhash64("text", F.col("host")), F.lit(SALTS)).cast("int"))
        joined = dealt.join(salted, F.col("host").eqNullSafe(F.col("of")) & (F.col("salt") == F.col("of_salt")), "left")
    frequent = F.array_intersect(codes(F.col("text")), F.coalesce("frequent", F.array().cast("array<bigint>")))
    present = joined.select("row", F.split("text", BREAK).alias("lines"), frequent.alias("drop"))
    stays = lambda line: ~F.coalesce(F.array_contains("drop", code(line)), F.lit(False))
    kept = F.when(F.size("drop") > 0, F.filter("lines", stays)).otherwise(F.col("lines"))
    return present.select("row", "lines", kept.alias("kept"))


def without_boilerplate(docs: DataFrame, host: str = "source", text: str = "text", copies_once: bool = False) -> DataFrame:
    """The documents with their boilerplate lines cut out; all columns and rows stay."""
    cut = marked(docs, host, text, copies_once=copies_once)
    return cut.select(*[F.array_join("kept", BREAK).alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns])


def report(docs: DataFrame) -> DataFrame:
    """Per document: lines, lines dropped, and length and digest of the text that stays (null text: null)."""
    cut = marked(docs.select("doc_id", "source", "text"))
    text = F.array_join("kept", BREAK)
    return cut.select(
        F.col("row.doc_id").alias("doc_id"), F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size("kept")).cast("bigint").alias("n_dropped"),
        F.char_length(text).cast("bigint").alias("n_chars"), F.sha2(text, 256).alias("text_sha256"),
    )
