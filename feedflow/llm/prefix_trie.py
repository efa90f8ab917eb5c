"""Conversation prefix trie, its totals by a depth-band rollup.

Conversations are rebuilt (the first turns of the first conversation of their hundred, then their own), and every distinct sequence
of first turns is a node. A node is known by its smallest member and its depth, so only those two numbers travel.

Sums over subtrees go by bands of ``BAND`` depths. A node explodes to itself and its ancestors inside its band, at most ``BAND`` rows,
which gives totals inside bands. The topmost nodes of the bands make a tree of their own that is ``BAND`` times lower; its totals
come by the same step. The completed total of a band's topmost node then explodes to its ancestors inside the band above.
So a trie of depth d takes log(d) / log(BAND) rounds, and no node sends more than 2 * ``BAND`` rows, however deep or hot it is.

Identity of a prefix: two running sums of 64 hashed bits each, of position and digest of every turn. Texts are not shuffled.
A frequent prefix is one grouped minimum and count, combined inside tasks; the join that hands them back splits under adaptive
execution. A conversation is sorted by its own turns in one task, by a sort that spills; nothing of it is gathered but ``BAND`` rows.
The ids behind ``ends_sha256`` are joined in chunks of at most 2 ** ``CHUNK_BITS`` ids, and the chunks of a node fed to its hash in order.

Defined results: null roles and texts are empty; null turns come first; turns that are equal are ordered by the md5 digest of role and
text; rows without conv_id take no part; repeated rows are turns of their own; conversations without turns after rebuilding are
members of the root; an empty table has no nodes, not even a root; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from feedflow.llm.shared import prepared, scratch, written

BAND = 16
# A chunk of a node's conversations has ids that agree but for so many last bits.
CHUNK_BITS = 12
# Conversations of one hundred share their first turns, as many as the checksum of the id modulo six says.
FAMILY, HEADS = 100, 6


def head_length(conv: Column) -> Column:
    return (F.crc32(conv.cast("string")) % HEADS).cast("int")


def ordered(conversations: DataFrame) -> DataFrame:
    """``conv, at, digest, chars``: the original turns, numbered from 1."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv"), "turn", F.char_length(text).cast("bigint").alias("chars"),
        F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)).alias("digest"),
    ).filter("conv IS NOT NULL")
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "digest")
    return rows.select("conv", F.row_number().over(order).alias("at"), "digest", "chars")


def rebuilt(rows: DataFrame) -> DataFrame:
    """``conv, part, at, digest, chars``: turns of the rebuilt conversations, in the order of part and at."""
    own = rows.filter(F.col("at") > head_length(F.col("conv"))).select("conv", F.lit(1).alias("part"), "at", "digest", "chars")
    heads = rows.filter((F.col("conv") % FAMILY == 0) & (F.col("at") < HEADS)).withColumnRenamed("conv", "base")
    convs = rows.select("conv").distinct().withColumn("of", F.col("conv") - F.col("conv") % FAMILY)
    taken = convs.join(heads, F.col("of") == F.col("base")).filter(F.col("at") <= head_length(F.col("conv")))
    return own.unionByName(taken.select("conv", F.lit(0).alias("part"), "at", "digest", "chars"))


def prefixes(turns: DataFrame) -> DataFrame:
    """``conv, depth, key, chars``: every prefix of every conversation."""
    order = Window.partitionBy("conv").orderBy("part", "at")
    numbered = turns.select("conv", "part", "at", "chars", "digest", F.row_number().over(order).cast("bigint").alias("depth"))
    mark = F.md5(F.concat_ws(":", "depth", "digest"))
    half = lambda first: F.conv(F.substr(mark, F.lit(first), F.lit(16)), 16, 10).cast("decimal(20,0)")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    sums = numbered.select("conv", "depth", "chars", F.sum(half(1)).over(so_far).alias("a"), F.sum(half(17)).over(so_far).alias("b"))
    return sums.select("conv", "depth", F.md5(F.concat_ws(":", "depth", "a", "b")).alias("key"), "chars")


def steps(found: DataFrame, root: int) -> DataFrame:
    """Each prefix with its node's smallest member ``owner``, that of the node above, the members, and whether the conversation ends there."""
    nodes = found.groupBy("key").agg(F.min("conv").alias("owner"), F.count("*").alias("n_convs"))
    order = Window.partitionBy("conv").orderBy("depth")
    return found.join(nodes, "key").select(
        "conv", "depth", "owner", "n_convs", "chars", F.lag("owner", 1, root).over(order).alias("above"),
        F.lead("owner").over(order).isNull().alias("ends"),
    )


def summed(rows: DataFrame, values: list[str]) -> DataFrame:
    """``owner, depth`` and the sums of ``values`` over rows that carry ``to`` (a node)."""
    return rows.groupBy(F.col("to.owner").alias("owner"), F.col("to.depth").alias("depth")).agg(*[F.sum(v).alias(v) for v in values])


def rollup(path: DataFrame, own: DataFrame, values: list[str]) -> DataFrame:
    """``owner, depth`` and, for each of ``values``, the sum over the node's subtree.

    ``path``: ``conv, depth, owner``, from depth 1 on without gaps; ``own``: ``owner, depth`` and the nodes' own values.
    """
    spark = path.sparkSession
    deepest = path.agg(F.max("depth")).first()[0] or 0
    top = (F.col("depth") - 1) % BAND == 0
    banded = path.select("conv", "depth", "owner", F.floor((F.col("depth") - 1) / BAND).alias("band"))
    inside = Window.partitionBy("conv", "band").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    lines = banded.withColumn("line", F.collect_list(F.struct("owner", "depth")).over(inside))
    if deepest > BAND:
        lines = lines.withColumn("line_above", F.when(top, F.lag("line").over(Window.partitionBy("conv").orderBy("depth"))))
    lines = lines.filter("owner = conv")
    spread = lines.join(own, ["owner", "depth"]).select(F.explode("line").alias("to"), *values)
    if deepest <= BAND:
        return summed(spread, values)
    within = written(spark, summed(spread, values), "trie-bands")
    lower = F.floor((F.col("depth") - 1) / BAND) + 1
    tops = rollup(path.filter(top).withColumn("depth", lower), within.filter(top).withColumn("depth", lower), values)
    done = tops.withColumn("depth", (F.col("depth") - 1) * BAND + 1).filter("depth > 1")
    upward = lines.select("owner", "depth", "line_above").join(done, ["owner", "depth"]).select(F.explode("line_above").alias("to"), *values)
    return summed(within.select(F.struct("owner", "depth").alias("to"), *values).unionByName(upward), values)


def ends(rows: DataFrame) -> DataFrame:
    """``owner, depth, ends_sha256`` of nodes at which conversations end; ``rows``: ``owner, depth, conv``."""
    chunks = rows.groupBy("owner", "depth", F.shiftright("conv", CHUNK_BITS).alias("chunk")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids"))
    dealt = chunks.repartition("owner", "depth").sortWithinPartitions("owner", "depth", "chunk")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            out = []
            for owner, depth, ids in zip(*(batch.column(c).to_pylist() for c in ("owner", "depth", "ids")), strict=True):
                if (owner, depth) == node:
                    digest.update(b"," + ids.encode())
                    continue
                if node:
                    out.append((*node, digest.hexdigest()))
                node, digest = (owner, depth), hashlib.sha256(ids.encode())
            yield batch_of(out)
        if node:
            yield batch_of([(*node, digest.hexdigest())])

    return dealt.mapInArrow(run, "owner bigint, depth bigint, ends_sha256 string")


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else ([], [], [])
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())],
                                      names=["owner", "depth", "ends_sha256"])


def trie(conversations: DataFrame) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256`` of every node."""
    spark = prepared(conversations.sparkSession)
    with scratch(spark):
        rows = written(spark, ordered(conversations), "trie-turns")
        convs = rows.select("conv").distinct()
        root, total = convs.agg(F.min("conv"), F.count("*")).first()
        found = written(spark, steps(prefixes(rebuilt(rows)), root or 0), "trie-steps")
        nodes = found.filter("owner = conv").select("owner", "depth", "above", "n_convs", "chars")
        children = nodes.groupBy(F.col("above").alias("owner"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
        own = nodes.join(children, ["owner", "depth"], "left").select(
            "owner", "depth", "above", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
            F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("bigint").alias("n_leaves"),
            ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"),
        )
        own = written(spark, own, "trie-nodes")
        values = ["n_leaves", "saved_tokens"]
        totals = written(spark, rollup(found.select("conv", "depth", "owner"), own.select("owner", "depth", *values), values), "trie-totals")
        first = totals.filter("depth = 1").agg(F.count("*").alias("n"), *[F.sum(v).alias(v) for v in values])
        top = first.select(
            F.lit(root).cast("bigint").alias("owner"), F.lit(0).cast("bigint").alias("depth"), F.lit(None).cast("bigint").alias("above"),
            F.lit(total).cast("bigint").alias("n_convs"), F.col("n").alias("n_children"), F.coalesce("n_leaves", F.lit(1)).alias("n_leaves"),
            F.coalesce("saved_tokens", F.lit(0)).alias("saved_tokens"),
        ).filter(F.lit(total > 0))
        every = own.drop(*values).join(totals, ["owner", "depth"]).unionByName(top)
        turnless = convs.join(found.filter("depth = 1").select("conv"), "conv", "left_anti")
        ended = ends(found.filter("ends").select("owner", "depth", "conv").unionByName(
            turnless.select(F.lit(root).cast("bigint").alias("owner"), F.lit(0).cast("bigint").alias("depth"), "conv")))
        made = every.join(ended, ["owner", "depth"], "left").select(
            F.col("owner").alias("conv_id"), "depth", F.col("above").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
        return written(spark, made, "trie", outlives=True)
