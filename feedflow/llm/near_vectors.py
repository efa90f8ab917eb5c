"""Near-duplicate vectors by NN-descent.

Equal vectors are one node with a number of copies. Every node has a list of its nearest neighbours so far. The lists begin with the best
of two small blocks, one of a random projection's bucket and one of random nodes, and are refined by neighbours-of-neighbours joins: all
nodes that have v on their list, or that v has, meet at v, and each is offered those it is nearer to than to the last of its list.
Pairs that met before do not meet again. Lists are kept by (node, neighbour) rows, so merging is a grouped maximum and a rank.

A list that is full of neighbours above the threshold is saturated: its room doubles and all its members meet again. From ``most`` on
it is dense and grows no further; everything in a dense node's cluster is compared with everything in it, in blocks of ``BLOCK`` vectors.

Lists rank by half-precision cosines, which are off by less than ``MARGIN``. Links are decided in double precision: the lists' pairs
above threshold less margin connect nodes to clusters; small clusters, and those with a dense node, are compared as blocks, other large
ones pair by pair. Blocks hand on counts and one link per node, never pairs, so a group of copies costs no more rows than it has members.

At the end the numbers of links of ``sample`` nodes are counted by comparing these nodes with all vectors. If fewer than ``goal`` of them
were found, all lists get twice the room and the descent goes on. The share found last is logged, and returned by ``near_links``.

Hubs: a node that stands on very many lists meets their owners in blocks of ``meet`` at most, each with the node's own list.

Defined results: vectors that are null, zero, empty or have null or non-finite components link with nothing and are components of their
own; a shorter vector has zeros behind its end; equal vectors are linked with each other; rows that repeat an id stay rows of their
own; rows without an id have no links and no component of their own (null unless an equal or near vector has an id), and are kept if
they have none; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import logging
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from feedflow.llm.components import components
from feedflow.llm.jaccard import broadcast_if_small, connected
from feedflow.llm.shared import prepared, scratch, utf8_view, written

log = logging.getLogger(__name__)

# Cosines of vectors in half precision differ from the exact ones by less than 2 * 2 ** -11, and a little for sums in single precision.
MARGIN = 0.002
# Vectors of a block in which clusters are compared.
BLOCK = 1024
# Rows that one Python group holds, of many small blocks or clusters.
GROUP_ROWS = 8192


@dataclass(frozen=True)
class Search:
    """``room`` neighbours on a list at first, ``most`` after enlargements, ``take`` new ones from a meeting; blocks of about ``start`` nodes begin it; hubs ``meet`` in
    blocks; rounds go on until one adds fewer than ``still`` of the nodes with a neighbour above the threshold."""

    threshold: float = 0.95
    room: int = 24
    most: int = 96
    take: int = 6
    start: int = 24
    projections: int = 1
    meet: int = 128
    least_rounds: int = 3
    most_rounds: int = 12
    still: float = 0.005
    sample: int = 2048
    goal: float = 0.98
    tries: int = 3

    @property
    def near(self) -> float:
        return self.threshold - MARGIN


def padded(array: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``width`` doubles (zeros behind a list's end), and which of them are usable."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    rows = len(array)
    lengths = np.nan_to_num(array.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    values = array.flatten()
    flat = np.asarray(values.to_numpy(zero_copy_only=False), np.float64)  # a null is NaN
    row = np.repeat(np.arange(rows), lengths)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    table = np.zeros((rows, width))
    good = np.ones(rows, bool)
    good[row[~np.isfinite(flat)]] = False
    fits = place < width
    table[row[fits], place[fits]] = flat[fits]
    good &= (table != 0).any(axis=1) if width else False
    return table, good


def units(table: np.ndarray) -> np.ndarray:
    """Rows of length one; the largest component is taken out first, so that no square leaves the range of doubles."""
    table = table / np.abs(table).max(axis=1, keepdims=True)
    return table / np.sqrt((table * table).sum(axis=1, keepdims=True))


def identities(table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit identities of each row."""
    table = table + 0.0  # no negative zeros
    found = np.array([np.frombuffer(hashlib.blake2b(row.tobytes(), digest_size=16).digest(), np.int64) for row in table], np.int64).reshape(-1, 2)
    return found[:, 0], found[:, 1]


def identified(embeddings: DataFrame, width: int) -> DataFrame:
    """``vec_id, node, other, v``; node is null for an unusable vector."""
    kind = embeddings.schema["embedding"].dataType.simpleString()
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").alias("v"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table, good = padded(batch.column("v"), width)
            node, other = identities(table)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(node, mask=~good), pa.array(other, mask=~good), batch.column("v")],
                                             names=["vec_id", "node", "other", "v"])

    return rows.mapInArrow(run, f"vec_id bigint, node bigint, other bigint, v {kind}")


def halved(vectors: DataFrame, width: int) -> DataFrame:
    """``vectors`` with ``half``, the unit vector in half precision."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table, _ = padded(batch.column("v"), width)
            half = units(table).astype(np.float16) if len(table) else table
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([row.tobytes() for row in half], pa.binary())], names=[*batch.schema.names, "half"])

    return vectors.mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vectors.schema.fields) + ", half binary")


def halves(array: pa.Array, width: int) -> np.ndarray:
    data, _ = utf8_view(array)
    return data.view(np.float16).astype(np.float32).reshape(-1, width)


def parts(table: pa.Table, names: list[str]) -> Iterator[np.ndarray]:
    """Row numbers of each distinct value of the columns ``names``."""
    keys = [table.column(name).to_numpy() for name in names]
    order = np.lexsort(keys[::-1])
    moved = np.zeros(max(len(order) - 1, 0), bool)
    for key in keys:
        moved |= np.diff(key[order]) != 0
    yield from np.split(order, np.flatnonzero(moved) + 1) if len(order) else ()


def offers(blocks: DataFrame, count: int, width: int, search: Search) -> DataFrame:
    """``node, w, sim, room``: what the members of every block are offered of each other.

    ``blocks``: ``at, part`` name a block; ``member, half, fresh, floor, room`` are its members. Two members meet if one is fresh; a
    member takes at most ``room`` that are above its ``floor``, and of those that are no links the ``take`` best, since it is offered
    others elsewhere. ``count``: about how many members there are.
    """

    def meet(member, vectors, fresh, floor, room):
        _, first, back = np.unique(member, return_index=True, return_inverse=True)
        known = np.zeros(len(first), bool)
        np.logical_or.at(known, back, fresh)
        member, vectors, fresh, floor, room = member[first], vectors[first], known, floor[first], room[first]
        sims = vectors @ vectors.T
        sims[~((fresh[:, None] | fresh[None, :]) & (sims > floor[:, None]))] = -2
        np.fill_diagonal(sims, -2)
        best = np.argsort(-sims, axis=1, kind="stable")[:, : int(room.max())]
        value = np.take_along_axis(sims, best, axis=1)
        place = np.arange(best.shape[1])
        rows, places = np.nonzero((value > -2) & (place < room[:, None]) & ((place < search.take) | (value >= search.near)))
        return member[rows], member[best[rows, places]], value[rows, places], room[rows]

    def run(table: pa.Table) -> pa.Table:
        member, fresh, floor, room = (table.column(c).to_numpy() for c in ("member", "fresh", "floor", "room"))
        vectors = halves(table.column("half"), width)
        found = [meet(member[rows], vectors[rows], fresh[rows], floor[rows], room[rows]) for rows in parts(table, ["at", "part"]) if len(rows) > 1]
        kinds = (np.int64, np.int64, np.float32, np.int32)
        columns = [np.concatenate([np.empty(0, kind), *(f[i] for f in found)]).astype(kind) for i, kind in enumerate(kinds)]
        # Blocks of one group offer the same pair again and again; the first is enough.
        numbers, place = np.unique(np.concatenate(columns[:2]), return_inverse=True)
        _, once = np.unique(place[: len(columns[0])] * len(numbers) + place[len(columns[0]) :], return_index=True)
        return pa.table({name: pa.array(column[once]) for name, column in zip(("node", "w", "sim", "room"), columns, strict=True)})

    groups = F.pmod(F.xxhash64("at", "part"), F.lit(max(1, -(-count // GROUP_ROWS)))).alias("many")
    rows = blocks.select(groups, "at", "part", "member", "half", "fresh", "floor", "room")
    return rows.groupBy("many").applyInArrow(run, "node bigint, w bigint, sim float, room int")


def first_blocks(spark, vectors: DataFrame, nodes: int, width: int, search: Search) -> DataFrame:
    """Blocks of nodes that share a bucket of a random projection, and of random nodes."""
    bits = max(0, (nodes // search.start).bit_length() - 1)
    planes = [np.random.default_rng(seed).standard_normal((width, bits)).astype(np.float32) for seed in range(search.projections)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = halves(batch.column("half"), width)
            for number, plane in enumerate(planes):
                code = ((own @ plane > 0) << np.arange(bits)).sum(axis=1).astype(np.int64) + (number << 48)
                yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(code), batch.column("half")], names=["node", "at", "half"])

    near = vectors.select("node", "half").mapInArrow(run, "node bigint, at bigint, half binary")
    sizes = near.groupBy("at").agg(F.ceil(F.count("*") / search.meet).alias("n")).filter("n > 1").withColumnRenamed("at", "of")
    near = near.join(broadcast_if_small(written(spark, sizes, "near-buckets")), F.col("at") == F.col("of"), "left")
    near = near.select("at", F.pmod(F.xxhash64("node"), F.coalesce("n", F.lit(1))).alias("part"), "node", "half")
    any_ = vectors.select(F.pmod(F.xxhash64("node", F.lit(7)), F.lit(max(1, -(-nodes // search.start)))).alias("at"), F.lit(-1).cast("bigint").alias("part"), "node", "half")
    return near.unionByName(any_).select("at", "part", F.col("node").alias("member"), "half", F.lit(True).alias("fresh"),
                                         F.lit(-1.0).cast("float").alias("floor"), F.lit(search.room).alias("room"))


def merged(lists: DataFrame | None, offered: DataFrame, search: Search) -> DataFrame:
    """``node, w, sim, fresh, room, floor`` of the lists with what they were offered; saturated ones get more room and are fresh again."""
    rows = offered.withColumn("fresh", F.lit(True))
    if lists is not None:
        rows = rows.unionByName(lists.select("node", "w", "sim", F.lit(False).alias("fresh"), "room"))
    pairs = rows.groupBy("node", "w").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"), F.max("room").alias("room"))
    order = Window.partitionBy("node").orderBy(F.desc("sim"), "w")
    own = Window.partitionBy("node")
    ranked = pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= search.most)
    ranked = ranked.withColumn("room", F.max("room").over(own)).filter(F.col("rank") <= F.col("room"))
    ranked = ranked.withColumn("n", F.count("*").over(own)).withColumn("last", F.min("sim").over(own))
    full, saturated = F.col("n") >= F.col("room"), F.col("last") >= search.near
    grown = full & saturated & (F.col("room") < search.most)
    floor = F.when(full & saturated & (F.col("room") >= search.most), 2.0).when(full & ~saturated, F.col("last")).otherwise(-1.0)
    return ranked.select("node", "w", "sim", (F.col("fresh") | grown).alias("fresh"),
                         F.when(grown, F.least(2 * F.col("room"), F.lit(search.most))).otherwise(F.col("room")).cast("int").alias("room"),
                         floor.cast("float").alias("floor"), grown.alias("grown"))


def meetings(lists: DataFrame, vectors: DataFrame, search: Search) -> DataFrame:
    """The blocks of a round: at every node that has a fresh relation, its list and those who have it on theirs."""
    has = lists.select(F.col("node").alias("at"), F.col("w").alias("member"), "fresh", F.lit(True).alias("own"))
    stands = lists.select(F.col("w").alias("at"), F.col("node").alias("member"), "fresh", F.lit(False).alias("own"))
    all_ = has.unionByName(stands)
    sizes = all_.groupBy("at").agg(F.max("fresh").alias("active"), F.sum(F.when(F.col("own"), 0).otherwise(1)).alias("n")).filter("active")
    sizes = sizes.select(F.col("at").alias("of"), F.greatest(F.ceil(F.col("n") / search.meet), F.lit(1)).alias("n"))
    every = F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)
    part = F.when(F.col("own"), every).otherwise(F.array(F.pmod(F.xxhash64("member"), F.col("n"))))
    placed = all_.join(sizes, F.col("at") == F.col("of")).select("at", F.explode(part).alias("part"), "member", "fresh")
    itself = sizes.select(F.col("of").alias("at"), F.explode(every).alias("part"), F.col("of").alias("member"), F.lit(False).alias("fresh"))
    states = lists.groupBy("node").agg(F.max("floor").alias("floor"), F.max("room").alias("room"))
    known = vectors.select("node", "half").join(states, "node", "left").select(
        F.col("node").alias("member"), "half", F.coalesce("floor", F.lit(-1.0)).cast("float").alias("floor"), F.coalesce("room", F.lit(search.room)).alias("room"))
    return placed.unionByName(itself).join(known, "member")


def descended(spark, lists: DataFrame, vectors: DataFrame, width: int, search: Search, least_rounds: int) -> DataFrame:
    """The lists after rounds of neighbours-of-neighbours joins, until links above the threshold stand still."""
    before = None
    for round_ in range(search.most_rounds):
        tops = lists.groupBy("node").agg(F.max("sim").alias("sim"), F.max("grown").alias("grown"), F.sum(F.col("fresh").cast("int")).alias("fresh"), F.count("*").alias("n"))
        near, grown, fresh, entries = tops.agg(F.count(F.when(F.col("sim") >= search.near, 1)), F.max("grown"), F.sum("fresh"), F.sum("n")).first()
        log.info("round %d: %d nodes with a neighbour above the threshold, %d fresh entries", round_, near, fresh or 0)
        settled = before is not None and near - before <= search.still * near and not grown and round_ >= least_rounds
        if settled or not fresh:
            break
        before = near
        with scratch(spark):
            lists = written(spark, merged(lists, offers(meetings(lists, vectors, search), 2 * entries, width, search), search), "near-lists", outlives=True)
    return lists


def cosines_above(left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    return left @ right.T >= threshold


def compared(rows: DataFrame, width: int, search: Search) -> DataFrame:
    """``node, links, root``: links that each node has within a pair of blocks, and the smallest node it is connected with there.

    ``rows``: ``cluster, a, b`` name a pair of blocks (a = b for one block by itself), ``side`` is 1 for the second block.
    """

    def links(node, copies, vectors, side):
        left, right = (np.flatnonzero(side == 0), np.flatnonzero(side == 1)) if side.any() else (np.arange(len(node)),) * 2
        linked = np.zeros((len(node), len(node)), bool)
        linked[np.ix_(left, right)] = cosines_above(vectors[left], vectors[right], search.threshold)
        linked |= linked.T
        np.fill_diagonal(linked, False)
        return node, linked @ copies, node[connected(linked)]

    def run(table: pa.Table) -> pa.Table:
        node, copies, side = (table.column(c).to_numpy() for c in ("node", "copies", "side"))
        vectors, _ = padded(table.column("v"), width)
        vectors = units(vectors)
        found = []
        for rows in parts(table, ["cluster", "a", "b"]):
            rows = rows[np.argsort(node[rows], kind="stable")]
            found.append(links(node[rows], copies[rows], vectors[rows], side[rows]))
        return pa.table({name: pa.array(np.concatenate([f[i] for f in found]), pa.int64()) for i, name in enumerate(("node", "links", "root"))})

    return rows.groupBy("many").applyInArrow(run, "node bigint, links bigint, root bigint")


def compared_pairs(pairs: DataFrame, vectors: DataFrame, width: int, search: Search) -> DataFrame:
    """The same for single pairs ``a, b``, each once."""
    own = vectors.select("node", "copies", "v")
    first = own.select(F.col("node").alias("a"), F.col("copies").alias("copies_a"), F.col("v").alias("va"))
    second = own.select(F.col("node").alias("b"), F.col("copies").alias("copies_b"), F.col("v").alias("vb"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (units(padded(batch.column(c), width)[0]) if batch.num_rows else np.zeros((0, width)) for c in ("va", "vb"))
            linked = np.flatnonzero((left * right).sum(axis=1) >= search.threshold)
            a, b, copies_a, copies_b = (batch.column(c).to_numpy()[linked] for c in ("a", "b", "copies_a", "copies_b"))
            columns = np.concatenate([a, b]), np.concatenate([copies_b, copies_a]), np.concatenate([np.minimum(a, b)] * 2)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["node", "links", "root"])

    return pairs.join(first, "a").join(second, "b").select("a", "b", "copies_a", "copies_b", "va", "vb").mapInArrow(run, "node bigint, links bigint, root bigint")


def verified(spark, lists: DataFrame, vectors: DataFrame, width: int, search: Search) -> tuple[DataFrame, DataFrame]:
    """``node, links`` of every node with links, and ``node, root`` of every node that is connected with a smaller one."""
    near = lists.filter(F.col("sim") >= search.near)
    clusters = written(spark, components(near.select("node", "w")), "near-clusters").select(F.col("node").alias("of"), F.col("root").alias("cluster"))
    dense = lists.filter("floor = 2").select(F.col("node").alias("dense")).distinct()
    held = clusters.join(dense, F.col("of") == F.col("dense"), "left")
    sizes = held.groupBy("cluster").agg(F.count("*").alias("n"), F.count("dense").alias("n_dense"))
    sizes = written(spark, sizes.select(F.col("cluster").alias("its"), F.ceil(F.col("n") / BLOCK).alias("blocks"),
                                        ((F.col("n") <= BLOCK) | (F.col("n_dense") > 0)).alias("whole")), "near-sizes")
    placed = clusters.join(broadcast_if_small(sizes), F.col("cluster") == F.col("its")).drop("its")
    members = vectors.select("node", "copies", "v").join(broadcast_if_small(placed.filter("whole")), F.col("node") == F.col("of"))
    members = members.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    # Block i meets blocks j >= i as the first of the pair, and blocks j < i as the second.
    meets = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1), lambda j: F.struct(
        F.least("block", j).alias("a"), F.greatest("block", j).alias("b"), F.when(j < F.col("block"), 1).otherwise(0).alias("side")))
    rows = members.select("cluster", "node", "copies", "v", F.explode(meets).alias("pair")).select("cluster", "node", "copies", "v", "pair.*")
    groups = F.pmod(F.xxhash64("cluster", "a", "b"), F.lit(max(1, -(-placed.filter("whole").count() // GROUP_ROWS) * 4))).alias("many")
    counted = compared(rows.select(groups, "*"), width, search)
    sparse = placed.filter("NOT whole").select("of")
    pairs = near.join(broadcast_if_small(sparse), F.col("node") == F.col("of"), "left_semi").select(F.least("node", "w").alias("a"), F.greatest("node", "w").alias("b")).distinct()
    counted = written(spark, counted.unionByName(compared_pairs(pairs, vectors, width, search)), "near-counts")
    linked = counted.groupBy("node").agg(F.sum("links").alias("links")).filter("links > 0")
    return linked, components(counted.filter("node <> root").select("node", "root"))


def sampled(vectors: DataFrame, width: int, search: Search) -> dict[int, int]:
    """Exact numbers of links with other nodes, copies counted, of nodes picked by a hash."""
    rows = vectors.select("node", "v").orderBy(F.xxhash64("node", F.lit(3)), "node").limit(search.sample).collect()
    if not rows:
        return {}
    nodes = np.array([r["node"] for r in rows], np.int64)
    asked = units(padded(pa.array([r["v"] for r in rows], pa.list_(pa.float64())), width)[0])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(nodes), np.int64)
        for batch in batches:
            if batch.num_rows:
                node, copies = batch.column("node").to_numpy(), batch.column("copies").to_numpy()
                linked = cosines_above(asked, units(padded(batch.column("v"), width)[0]), search.threshold) & (nodes[:, None] != node[None, :])
                total += linked @ copies
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(nodes[found]), pa.array(total[found])], names=["node", "links"])

    counted = vectors.select("node", "copies", "v").mapInArrow(run, "node bigint, links bigint").groupBy("node").agg(F.sum("links").alias("links"))
    return {r["node"]: int(r["links"]) for r in counted.collect()}


def recall(spark, linked: DataFrame, truth: dict[int, int]) -> float:
    """Mean share of the sampled nodes' links that were found; one if they have none."""
    if not truth:
        return 1.0
    known = spark.createDataFrame(list(truth.items()), "of bigint, wanted bigint")
    both = F.broadcast(known).join(linked, F.col("of") == F.col("node"), "inner")
    return (both.agg(F.sum(F.col("links") / F.col("wanted"))).first()[0] or 0.0) / len(truth)


def near_links(spark, vectors: DataFrame, nodes: int, width: int, search: Search) -> tuple[DataFrame, DataFrame, float]:
    """``verified`` of the lists that the descent ends with, and the share of sampled links that they hold."""
    truth = sampled(vectors, width, search)
    begun = offers(first_blocks(spark, vectors, nodes, width, search), (search.projections + 1) * nodes, width, search)
    lists = written(spark, merged(None, begun, search), "near-lists")
    least_rounds = search.least_rounds
    for again in range(search.tries):
        lists = descended(spark, lists, vectors, width, search, least_rounds)
        linked, roots = verified(spark, lists, vectors, width, search)
        share = recall(spark, linked, truth)
        log.info("%.4f of the links of %d sampled vectors were found", share, len(truth))
        if share >= search.goal or again + 1 == search.tries:
            break
        # More room for every list, and every pair meets again.
        more = F.least(2 * F.col("room"), F.lit(search.most)).cast("int")
        lists = lists.withColumn("floor", F.when(F.col("floor") < 2, -1.0).otherwise(2.0).cast("float")).withColumn("room", more).withColumn("fresh", F.lit(True))
        least_rounds = 1
    if share < search.goal:
        log.warning("only %.3f of the links of the sampled vectors were found", share)
    return linked, roots, share


def join(embeddings: DataFrame, search: Search | None = None) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row."""
    search = search or Search()
    spark = prepared(embeddings.sparkSession)
    width = max(1, embeddings.agg(F.max(F.size("embedding"))).first()[0] or 1)
    with scratch(spark):
        rows = written(spark, identified(embeddings, width), "near-rows")
        vectors = written(spark, halved(distinct(rows), width), "near-vectors")
        if not vectors.filter("a <> b").isEmpty():
            raise ValueError("two different vectors have the same 64-bit identity")
        linked, roots, _ = near_links(spark, vectors, vectors.count(), width, search)
        return written(spark, labelled(rows, vectors, linked, roots), "near-components", outlives=True)


def distinct(rows: DataFrame) -> DataFrame:
    """``node, first, copies, a, b, v``: each usable vector once; ``a`` and ``b`` differ where two vectors have one identity."""
    return rows.filter("node IS NOT NULL").groupBy("node").agg(
        F.min("vec_id").alias("first"), F.count("*").alias("copies"), F.min("other").alias("a"), F.max("other").alias("b"), F.first("v").alias("v"))


def labelled(rows: DataFrame, vectors: DataFrame, linked: DataFrame, roots: DataFrame) -> DataFrame:
    """Every row with the links of its node (its copies among them) and the smallest id of its component."""
    own = vectors.select("node", "first", "copies").join(linked.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left").drop("of")
    own = own.filter("copies > 1 OR links IS NOT NULL").join(roots.select(F.col("node").alias("of"), "root"), F.col("node") == F.col("of"), "left")
    own = own.withColumn("component", F.coalesce("root", "node"))
    least = own.groupBy("component").agg(F.min("first").alias("component_id"))
    placed = own.join(least, "component").select(F.col("node").alias("of"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), "component_id")
    joined = rows.select("vec_id", "node").join(placed, F.col("node") == F.col("of"), "left")
    component = F.when(F.col("of").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return joined.select("vec_id", F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
                         F.col("vec_id").eqNullSafe(component).alias("kept"))
