"""N-gram Jaccard join with PartEnum signatures.

Documents become sets of hashed word shingles. Sets that may be similar enough differ in at most k shingles, where k follows
from the sizes of a band. For each band the shingle domain is dealt over first-level parts, each of three second-level parts; of
the first-level parts, more than half of k differ nowhere or in one second-level part, so two similar sets agree on two of
its three parts. A set's signatures are the hashes of its shingles in every such choice. Bands hold sizes up to a fixed
ratio; a set near the upper end also signs for the next band, so similar sets of neighbouring bands meet.

A choice without shingles says nothing and is left out, unless a set has more of them than the spare first-level parts make
up for; such sets sign their empty choices too, which keeps the join exact.

Sets that share a signature are candidates, and connected candidates a cluster. Looser rules have signatures of fewer shingles, which sets
of little similarity share as well; with ``likely`` above 0, sets under a signature are candidates only if their sketches leave it open
whether they are linked. A sketch holds parities, so the bits in which two of them differ are a lower bound of the shingles in which the sets
differ: no linked pair is left out. Within clusters all pairs of sets are
compared exactly, by blocks of bounded size: first every block with one hub block, then only blocks that still hold
different components. Nothing is emitted per pair: a block hands on one link per set it found connected.

Defined results: null texts and texts without words have the empty set, which is linked with nothing, and are components of their
own; equal texts are linked by having one set, which is compared once; rows that repeat a document id stay rows;
rows without an id take no part as representatives; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from feedflow.llm.components import components
from feedflow.llm.shared import Rolling, annotated, blocks, column, lower_ascii_table, mix, prepared, scratch, utf8_view, words, written

# Members and shingles of a block of sets.
BLOCK_SETS, BLOCK_SHINGLES = 1024, 400_000
# Ids (8 bytes) that are broadcast at most to pick documents; beyond it, documents are joined by id.
BROADCAST_IDS = 1_000_000
# Sets of a signature that are held together at most.
PART = 1024
LOWER = lower_ascii_table()


@dataclass(frozen=True)
class Rule:
    """Shingles of ``words`` words; sets are linked from ``numerator / denominator`` on. ``reach`` is how many times the ratio of
    sizes of two linked sets a band spans; ``spare`` is the number of first-level parts beyond those that k asks for. ``likely``
    above 0 has candidates tested by their sketches, which leave out no linked pair; 0 takes all."""

    words: int = 3
    numerator: int = 90
    denominator: int = 100
    reach: int = 2
    spare: int = 1
    likely: float = 0.0

    def bands(self, largest: int) -> list[tuple[int, int]]:
        """Size bands up to ``largest``: first and last size."""
        found, low = [], 1
        while low <= largest:
            high = max(low, low * self.denominator**self.reach // self.numerator**self.reach)
            found.append((low, high))
            low = high + 1
        return found

    def differences(self, high: int) -> int:
        """The most shingles in which two linked sets of at most ``high`` shingles differ."""
        return 2 * high * (self.denominator - self.numerator) // (self.denominator + self.numerator)

    def linked(self, common: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (self.denominator * common >= self.numerator * (left + right - common)) & (common > 0)


def word_bytes() -> np.ndarray:
    """All bytes but white space."""
    inside = np.ones(256, np.int8)
    inside[0x20] = inside[0x09:0x0E] = 0
    return inside


INSIDE = word_bytes()


class Shingler:
    """Shingle sets of blocks of texts."""

    def __init__(self, size: int) -> None:
        self.size, self.of_bytes, self.of_words = size, Rolling(), Rolling()

    def sets(self, data: np.ndarray, bounds: np.ndarray) -> Iterator[np.ndarray]:
        """The distinct shingle hashes of each text, ascending."""
        low = LOWER[data]
        starts, ends, counts = words(low, bounds, INSIDE)
        codes = self.of_bytes.ranges(self.of_bytes.prefix(low), starts, ends) if len(starts) else np.empty(0, np.uint64)
        sums = self.of_words.prefix(codes)
        sizes = np.minimum(counts, self.size)
        room = np.where(counts > 0, counts - sizes + 1, 0)
        owner = np.repeat(np.arange(len(counts)), room)
        first = (np.cumsum(counts) - counts)[owner] + np.arange(len(owner)) - (np.cumsum(room) - room)[owner]
        hashes = self.of_words.ranges(sums, first, first + sizes[owner]) if len(owner) else np.empty(0, np.uint64)
        at = 0
        for n in room.tolist():
            yield np.unique(hashes[at : at + n])
            at += n


class Signer:
    """PartEnum signatures of shingle sets."""

    def __init__(self, rule: Rule) -> None:
        self.rule, self.bands = rule, rule.bands(1)

    def roles(self, size: int) -> list[int]:
        """Bands that a set of this size signs for: its own, and the next if a set of that one can be similar."""
        while self.bands[-1][1] < size * 2:
            self.bands = self.rule.bands(4 * size)
        own = int(np.searchsorted([high for _, high in self.bands], size))
        next_low = self.bands[own + 1][0]
        return [own, own + 1] if self.rule.denominator * size >= self.rule.numerator * next_low else [own]

    def sign(self, shingles: np.ndarray) -> np.ndarray:
        """Signatures of a set, over all its bands. Bands in which only equal sets are similar need none."""
        out = []
        for band in self.roles(len(shingles)) if len(shingles) else ():
            k = self.rule.differences(self.bands[band][1])
            if k:
                out.append(self.choices(shingles, band, k // 2 + 1 + self.rule.spare))
        return np.concatenate(out) if out else np.empty(0, np.uint64)

    def choices(self, shingles: np.ndarray, band: int, parts: int) -> np.ndarray:
        """Hashes of the shingles in two of the three second-level parts of each first-level part."""
        salted = mix(shingles + np.uint64(band * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        place = ((salted >> np.uint64(32)) * np.uint64(3 * parts) >> np.uint64(32)).astype(np.int64)
        sums = np.zeros(3 * parts, np.uint64)
        np.add.at(sums, place, mix(salted))
        held = (np.bincount(place, minlength=3 * parts) > 0).reshape(parts, 3)
        sums = sums.reshape(parts, 3)
        left = sums[:, [1, 0, 0]] * np.uint64(0xC2B2AE3D27D4EB4F) + sums[:, [2, 2, 1]]
        label = np.arange(3 * parts, dtype=np.uint64).reshape(parts, 3) + np.uint64(band << 32)
        codes = mix(left ^ mix(label))
        filled = held[:, [1, 0, 0]] | held[:, [2, 2, 1]]
        enough = (~filled).any(axis=1).sum() <= self.rule.spare
        return codes[filled] if enough else codes.ravel()


def keys(shingles: np.ndarray) -> tuple[int, int]:
    """Two 64-bit identities of a set."""
    sums = [int(mix(shingles ^ np.uint64(salt)).sum(dtype=np.uint64)) for salt in (0, 0x5851F42D4C957F2D)]
    return tuple(x - (1 << 64) if x >> 63 else x for x in sums)


# Bits of the smallest sketch, and bits for each shingle at least.
SKETCH, SKETCHED = 512, 1
# Bytes of sketches that are compared at once.
SKETCH_BYTES = 1 << 22


def sketch(shingles: np.ndarray) -> bytes:
    """Parities of the shingles that fall on each bit. Two sets' sketches differ in no more bits than the sets do in shingles."""
    bits = max(SKETCH, 1 << (SKETCHED * len(shingles) - 1).bit_length())
    place = (mix(shingles ^ np.uint64(0xA0761D6478BD642F)) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(place, minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def folded(sketches: np.ndarray, width: int) -> np.ndarray:
    """Sketches (rows of 64-bit words) as they would be with ``width`` words."""
    return np.bitwise_xor.reduce(sketches.reshape(len(sketches), -1, width), axis=1)


def shingled(docs: DataFrame, rule: Rule) -> DataFrame:
    """``doc_id, n, key, other, sketch``: the size and identity of each document's set, and its sketch if the rule has use for one."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(rule.words)
        for rows, data, bounds in blocks(batches, "text"):
            found = [(len(s), *keys(s), sketch(s) if rule.likely and len(s) else None) for s in shingler.sets(data, bounds)]
            *numbers, sketches = zip(*found, strict=True) if found else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([rows.column(0), *(pa.array(x, pa.int64()) for x in numbers), pa.array(sketches, pa.binary())],
                                             names=["doc_id", "n", "key", "other", "sketch"])

    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"])
    return rows.mapInArrow(run, "doc_id bigint, n bigint, key bigint, other bigint, sketch binary")


def signed(docs: DataFrame, rule: Rule) -> DataFrame:
    """``key, signatures``; a task signs each distinct set once. Signatures are never written: they go from here into the shuffle."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, signer, seen = Shingler(rule.words), Signer(rule), set()
        for rows, data, bounds in blocks(batches, "text"):
            found, codes = [], []
            for shingles in shingler.sets(data, bounds):
                key = keys(shingles)[0]
                if key not in seen:
                    seen.add(key)
                    found.append(key)
                    codes.append(signer.sign(shingles).view(np.int64))
            offsets = np.cumsum([0, *map(len, codes)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(codes) if codes else np.empty(0, np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), lists], names=["key", "signatures"])

    return docs.select("text").mapInArrow(run, "key bigint, signatures array<bigint>")


def candidates(signatures: DataFrame) -> DataFrame:
    """``lead, key``: every set that shares a signature with others, with the smallest of them."""
    rows = signatures.select(F.explode("signatures").alias("signature"), "key")
    sharing = rows.withColumn("lead", F.min("key").over(Window.partitionBy("signature")))
    return sharing.filter("lead <> key").select("lead", "key").distinct()


def alike(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The ``pairs`` (``lead, key``) without those whose sketches prove that they aren't linked; no linked pair goes."""
    sketches = sets.filter("n > 0").groupBy("key").agg(F.max(F.struct("n", "sketch")).alias("sketch"))
    both = pairs.join(sketches.select(F.col("key").alias("lead"), F.col("sketch").alias("a")), "lead").join(sketches.withColumnRenamed("sketch", "b"), "key")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [batch.column(c).to_numpy() for c in ("n_a", "n_b")]
            most = (sizes[0] + sizes[1]) * (rule.denominator - rule.numerator) // (rule.denominator + rule.numerator)
            data, words = [], []
            for c in ("a", "b"):
                flat, bounds = utf8_view(batch.column(c))
                data.append((flat, bounds))
                words.append(np.diff(bounds) // 8)
            differ = np.zeros(batch.num_rows, np.int64)
            for x, y in np.unique(np.stack(words, axis=1), axis=0).tolist():
                of_kind, step = np.flatnonzero((words[0] == x) & (words[1] == y)), max(1, SKETCH_BYTES // (8 * max(x, y)))
                for first in range(0, len(of_kind), step):
                    at = of_kind[first : first + step]
                    a, b = (folded(flat[bounds[at][:, None] + np.arange(8 * n)].view(np.uint64), min(x, y)) for (flat, bounds), n in zip(data, (x, y), strict=True))
                    differ[at] = np.bitwise_count(a ^ b).sum(axis=1)
            yield batch.select(["lead", "key"]).filter(pa.array(differ <= most))

    columns = both.select("lead", "key", F.col("a.n").alias("n_a"), F.col("b.n").alias("n_b"), F.col("a.sketch").alias("a"), F.col("b.sketch").alias("b"))
    return columns.mapInArrow(run, "lead bigint, key bigint")


def of_pairs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one ``pair`` (the first column) after the other; rows come in its order."""
    held, last = [], None
    for batch in batches:
        pair = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(pair)) + 1).tolist(), len(pair)]
        for first, end in zip(cuts, cuts[1:], strict=False) if len(pair) else ():
            if held and pair[first] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(first, end - first))
            last = pair[first]
    if held:
        yield pa.Table.from_batches(held)


def unlike_bits(flat: np.ndarray, starts: np.ndarray, words: np.ndarray, left: np.ndarray, right: np.ndarray):
    """``rows, columns, bits``: numbers of sets of ``left`` and ``right``, and how many bits of their sketches differ, by bounded matrices."""
    for x in np.unique(words[left]).tolist():
        for y in np.unique(words[right]).tolist():
            width = min(x, y)
            step = max(1, SKETCH_BYTES // (64 * width))

            def bits(at: np.ndarray, n: int) -> np.ndarray:
                narrow = folded(flat[starts[at][:, None] + np.arange(8 * n)].view(np.uint64), width)
                return np.unpackbits(narrow.view(np.uint8), axis=1).astype(np.float32)

            rows, columns = left[words[left] == x], right[words[right] == y]
            for i in range(0, len(rows), step):
                a = bits(rows[i : i + step], x)
                for j in range(0, len(columns), step):
                    b = bits(columns[j : j + step], y)
                    yield rows[i : i + step], columns[j : j + step], a.sum(axis=1)[:, None] + b.sum(axis=1) - 2 * (a @ b.T)


def alike_apart(met: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """``lead, key``: all pairs of sets of different components in the pairs of parts ``met`` (``sets, others``, or ``sets`` alone) that may be
    linked by their sketches and sizes. Sets travel with their sketches, once a pair of parts; only what passes becomes a row.

    Two pairs of parts with one hash are compared as one, which leaves out nothing.
    """
    sketches = sets.filter("n > 0").groupBy("key").agg(F.max(F.struct("n", "sketch")).alias("held"))

    def members_of(column: str, side: int):
        return F.transform(column, lambda s: F.struct(s["key"].alias("of"), s["component"].alias("component"), F.lit(side).alias("side")))

    rows = met.select(F.xxhash64("sets", "others").alias("pair"), F.inline(F.concat(members_of("sets", 0), members_of("others", 1)))).join(sketches, F.col("of") == F.col("key"))
    rows = rows.select("pair", "side", "key", "component", F.col("held.n").alias("n"), F.col("held.sketch").alias("sketch"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in of_pairs(batches):
            side, key, component, n = (table.column(c).to_numpy() for c in ("side", "key", "component", "n"))
            flat, bounds = utf8_view(table.column("sketch"))
            left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            for a, b, differ in unlike_bits(flat, bounds[:-1], np.diff(bounds) // 8, left, right if len(right) else left):
                sizes = n[a][:, None] + n[b]
                near = differ <= sizes * (rule.denominator - rule.numerator) // (rule.denominator + rule.numerator)
                near &= rule.denominator * np.minimum(n[a][:, None], n[b]) >= rule.numerator * np.maximum(n[a][:, None], n[b])
                i, j = np.nonzero(near & (component[a][:, None] != component[b]))
                if len(i):
                    x, y = key[a[i]], key[b[j]]
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["lead", "key"])

    return rows.repartition("pair").sortWithinPartitions("pair").mapInArrow(run, "lead bigint, key bigint")


def likely_candidates(signatures: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """``lead, key``: sets that share a signature and may be linked by their sketches, as far as needed to connect all that are.

    First the sets that follow each other under a signature; then, under signatures whose sets these leave in several components,
    all pairs of sets of different ones, by parts of ``PART`` sets.
    """
    spark = sets.sparkSession
    rows = signatures.select(F.explode("signatures").alias("signature"), "key")
    order = Window.partitionBy("signature").orderBy("key")
    beside = rows.select("signature", "key", F.lag("key").over(order).alias("before"), F.lead("key").over(order).alias("after"))
    shared = written(spark, beside.filter("before <> key OR after <> key").drop("after"), "shared-signatures")
    near = shared.filter("before <> key").select(F.col("before").alias("lead"), "key").distinct()
    near = written(spark, alike(near, sets, rule), "near-candidates")
    labelled = shared.join(components(near), F.col("key") == F.col("node"), "left").select("signature", "key", F.coalesce("root", "key").alias("component"))
    whole = Window.partitionBy("signature")
    several = labelled.select(
        "*", F.min("component").over(whole).alias("least"), F.max("component").over(whole).alias("most"),
        F.floor((F.row_number().over(order) - 1) / PART).alias("part"),
    ).filter("least <> most")
    parts = several.groupBy("signature", "part").agg(F.array_sort(F.collect_list(F.struct("key", "component"))).alias("sets"))
    parts = written(spark, parts, "open-signatures")
    later = parts.select("signature", F.col("part").alias("later"), F.col("sets").alias("others"))
    met = parts.join(later, "signature").filter("part <= later")
    # Many signatures have the same sets; each pair of parts is taken once. A part meets itself as one side.
    met = met.select("sets", F.when(F.col("part") < F.col("later"), F.col("others")).otherwise(F.slice("others", 1, 0)).alias("others")).distinct()
    return near.unionByName(alike_apart(met, sets, rule))


def broadcast_if_small(table: DataFrame) -> DataFrame:
    """A written table of ids, marked for broadcast if it is counted small."""
    return F.broadcast(table) if table.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else table


def members(docs: DataFrame, sets: DataFrame, clusters: DataFrame, rule: Rule) -> DataFrame:
    """``cluster, key, n, shingles`` of the sets in clusters, computed again from one document of each."""
    spark = docs.sparkSession
    firsts = sets.filter("n > 0").groupBy("key").agg(F.min("doc_id").alias("first"))
    wanted = written(spark, firsts.join(clusters, F.col("key") == F.col("node")).select("first", "key", F.col("root").alias("cluster")), "members")
    texts = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"])
    texts = texts.join(broadcast_if_small(wanted), F.col("doc_id") == F.col("first"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(rule.words)
        for rows, data, bounds in blocks(batches, "text"):
            found = list(shingler.sets(data, bounds))
            offsets = np.cumsum([0, *map(len, found)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found).view(np.int64)))
            # An id may stand for several texts; only the one that has the set counts.
            same = pa.array([keys(s)[0] == k for s, k in zip(found, rows.column(1).to_pylist(), strict=True)])
            made = pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), pa.array([len(s) for s in found], pa.int64()), lists], names=["cluster", "key", "n", "shingles"]
            )
            yield made.filter(same)

    return texts.select("cluster", "key", "text").mapInArrow(run, "cluster bigint, key bigint, n bigint, shingles array<bigint>")


HEAVY, WIDTH = 16, 4096


def common(owner: np.ndarray, shingle: np.ndarray, count: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Shingles that the sets ``left`` and ``right`` (numbers below ``count``) have in common, as a matrix.

    Shingles in few sets are counted pair by pair, those in many by matrix products over some thousand shingles at a time.
    """
    order = np.argsort(shingle, kind="stable")
    shingle, owner = shingle[order], owner[order]
    edge = np.flatnonzero(np.diff(shingle)) + 1
    starts, ends = np.concatenate([[0], edge]), np.concatenate([edge, [len(shingle)]])
    frequency = np.repeat(ends - starts, ends - starts)
    total = np.zeros((count, count), np.float32)
    rare = (frequency > 1) & (frequency < HEAVY)
    few_shingles, few_owners = shingle[rare], owner[rare]
    for step in range(1, HEAVY - 1):
        if len(few_owners) <= step:
            break
        same = few_shingles[step:] == few_shingles[:-step]
        a, b = few_owners[:-step][same], few_owners[step:][same]
        np.add.at(total, (a, b), 1)
        np.add.at(total, (b, a), 1)
    table = total[np.ix_(left, right)]
    heavy = frequency >= HEAVY
    number = np.cumsum(np.concatenate([[0], np.diff(shingle[heavy]) != 0])) if heavy.any() else np.empty(0, np.int64)
    many = owner[heavy]
    for at in range(0, int(number[-1]) + 1 if len(number) else 0, WIDTH):
        first, last = np.searchsorted(number, [at, at + WIDTH])
        dense = np.zeros((count, WIDTH), np.float32)
        dense[many[first:last], number[first:last] - at] = 1
        table += dense[left] @ dense[right].T
    return table


def connected(linked: np.ndarray) -> np.ndarray:
    """The smallest number each one is connected with, from a symmetric matrix of links."""
    label, open_ = np.arange(len(linked)), np.ones(len(linked), bool)
    for start in range(len(linked)):
        if not open_[start]:
            continue
        open_[start], front = False, [start]
        while front:
            reached = np.flatnonzero(linked[front].any(axis=0) & open_)
            open_[reached], label[reached] = False, start
            front = reached.tolist()
    return label


def compare(rule: Rule):
    """Links among the sets of a pair of blocks: every set found connected, with the smallest key of its component."""

    def run(table: pa.Table) -> pa.Table:
        key, size, side = (table.column(c).to_numpy() for c in ("key", "n", "side"))
        _, kept = np.unique(np.stack([key, side]), axis=1, return_index=True)
        order = kept[np.argsort(key[kept], kind="stable")]
        key, size, side = key[order], size[order], side[order]
        lists = table.column("shingles").combine_chunks().take(pa.array(order))
        lengths = lists.value_lengths().to_numpy()
        owner = np.repeat(np.arange(len(key)), lengths)
        both = bool(side.any())
        left, right = (np.flatnonzero(side == 0), np.flatnonzero(side == 1)) if both else (np.arange(len(key)),) * 2
        matrix = common(owner, lists.flatten().to_numpy(), len(key), left, right)
        found = rule.linked(matrix.astype(np.int64), size[left][:, None], size[right][None, :])
        links = np.zeros((len(key), len(key)), bool)
        links[np.ix_(left, right)] = found
        links |= links.T
        label = connected(links)
        moved = np.flatnonzero(label != np.arange(len(key)))
        return pa.table({"node": pa.array(key[moved], pa.int64()), "root": pa.array(key[label[moved]], pa.int64())})

    return run


def compared(rows: DataFrame, rule: Rule) -> DataFrame:
    """``node, root`` over all pairs of blocks; ``rows`` are sets with ``pair`` (a struct) and ``side`` (0, or 1 for the second block)."""
    return rows.groupBy("pair").applyInArrow(compare(rule), "node bigint, root bigint")


def blocks_of(total, count):
    """How many blocks so many shingles and sets take."""
    return F.greatest(F.ceil(total / BLOCK_SHINGLES), F.ceil(count / BLOCK_SETS)).cast("int")


def several_blocks(sets: DataFrame) -> DataFrame:
    """``of, parts``: the clusters that take more than one block."""
    sizes = sets.groupBy("cluster").agg(blocks_of(F.sum("n"), F.count("*")).alias("parts")).filter("parts > 1")
    return written(sets.sparkSession, sizes.withColumnRenamed("cluster", "of"), "large-clusters")


def hub_links(sets: DataFrame, large: DataFrame, rule: Rule) -> DataFrame:
    """Links of every block of a cluster with its first block. Clusters of one block are done with this."""
    dealt = sets.join(broadcast_if_small(large), F.col("cluster") == F.col("of"), "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int"))
    meets = F.when(F.col("part") == 0, F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array("part"))
    rows = dealt.withColumn("other", F.explode(meets))
    return compared(rows.select(F.struct("cluster", "other").alias("pair"), "key", "n", "shingles",
                                F.when((F.col("part") > 0), 1).otherwise(0).alias("side")), rule)


def open_links(sets: DataFrame, large: DataFrame, found: DataFrame, rule: Rule) -> DataFrame:
    """Links among the blocks of clusters of several blocks that still hold different components.

    Components that fill blocks of their own are not compared with themselves; the smaller ones of a cluster share blocks.
    """
    spark = sets.sparkSession
    own = sets.join(broadcast_if_small(large.select("of")), F.col("cluster") == F.col("of"), "left_semi")
    own = own.join(found, F.col("key") == F.col("node"), "left")
    own = own.withColumn("component", F.coalesce("root", "key"))
    counted = own.groupBy("cluster", "component").agg(F.sum("n").alias("total"), F.count("*").alias("sets"))
    counted = counted.withColumn("big", F.col("sets") * 2 > BLOCK_SETS)
    # Group -1 of a cluster holds all its smaller components; keys are hashes, so -1 is as good as any and checked by ``big``.
    grouped = counted.withColumn("grp", F.when(F.col("big"), F.col("component")).otherwise(-1))
    totals = grouped.groupBy("cluster", "grp", "big").agg(blocks_of(F.sum("total"), F.sum("sets")).alias("parts"), F.count("*").alias("several"))
    groups = grouped.select("cluster", "component", "grp", "big").join(totals, ["cluster", "grp", "big"])
    dealt = written(
        spark,
        own.join(groups, ["cluster", "component"]).select(
            "cluster", "key", "n", "shingles",
            F.struct("big", "grp", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int").alias("part")).alias("block")),
        "open-blocks",
    )
    each = dealt.select("cluster", "block").distinct()
    pairs = each.withColumnRenamed("block", "a").join(each.withColumnRenamed("block", "b"), "cluster").filter("a <= b")
    pairs = pairs.filter(~(F.col("a.big") & F.col("b.big") & (F.col("a.grp") == F.col("b.grp"))))
    pairs = written(spark, pairs.select(F.col("cluster").alias("of"), "a", "b"), "open-pairs")
    first = dealt.join(pairs, (F.col("cluster") == F.col("of")) & (F.col("block") == F.col("a"))).withColumn("side", F.lit(0))
    second = dealt.join(pairs.filter("a <> b"), (F.col("cluster") == F.col("of")) & (F.col("block") == F.col("b"))).withColumn("side", F.lit(1))
    rows = first.unionByName(second).select(F.struct("cluster", "a", "b").alias("pair"), "key", "n", "shingles", "side")
    return compared(rows, rule)


def placed(docs: DataFrame, rule: Rule) -> DataFrame:
    """``doc_id, n, key, component_id, lead`` of every document; ``lead`` is the set that stands for the component, one that the document
    with the smallest id has."""
    spark = prepared(docs.sparkSession)
    with scratch(spark):
        sets = written(spark, shingled(docs, rule), "sets")
        clash = sets.groupBy("key").agg(F.min("other").alias("a"), F.max("other").alias("b")).filter("a <> b")
        if not clash.isEmpty():
            raise ValueError("two different shingle sets have the same 64-bit key")
        signatures = signed(docs, rule)
        clusters = components(likely_candidates(signatures, sets, rule) if rule.likely else candidates(signatures))
        held = written(spark, members(docs, sets, clusters, rule), "shingles")
        large = several_blocks(held)
        found = components(hub_links(held, large, rule))
        links = written(spark, found.unionByName(open_links(held, large, found, rule)), "links")
        linked = components(links)
        # Sets with one document and no link need no look-up: their component is the document itself.
        firsts = sets.filter("n > 0").groupBy("key").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"))
        own = firsts.join(linked, F.col("key") == F.col("node"), "left").filter("copies > 1 OR node IS NOT NULL")
        own = own.select("key", "first", F.coalesce("root", "key").alias("component"))
        # Sets of which no document has an id come last.
        order = F.struct(F.col("first").isNull().alias("none"), "first", "key")
        least = own.groupBy("component").agg(F.min(order).alias("least"))
        of_key = own.join(least, "component").select(F.col("key").alias("of"), F.col("least.first").alias("component_id"), F.col("least.key").alias("lead"))
        rows = sets.select("doc_id", "n", F.when(F.col("n") > 0, F.col("key")).alias("key")).join(of_key, F.col("key") == F.col("of"), "left")
        found = rows.select("doc_id", "n", "key", F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("lead", "key").alias("lead"))
        return written(spark, found, "components", outlives=True)


def join(docs: DataFrame, rule: Rule | None = None) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document: its set's size, and the smallest id that links lead to."""
    return placed(docs, rule or Rule()).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def one_of_each(docs: DataFrame, rule: Rule | None = None) -> DataFrame:
    """The documents, with one of each component, that with the smallest id.

    Rows without an id and texts without words stay. Rows that repeat an id are told apart by their sets: of equal sets one row stays, and
    a different set under the same id is a document of its own.
    """
    rule = rule or Rule()
    found = placed(docs, rule)
    stays = F.col("n").eqNullSafe(0) | F.col("doc_id").isNull() | ((F.col("doc_id") == F.col("component_id")) & (F.col("key") == F.col("lead")))
    gone = found.filter(~stays).select(F.col("doc_id").alias("gone"), F.col("key").alias("gone_key")).distinct()
    if found.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").isEmpty():
        rows = docs.select(F.struct(*[column(docs, c).alias(c) for c in docs.columns]).alias("row"), column(docs, "doc_id").cast("bigint").alias("id"))
        kept = rows.join(broadcast_if_small(gone.select("gone")), F.col("id") == F.col("gone"), "left_anti")
        return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])

    def identity():
        shingler = Shingler(rule.words)

        def step(data, bounds):
            sets = list(shingler.sets(data, bounds))
            return [len(s) for s in sets], [keys(s)[0] for s in sets]

        return step

    rows = annotated(docs, "text", "n bigint, key bigint", identity).withColumn("id", F.col("row.doc_id").cast("bigint"))
    kept = rows.join(broadcast_if_small(gone), (F.col("id") == F.col("gone")) & (F.col("key") == F.col("gone_key")), "left_anti")
    own = (F.col("n") == 0) | F.col("id").isNull()
    single = kept.filter(~own).dropDuplicates(["id", "key"]).unionByName(kept.filter(own))
    return single.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
