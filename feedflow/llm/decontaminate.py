"""Benchmark decontamination: documents are scanned for the word windows of test items.

A window is ``size`` consecutive words of an item; a shorter item with any word is one window. A Spark job cuts and hashes the
items' windows; the distinct ones are counted, and arrive as arrays (a hash, a digest of the words and a number of an item: 24 bytes a
window) that are broadcast. Beyond ``SLICE_WINDOWS`` they come in slices by hash, each a pass over documents of its own, whose result is
written before the next one, so no task ever holds two slices. In a task, words and window hashes come from prefix sums over whole blocks of
text; a window whose hash is found is verified by the digest of its words.

Defined results: null text has no words; an item without words matches nothing; a null item id counts as the empty id;
repeated documents are rows of their own and repeated items count once by id; empty tables give no hits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedflow.llm.shared import Rolling, annotated, blocks, lower_ascii_table, prepared, words, written

SIZE = 13
# Windows that are broadcast at once (about 100 MB); more take more passes.
SLICE_WINDOWS = 4_000_000
LOWER = lower_ascii_table()


def word_bytes() -> np.ndarray:
    """Bytes of words, after lower-casing: digits, a-z and everything beyond ASCII."""
    inside = np.zeros(256, np.int8)
    inside[0x30:0x3A] = inside[0x61:0x7B] = inside[0x80:] = 1
    return inside


INSIDE = word_bytes()


class Scanner:
    """Words and windows of blocks of texts."""

    def __init__(self) -> None:
        self.of_bytes, self.of_words = Rolling(), Rolling()

    def split(self, data: np.ndarray, bounds: np.ndarray):
        """Lower-case bytes, starts and ends of words, words per row, and a prefix sum over word hashes."""
        low = LOWER[data]
        starts, ends, counts = words(low, bounds, INSIDE)
        hashes = self.of_bytes.ranges(self.of_bytes.prefix(low), starts, ends) if len(starts) else np.empty(0, np.uint64)
        return low, starts, ends, counts, self.of_words.prefix(hashes)

    def windows(self, sums: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of every window of ``size`` words that lies in one row."""
        firsts = np.cumsum(counts) - counts
        room = np.maximum(counts - size + 1, 0)
        first = np.repeat(firsts - (np.cumsum(room) - room), room) + np.arange(room.sum())
        return first, self.of_words.ranges(sums, first, first + size)


def signed(code: int) -> int:
    return code - (1 << 64) if code >> 63 else code


def digest(words_of: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(words_of, digest_size=8).digest(), "big", signed=True)


def item_windows(benchmark: DataFrame, size: int) -> DataFrame:
    """``length, code, digest, item_id`` of every distinct window. Items shorter than ``size`` have one window, their whole."""
    prepared(benchmark.sparkSession)
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.col("text")).filter("text IS NOT NULL")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for part, data, bounds in blocks(batches, "text"):
            low, starts, ends, counts, sums = scanner.split(data, bounds)
            text, owner, found = low.tobytes(), np.repeat(np.arange(len(counts)), counts), []
            for length in sorted({min(size, int(c)) for c in counts if c}):
                for first, code in zip(*(x.tolist() for x in scanner.windows(sums, counts, length)), strict=True):
                    if length == size or counts[owner[first]] == length:
                        found.append((length, signed(code), digest(joined(text, starts, ends, first, length)), owner[first]))
            lengths, codes, digests, owners = zip(*found, strict=True) if found else ((), (), (), ())
            names = part.column(0).take(pa.array(owners, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(lengths, pa.int32()), pa.array(codes, pa.int64()), pa.array(digests, pa.int64()), names],
                                             names=["length", "code", "digest", "item_id"])

    return rows.mapInArrow(run, "length int, code bigint, digest bigint, item_id string").distinct()


class Windows:
    """A slice of the items' windows: by length, a bit table over hashes, and sorted hashes with the digest of words and item of each."""

    def __init__(self, table: pa.Table) -> None:
        names = table.column("item_id").combine_chunks().dictionary_encode() if len(table) else pa.array([], pa.string()).dictionary_encode()
        if isinstance(names, pa.ChunkedArray):
            names = names.combine_chunks()
        self.names = names.dictionary.to_pylist()
        length, code, digests, item = (np.asarray(x) for x in (table.column("length"), table.column("code"), table.column("digest"), names.indices))
        self.bits = int(np.clip(len(table).bit_length() + 4, 12, 24))
        self.own: dict[int, tuple] = {}
        for n in np.unique(length).tolist():
            rows = np.flatnonzero(length == n)
            rows = rows[np.argsort(code[rows].astype(np.int64).view(np.uint64), kind="stable")]
            codes = code[rows].astype(np.int64).view(np.uint64)
            seen = np.zeros(1 << self.bits, bool)
            seen[codes >> np.uint64(64 - self.bits)] = True
            self.own[n] = seen, codes, digests[rows].astype(np.int64), item[rows].astype(np.int32)

    def hits(self, scanner: Scanner, text: bytes, starts, ends, counts, sums) -> Iterator[tuple[int, int, set[str]]]:
        """``(first word, words, items)`` of each verified occurrence in a block."""
        for length, (seen, codes, digests, item) in self.own.items():
            first, hashes = scanner.windows(sums, counts, length)
            maybe = np.flatnonzero(seen[hashes >> np.uint64(64 - self.bits)])
            low, high = (np.searchsorted(codes, hashes[maybe], side=side) for side in ("left", "right"))
            for at, a, b in zip(first[maybe].tolist(), low.tolist(), high.tolist(), strict=True):
                if a < b:
                    same = np.flatnonzero(digests[a:b] == digest(joined(text, starts, ends, at, length))) + a
                    if len(same):
                        yield at, length, {self.names[i] for i in item[same]}


def joined(text: bytes, starts, ends, first: int, length: int) -> bytes:
    return b" ".join([text[starts[i] : ends[i]] for i in range(first, first + length)])


def window_slices(benchmark: DataFrame, size: int, limit: int) -> Iterator[pa.Table]:
    """The items' windows in tables of about ``limit`` rows, at least one table."""
    windows = written(benchmark.sparkSession, item_windows(benchmark, size), "benchmark-windows")
    count = max(1, -(-windows.count() // limit))
    for number in range(count):
        yield windows.filter(F.pmod(F.xxhash64("code"), F.lit(count)) == number).toArrow()


# Word and byte positions are those in the document.
FIELDS = "n_words bigint, hits array<struct<first:int,words:int,start:int,end:int,items:array<string>>>"


def occurrences(
    docs: DataFrame, benchmark: DataFrame, size: int = SIZE, slice_windows: int = SLICE_WINDOWS, keep: list[str] | None = None
) -> DataFrame:
    """``row, n_words, hits``: every window of an item found in a document. ``row`` has the columns ``keep``, by default all."""
    spark = docs.sparkSession

    wanted = docs.columns if keep is None else keep

    def scan(df: DataFrame, items: pa.Table, keep: list[str]) -> DataFrame:
        shared = spark.sparkContext.broadcast(Windows(items))

        def compute():
            scanner, windows = Scanner(), shared.value

            def step(data, bounds):
                low, starts, ends, counts, sums = scanner.split(data, bounds)
                found: list[list] = [[] for _ in counts]
                firsts = np.cumsum(counts) - counts
                for at, length, item_ids in windows.hits(scanner, low.tobytes(), starts, ends, counts, sums):
                    row = int(np.searchsorted(bounds, starts[at], side="right")) - 1
                    found[row].append({
                        "first": at - int(firsts[row]), "words": length, "start": int(starts[at] - bounds[row]),
                        "end": int(ends[at + length - 1] - bounds[row]), "items": sorted(item_ids),
                    })
                return counts, found

            return step

        return annotated(df, "text", FIELDS, compute, keep)

    # All but the last pass keep every column and pack the hits so far beside them.
    scanned, pending = None, next(slices := window_slices(benchmark, size, slice_windows))
    while True:
        following = next(slices, None)
        if scanned is None:
            scanned = scan(docs, pending, wanted if following is None else docs.columns)
        else:
            earlier = written(spark, scanned, "decontaminate").select(F.struct("row", "hits").alias("held"), F.col("row.text").alias("text"))
            scanned = scan(earlier, pending, ["held"]).select(
                F.col("row.held.row").alias("row"), "n_words", F.concat("row.held.hits", "hits").alias("hits")
            )
        if following is None:
            return scanned
        pending = following


def judged(scanned: DataFrame) -> DataFrame:
    """Add the number of words inside any hit, the items hit and the verdict (a twentieth of the words or more)."""
    covered = F.array_distinct(F.flatten(F.transform("hits", lambda h: F.sequence(h["first"], h["first"] + h["words"] - 1))))
    items = F.array_sort(F.array_distinct(F.flatten(F.transform("hits", lambda h: h["items"]))))
    counted = scanned.select("row", "n_words", F.size(covered).cast("bigint").alias("n_hit"), items.alias("items"))
    return counted.select(
        "row", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), "items",
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` of every document."""
    found = judged(occurrences(docs, benchmark, keep=["doc_id"]))
    return found.select(F.col("row.doc_id").cast("bigint").alias("doc_id"), "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with their columns."""
    return judged(occurrences(docs, benchmark)).filter(~F.col("contaminated")).select("row.*")


def without_spans(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """All documents, with the bytes from the first to the last word of each hit cut out of their texts."""
    scanned = occurrences(docs, benchmark)
    raw = F.col("row.text").cast("binary")
    spans = F.array_sort(F.transform("hits", lambda h: F.struct(h["start"].alias("a"), h["end"].alias("b"))))
    # Keep what lies before each span, and what lies behind the furthest end in the end.
    kept = F.aggregate(
        spans, F.struct(F.lit(b"").alias("text"), F.lit(0).alias("at")),
        lambda acc, s: F.struct(
            F.when(s["a"] > acc["at"], F.concat(acc["text"], F.substring(raw, acc["at"] + 1, s["a"] - acc["at"])))
            .otherwise(acc["text"]).alias("text"),
            F.greatest(acc["at"], s["b"]).alias("at")),
        lambda acc: F.concat(acc["text"], F.substring(raw, acc["at"] + 1, F.length(raw))).cast("string"),
    )
    cleaned = F.when(F.size("hits") > 0, kept).otherwise(F.col("row.text"))
    return scanned.select(*[cleaned.alias("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])
