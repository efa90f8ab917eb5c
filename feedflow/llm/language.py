"""Language identification by prediction by partial matching.

Each language has a context tree over the last ``ORDER`` bytes, counted on a bounded sample of its texts and then frozen. A byte
costs ``-log2(count / (total + kinds))`` in the longest context that knows it; every longer known context in which it did not
occur adds the price of an escape, ``-log2(kinds / (total + kinds))``; a byte that no context knows costs 8 bits more. The text's
language is the one under which it has the shortest code.

The cost of a byte depends on it and the ``ORDER`` bytes before it alone, so the trees are compiled into tables of such
strings with the costs under all languages side by side, and a block of texts is scored by table look-ups. A string outside
the longest table is priced by its escape and the next shorter one, which is the same sum as walking the tree.

Defined results: ``und`` with score 0 if a text is null or has no letter, or if there is nothing to learn from; ties go to
the language first in order of names; repeated rows are rows of their own; rows without an id are not learned from and
not held out; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedflow.llm.shared import annotated, blocks, prepared

ORDER = 4
# Texts per language that the trees are counted on, about; what is sent to the driver and back is bounded by it.
SAMPLE_TEXTS = 500
FOLDS, HELD_OUT = 4, 2
PAD = 10  # A line break stands before each text.


def fold(folds: int):
    """The fold of a document: CRC-32 of its id as text."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds


def strings(data: np.ndarray, bounds: np.ndarray, order: int = ORDER) -> np.ndarray:
    """For each byte, it and the ``order`` bytes before it as one number, the byte lowest. Texts don't see their neighbours."""
    lengths = np.diff(bounds)
    padded = np.full(len(data) + order * len(lengths), PAD, np.uint64)
    places = np.arange(len(data)) + order * (np.repeat(np.arange(len(lengths)), lengths) + 1)
    padded[places] = data
    codes = padded[places]
    for back in range(1, order + 1):
        codes |= padded[places - back] << np.uint64(8 * back)
    return codes


class Table:
    """Numbers to row numbers: open addressing over arrays, for look-ups of whole arrays."""

    FREE = np.uint64(0xFFFFFFFFFFFFFFFF)

    def __init__(self, keys: np.ndarray) -> None:
        bits = max(4, int(len(keys) * 4).bit_length())
        self.shift, self.size = np.uint64(64 - bits), 1 << bits
        self.keys, self.rows = np.full(self.size, self.FREE, np.uint64), np.zeros(self.size, np.int32)
        left, slot = np.arange(len(keys)), self.slot(keys)
        while len(left):
            free = self.keys[slot] == self.FREE
            _, first = np.unique(np.where(free, slot, -1 - np.arange(len(slot))), return_index=True)
            put = first[free[first]]
            self.keys[slot[put]], self.rows[slot[put]] = keys[left[put]], left[put]
            stay = np.ones(len(left), bool)
            stay[put] = False
            left, slot = left[stay], (slot[stay] + 1) % self.size

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row numbers, -1 where a key is missing."""
        slot = self.slot(keys)
        held = self.keys[slot]
        rows = np.where(held == keys, self.rows[slot], -1)
        pending = np.flatnonzero((held != keys) & (held != self.FREE))
        slot = slot[pending]
        while len(pending):
            slot = (slot + 1) % self.size
            held, wanted = self.keys[slot], keys[pending]
            rows[pending] = np.where(held == wanted, self.rows[slot], -1)
            again = (held != wanted) & (held != self.FREE)
            pending, slot = pending[again], slot[again]
        return rows


@dataclass
class Trees:
    """Frozen statistics: for each order, costs of the strings any language knows, and escape prices of the contexts."""

    langs: list[str]
    costs: list[np.ndarray]
    tables: list[Table | None]
    escapes: list[np.ndarray]
    contexts: list[Table | None]

    def price(self, codes: np.ndarray) -> np.ndarray:
        """Bits for each string under each language."""
        top = len(self.costs) - 1
        out = np.empty((len(codes), len(self.langs)), np.float32)
        rows = self.tables[top].find(codes)
        missing = np.flatnonzero(rows < 0)
        np.take(self.costs[top], rows, axis=0, out=out, mode="clip")
        extra = np.zeros((len(missing), len(self.langs)), np.float32)
        for order in range(top, 0, -1):
            if not len(missing):
                break
            own = codes[missing] & np.uint64((1 << (8 * (order + 1))) - 1)
            context = self.contexts[order].find(own >> np.uint64(8))
            known = context >= 0
            extra[known] += self.escapes[order][context[known]]
            shorter = own & np.uint64((1 << (8 * order)) - 1)
            rows = shorter.astype(np.int64) if order == 1 else self.tables[order - 1].find(shorter)
            found = rows >= 0
            out[missing[found]] = extra[found] + self.costs[order - 1][rows[found]]
            missing, extra = missing[~found], extra[~found]
        return out


def compiled(langs: list[str], counts: list[tuple[np.ndarray, np.ndarray]]) -> Trees:
    """Trees from each language's strings of full length and their counts."""
    top = ORDER
    costs, tables, escapes, contexts = [], [], [None], [None]
    for order in range(top + 1):
        mask = np.uint64((1 << (8 * (order + 1))) - 1)
        own = []
        for codes, n in counts:
            kept, place = np.unique(codes & mask, return_inverse=True)
            own.append((kept, np.bincount(place, weights=n, minlength=len(kept))))
        keys = np.arange(256, dtype=np.uint64) if order == 0 else np.unique(np.concatenate([k for k, _ in own]))
        if order:
            shorter = keys & np.uint64((1 << (8 * order)) - 1)
            base = costs[-1][shorter.astype(np.int64) if order == 1 else tables[-1].find(shorter)]
        else:
            base = np.full((256, len(langs)), 8.0)
        every = np.unique(keys >> np.uint64(8))
        cost, escape = np.array(base, np.float64), np.zeros((len(every), len(langs)))
        for i, (kept, n) in enumerate(own):
            context, place = np.unique(kept >> np.uint64(8), return_inverse=True)
            total, kinds = np.bincount(place, weights=n), np.bincount(place)
            price = -np.log2(kinds / (total + kinds))
            escape[np.searchsorted(every, context), i] = price
            # A byte that this context has not seen escapes from it; one it has seen has its own cost.
            cost[:, i] += escape[np.searchsorted(every, keys >> np.uint64(8)), i]
            cost[np.searchsorted(keys, kept), i] = -np.log2(n / (total + kinds)[place])
        costs.append(cost.astype(np.float32))
        tables.append(Table(keys) if order else None)
        if order:
            escapes.append(escape.astype(np.float32))
            contexts.append(Table(every))
    return Trees(langs, costs, tables, escapes, contexts)


def learn(docs: DataFrame, sample_texts: int = SAMPLE_TEXTS) -> Trees | None:
    """Trees of every language among ``docs`` (``doc_id, text, lang``), each from about ``sample_texts`` whole texts picked by
    a hash of their ids. None if there is nothing to learn from."""
    labelled = docs.filter("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "lang", "text")
    sizes = {row[0]: row[1] for row in labelled.groupBy("lang").count().collect()}
    if not sizes:
        return None
    share = F.element_at(F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, sample_texts / n))]), F.col("lang"))
    picked = labelled.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share * (1 << 20))

    def count(batches):
        for rows, data, bounds in blocks(batches, "text"):
            codes = strings(data, bounds)
            owner = np.repeat(np.arange(len(rows)), np.diff(bounds))
            langs = np.array(rows.column(0).to_pylist(), object)
            for lang in sorted(set(langs)):
                kept, n = np.unique(codes[(langs == lang)[owner]], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(kept), pa.string()), pa.array(kept.astype(np.int64)), pa.array(n, pa.int64())], names=["lang", "code", "n"]
                )

    counted = picked.select("lang", "text").mapInArrow(count, "lang string, code bigint, n bigint")
    found = counted.groupBy("lang", "code").agg(F.sum("n").alias("n")).toArrow().to_pandas()
    langs = sorted(found["lang"].unique())
    if not langs:
        return None
    parts = [found[found["lang"] == lang] for lang in langs]
    return compiled(langs, [(x["code"].to_numpy().astype(np.uint64), x["n"].to_numpy(np.float64)) for x in parts])


def identify(docs: DataFrame, trees: Trees | None) -> DataFrame:
    """``row (doc_id), lang_pred, score`` of every document; the score is the language's posterior under equal priors."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(trees)
    lettered = docs.select("doc_id", F.when(F.col("text").rlike(r"\p{L}"), F.col("text")).alias("text"))

    def compute():
        trees = shared.value

        def step(data, bounds):
            lengths = np.diff(bounds)
            langs, scores = np.full(len(lengths), "und", object), np.zeros(len(lengths))
            full = np.flatnonzero(lengths)
            if trees is None or not len(full):
                return langs, scores
            bits = np.zeros((len(full), len(trees.langs)))
            # Parts of a block at a time, so that the costs stay in the processor's caches.
            ends = bounds[full + 1]
            codes, part = strings(data, bounds), 1 << 16
            for at in range(0, len(data), part):
                cost = trees.price(codes[at : at + part])
                row = int(np.searchsorted(ends, at, side="right"))
                last = int(np.searchsorted(ends, min(at + part, len(data)) - 1, side="right"))
                starts = np.maximum(bounds[full[row : last + 1]] - at, 0)
                bits[row : last + 1] += np.add.reduceat(cost, starts, axis=0, dtype=np.float64)
            best = bits.argmin(axis=1)
            gap = np.minimum(bits - bits[np.arange(len(full)), best][:, None], 1000)
            scores[full] = 1 / np.exp2(-gap).sum(axis=1)
            langs[full] = np.array(trees.langs, object)[best]
            return langs, scores

        return step

    return annotated(lettered, "text", "lang_pred string, score double", compute, ["doc_id"])


def report(docs: DataFrame) -> DataFrame:
    """Learn on the folds that are not held out and predict every document."""
    prepared(docs.sparkSession)
    trees = learn(docs.filter(fold(FOLDS) != HELD_OUT))
    found = identify(docs, trees).select(F.col("row.doc_id").cast("bigint").alias("doc_id"), "lang_pred", "score")
    return found.select("doc_id", F.coalesce(fold(FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), "lang_pred", "score")
