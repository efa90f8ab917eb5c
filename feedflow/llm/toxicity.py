"""Toxicity: a support vector machine over a subsequence string kernel, with Nyström landmarks.

The kernel compares words by the letter triples they share as subsequences, with up to two letters between; a triple counts
``DECAY`` per letter skipped. Inserted letters, dropped ones and changed endings therefore leave most of a word's similarity.
Words are what stands between white space, letters only, so ``id-iot`` is a word, and a run of single letters
(``i d i o t``) is one too. Long words are compared in overlapping windows.

Training takes labelled sentences: the words of a bounded sample of labelled texts, with the text's label. Words that stand
in clearly more surroundings of toxic texts than of clean ones are the toxic examples (surroundings, not occurrences, so that
copies of a text do not make its words toxic); words of clean texts are the others, and those that score highest after a first fit
are added for a second one. Words are mapped to their kernels with the landmarks, whitened; landmarks are the most common clean words, and
toxic words picked by pivoted Cholesky until they cover every toxic word, so their number follows from the words' variety; the fitted hyperplane is a sum
over landmarks, hence one weight per triple, and a whole text is scored by look-ups. A text's score is that of its worst
word, turned into a probability by a logistic curve fitted on the sample.

Defined results: null and empty texts score as a text without words; if a class has no labelled text, every score is 0;
repeated rows are rows of their own; rows without an id are not learned from and not held out; null labels are not used; labels of unknown documents are ignored; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedflow.llm.shared import Rolling, annotated, blocks, prepared, utf8_view, written

FOLDS, HELD_OUT = 5, 0
# Texts of each class that the machine is fitted on, about: the bound of the sample.
TOXIC_TEXTS, CLEAN_TEXTS = 2000, 6000
DECAY = 0.5
# Second and third letter of a triple, counted from its first; a triple's weight falls with the letters skipped.
TRIPLES = ((1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 4))
# Triples of a word are grouped by where they begin, in cells of so many letters; a window is three cells.
CELL = 4
# Words are normalised as if they had at least a four-letter word's triples, so one shared triple doesn't make a word.
LEAST_NORM = 2 + 2 * DECAY**2
# Clean landmarks; toxic ones are added until the part of any toxic word that they leave out is at most RESIDUAL of it.
CLEAN_LANDMARKS, RESIDUAL, NEGATIVES, HARD = 64, 0.1, 20_000, 4000
# Support for a toxic word: log-likelihood ratio of its surroundings, and how much more frequent it is than in clean texts. The
# ratio a word must reach grows with the number of words tested (2 ln n), so that chance alone makes about one of them toxic.
LEAST_G, LEAST_RATIO = 12.0, 6.0
KNOWN = 0x3000


def letter_codes() -> np.ndarray:
    """Code point to letter code: a-z 1 to 26 in either case, other letters 27 to 31, white space 32, all else 0."""
    codes = np.zeros(KNOWN + 1, np.uint8)
    for point in range(KNOWN):
        char = chr(point).lower()[0]
        if "a" <= char <= "z":
            codes[point] = ord(char) - 96
        elif char.isalpha():
            codes[point] = 27 + ord(char) % 5
        elif char.isspace():
            codes[point] = 32
    codes[KNOWN] = 27
    return codes


CODES = letter_codes()


@dataclass
class Words:
    """Words of a block: their letters in one array, where each begins, and its row."""

    letters: np.ndarray
    starts: np.ndarray
    rows: np.ndarray

    def __len__(self) -> int:
        return len(self.starts)


def words_of(data: np.ndarray, bounds: np.ndarray) -> Words:
    """Split a block of UTF-8 texts into words."""
    points = np.frombuffer(data.tobytes().decode("utf-8", errors="replace").encode("utf-32-le"), np.uint32)
    codes = CODES[np.minimum(points, KNOWN)]
    if len(points) == len(data):
        row_starts = bounds[:-1]
    else:
        whole = np.zeros(len(data) + 1, np.int64)
        np.cumsum((data & 0xC0) != 0x80, out=whole[1:])
        row_starts = whole[bounds[:-1]]
    gap = np.zeros(len(codes) + 1, np.int32)
    gap[1:] = codes == 32
    gap[row_starts] = 1
    place = np.flatnonzero((codes != 0) & (codes != 32))
    if not len(place):
        return Words(np.empty(0, np.uint8), np.empty(0, np.int64), np.empty(0, np.int64))
    # The gaps up to a letter number its word; a gap at a row's start counts for the first letter of the row itself.
    number = np.cumsum(gap[:-1])[place]
    starts = np.concatenate([[0], np.flatnonzero(np.diff(number)) + 1])
    rows = np.searchsorted(row_starts, place[starts], side="right") - 1
    single = np.diff(starts, append=len(place)) == 1
    joins = np.zeros(len(starts), bool)
    joins[1:] = single[1:] & single[:-1] & (rows[1:] == rows[:-1])
    return Words(codes[place], starts[~joins], rows[~joins])


def triples(words: Words):
    """``(first letter's position, code, weight)`` of the triples of all words, one offset pair after the other."""
    letters = words.letters.astype(np.int32)
    ends = np.repeat(np.append(words.starts[1:], len(letters)), np.diff(words.starts, append=len(letters)))
    room = ends - np.arange(len(letters))
    for second, third in TRIPLES:
        at = np.flatnonzero(room > third)
        yield at, (letters[at] << 10) | (letters[at + second] << 5) | letters[at + third], DECAY ** (third - 2)


def windows(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cells of all words, and the windows over them: cell starts, first cell of each window, cells in it, and its word."""
    lengths = np.diff(words.starts, append=len(words.letters))
    cells = -(-lengths // CELL)
    first = np.cumsum(cells) - cells
    word = np.repeat(np.arange(len(words)), cells)
    index = np.arange(len(word)) - first[word]
    cell_starts = words.starts[word] + CELL * index
    leads = (index == 0) | (index + 3 <= cells[word])
    lead = np.flatnonzero(leads)
    return cell_starts, lead, np.minimum(3, cells[word[lead]] - index[lead]), word[lead]


def over_windows(values: np.ndarray, cell_starts: np.ndarray, lead: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Sums of a value per letter position over each window."""
    cells = np.append(np.add.reduceat(values, cell_starts, axis=0), np.zeros((2, *values.shape[1:]), values.dtype), axis=0)
    total = cells[lead]
    for more in (1, 2):
        has = size > more
        total[has] += cells[lead[has] + more]
    return total


def kernel(words: Words, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each window: its normalised kernels with what ``table`` (a row or weight per triple code) stands for; its word."""
    wide = table.ndim > 1
    sums = np.zeros((len(words.letters), *table.shape[1:]), np.float32)
    norm = np.zeros(len(words.letters), np.float32)
    for at, code, weight in triples(words):
        sums[at] += weight * table[code]
        norm[at] += weight * weight
    cell_starts, lead, size, word = windows(words)
    scale = np.sqrt(np.maximum(over_windows(norm, cell_starts, lead, size), LEAST_NORM))
    total = over_windows(sums, cell_starts, lead, size)
    return total / (scale[:, None] if wide else scale), word


def as_words(texts: list[str]) -> Words:
    """Words given as strings of letter codes (``a`` is 1)."""
    lengths = np.array([len(t) for t in texts], np.int64)
    letters = np.frombuffer("".join(texts).encode("latin-1"), np.uint8) - 96
    return Words(letters, np.cumsum(lengths) - lengths, np.arange(len(texts)))


def spelled(words: Words) -> list[str]:
    text = (words.letters + 96).tobytes().decode("latin-1")
    ends = np.append(words.starts[1:], len(text))
    return [text[a:b] for a, b in zip(words.starts.tolist(), ends.tolist(), strict=True)]


@dataclass
class Machine:
    """A weight per triple code, the bias, and the logistic curve from a text's worst word to a probability."""

    weights: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def margins(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The highest decision value of any word of each text; the bias if it has none."""
        out = np.full(len(bounds) - 1, self.bias)
        words = words_of(data, bounds)
        if len(words):
            value, word = kernel(words, self.weights)
            rows = words.rows[word]
            firsts = np.concatenate([[0], np.flatnonzero(np.diff(rows)) + 1])
            out[rows[firsts]] = np.maximum(out[rows[firsts]], np.maximum.reduceat(value, firsts) + self.bias)
        return out

    def scores(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(data, bounds) + self.shift, -500, 500)))


def landmark_table(landmarks: list[str]) -> np.ndarray:
    """Feature vectors of the landmarks, normalised: a row of all landmarks for each triple code."""
    words = as_words(landmarks)
    owner = np.repeat(np.arange(len(landmarks)), np.diff(words.starts, append=len(words.letters)))
    table, norm = np.zeros((1 << 15, len(landmarks)), np.float32), np.zeros(len(landmarks))
    for at, code, weight in triples(words):
        np.add.at(table, (code, owner[at]), weight)
        np.add.at(norm, owner[at], weight * weight)
    return table / np.sqrt(np.maximum(norm, LEAST_NORM)).astype(np.float32)


def pivots(texts: list[str], known: list[str], residual: float = RESIDUAL) -> list[str]:
    """Words of ``texts`` to add to the landmarks ``known``, by pivoted Cholesky: the one that is covered least, until each is covered
    but for ``residual`` of its squared length."""
    every = [*known, *texts]
    words = as_words(every)
    owner = np.repeat(np.arange(len(every)), np.diff(words.starts, append=len(words.letters)))
    found = [(owner[at], code, np.full(len(at), weight)) for at, code, weight in triples(words)]
    rows, codes, values = (np.concatenate(x) for x in zip(*found, strict=True))
    # A triple that a word holds more than once has one entry, as lengths are of sums.
    both, where = np.unique(rows.astype(np.int64) << 15 | codes, return_inverse=True)
    values, rows, codes = np.bincount(where, values, len(both)), both >> 15, both & 0x7FFF
    full = np.bincount(rows, values**2, len(every))
    values = values / np.sqrt(np.maximum(full, 1e-12))[rows]
    bounds = np.searchsorted(rows, np.arange(len(every) + 1))
    left, columns, chosen = (full > 0).astype(float), [], []
    while len(columns) < len(every):
        at = len(columns) if len(columns) < len(known) else len(known) + int(np.argmax(left[len(known) :]))
        if at >= len(known) and left[at] <= residual:
            break
        vector = np.zeros(1 << 15)
        vector[codes[bounds[at] : bounds[at + 1]]] = values[bounds[at] : bounds[at + 1]]
        column = np.bincount(rows, values * vector[codes], len(every))
        for before in columns:
            column -= before[at] * before
        column = column / np.sqrt(left[at]) if left[at] > 1e-6 else np.zeros(len(every))
        columns.append(column)
        left = np.maximum(left - column**2, 0)
        if at >= len(known):
            left[at] = 0
            chosen.append(every[at])
    return chosen


def hyperplane(x: np.ndarray, y: np.ndarray, cost: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Squared-hinge support vector machine by Newton steps on the active examples; classes weigh the same."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())) * len(y) * cost
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    theta, active = np.zeros(x.shape[1]), np.ones(len(y), bool)
    for _ in range(rounds):
        gram, pull = ridge.copy(), np.zeros(x.shape[1])
        for at in np.array_split(np.flatnonzero(active), active.sum() // 2000 + 1):
            own = x[at].astype(np.float64)
            weighted = own * share[at][:, None]
            gram += weighted.T @ own
            pull += weighted.T @ y[at]
        theta = np.linalg.solve(gram, pull)
        now = y * (x @ theta) < 1
        if (now == active).all():
            break
        active = now
    return theta


def kernels(texts: list[str], table: np.ndarray, whiten: np.ndarray, part: int = 250) -> np.ndarray:
    """Whitened kernels of words with all landmarks, some words at a time: every letter takes a number for each landmark."""
    parts = [(kernel(as_words(texts[at : at + part]), table)[0] @ whiten).astype(np.float32) for at in range(0, len(texts), part)]
    return np.vstack(parts)


def fitted(toxic: list[str], clean: list[str]) -> Machine:
    """Fit on words of both classes; landmarks are common clean words, and what it takes to cover all toxic ones."""
    common = clean[:CLEAN_LANDMARKS]
    landmarks = sorted({*common, *pivots(toxic, common)})
    table = landmark_table(landmarks)
    gram, _ = kernel(as_words(landmarks), table)
    gram = gram[: len(landmarks)] if len(gram) == len(landmarks) else table.T @ table
    values, vectors = np.linalg.eigh((gram + gram.T) / 2 + 1e-6 * np.eye(len(landmarks)))
    whiten = vectors / np.sqrt(np.maximum(values, 1e-3))
    positive, negative = kernels(toxic, table, whiten), kernels(clean, table, whiten)
    x = np.vstack([positive, negative])
    theta = hyperplane(x, np.repeat([1.0, -1.0], [len(positive), len(negative)]))
    return Machine((table @ (whiten @ theta[:-1])).astype(np.float32), float(theta[-1]))


def calibrated(margin: np.ndarray, label: np.ndarray, clean_share: float = 1.0, toxic_share: float = 1.0) -> tuple[float, float]:
    """Slope and shift: probability one half lies at the cut with the fewest errors, in the middle of its gap; the slope has
    the smallest log loss of a geometric series. A text of the sample stands for as many of the corpus as its class's share
    says, so the cut is for the corpus's own mix of classes at every size."""
    order = np.argsort(margin, kind="stable")
    stands_for = np.where(label > 0, 1 / toxic_share, 1 / clean_share)
    m, y, w = margin[order], label[order], stands_for[order]
    # Errors of a cut below each value: toxic texts under it and clean ones from it on.
    errors = np.concatenate([[0], np.cumsum(y * w)]) + np.concatenate([np.cumsum(((1 - y) * w)[::-1])[::-1], [0]])
    allowed = np.concatenate([[True], np.diff(m) > 0, [True]])
    best = int(np.argmin(np.where(allowed, errors, np.inf)))
    cut = (m[max(0, best - 1)] + m[min(best, len(m) - 1)]) / 2
    slopes = np.geomspace(1, 256, 33)
    sign = 2 * label - 1
    losses = [np.average(np.logaddexp(0, -slope * sign * (margin - cut)), weights=stands_for) for slope in slopes]
    slope = float(slopes[int(np.argmin(losses))])
    return slope, -slope * float(cut)


def fold(folds: int):
    """The fold of a document: CRC-32 of its id as text."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds


def vocabulary(sample: DataFrame) -> DataFrame:
    """``word, toxic, clean``: in how many different surroundings (words before it) each word stands in texts of either class."""

    def run(batches):
        rolling = Rolling()
        for rows, data, bounds in blocks(batches, "text"):
            words = words_of(data, bounds)
            if not len(words):
                continue
            ends = np.append(words.starts[1:], len(words.letters))
            code = rolling.ranges(rolling.prefix(words.letters), words.starts, ends)
            before = np.concatenate([np.zeros(1, np.uint64), code[:-1]])
            before[np.concatenate([[True], np.diff(words.rows) != 0])] = 0
            label = np.array(rows.column(0).to_pylist())[words.rows]
            kept = np.unique(np.stack([code, before, label.astype(np.uint64)], 1), axis=0, return_index=True)[1]
            kept = kept[(ends - words.starts)[kept] >= 3]
            spelling = spelled(words)
            yield pa.RecordBatch.from_arrays(
                [pa.array([spelling[i] for i in kept]), pa.array(before[kept].astype(np.int64)), pa.array(label[kept].astype(np.int32))],
                names=["word", "before", "label"],
            )

    found = sample.select("label", "text").mapInArrow(run, "word string, before bigint, label int").distinct()
    return found.groupBy("word").agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean"))


def support(words: DataFrame, toxic: int, clean: int) -> DataFrame:
    """Words far more frequent in toxic texts; ``g`` is the log-likelihood ratio against equal frequency."""
    share = toxic / (toxic + clean)
    least = max(LEAST_G, 2 * math.log(max(1, words.count())))
    seen = F.col("toxic") + F.col("clean")
    term = lambda n, p: F.when(n > 0, n * F.log(n / (seen * p))).otherwise(0.0)
    g = 2 * (term(F.col("toxic"), share) + term(F.col("clean"), 1 - share))
    ratio = (F.col("toxic") / toxic) / ((F.col("clean") + 0.5) / clean)
    return words.withColumn("g", g).filter((F.col("g") >= least) & (ratio >= LEAST_RATIO))


def sampled(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, tuple[float, float]]:
    """``doc_id, text, label`` of about ``TOXIC_TEXTS`` and ``CLEAN_TEXTS`` documents that may be learned from, and which shares
    of the clean and of the toxic documents they are.

    The ids are picked from the labels by their hashes, so what is broadcast to find the texts has those bounds too. A
    document with both labels counts as toxic.
    """
    usable = labels.filter("toxic IN (0, 1)").filter(fold(FOLDS) != HELD_OUT)
    of_each = usable.groupBy(F.col("doc_id").alias("of")).agg(F.max("toxic").cast("int").alias("label"))
    sizes = {row[0]: row[1] for row in of_each.groupBy("label").count().collect()}
    shares = min(1.0, CLEAN_TEXTS / sizes.get(0, 1)), min(1.0, TOXIC_TEXTS / sizes.get(1, 1))
    share = F.when(F.col("label") == 1, shares[1]).otherwise(shares[0])
    ids = of_each.filter(F.pmod(F.xxhash64("of"), F.lit(1 << 20)) < share * (1 << 20))
    texts = docs.filter("text IS NOT NULL").select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("of"))
    return written(docs.sparkSession, texts.select("doc_id", "text", "label"), "toxicity-sample"), shares


def learn(sample: DataFrame, shares: tuple[float, float] = (1.0, 1.0)) -> Machine | None:
    """Fit on the rows ``doc_id, text, label``, which are these shares of the clean and the toxic texts; None if a class is missing."""
    spark = sample.sparkSession
    picked = {row[0]: row[1] for row in sample.groupBy("label").count().collect()}
    if not picked.get(0) or not picked.get(1):
        return None
    words = written(spark, vocabulary(sample), "toxicity-words")
    order = (F.desc("g"), "word")
    toxic = [row[0] for row in support(words, picked[1], picked[0]).orderBy(*order).limit(NEGATIVES).select("word").collect()]
    clean = words.filter("clean > 0")
    common = [row[0] for row in clean.orderBy(F.desc("clean"), "word").limit(NEGATIVES // 2).select("word").collect()]
    others = [row[0] for row in clean.orderBy(F.xxhash64("word"), "word").limit(NEGATIVES // 2).select("word").collect()]
    if not toxic or not common:
        return None
    known = set(toxic)
    negative = [w for w in dict.fromkeys([*common, *others]) if w not in known]
    machine = fitted(toxic, negative)
    hard = hardest(clean, machine).collect()
    machine = fitted(toxic, list(dict.fromkeys([*negative, *(r[0] for r in hard if r[0] not in known)])))
    margins = applied(sample, machine, ["label"], "margins").select("row.label", "value").toArrow().to_pandas()
    machine.slope, machine.shift = calibrated(margins["value"].to_numpy(), margins["label"].to_numpy(np.float64), *shares)
    return machine


def hardest(words: DataFrame, machine: Machine) -> DataFrame:
    """The words of clean texts that come closest to being toxic."""
    shared = words.sparkSession.sparkContext.broadcast(machine)

    def run(batches):
        for batch in batches:
            data, bounds = utf8_view(batch.column(0))
            lengths = np.diff(bounds)
            value, word = kernel(Words(data - np.uint8(96), bounds[:-1], np.arange(len(lengths))), shared.value.weights) if len(lengths) else ([], [])
            best = np.full(len(lengths), -np.inf)
            np.maximum.at(best, word, value)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(best)], names=["word", "value"])

    return words.select("word").mapInArrow(run, "word string, value double").orderBy(F.desc("value"), "word").limit(HARD).select("word")


def applied(docs: DataFrame, machine: Machine | None, keep: list[str], what: str = "scores") -> DataFrame:
    """``row`` (the columns ``keep``) and ``value`` (scores or margins) of every text."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def compute():
        machine = shared.value
        return lambda data, bounds: [np.zeros(len(bounds) - 1) if machine is None else getattr(machine, what)(data, bounds)]

    return annotated(docs, "text", "value double", compute, keep)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn on the folds that are not held out and score every document: ``doc_id, held_out, score, predicted``."""
    prepared(docs.sparkSession)
    machine = learn(*sampled(docs, labels))
    found = applied(docs, machine, ["doc_id"]).select(F.col("row.doc_id").cast("bigint").alias("doc_id"), F.col("value").alias("score"))
    return found.select("doc_id", F.coalesce(fold(FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted toxic, with all their columns."""
    machine = learn(*sampled(docs, labels))
    return applied(docs, machine, docs.columns).filter("value < 0.5").select("row.*")
