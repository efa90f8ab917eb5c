"""BPE encoding and decoding by content-defined chunk reuse.

A rolling hash over the bytes cuts texts into chunks at places that depend on the content only, so passages that documents
share fall into equal chunks. Each task encodes a chunk once and keeps its ids in a bounded cache. Ids near a cut may depend
on the text beyond it; they are dropped on both sides and the text between the nearest places that no token can cross is
encoded again. How much to drop is found by encoding the ends on their own and moving inwards until they agree exactly with
the chunk's own ids.

Defined results: null and empty texts have no ids and decode to empty text; repeated rows are rows of their own; an empty
table gives an empty result; extra columns are ignored. Special strings of the vocabulary inside a text become their id.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from feedflow.llm.shared import Rolling, blocks, prepared

# Fixed value: how byte-level BPE splits text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# A single space between two letters, digits or underscores always starts a token: no token holds a space behind a letter.
SAFE = re.compile(r"(?<=\w) (?=\w)")


def last_safe(text: str, end: int, step: int = 128) -> int:
    """The last safe place before ``end``, or -1."""
    at = end
    while at > 0:
        at = max(0, at - step)
        found = [m.start() for m in SAFE.finditer(text, max(0, at - 1), min(len(text), at + step + 2)) if m.start() < end]
        if found:
            return found[-1]
    return -1


def printable_bytes() -> dict[str, int]:
    """Characters that stand for the 256 bytes in byte-level vocabulary files: printable ones themselves, others from 256 up."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass(frozen=True)
class Vocabulary:
    """Token bytes by id, and the special strings."""

    tokens: dict[int, bytes]
    special: dict[str, int]

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        """Read a byte-level BPE file whose merges are in the order of their ids."""
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        if spec.get("normalizer") or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError(f"{path}: only plain byte-level BPE files are supported")
        special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        vocab = spec["model"]["vocab"]
        ids = [vocab["".join(pair if isinstance(pair, list) else pair.split(" "))] for pair in spec["model"]["merges"]]
        if any(a >= b for a, b in zip(ids, ids[1:], strict=False)):
            raise ValueError(f"{path}: merges are not in the order of their ids")
        byte_of = printable_bytes()
        return cls({i: bytes(byte_of[c] for c in token) for token, i in vocab.items() if token not in special}, special)


@dataclass
class Chunk:
    """Ids of a chunk's inner part, and the texts at both ends whose ids depend on the neighbours."""

    head: str
    ids: np.ndarray
    tail: str


class Codec:
    """Encodes and decodes whole texts. ``chunk_bytes`` is the mean chunk length, ``cache_bytes`` bounds what is kept."""

    WINDOW = 48

    def __init__(self, vocabulary: Vocabulary, chunk_bytes: int = 2048, cache_bytes: int = 48 << 20) -> None:
        import tiktoken

        self.encoding = tiktoken.Encoding(
            "texts", pat_str=PATTERN, mergeable_ranks={b: i for i, b in vocabulary.tokens.items()}, special_tokens={}
        )
        self.special = vocabulary.special
        self.split = re.compile("(" + "|".join(map(re.escape, vocabulary.special)) + ")") if vocabulary.special else None
        bytes_of = vocabulary.tokens | {i: s.encode() for s, i in vocabulary.special.items()}
        self.bytes_of = [bytes_of.get(i, b"") for i in range(max(bytes_of) + 1)]
        self.shift = np.uint64(65 - chunk_bytes.bit_length())
        self.rolling = Rolling()
        self.cache: dict[bytes, Chunk | None] = {}
        self.cache_bytes, self.cached, self.reused, self.encoded = cache_bytes, 0, 0, 0

    def plain(self, text: str) -> np.ndarray:
        return np.array(self.encoding.encode_ordinary(text), dtype="<u4")

    def cuts(self, data: np.ndarray) -> np.ndarray:
        """Positions in a block of bytes where the window before them hashes to zero in its high bits; never inside a character."""
        if len(data) <= self.WINDOW:
            return np.empty(0, np.int64)
        sums = self.rolling.prefix(data)
        windows = (sums[self.WINDOW : -1] - sums[: -self.WINDOW - 1]) * self.rolling.inverses[: len(data) - self.WINDOW]
        found = np.flatnonzero(windows >> self.shift == 0) + self.WINDOW
        return found[(data[found] & 0xC0) != 0x80]

    def chunk(self, raw: bytes) -> Chunk | None:
        """The chunk's reusable part; None if it has none (no safe place in it)."""
        if raw in self.cache:
            self.reused += 1
            return self.cache[raw]
        self.encoded += 1
        text = raw.decode()
        made = self.settle(text)
        cost = 2 * len(raw) + 200 + (made.ids.nbytes if made else 0)
        if self.cached + cost > self.cache_bytes:
            self.cache.clear()
            self.cached = 0
        self.cache[raw] = made
        self.cached += cost
        return made

    def settle(self, text: str) -> Chunk | None:
        """Encode a chunk and find the part of its ids that no neighbour can change."""
        first, last = SAFE.search(text), last_safe(text, len(text))
        ids = self.plain(text) if first else None
        while first and last >= first.start():
            head, tail = self.plain(text[: first.start()]), self.plain(text[last:])
            opens, closes = np.array_equal(ids[: len(head)], head), np.array_equal(ids[len(ids) - len(tail) :], tail)
            if opens and closes:
                return Chunk(text[: first.start()], ids[len(head) : len(ids) - len(tail)], text[last:])
            if not opens:
                first = SAFE.search(text, first.end())
            if not closes:
                last = last_safe(text, last)
        return None

    def encode_piece(self, raw: bytes, cuts: np.ndarray) -> list[np.ndarray]:
        """Ids of text without special strings, cut at ``cuts``."""
        out, carry, at = [], "", 0
        for end in [*cuts.tolist(), len(raw)]:
            part = raw[at:end]
            at = end
            chunk = self.chunk(part)
            if chunk is None:
                carry += part.decode()
                continue
            if carry or chunk.head:
                out.append(self.plain(carry + chunk.head))
            out.append(chunk.ids)
            carry = chunk.tail
        if carry:
            out.append(self.plain(carry))
        return out

    def encode(self, raw: bytes, cuts: np.ndarray) -> np.ndarray:
        """Ids of one text; ``cuts`` are positions in it."""
        if self.split is None or not any(s.encode() in raw for s in self.special):
            parts = self.encode_piece(raw, cuts) if raw else []
        else:
            parts = []
            for piece in self.split.split(raw.decode()):
                if piece in self.special:
                    parts.append(np.array([self.special[piece]], dtype="<u4"))
                elif piece:
                    own = np.frombuffer(piece.encode(), np.uint8)
                    parts += self.encode_piece(own.tobytes(), self.cuts(own))
        return np.concatenate(parts).astype("<u4", copy=False) if parts else np.empty(0, "<u4")

    def decode(self, ids: np.ndarray) -> str:
        table = self.bytes_of
        return b"".join([table[i] for i in ids.tolist()]).decode("utf-8", errors="replace")

    def encode_block(self, data: np.ndarray, bounds: np.ndarray) -> Iterator[np.ndarray]:
        """Ids of each text of a block."""
        found = self.cuts(data)
        # The window must lie within the text, else equal passages would be cut by what stands before them.
        owner = np.searchsorted(bounds, found, side="right") - 1
        found = found[found - bounds[owner] >= self.WINDOW]
        ranges = np.searchsorted(found, bounds)
        raw = data.tobytes()
        for row in range(len(bounds) - 1):
            first, last = bounds[row], bounds[row + 1]
            cuts = found[ranges[row] : ranges[row + 1]] - first
            yield self.encode(raw[first:last], cuts[(cuts > 0) & (cuts < last - first)])


def codecs(df: DataFrame, path: str):
    """A function that gives each task its codec; the vocabulary is broadcast, its size is that of one vocabulary file."""
    shared = df.sparkSession.sparkContext.broadcast(Vocabulary.load(path))
    return lambda: Codec(shared.value)


def encode(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_tokens, ids`` (little-endian unsigned 32-bit integers in one binary value) of every text."""
    prepared(df.sparkSession)
    codec_of = codecs(df, path)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of()
        for rows, data, bounds in blocks(batches, "text"):
            found = list(codec.encode_block(data, bounds))
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array([len(x) for x in found], pa.int64()), pa.array([x.tobytes() for x in found], pa.binary())],
                names=["doc_id", "n_tokens", "ids"],
            )

    return df.select(df[key].cast("bigint").alias("doc_id"), df[text].alias("text")).mapInArrow(
        run, "doc_id bigint, n_tokens bigint, ids binary"
    )


def decode(df: DataFrame, path: str) -> DataFrame:
    """``doc_id, text`` from the output of ``encode``; bytes that are no UTF-8 become replacement characters."""
    prepared(df.sparkSession)
    codec_of = codecs(df, path)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of()
        for batch in batches:
            texts = [codec.decode(np.frombuffer(x or b"", "<u4")) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return df.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, text string")


def digests(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode and decode in one pass: ``doc_id, n_tokens, ids_sha256, decoded_sha256``."""
    prepared(df.sparkSession)
    codec_of = codecs(df, path)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of()
        for rows, data, bounds in blocks(batches, "text"):
            counts, of_ids, of_text = [], [], []
            for ids in codec.encode_block(data, bounds):
                counts.append(len(ids))
                of_ids.append(hashlib.sha256(ids.tobytes()).hexdigest())
                of_text.append(hashlib.sha256(codec.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return df.select(df[key].cast("bigint").alias("doc_id"), df[text].alias("text")).mapInArrow(
        run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
