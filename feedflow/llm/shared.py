"""Helpers of the training-data operators: written intermediate tables, text blocks out of Arrow batches, hashes.

Intermediate results that several later steps read are written as Parquet tables below ``spark.checkpoint.dir``, so a lost
executor costs only its own tasks, and lineage ends there. Python code sees rows as Arrow batches of bounded size.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from feedflow.settings import shared_dir

# Rows of one Arrow batch; texts are mostly a few kilobytes.
ARROW_ROWS = 512
ARROW_BYTES = 16 << 20
# Bytes of text that a vectorised step works on at once.
BLOCK_BYTES = 1 << 20


# Where this package lies; workers started on the same machine or with the same image import it from there.
ROOT = str(Path(__file__).resolve().parents[2])


def prepared(spark: SparkSession) -> SparkSession:
    """Bound the Arrow batches that Python workers receive, and let workers import this package from where the driver has it.

    On a cluster whose executors don't have that path, ship the package with ``--py-files``.
    """
    environment = spark.sparkContext.environment
    paths = [path for path in environment.get("PYTHONPATH", "").split(os.pathsep) if path]
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    # What a written table was shuffled from goes when the table stands, not when the driver next collects its garbage.
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return spark


# Paths of the tables that the open scopes have written, the innermost last.
SCOPES: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())


def removed(spark: SparkSession, path: str) -> None:
    """Delete a table of the shared folder, wherever it is."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that ``written`` makes inside are removed at the end, but for those that outlive it.

    What leaves the scope must therefore be a written table that outlives it, not a plan over tables of the scope.
    """
    paths: list[str] = []
    token = SCOPES.set((*SCOPES.get(), paths))
    try:
        yield
    finally:
        SCOPES.reset(token)
        for path in paths:
            removed(spark, path)


def written(spark: SparkSession, df: DataFrame, name: str, outlives: bool = False) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, read any number of times.

    It goes with the scope (``scratch``) around it; with ``outlives``, with the scope around that one. Outside of scopes it stays.
    """
    path = shared_dir(spark, name)
    scopes = SCOPES.get()[: -1 if outlives else None]
    if scopes:
        scopes[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def column(df: DataFrame, name: str):
    """The column of exactly this name (also where the name holds dots)."""
    return df[f"`{name}`"]


def utf8_view(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of an Arrow string or binary column, without copying; nulls are empty rows."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if array.null_count:
        array = array.fill_null("" if pa.types.is_string(array.type) else b"")
    kind = np.int64 if pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type) else np.int32
    _, offsets, data = array.buffers()
    if not len(array):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(offsets, kind)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(bounds: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes each; a longer row is a range of its own."""
    first, rows = 0, len(bounds) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + limit, side="right")) - 1)
        yield first, min(last, rows)
        first = min(last, rows)


def annotated(df: DataFrame, text: str, fields: str, compute: Callable, keep: list[str] | None = None) -> DataFrame:
    """``row`` (a struct of the columns ``keep`` of ``df``, by default all) and new ``fields``, so that names cannot clash.

    ``compute()`` is called once a task and gives a function from a block (bytes, row offsets) of column ``text`` to
    one sequence per new field.
    """
    prepared(df.sparkSession)
    keep = df.columns if keep is None else keep
    packed = df.select(F.struct(*[column(df, name).alias(name) for name in keep]).alias("row"),
                       *([] if text in keep else [column(df, text).alias("text")]))
    schema = StructType([packed.schema.fields[0], *StructType.fromDDL(fields).fields])
    kinds = list(to_arrow_schema(schema))[1:]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = compute()
        for batch in batches:
            data, bounds = utf8_view(batch.column(0).field(text) if text in keep else batch.column(1))
            for first, last in slices(bounds):
                part = bounds[first : last + 1]
                made = step(data[part[0] : part[-1]], part - part[0])
                arrays = [pa.array(x, kind.type) for x, kind in zip(made, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), *arrays], names=schema.names)

    return packed.mapInArrow(run, schema)


def blocks(batches: Iterable[pa.RecordBatch], name: str, limit: int = BLOCK_BYTES):
    """``(rows, bytes, offsets)`` for parts of the batches of at most about ``limit`` bytes of column ``name``."""
    for batch in batches:
        data, bounds = utf8_view(batch.column(batch.schema.get_field_index(name)))
        for first, last in slices(bounds, limit):
            part = bounds[first : last + 1]
            yield batch.slice(first, last - first), data[part[0] : part[-1]], part - part[0]


def mix(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: equal inputs give equal outputs, close inputs give unrelated ones."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


class Rolling:
    """Hashes of byte ranges from one prefix sum: ``sum(b[i] * base**i)``, shifted back to position 0, modulo 2**64."""

    BASE = 0x9E3779B97F4A7C15
    INVERSE = pow(BASE, -1, 1 << 64)

    def __init__(self) -> None:
        self.powers = self.inverses = np.ones(1, np.uint64)

    def reach(self, length: int) -> None:
        if len(self.powers) <= length:
            size = 1 << int(length).bit_length()
            for name, base in (("powers", self.BASE), ("inverses", self.INVERSE)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def prefix(self, values: np.ndarray) -> np.ndarray:
        self.reach(len(values))
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values.astype(np.uint64) * self.powers[: len(values)], out=sums[1:])
        return sums

    def ranges(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((sums[ends] - sums[starts]) * self.inverses[starts] + (ends - starts).astype(np.uint64))


def lower_ascii_table() -> np.ndarray:
    """Byte to byte: A-Z to a-z, all else as it is."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def words(data: np.ndarray, bounds: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of ``inside`` bytes, and how many each row has. Runs end at row ends."""
    member = np.zeros(len(data) + 2, np.int8)
    member[1:-1] = inside[data]
    edge = np.diff(member)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    cuts = bounds[1:-1]
    cuts = np.unique(cuts[(cuts > 0) & (cuts < len(data))])
    if len(cuts):
        cuts = cuts[(member[cuts] == 1) & (member[cuts + 1] == 1)]
        if len(cuts):
            starts = np.sort(np.concatenate([starts, cuts]))
            ends = np.sort(np.concatenate([ends, cuts]))
    return starts, ends, np.diff(np.searchsorted(starts, bounds))
