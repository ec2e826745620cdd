"""What several operators of this package share: worker set-up, tables in the shared folder,
and vectorised hashing of runs inside a batch of texts."""

from __future__ import annotations

import functools
import math
import os
from collections.abc import Callable, Iterator
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidemark.session import scratch_dir
from tidemark.sources.storage import delete

# Most bytes of text that a numpy pass takes at once.
SLICE_BYTES = 500_000
# Bytes and rows of one Arrow batch sent to a Python worker.
BATCH_BYTES = "8m"
BATCH_ROWS = "2000"

_BASE = 0x9E3779B97F4A7C15 | 1
# The folders stored inside the innermost call of ``settled``.
_MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)


def prepare(spark: SparkSession) -> None:
    """Small Arrow batches, and workers that can import this package.

    A cluster ships the package with ``--py-files``; a local session finds it by path.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(p for p in (root, known) if p)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def stored(df: DataFrame, name: str, group_bytes: int = 128 * 1024 * 1024) -> DataFrame:
    """The rows as a table in the shared scratch folder, so that later jobs start from files. Readers
    hold up to a row group's bytes at once; give fewer where rows are large."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    made = _MADE.get()
    if made is not None:
        made.append(path)
    df.write.option("parquet.block.size", group_bytes).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(spark: SparkSession, make: Callable[[], DataFrame], name: str) -> DataFrame:
    """The rows of the table that ``make`` returns, stored. The tables that it stored on the way are
    deleted once its rows are written, or when it fails; calls may stand inside each other."""
    made: list[str] = []
    token = _MADE.set(made)
    try:
        rows = make()
        _MADE.reset(token)
        return stored(rows, name)
    finally:
        if _MADE.get() is made:
            _MADE.reset(token)
        for path in made:
            delete(spark, path)


def task_count(spark: SparkSession, amount: int, most: int, least: int) -> int:
    """Tasks for an amount of work: at most ``most`` in each, and where that leaves cores idle, as many
    tasks as there are cores, of at least ``least``."""
    cores = spark.sparkContext.defaultParallelism
    return max(1, math.ceil(amount / most), min(cores, math.ceil(amount / least)))


def map_arrow(df: DataFrame, columns: list[str], work: Callable, schema: str) -> DataFrame:
    """``work`` on every Arrow batch of the named columns; it yields record batches."""
    prepare(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from work(batch)

    return df.select(*columns).mapInArrow(run, schema)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column, one after the other, and where each text begins (with the
    end of the last). A null is an empty text."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_slices(starts: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of whole texts of up to ``most`` bytes; a longer text is a run of its own."""
    first, n = 0, len(starts) - 1
    while first < n:
        last = int(np.searchsorted(starts, starts[first] + most, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


@functools.lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 1 << 64)
    up, down = (np.full(size, np.uint64(b), np.uint64) for b in (_BASE, inverse))
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def prefix_hash(symbols: np.ndarray) -> np.ndarray:
    """Running sums from which ``run_hash`` takes the hash of any run of the symbols."""
    size = 1 << max(20, int(len(symbols)).bit_length())
    sums = np.zeros(len(symbols) + 1, np.uint64)
    np.cumsum((symbols.astype(np.uint64) + np.uint64(1)) * _powers(size)[0][: len(symbols)], out=sums[1:])
    return sums


def run_hash(sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each run, from its symbols and its length alone."""
    size = 1 << max(20, int(len(sums) - 1).bit_length())
    plain = (sums[end] - sums[begin]) * _powers(size)[1][begin]
    return mix(plain ^ (end - begin).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(32))


def words_of(raw: np.ndarray, starts: np.ndarray, word_byte: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words in a batch of texts: where each begins and ends in the bytes, and the number of
    words before each text (with the total last). ``word_byte`` tells which bytes make words."""
    inside = np.zeros(len(raw) + 1, bool)
    inside[:-1] = word_byte[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = starts[1:-1]
    first[edges] = inside[edges]
    begin = np.flatnonzero(first)
    last = inside[:-1] & ~inside[1:]
    if len(edges):
        cut = edges[edges > 0] - 1
        last[cut] = inside[cut]
    end = np.flatnonzero(last) + 1
    return begin, end, np.searchsorted(begin, starts)
