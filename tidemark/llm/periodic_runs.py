"""Periodic runs in texts, by string synchronising sets.

A run is a stretch of words with smallest period q that holds at least three periods and that no
neighbouring word extends. All of them are found, in about n log n steps for n words:

* At each scale t = 8, 16, 32, ... a position belongs to the synchronising set if the least hash
  of the t-word strings that begin in [i, i+t] is that at i or at i+t. Whether it does depends on
  the 2t words from i alone, so a run's positions repeat with its period. Strings with a period of
  at most t/3 do not take part; without them, every t neighbouring positions hold a member.
* Two members with equal contexts (2t words) at a distance q of 2t to 4t propose the period q. A
  context occurs at most every t/3 words, since the highly periodic ones are out, so a member has
  at most eleven such partners. Each run of period q is proposed: its first period holds a member
  whose context, and the same one period later, lie inside the run.
* The highly periodic regions left out are the runs of smaller scales; those of periods below
  16, which no scale proposes, are detected by comparing the words so many places apart.
* A proposed pair is extended to both sides by binary search over prefix hashes, and every run is
  then compared word by word, so a hash that misleads costs time and no result. Of several periods
  of one stretch the smallest counts.

Texts are cut into words in pieces of a megabyte, and words become numbers, so a very long text
costs some hundred bytes a word at most. The texts of a batch are worked on as one, with a number
between them that occurs once. A text is never split between tasks, as its runs may span it.

Defined results: a null or empty text has no words and no runs; rows with equal or null ids are
taken one by one; of runs with the same ratio of length to period the first is the greatest, then
that of the smaller period; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import map_arrow, mix, prefix_hash, run_hash, row_slices, text_bytes

# Periods below this are detected by comparing; the first scale is half of it.
SMALL = 16
# Least length of a run in words, and least number of its periods.
LENGTH, PERIODS = 24, 3
# Members of a synchronising set that can follow one with its context within the distance.
PARTNERS = 11
# Bytes of text that are cut into words at once.
PIECE = 1 << 20

_SPACE = re.compile(rb"[\x20\x09-\x0d]")
_NEVER = np.uint64(0xFFFFFFFFFFFFFFFF)
RUNS = "array<struct<start:long,length:long,period:long>>"


def _stretches(same: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of trues of at least that length begin and end."""
    edges = np.flatnonzero(np.diff(same.astype(np.int8), prepend=0, append=0))
    begin, end = edges[::2], edges[1::2]
    long = end - begin >= least
    return begin[long], end[long]


def _smallest(found: np.ndarray) -> np.ndarray:
    """Rows (start, end, period), one for each stretch, with its smallest period."""
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
    return found[new]


def _small_runs(symbols: np.ndarray, most: int) -> np.ndarray:
    """Runs of periods up to ``most``, by comparing."""
    found = [np.zeros((0, 3), np.int64)]
    for q in range(1, most + 1):
        begin, end = _stretches(symbols[q:] == symbols[:-q], (PERIODS - 1) * q)
        if len(begin):
            found.append(np.column_stack([begin, end + q, np.full(len(begin), q)]))
    return _smallest(np.concatenate(found))


def _members(grams: np.ndarray, t: int, found: np.ndarray) -> np.ndarray:
    """The synchronising set at scale t, from the hashes of all strings of t symbols and the runs
    of smaller periods."""
    chosen = grams
    periodic = found[(PERIODS * found[:, 2] <= t) & (found[:, 1] - found[:, 0] >= t)]
    if len(periodic):
        depth = np.zeros(len(grams) + 1, np.int64)
        np.add.at(depth, periodic[:, 0], 1)
        np.add.at(depth, periodic[:, 1] - t + 1, -1)
        chosen = np.where(np.cumsum(depth[:-1]) > 0, _NEVER, grams)
    least, width = chosen, 1
    while width < t:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    here, there = chosen[: len(grams) - t], chosen[t:]
    least = np.minimum(least[: len(here)], there)
    return np.flatnonzero(((least == here) | (least == there)) & (least != _NEVER))


def _proposals(members: np.ndarray, context: np.ndarray, t: int) -> np.ndarray:
    """Rows (position, distance) of members with equal contexts, 2t to 4t apart."""
    order = np.argsort(context, kind="stable")
    members, context = members[order], context[order]
    near = (context[1:] == context[:-1]) & (members[1:] - members[:-1] < 4 * t)
    some = np.zeros(len(members), bool)
    some[1:] |= near
    some[:-1] |= near
    members, context = members[some], context[some]
    found = [np.zeros((0, 2), np.int64)]
    for lag in range(1, min(PARTNERS, len(members) - 1) + 1):
        apart = members[lag:] - members[:-lag]
        good = (context[lag:] == context[:-lag]) & (apart >= 2 * t) & (apart < 4 * t)
        if good.any():
            found.append(np.column_stack([members[:-lag][good], apart[good]]))
    return np.concatenate(found)


def _extension(sums: np.ndarray, left: np.ndarray, right: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
    """How far the symbols from two positions on (or before them) agree, by binary search."""
    low, high = np.zeros(len(left), np.int64), most.copy()
    while (low < high).any():
        middle = (low + high + 1) // 2
        if back:
            same = run_hash(sums, left - middle, left) == run_hash(sums, right - middle, right)
        else:
            same = run_hash(sums, left, left + middle) == run_hash(sums, right, right + middle)
        low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
    return low


def _confirmed(symbols: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """The stretches as they are, or, where hashes misled, those that they hold."""
    for start, end, q in rows.tolist():
        same = symbols[start : end - q] == symbols[start + q : end]
        if same.all():
            yield start, end, q
        else:
            for b, e in zip(*_stretches(same, (PERIODS - 1) * q), strict=True):
                yield start + int(b), start + int(e) + q, q


def runs(symbols: np.ndarray, longest: int | None = None) -> np.ndarray:
    """Rows (start, end, smallest period), by start and end, of all maximal stretches that hold at
    least three periods. ``longest`` bounds the length of a stretch, where it is known."""
    symbols = np.asarray(symbols, np.int64)
    most = (len(symbols) if longest is None else min(longest, len(symbols))) // PERIODS
    found = _small_runs(symbols, min(most, SMALL - 1))
    sums, t = None, 1
    grams = mix(symbols.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
    while 2 * t <= most:
        double = mix(grams[:-t] * np.uint64(0xD1342543DE82EF95) + grams[t:])
        if 2 * t >= SMALL:
            members = _members(grams, t, found)
            pairs = _proposals(members, double[members], t)
            if len(pairs):
                sums = prefix_hash(mix(symbols.astype(np.uint64))) if sums is None else sums
                at, q = pairs[:, 0], pairs[:, 1]
                start = at - _extension(sums, at, at + q, at, back=True)
                end = at + q + _extension(sums, at, at + q, len(symbols) - at - q, back=False)
                long = end - start >= PERIODS * q
                rows = np.unique(np.column_stack([start, end, q])[long], axis=0)
                rows = np.array(list(_confirmed(symbols, rows)), np.int64).reshape(-1, 3)
                found = _smallest(np.concatenate([found, rows]))
        grams, t = double, 2 * t
    return found


def collapsed(count: int, found: np.ndarray) -> np.ndarray:
    """Which of the words stay: all but those after the first period of a run that holds them."""
    depth = np.zeros(count + 1, np.int64)
    np.add.at(depth, found[:, 0] + found[:, 2], 1)
    np.add.at(depth, found[:, 1], -1)
    return np.cumsum(depth[:-1]) == 0


def word_numbers(data: bytes, known: dict[bytes, int]) -> np.ndarray:
    """The words of a text as numbers; ``known`` has the number of each word so far."""
    parts, first = [np.zeros(0, np.int64)], 0
    while first < len(data):
        cut = _SPACE.search(data, first + PIECE)
        last = cut.start() if cut else len(data)
        words = data[first:last].split()
        for word in dict.fromkeys(words):
            known.setdefault(word, len(known))
        parts.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
        first = last
    return np.concatenate(parts)


def _joined(names: list[bytes], numbers: np.ndarray) -> str:
    return b" ".join(map(names.__getitem__, numbers.tolist())).decode()


def collapse_runs(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    length: int = LENGTH,
    edit: Callable[[object, np.ndarray], np.ndarray] | None = None,
) -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` (start and length in words, period; by start and period) and
    ``collapsed``, the text with each run of at least ``length`` words cut to its first period and
    one space between words. ``edit`` may change the word numbers of a text, by its id."""
    kind = docs.schema[id_column].dataType

    def one_slice(ids: pa.Array, raw: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
        known: dict[bytes, int] = {}
        texts = []
        for k, doc_id in enumerate(ids.to_pylist()):
            numbers = word_numbers(raw[starts[k] : starts[k + 1]].tobytes(), known)
            texts.append(edit(doc_id, numbers) if edit else numbers)
        counts = np.array([len(t) for t in texts], np.int64)
        begin = np.concatenate([[0], np.cumsum(counts + 1)])
        symbols = np.empty(begin[-1], np.int64)
        for k, numbers in enumerate(texts):
            symbols[begin[k] : begin[k + 1] - 1] = numbers
        symbols[begin[1:] - 1] = -1 - np.arange(len(texts))
        found = runs(symbols, int(counts.max()))
        found = found[found[:, 1] - found[:, 0] >= length]
        found = found[np.lexsort((found[:, 2], found[:, 0]))]
        edges = np.searchsorted(found[:, 0], begin)
        names, kept = list(known), []
        for k, numbers in enumerate(texts):
            own = found[edges[k] : edges[k + 1]] - np.array([begin[k], begin[k], 0])
            kept.append(_joined(names, numbers[collapsed(len(numbers), own)] if len(own) else numbers))
        owner = np.searchsorted(begin, found[:, 0], side="right") - 1
        rows = pa.StructArray.from_arrays(
            [pa.array(found[:, 0] - begin[owner]), pa.array(found[:, 1] - found[:, 0]), pa.array(found[:, 2])],
            names=["start", "length", "period"],
        )
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(counts), pa.ListArray.from_arrays(pa.array(edges, pa.int32()), rows), pa.array(kept, pa.string())],
            names=["doc_id", "n_words", "runs", "collapsed"],
        )

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        raw, starts = text_bytes(batch.column(1))
        for first, last in row_slices(starts):
            span = raw[starts[first] : starts[last]]
            yield one_slice(batch.column(0).slice(first, last - first), span, starts[first : last + 1] - starts[first])

    schema = f"doc_id {kind.simpleString()}, n_words long, runs {RUNS}, collapsed string"
    return map_arrow(docs, [id_column, text_column], work, schema)


def planted(doc_id: int | None, words: np.ndarray) -> np.ndarray:
    """The contract's repeats: for an id whose checksum ends in 0, the words from a place on repeat
    the first few of them. A null id has none."""
    if doc_id is None or not len(words):
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    return words[np.where(at < a, at, a + (at - a) % p)]


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = collapse_runs(spark.read.parquet(f"{folder}/documents.parquet"), edit=planted)
    # Ratios are compared as whole numbers; the runs come by start and period, so the first stays.
    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    best = F.aggregate(
        "runs",
        none,
        lambda top, run: F.when(top.isNull() | (run["length"] * top["period"] > top["length"] * run["period"]), run).otherwise(top),
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))))
    return docs.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform(lines, lambda line: F.concat(line, F.lit("\n")))), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        "n_words",
    )
