"""Benchmark decontamination by Wu-Manber search over words.

Test items give windows of consecutive words; an item of fewer words is one window. For each
window length there is a matcher: a shift table, indexed by the hash of a block of two words,
says how far the next possible end of a match is, so most positions are never looked at; where
the shift is zero, the block's bucket names the windows that end so, and comparing all their
words, at last byte by byte, confirms an occurrence. Many stretches of text advance side by side
in numpy, each by its own shift.

Documents are only scanned, never shuffled. Items are taken in blocks of bounded size: each block
is sent to the tasks once, and where there are several, what was found so far is kept in a table
between them.

Defined results: a null or empty text or item has no words; an item without words matches
nothing; repeated items with one id count once, a null item id is the empty text; repeated rows
each get their result; several items with one window are all hit by it; a very long text is searched whole, in
one pass over its words; empty tables give no rows or no hits; other columns are kept aside.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import map_arrow, mix, prefix_hash, prepare, row_slices, run_hash, stored, text_bytes, words_of

WINDOW = 10
# Bytes of item texts in one block (a worker holds some 250 times as many for its windows), and
# positions that one stretch of text covers.
BLOCK_BYTES = 1_000_000
STRETCH = 256
# Places of the shift table for each block of words in it, at least and at most.
PLACES, LEAST_TABLE, MOST_TABLE = 4, 1 << 16, 1 << 24

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True

_HITS = "array<struct<first:long,last:long>>"


@dataclass
class Words:
    """The words of a batch of texts, in lower case."""

    raw: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    hashes: np.ndarray
    before: np.ndarray  # words before each text, and the total

    def text(self, i: int) -> bytes:
        return self.raw[self.begin[i] : self.end[i]].tobytes()


def read_words(raw: np.ndarray, starts: np.ndarray) -> Words:
    raw = _LOWER[raw]
    begin, end, before = words_of(raw, starts, _WORD)
    return Words(raw, begin, end, run_hash(prefix_hash(raw), begin, end), before)


def _block(left: np.ndarray, right: np.ndarray, table: int) -> np.ndarray:
    return (mix(left * np.uint64(0x9E3779B97F4A7C15) + right) & np.uint64(table - 1)).astype(np.int64)


class Matcher:
    """Wu-Manber tables for windows of one length."""

    def __init__(self, windows: list[tuple[bytes, ...]], hashes: np.ndarray):
        n, self.length = hashes.shape
        self.size = min(2, self.length)
        # Large enough that most blocks of a text are not in it and so shift.
        wanted = PLACES * n * (self.length - self.size + 1)
        self.table = min(max(1 << (wanted - 1).bit_length(), LEAST_TABLE), MOST_TABLE)
        ends = [self._blocks(hashes, j) for j in range(self.size - 1, self.length)]
        self.shift = np.full(self.table, self.length - self.size + 1, np.int64)
        for back, blocks in enumerate(reversed(ends)):
            np.minimum.at(self.shift, blocks, back)
        order = np.argsort(ends[-1], kind="stable")
        self.windows = [windows[i] for i in order]
        self.hashes = hashes[order]
        self.order = order
        self.bucket = np.searchsorted(ends[-1][order], np.arange(self.table + 1))

    def _blocks(self, hashes: np.ndarray, j: int) -> np.ndarray:
        return _block(hashes[:, j - 1] if self.size == 2 else hashes[:, j], hashes[:, j], self.table)

    def find(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Last word and window number of every occurrence inside one text."""
        length, hashes = self.length, words.hashes
        first, stop = words.before[:-1] + length - 1, words.before[1:]
        lanes = np.maximum(0, -(-(stop - first) // STRETCH))
        within = np.arange(int(lanes.sum())) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        at = np.repeat(first, lanes) + within * STRETCH
        limit = np.minimum(np.repeat(stop, lanes), at + STRETCH)
        last, which = [], []
        while len(at):
            left = hashes[at - 1] if self.size == 2 else hashes[at]
            block = _block(left, hashes[at], self.table)
            step = self.shift[block]
            if (hit := step == 0).any():
                ends, window = self._confirm(words, at[hit], block[hit])
                last.append(ends)
                which.append(window)
            at = at + np.maximum(step, 1)
            going = at < limit
            at, limit = at[going], limit[going]
        none = np.zeros(0, np.int64)
        return (np.concatenate(last), np.concatenate(which)) if last else (none, none)

    def _confirm(self, words: Words, at: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        window, rest = self.bucket[block], self.bucket[block + 1]
        ends, found = [], []
        while len(at):
            same = np.ones(len(at), bool)
            for k in range(self.length):
                same[same] = words.hashes[at[same] - self.length + 1 + k] == self.hashes[window[same], k]
            for end, w in zip(at[same].tolist(), window[same].tolist()):
                if all(words.text(end - self.length + 1 + k) == word for k, word in enumerate(self.windows[w])):
                    ends.append(end)
                    found.append(int(self.order[w]))
            window = window + 1
            more = window < rest
            at, window, rest = at[more], window[more], rest[more]
        return np.array(ends, np.int64), np.array(found, np.int64)


class Items:
    """Matchers for a block of items, and which items each window belongs to."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        owners: dict[int, dict[tuple[bytes, ...], set[str]]] = {}
        hashes: dict[int, dict[tuple[bytes, ...], np.ndarray]] = {}
        column = pa.array([text for _, text in items], pa.string())
        words = read_words(*text_bytes(column))
        for (name, _), lo, hi in zip(items, words.before[:-1].tolist(), words.before[1:].tolist()):
            length = min(window, hi - lo)
            for at in range(lo, hi - length + 1) if length else ():
                key = tuple(words.text(i) for i in range(at, at + length))
                owners.setdefault(length, {}).setdefault(key, set()).add(name)
                hashes.setdefault(length, {})[key] = words.hashes[at : at + length]
        self.matchers = [
            (Matcher(list(found), np.stack([hashes[n][k] for k in found])), [sorted(v) for v in found.values()])
            for n, found in sorted(owners.items())
        ]

    def search(self, column: pa.Array) -> tuple[list[int], list[list[tuple[int, int]]], list[set[str]]]:
        """Per text: its number of words, maximal runs of hit words, items that occur."""
        raw, starts = text_bytes(column)
        counts: list[int] = []
        runs: list[list[tuple[int, int]]] = []
        names: list[set[str]] = []
        for lo, hi in row_slices(starts):
            words = read_words(raw[starts[lo] : starts[hi]], starts[lo : hi + 1] - starts[lo])
            base = len(counts)
            counts += np.diff(words.before).tolist()
            runs += [[] for _ in range(lo, hi)]
            names += [set() for _ in range(lo, hi)]
            cover = np.zeros(len(words.begin) + 1, np.int64)
            for matcher, owners in self.matchers:
                last, which = matcher.find(words)
                np.add.at(cover, last - matcher.length + 1, 1)
                np.add.at(cover, last + 1, -1)
                rows = np.searchsorted(words.before, last, side="right") - 1
                for row, w in set(zip(rows.tolist(), which.tolist())):
                    names[base + row].update(owners[w])
            hit = np.zeros(len(cover) + 1, np.int64)
            hit[1:] = np.cumsum(cover) > 0
            inside = words.before[1:-1][words.before[1:-1] < len(words.begin)]
            change = np.diff(hit)
            begins = np.union1d(np.flatnonzero(change == 1), inside[hit[inside + 1] == 1])
            ends = np.union1d(np.flatnonzero(change == -1), inside[hit[inside] == 1])
            for b, e in zip(begins.tolist(), ends.tolist()):
                row = int(np.searchsorted(words.before, b, side="right")) - 1
                at = int(words.before[row])
                runs[base + row].append((b - at, e - 1 - at))
        return counts, runs, names


def item_blocks(items: DataFrame, id_column: str, text_column: str, most: int) -> Iterator[list[tuple[str, str]]]:
    """Items in blocks of bounded bytes, one after the other."""
    block: list[tuple[str, str]] = []
    size = 0
    text = F.coalesce(F.col(text_column), F.lit("")).alias("t")
    for row in items.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("i"), text).toLocalIterator():
        block.append((row.i, row.t))
        size += len(row.t.encode())
        if size >= most:
            yield block
            block, size = [], 0
    if block:
        yield block


def find_items(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per row: ``n_words``, ``hits`` (runs of hit words, first and last) and the ``items`` found."""
    found = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    found = found.withColumn("hits", F.array().cast(_HITS)).withColumn("items", F.array().cast("array<string>"))
    blocks = item_blocks(items, item_column, "text", block_bytes)
    block, n = next(blocks, []), 0
    id_type = found.schema["doc_id"].dataType.simpleString()
    while True:
        later = next(blocks, None)
        shared = docs.sparkSession.sparkContext.broadcast((block, window, uuid.uuid4().hex))

        def work(batch: pa.RecordBatch, shared=shared, last=later is None) -> Iterator[pa.RecordBatch]:
            counts, runs, names = _matchers(shared).search(batch.column(1))
            old_hits, old_items = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            hits = [
                _joined(new + [(h["first"], h["last"]) for h in old]) if old else new for new, old in zip(runs, old_hits)
            ]
            hit_type = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
            columns = {
                "doc_id": batch.column(0),
                "text": batch.column(1),
                "n_words": pa.array(counts, pa.int64()),
                "hits": pa.array([[{"first": b, "last": e} for b, e in h] for h in hits], hit_type),
                "items": pa.array([sorted(new | set(old)) for new, old in zip(names, old_items)], pa.list_(pa.string())),
            }
            del columns["text" if last else "n_words"]
            yield pa.RecordBatch.from_pydict(columns)

        kept = "n_words long" if later is None else "text string"
        order = f"doc_id {id_type}, {kept}, hits {_HITS}, items array<string>"
        found = map_arrow(found, ["doc_id", "text", "hits", "items"], work, order)
        if later is None:
            return found
        block, n = later, n + 1
        found = stored(found, f"items-found-{n}")


_KNOWN: dict[str, Items] = {}


def _matchers(shared) -> Items:
    """The matchers of a broadcast block, built once per worker; blocks have names of their own."""
    block, window, name = shared.value
    if name not in _KNOWN:
        _KNOWN.clear()
        _KNOWN[name] = Items(block, window)
    return _KNOWN[name]


def _joined(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, last in sorted(runs):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(last, out[-1][1]))
        else:
            out.append((first, last))
    return out


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs``, all columns, whose text holds no window of any item."""
    prepare(docs.sparkSession)
    position = docs.columns.index("text")
    blocks = item_blocks(items, "item_id", "text", block_bytes)
    block, n = next(blocks, None), 0
    while block is not None:
        later = next(blocks, None)
        shared = docs.sparkSession.sparkContext.broadcast((block, window, uuid.uuid4().hex))

        def work(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    _, runs, _ = _matchers(shared).search(batch.column(position))
                    yield batch.filter(pa.array([not r for r in runs]))

        docs = docs.mapInArrow(work, docs.schema)
        if later is not None:  # one block's matchers at a time in a worker
            n += 1
            docs = stored(docs, f"clean-of-{n}")
        block = later
    return docs


def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = find_items(
        spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet")
    )
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, h: n + h["last"] - h["first"] + 1)
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


OP5_SQL = """
WITH letters AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS upper_az, 'abcdefghijklmnopqrstuvwxyz' AS lower_az),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), upper_az, lower_az),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents, letters),
i AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all(translate(coalesce(text, ''), upper_az, lower_az),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark, letters),
iw AS (SELECT item, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS k FROM i WHERE len(w) > 0),
patterns AS (SELECT DISTINCT item, n, array_to_string(w[k : k + n - 1], ' ') AS key FROM iw),
lengths AS (SELECT DISTINCT n FROM patterns),
dw AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, lengths WHERE len(w) >= n),
dk AS (SELECT doc_id, n, k, array_to_string(w[k : k + n - 1], ' ') AS key FROM dw),
hits AS (SELECT dk.doc_id, dk.n, dk.k, p.item FROM dk JOIN patterns p ON p.n = dk.n AND p.key = dk.key),
covered AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS pos FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""
