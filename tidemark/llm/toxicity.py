"""Toxicity scores from a linear classifier on character n-grams.

A text is lower-cased (A-Z) and each ASCII character that is no letter or digit becomes a space, with
one before and after the text, so n-grams see where words begin and end; other characters stay. Features are
n-grams of 4, 6 and 8 characters (code points), hashed, present or not. Each is scaled by its naive
Bayes log-count ratio, and a logistic regression is trained on the ``KEPT`` scaled features that
differ most between the classes, of those that ``MIN_ROWS`` rows hold.

Training uses at most ``SAMPLE`` labelled ids, those with the smallest hash, and one text of each (that with
the least hash of several). Features are counted and looked up by many tasks; the one task of the regression gets the numbers of the
kept features in each text and no text, at most ``SAMPLE * KEPT`` numbers of two bytes (96 MB) however
long the texts are, and takes them in blocks. Scoring is a scan of all documents, every text whole, with the weights
sent to each task (``1 << BITS`` numbers). Very long texts are taken in slices that overlap.

Defined results: a null or empty text has no features and gets the intercept's score; without
labelled rows of both classes every score is the smoothed share of label 1; labels of one id count
as the largest; null labels and ids are left out of training; repeated rows are scored each; features
that differ equally are kept by their number; other columns are ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import SLICE_BYTES, map_arrow, prepare, row_slices, stored, text_bytes

SAMPLE = 6000
BITS = 20
KEPT = 8000
SIZES = (4, 6, 8)
MIN_ROWS = 3
THRESHOLD = 0.7
# Of the regression: ridge, weight of label 1, steps and their size.
RIDGE, POSITIVE, STEPS, RATE = 1e-4, 2.0, 250, 0.05
# Tasks that count features of the sample, features counted in one group, numbers in a block of the regression.
TASKS, GROUP, BLOCK = 8, 1 << 14, 1 << 20
# Most bytes of text taken at once.
SLICE = SLICE_BYTES

_SPACE = np.array([32], np.uint64)
_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_LOWER = np.full(256, 32, np.uint8)
for _b in (*range(48, 58), *range(97, 123), *range(128, 256)):
    _LOWER[_b] = _b
_LOWER[65:91] = np.arange(97, 123)


def characters(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number per character of the texts (its bytes, the first one highest), and where each text
    begins among them (with the end of the last)."""
    leads = (raw & 0xC0) != 0x80
    leads[starts[:-1][starts[:-1] < len(raw)]] = True
    at = np.flatnonzero(leads)
    found = _LOWER[raw[at]].astype(np.uint64)
    if len(at) < len(raw):
        size = np.diff(np.append(at, len(raw)))
        for k in (1, 2, 3):
            more = np.flatnonzero(size > k)
            found[more] = found[more] << np.uint64(8) | raw[at[more] + k]
    return found, np.searchsorted(at, starts)


def grams(symbols: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each size of n-gram with the features of those that begin at each place."""
    gram = symbols
    for size in range(2, max(SIZES) + 1):
        if len(symbols) < size:
            break
        gram = gram[:-1] * _STEP + symbols[size - 1 :]
        if size in SIZES:
            salted = gram * _MIX + np.uint64(size * 0x632BE59BD9B4E019 % (1 << 64))
            salted ^= salted >> np.uint64(31)
            yield size, (salted * _MIX >> np.uint64(64 - BITS)).astype(np.int64)


def features(raw: np.ndarray, starts: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of text number and feature, of the features that ``wanted`` marks."""
    rows = len(starts) - 1
    plain, first = characters(raw, starts)
    begin = first[:-1] + 2 * np.arange(rows)
    end = first[1:] + 2 * np.arange(1, rows + 1)
    padded = np.full(len(plain) + 2 * rows, 32, np.uint64)
    padded[np.arange(len(plain)) + np.repeat(2 * np.arange(rows) + 1, np.diff(first))] = plain
    found = []
    for size, feature in grams(padded):
        at = np.flatnonzero(wanted[feature])
        row = np.searchsorted(begin, at, side="right") - 1
        inside = at + size <= end[row]
        found.append(row[inside] << BITS | feature[at[inside]])
    pairs = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
    return pairs >> BITS, pairs & ((1 << BITS) - 1)


def long_features(raw: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The same for one text, a slice at a time: the last characters of each are put before the next."""
    seen = np.zeros(1 << BITS, bool)
    kept, lo = _SPACE, 0
    while lo < len(raw):
        hi = min(lo + SLICE, len(raw))
        while hi < len(raw) and hi > lo + 1 and raw[hi] & 0xC0 == 0x80:
            hi -= 1
        plain, _ = characters(raw[lo:hi], np.array([0, hi - lo]))
        symbols = np.concatenate([kept, plain, _SPACE[: hi == len(raw)]])
        for _, feature in grams(symbols):
            seen[feature] = True
        kept, lo = symbols[-max(SIZES) + 1 :], hi
    return np.flatnonzero(seen & wanted)


def found_in(column: pa.Array, wanted: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct pairs of row and wanted feature of a text column, in order, all of a row together."""
    raw, starts = text_bytes(column)
    for lo, hi in row_slices(starts, SLICE):
        text = raw[starts[lo] : starts[hi]]
        if len(text) > SLICE:
            feature = long_features(text, wanted)
            yield np.full(len(feature), lo), feature
        else:
            row, feature = features(text, starts[lo : hi + 1] - starts[lo], wanted)
            yield row + lo, feature


class Model:
    """Intercept and one weight per feature; features without a weight have zero."""

    def __init__(self, intercept: float, chosen: np.ndarray, weights: np.ndarray):
        self.intercept, self.chosen, self.weights = intercept, chosen, weights
        self.table = np.zeros(1 << BITS)
        self.table[chosen] = weights

    def dumps(self) -> bytes:
        return struct.pack("<d", self.intercept) + self.chosen.astype("<i8").tobytes() + self.weights.astype("<f8").tobytes()

    @classmethod
    def loads(cls, data: bytes) -> Model:
        n = (len(data) - 8) // 16
        return cls(struct.unpack_from("<d", data)[0], np.frombuffer(data, "<i8", n, 8), np.frombuffer(data, "<f8", n, 8 + 8 * n))

    def score(self, column: pa.Array) -> np.ndarray:
        margin = np.full(len(column), self.intercept)
        for row, feature in found_in(column, self.table != 0):
            margin += np.bincount(row, self.table[feature], len(column))
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def count(column: pa.Array, labels: np.ndarray) -> np.ndarray:
    """How many rows of label 0 and 1 hold each feature."""
    seen = np.zeros((2, 1 << BITS), np.int64)
    for row, feature in found_in(column, np.ones(1 << BITS, bool)):
        for label in (0, 1):
            seen[label] += np.bincount(feature[labels[row] == label], minlength=1 << BITS)
    return seen


def weigh(seen: np.ndarray, positive: int, negative: int) -> tuple[np.ndarray, np.ndarray]:
    """Log-count ratio of each feature, and how far apart its shares in the classes are, in standard errors."""
    ratio = np.log((seen[1] + 1) / (positive + 2)) - np.log((seen[0] + 1) / (negative + 2))
    share = seen.sum(0) / (positive + negative)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / positive + 1 / negative))
    apart = np.abs(seen[1] / positive - seen[0] / negative) / spread
    apart[seen.sum(0) < MIN_ROWS] = 0
    return ratio, apart


def regress(numbers: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray) -> tuple[float, np.ndarray]:
    """Intercept and weights over the features numbered as ``ratio`` is, for rows that hold ``numbers``."""
    ends = np.cumsum([len(n) for n in numbers])
    blocks, lo = [], 0
    while lo < len(numbers):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + BLOCK, side="right")))
        blocks.append((lo, hi, np.concatenate(numbers[lo:hi]), np.array([len(n) for n in numbers[lo:hi]])))
        numbers[lo:hi] = [None] * (hi - lo)
        lo = hi
    weight = np.where(labels == 1, POSITIVE, 1.0) / len(labels)
    w, bias = np.zeros(len(ratio)), float(np.log((labels == 1).sum() / (labels == 0).sum()))
    mean, square = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, STEPS + 1):
        slope, total, value = RIDGE * w, 0.0, ratio * w
        for lo, hi, held, sizes in blocks:
            margin = bias + np.bincount(np.repeat(np.arange(hi - lo), sizes), value[held], hi - lo)
            error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[lo:hi]) * weight[lo:hi]
            slope += ratio * np.bincount(held, np.repeat(error, sizes), len(w))
            total += error.sum()
        slope = np.append(slope, total)
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope * slope
        move = RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
        w, bias = w - move[:-1], bias - float(move[-1])
    return bias, w * ratio


def fold(id_column: str = "doc_id") -> Column:
    """Which third an id is in: crc32 of its text form, modulo 3."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % 3


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE) -> Model:
    """A model from at most ``sample`` labelled ids that are not in the held-out third."""
    spark = docs.sparkSession
    usable = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & (fold() != 1))
    one = usable.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    chosen = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).dropna(subset=["doc_id"])
    # The chosen labels are bounded by the sample, and so are the rows kept: one of each id.
    least = F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t")
    texts = rows.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(least, F.max("label").alias("label"))
    picked = stored(texts.select("doc_id", "t.text", "label").repartition(TASKS), "toxicity-sample")
    of = {r.label: r["count"] for r in picked.groupBy("label").count().collect()}
    positive, negative = of.get(1, 0), of.get(0, 0)
    if not positive or not negative:
        return Model(float(np.log((positive + 1) / (negative + 1))), np.zeros(0, np.int64), np.zeros(0))
    kept = choose(picked, positive, negative)
    feature = np.array([r.feature for r in kept], np.int64)
    ratio = np.array([r.ratio for r in kept])
    shared = spark.sparkContext.broadcast(feature)

    def look_up(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        wanted, number = np.zeros(1 << BITS, bool), np.zeros(1 << BITS, np.uint16 if KEPT <= 1 << 16 else np.uint32)
        wanted[shared.value], number[shared.value] = True, np.arange(len(shared.value))
        held = [b""] * batch.num_rows
        for row, found in found_in(batch.column(1), wanted):
            edges = np.searchsorted(row, np.arange(row[0], row[-1] + 2)) if len(row) else []
            for k in range(len(edges) - 1):
                held[row[0] + k] = number[found[edges[k] : edges[k + 1]]].tobytes()
        columns = [batch.column(0), pa.array(held, pa.binary()), batch.column(2)]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held", "label"])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, known = [], []
        for batch in batches:
            kind = np.uint16 if KEPT <= 1 << 16 else np.uint32
            numbers += [np.frombuffer(b, kind) for b in batch.column(0).to_pylist()]
            known.append(batch.column(1).to_numpy())
        if numbers:
            intercept, weights = regress(numbers, np.concatenate(known), ratio)
            made = Model(intercept, shared.value, weights).dumps()
            yield pa.RecordBatch.from_arrays([pa.array([made], pa.binary())], ["model"])

    kind = picked.schema["doc_id"].dataType.simpleString()
    held = map_arrow(picked, ["doc_id", "text", "label"], look_up, f"doc_id {kind}, held binary, label int")
    ordered = held.repartition(1).sortWithinPartitions("doc_id").select("held", "label")
    return Model.loads(ordered.mapInArrow(solve, "model binary").first().model)


def choose(picked: DataFrame, positive: int, negative: int) -> list:
    """The features to keep, at most ``KEPT`` rows of ``feature`` and ``ratio`` in order of features. Each task
    sends its counts once, a row for each group of features."""
    groups = range((1 << BITS) // GROUP)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, 1 << BITS), np.int64)
        for batch in batches:
            if batch.num_rows:
                seen += count(batch.column(0), batch.column(1).to_numpy())
        if seen.any():
            parts = [seen[:, g * GROUP : (g + 1) * GROUP].astype("<u4").tobytes() for g in groups]
            yield pa.RecordBatch.from_arrays([pa.array(groups, pa.int64()), pa.array(parts, pa.binary())], ["g", "seen"])

    def best(table: pa.Table) -> pa.Table:
        seen = np.zeros((2, GROUP), np.int64)
        for part in table.column("seen"):
            seen += np.frombuffer(part.as_py(), "<u4").reshape(2, GROUP)
        ratio, apart = weigh(seen, positive, negative)
        feature = np.flatnonzero(apart > 0)
        columns = [pa.array(feature + table.column("g")[0].as_py() * GROUP), pa.array(ratio[feature]), pa.array(apart[feature])]
        return pa.table(columns, ["feature", "ratio", "apart"])

    prepare(picked.sparkSession)
    counted = picked.select("text", "label").mapInArrow(run, "g long, seen binary")
    scored = counted.groupBy("g").applyInArrow(best, "feature long, ratio double, apart double")
    top = scored.orderBy(F.desc("apart"), "feature").limit(KEPT).collect()
    return sorted(top, key=lambda r: r.feature)


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id`` and ``score`` of every row."""
    kind = docs.schema[id_column].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.score(batch.column(1)))], ["doc_id", "score"])

    named = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    return map_arrow(named, ["doc_id", "text"], work, f"doc_id {kind}, score double")


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, that score below the threshold."""
    prepare(docs.sparkSession)
    position = docs.columns.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(shared.value.score(batch.column(position)) < threshold))

    return docs.mapInArrow(work, docs.schema)


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    held = F.coalesce(fold() == 1, F.lit(False)).alias("held_out")
    return score(docs, model).select("doc_id", held, "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
