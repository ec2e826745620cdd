"""Quality rules: repeated lines across the documents of a host.

Lines are normalised (A-Z in lower case, words joined by one space) and hashed together with
their host. A line that more than ``LIMIT`` documents of one host hold is removed; a document
that loses more than ``DEPLETED`` of its words so is rejected, besides those that fail the base
rules on length and repetition.

One scan finds every document's figures and its distinct lines as numbers, which are kept in a
table, so the text is never shuffled. Counting adds up per task before the shuffle; the few lines above the limit are joined back to the lines in a way that
lets a line held by a third of all documents be split.

Defined results: a null or empty text has no words and fails the base rules; lines without a word
do not count; a null host is a host of its own; every row is a document, equal or not, so a page with
more copies on a host than the limit loses its lines there; an empty table gives no rows; other
columns are ignored; a line that exactly ``LIMIT`` documents hold stays, and so does a document that loses exactly
``DEPLETED`` of its words. A very long text is one pass over all of its words. Hashes have 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import map_arrow, mix, prefix_hash, row_slices, run_hash, stored, text_bytes, words_of

LIMIT = 20
DEPLETED = 0.7
MIN_WORDS = 50
MAX_REPEATED = 0.5

_WORD = np.ones(256, bool)
_WORD[[9, 10, 11, 12, 13, 32]] = False
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# A lead byte begins a code point.
_LEAD = np.array([b & 0xC0 != 0x80 for b in range(256)])

_FIGURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _sum_before(flags: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(flags)])


def figures(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a batch of texts: the base figures, a row each; and per distinct normalised line of a
    text its row, hash and words in all its occurrences."""
    rows = len(starts) - 1
    begin, end, before = words_of(raw, starts, _WORD)
    sums = prefix_hash(raw)
    words = run_hash(sums, begin, end)
    out = np.zeros((rows, 5), np.int64)
    out[:, 0] = np.diff(before)
    leads = _sum_before(_LEAD[raw])
    chars = _sum_before(leads[end] - leads[begin])
    out[:, 1] = chars[before[1:]] - chars[before[:-1]]
    out[:, 2] = np.diff(_sum_before(_SYMBOL[raw])[starts])
    # Words in windows of three that a text holds more than once.
    if len(words) >= 3:
        row = np.repeat(np.arange(rows), np.diff(before))
        window = mix(mix(words[:-2] * np.uint64(3) + words[1:-1]) * np.uint64(5) + words[2:])
        inside = np.flatnonzero(row[:-2] == row[2:])
        key = mix(window[inside] + row[inside].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        again = np.zeros(len(order), bool)
        again[1:] |= same
        again[:-1] |= same
        at = inside[order[again]]
        marked = np.zeros(len(words), bool)
        for k in range(3):
            marked[at + k] = True
        out[:, 4] = np.bincount(row[marked], minlength=rows)
    # Lines that hold a word.
    breaks = np.flatnonzero(raw == 10)
    inner = starts[1:-1]
    line_begin = np.union1d(np.append(breaks + 1, inner), starts[:1])
    line_begin = line_begin[line_begin < len(raw)]
    line_end = np.append(line_begin[1:], len(raw))
    first = np.searchsorted(begin, line_begin)
    last = np.searchsorted(begin, line_end)
    full = last > first
    line_begin, line_end, first, last = line_begin[full], line_end[full], first[full], last[full]
    row = np.searchsorted(starts, line_begin, side="right") - 1
    # The break that ends a line is not part of it.
    stop = line_end - (raw[line_end - 1] == 10)
    exact = run_hash(sums, line_begin, stop)
    salt = row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    _, at = np.unique(mix(exact + salt), return_index=True)
    out[:, 3] = np.bincount(row, minlength=rows) - np.bincount(row[at], minlength=rows)
    low = prefix_hash(_LOWER[raw])
    normal = run_hash(prefix_hash(run_hash(low, begin, end)), first, last)
    _, at, back = np.unique(mix(normal + salt), return_index=True, return_inverse=True)
    held = np.bincount(back, last - first, len(at)).astype(np.int64)
    order = np.argsort(row[at], kind="stable")
    return out, row[at][order], normal[at][order], held[order]


def measured(docs: DataFrame, id_column: str, text_column: str, host_column: str) -> DataFrame:
    """Each row's figures, and its different lines as keys of host and line."""
    named = docs.select(
        F.col(id_column).alias("doc_id"),
        F.col(text_column).alias("text"),
        F.xxhash64(F.lit(1), host_column).alias("host"),
    )
    kind = named.schema["doc_id"].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        raw, starts = text_bytes(batch.column(1))
        hosts = batch.column(2).to_numpy().view(np.uint64)
        for lo, hi in row_slices(starts):
            found, row, line, held = figures(raw[starts[lo] : starts[hi]], starts[lo : hi + 1] - starts[lo])
            keys = mix(line ^ mix(hosts[lo:hi][row])).view(np.int64)
            bounds = np.searchsorted(row, np.arange(hi - lo + 1)).astype(np.int32)
            columns = [batch.column(0)[lo:hi]]
            columns += [pa.array(found[:, k]) for k in range(5)]
            columns += [pa.ListArray.from_arrays(bounds, pa.array(v)) for v in (keys, held)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", *_FIGURES, "lines", "held"])

    schema = f"doc_id {kind}, {', '.join(f'{c} long' for c in _FIGURES)}, lines array<long>, held array<long>"
    return map_arrow(named, ["doc_id", "text", "host"], work, schema)


def judge(
    docs: DataFrame,
    limit: int = LIMIT,
    depleted: float = DEPLETED,
    id_column: str = "doc_id",
    text_column: str = "text",
    host_column: str = "source",
) -> DataFrame:
    """Each row's figures, ``n_removed`` (words of removed lines), ``base_failed`` and ``kept``."""
    found = measured(docs, id_column, text_column, host_column).withColumn("row", F.monotonically_increasing_id())
    found = stored(found, "line-figures")  # from here on row numbers are fixed
    lines = found.select("row", F.explode(F.arrays_zip("lines", "held")).alias("line")).select(
        "row", F.col("line.lines").alias("line"), F.col("line.held").alias("held")
    )
    # A row has each of its lines once.
    frequent = lines.groupBy("line").agg(F.count("*").alias("n")).filter(F.col("n") > limit).select("line")
    removed = lines.join(frequent, "line").groupBy("row").agg(F.sum("held").alias("n_removed"))
    base_failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    n_removed = F.coalesce("n_removed", F.lit(0)).cast("long")
    return (
        found.drop("lines", "held")
        .join(removed, "row", "left")
        .withColumn("n_removed", n_removed)
        .withColumn("base_failed", base_failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("n_removed") <= depleted * F.col("n_words")))
        .drop("row")
    )


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    return judge(spark.read.parquet(f"{folder}/documents.parquet")).select("doc_id", *_FIGURES, "n_removed", "base_failed", "kept")


OP8_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, '<none>') AS source, coalesce(text, '') AS text,
  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
tri AS (SELECT r, k, array_to_string(w[k : k + 2], ' ') AS key
        FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS k FROM d WHERE len(w) >= 3)),
rep AS (SELECT r, count(DISTINCT pos) AS n FROM (
          SELECT r, unnest(range(k, k + 3)) AS pos
          FROM (SELECT r, k, count(*) OVER (PARTITION BY r, key) AS c FROM tri) WHERE c > 1) GROUP BY r),
raw_lines AS (SELECT r, source, unnest(string_split(text, chr(10))) AS line FROM d),
l AS (SELECT r, source, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS lw FROM raw_lines),
lines AS (SELECT r, source, line, len(lw) AS n,
            translate(array_to_string(lw, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
          FROM l WHERE len(lw) > 0),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY r),
frequent AS (SELECT source, key FROM lines GROUP BY source, key HAVING count(DISTINCT r) > 20),
gone AS (SELECT r, sum(n) AS n FROM lines JOIN frequent USING (source, key) GROUP BY r),
f AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
  CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
  CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
  CAST(coalesce(gone.n, 0) AS BIGINT) AS n_removed
  FROM d LEFT JOIN dup USING (r) LEFT JOIN rep USING (r) LEFT JOIN gone USING (r))
SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 10 * n_removed <= 7 * n_words AS kept FROM f
"""
