"""Removal of long strings that occur more than once, by column-wise suffix sorting.

Strings of ``LENGTH`` bytes that occur more than once are removed; strings of ``SHORT`` bytes that do
are counted, from the same sort. A string of ``SHORT`` bytes always holds the same anchor: the smallest
hash among its pieces of ``PIECE`` bytes. So the starts of such strings fall into chunks, runs of
starts with one anchor, and equal strings lie at the same place beside equal anchors. Chunks whose
anchor occurs once are done with; equal chunks are folded. What is left, different chunks with a
common anchor, is sorted column by column, many chunks at once: each round puts the next symbol of
each chunk, from the right, before its suffix, as the construction of a collection's
Burrows-Wheeler transform does, and updates the lengths of the common prefixes. A suffix whose common
prefix with a neighbour reaches a length begins a repeated string.

Where this departs from the dealt method: a round keeps the order and the common prefixes of one suffix
per chunk, those that begin in its column. It does not insert them among the suffixes of earlier
rounds, and it writes no transform to files, since equal strings stand in one column here. The
README has what that would cost. The rounds of one collection stay within a task and see a bounded
number of chunks. An anchor with more than ``GROUP`` different chunks would not fit one collection:
its strings are compared by their own hashes, one row each, which spreads them evenly and is as
exact. Equal texts are counted without their text, so a text with very many copies is never gathered.

Defined results: a null text is empty, keeps nothing and has nothing to remove; texts shorter
than ``LENGTH`` are kept whole; equal texts of that length and more lose all bytes; repeated rows
count as copies; an empty table gives no rows; other columns are ignored; very long texts are cut
into overlapping segments. Of equal strings none is first: all are removed. Hashes of texts have
128 bits, of chunks 128, of strings in large groups 128.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import map_arrow, mix, prefix_hash, row_slices, run_hash, stored, text_bytes

LENGTH = 400
# Strings that are counted as repeated: some fifty words of short letters.
SHORT = 250
PIECE = 64
# Bytes of the chunks that one collection is meant to hold, and most chunks of one anchor in it.
COLLECTION_BYTES = 4_000_000
GROUP = 20_000
# Bytes of a long text that are looked at together; must stay below the 22 bits of a place.
SEGMENT = 2_000_000
_PLACE = np.uint64((1 << 22) - 1)

_RUNS = "array<struct<first:int,last:int>>"
_RUN_TYPE = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))


def chunks(raw: np.ndarray, starts: np.ndarray, length: int, piece: int, reach: int | None = None) -> dict[str, np.ndarray]:
    """Chunks of the texts: row, first start in the text, number of starts of strings of ``length``,
    bytes (up to ``reach`` from the last start, or the text's end), place of the anchor from the
    first start, anchor hash, chunk hash."""
    reach = reach or length
    names = ("row", "begin", "count", "size", "anchor_at", "anchor", "chunk")
    parts: list[list[np.ndarray]] = [[] for _ in names]
    for lo, hi in row_slices(starts, SEGMENT):
        begin, end = int(starts[lo]), int(starts[hi])
        for at in range(begin, end, SEGMENT) if hi - lo == 1 else (begin,):
            stop = min(end, at + SEGMENT + reach - 1) if hi - lo == 1 else end
            edges = np.clip(starts[lo : hi + 1], at, stop) - at
            # Starts beyond the segment are the next one's.
            found = _segment(raw[at:stop], edges, length, piece, reach, SEGMENT if hi - lo == 1 else end - at)
            if found is not None:
                row = found[0]
                found[0] = row + lo
                found[1] = found[1] + at - starts[found[0]]
                for part, values in zip(parts, found):
                    part.append(values)
    kinds = (np.int64, np.int64, np.int64, np.int64, np.int64, np.uint64, np.uint64)
    return {n: np.concatenate(p) if p else np.zeros(0, k) for n, p, k in zip(names, parts, kinds)}


def _segment(raw: np.ndarray, edges: np.ndarray, length: int, piece: int, reach: int, most: int) -> list[np.ndarray] | None:
    if len(raw) < length:
        return None
    sums = prefix_hash(raw)
    places = np.arange(len(raw) - piece + 1)
    hashes = run_hash(sums, places, places + piece)
    least = hashes & ~_PLACE | places.astype(np.uint64)
    width, size = length - piece + 1, 1
    while 2 * size <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if width > size:
        least = np.minimum(least[: -(width - size)], least[width - size :])
    anchor = (least & _PLACE).astype(np.int64)
    long = np.flatnonzero(np.diff(edges) >= length)
    valid = np.zeros(len(anchor) + 1, np.int8)
    valid[edges[long]] = 1
    valid[edges[long + 1] - length + 1] -= 1
    valid = np.cumsum(valid[:-1]) > 0
    valid[most:] = False
    first = valid.copy()
    first[1:] &= ~valid[:-1] | (anchor[1:] != anchor[:-1])
    first[edges[long]] = True
    begin = np.flatnonzero(first)
    stop = np.flatnonzero(np.append(first | ~valid, True))
    count = stop[np.searchsorted(stop, begin, side="right")] - begin
    at = anchor[begin] - begin
    row = np.searchsorted(edges, begin, side="right") - 1
    last = np.minimum(begin + count + reach - 1, edges[row + 1])
    chunk = mix(run_hash(sums, begin, last) + at.astype(np.uint64))
    return [row, begin, count, last - begin, at, hashes[anchor[begin]], chunk]


def insert_columns(
    texts: list[bytes], anchor_at: np.ndarray, count: np.ndarray, lengths: tuple[int, ...]
) -> list[tuple[list[tuple[int, int]], ...]]:
    """For each of these different chunks and each length, runs of starts of repeated strings.

    The chunks stand under each other with their anchors aligned. Round by round, from the right,
    the symbol of each chunk is put before its suffix: a stable sort by that symbol gives the new
    order, and two neighbours with one symbol share one more than the least common prefix between
    them before.
    """
    n = len(texts)
    sizes = np.fromiter(map(len, texts), np.int64, n)
    left, right = int(anchor_at.max()), int((sizes - anchor_at).max())
    none = 256  # no symbol here; starts whose strings would reach into it do not count
    grid = np.full((left + right, n), none, np.uint16)
    chunk = np.repeat(np.arange(n), sizes)
    within = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    grid[within + np.repeat(left - anchor_at, sizes), chunk] = np.frombuffer(b"".join(texts), np.uint8)
    order = np.arange(n)
    common = np.zeros(n + 1, np.int32)
    repeated = [np.zeros((left + 1, n), bool) for _ in lengths]
    for column in range(left + right - 1, -1, -1):
        symbol = grid[column][order]
        place = np.argsort(symbol, kind="stable")
        symbol = symbol[place]
        same = np.flatnonzero(symbol[1:] == symbol[:-1]) + 1
        fresh = np.zeros(n + 1, np.int32)
        if len(same):
            spans = np.empty(2 * len(same), np.int64)
            spans[0::2], spans[1::2] = place[same - 1] + 1, place[same] + 1
            fresh[same] = np.minimum.reduceat(common, spans)[::2] + 1
        order, common = order[place], fresh
        if column <= left:
            for length, flags in zip(lengths, repeated, strict=True):
                long = np.flatnonzero(common[:n] >= length)
                flags[column, order[long]] = True
                flags[column, order[long - 1]] = True
    out = []
    for i in range(n):
        lo, whole = left - int(anchor_at[i]), int(sizes[i])
        ends = (lo + max(min(int(count[i]), whole - length + 1), 0) for length in lengths)
        out.append(tuple(_runs(flags[lo:end, i]) for flags, end in zip(repeated, ends, strict=True)))
    return out


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return list(zip(np.flatnonzero(edge == 1).tolist(), (np.flatnonzero(edge == -1) - 1).tolist()))


def _keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    text = F.coalesce(F.col(text_column), F.lit(""))
    named = docs.select(F.col(id_column).alias("doc_id"), text.alias("text"))
    return named.withColumns({"t1": F.xxhash64("text"), "t2": F.xxhash64(F.lit(1), "text")})


def find_chunks(keyed: DataFrame, short: int, piece: int, length: int) -> DataFrame:
    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = chunks(*text_bytes(batch.column(0)), short, piece, length)
        row = pa.array(found["row"])
        columns = [batch.column(1).take(row), batch.column(2).take(row)]
        columns += [pa.array(found[c].astype(np.int32)) for c in ("begin", "count", "size", "anchor_at")]
        columns += [pa.array(found[c].view(np.int64)) for c in ("anchor", "chunk")]
        yield pa.RecordBatch.from_arrays(columns, ["t1", "t2", "begin", "count", "size", "anchor_at", "anchor", "chunk"])

    schema = "t1 long, t2 long, begin int, count int, size int, anchor_at int, anchor long, chunk long"
    return map_arrow(keyed, ["text", "t1", "t2"], work, schema)


def _chunk_bytes(keyed: DataFrame, wanted: DataFrame, copies: DataFrame) -> DataFrame:
    """The bytes of one occurrence of each wanted chunk (columns ``rep``, ``anchor``, ``chunk``,
    ``count``, ``size``, ``anchor_at``, ``large``)."""
    listed = wanted.groupBy(F.col("rep.t1").alias("t1"), F.col("rep.t2").alias("t2")).agg(
        F.collect_list(F.struct("anchor", "chunk", F.col("rep.begin").alias("begin"), "count", "size", "anchor_at", "large")).alias("cut")
    )
    one = copies.select("t1", "t2", F.col("low").alias("doc_id"))
    # One row of each text: the list goes to its lowest id alone.
    at_one = listed.join(one, ["t1", "t2"])
    same = F.col("d.doc_id").eqNullSafe(F.col("l.doc_id")) & (F.col("d.t1") == F.col("l.t1")) & (F.col("d.t2") == F.col("l.t2"))
    texts = keyed.alias("d").join(at_one.alias("l"), same).select("d.text", "l.cut")

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for text, cut in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist()):
            for c in cut:
                part = text[c["begin"] : c["begin"] + c["size"]]
                rows.append((c["anchor"], c["chunk"], c["count"], c["anchor_at"], c["large"], part))
            if len(rows) > 4000:
                yield _batch(rows)
                rows = []
        if rows:
            yield _batch(rows)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.binary())
        names = ["anchor", "chunk", "count", "anchor_at", "large", "bytes"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    schema = "anchor long, chunk long, count int, anchor_at int, large boolean, bytes binary"
    return map_arrow(texts, ["text", "cut"], work, schema)


def _sorted_runs(parts: DataFrame, collections: int, lengths: tuple[int, int]) -> DataFrame:
    """Runs of repeated starts per chunk, of both lengths, from one collection of chunks after the other."""

    def work(table: pa.Table) -> pa.Table:
        anchor, chunk = (table.column(c).to_numpy() for c in ("anchor", "chunk"))
        _, at = np.unique(np.stack([anchor, chunk]), axis=1, return_index=True)
        table = table.take(pa.array(at))
        runs = insert_columns(
            table.column("bytes").to_pylist(), table.column("anchor_at").to_numpy(), table.column("count").to_numpy(), lengths
        )
        told = [pa.array([[{"first": a, "last": b} for a, b in r[k]] for r in runs], _RUN_TYPE) for k in (0, 1)]
        return pa.table({"anchor": table.column("anchor"), "chunk": table.column("chunk"), "runs": told[0], "short_runs": told[1]})

    dealt = parts.withColumn("collection", F.pmod(F.xxhash64("anchor"), F.lit(collections)))
    schema = f"anchor long, chunk long, runs {_RUNS}, short_runs {_RUNS}"
    return dealt.groupBy("collection").applyInArrow(work, schema).filter(F.size("short_runs") > 0)


def _string_runs(parts: DataFrame, length: int) -> DataFrame:
    """The same for anchors with very many chunks: a row per string, matched by hash and place."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        raw, edges = text_bytes(batch.column(2))
        counts = np.maximum(np.minimum(batch.column(3).to_numpy().astype(np.int64), np.diff(edges) - length + 1), 0)
        places = batch.column(4).to_numpy().astype(np.int64)
        row = np.repeat(np.arange(len(counts)), counts)
        start = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
        begin = edges[row] + start
        string = run_hash(prefix_hash(raw), begin, begin + length)
        string = mix(string + (places[row] - start).astype(np.uint64))
        for lo in range(0, len(row), 100_000):
            part = slice(lo, lo + 100_000)
            taken = pa.array(row[part])
            columns = [batch.column(0).take(taken), batch.column(1).take(taken)]
            columns += [pa.array(start[part].astype(np.int32)), pa.array(string[part].view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["anchor", "chunk", "start", "string"])

    columns = ["anchor", "chunk", "bytes", "count", "anchor_at"]
    strings = map_arrow(parts.dropDuplicates(["anchor", "chunk"]), columns, work, "anchor long, chunk long, start int, string long")
    twice = strings.groupBy("anchor", "string").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    run = F.struct(F.col("start").alias("first"), F.col("start").alias("last"))
    return strings.join(twice, ["anchor", "string"]).groupBy("anchor", "chunk").agg(F.collect_list(run).alias("runs"))


def _large_runs(parts: DataFrame, lengths: tuple[int, int]) -> DataFrame:
    long, short = (_string_runs(parts, length) for length in lengths)
    both = short.withColumnRenamed("runs", "short_runs").join(long, ["anchor", "chunk"], "left")
    return both.select("anchor", "chunk", F.coalesce("runs", F.array().cast(_RUNS)).alias("runs"), "short_runs")


def repeated_runs(docs: DataFrame, length: int, short: int, piece: int, group: int, id_column: str, text_column: str) -> tuple:
    """Keyed documents, copies per text, and per text with one copy the runs of its starts of
    repeated strings: ``t1``, ``t2``, ``cut`` (begin of a chunk and runs of both lengths in it)."""
    keyed = _keyed(docs, id_column, text_column)
    copies = keyed.groupBy("t1", "t2").agg(F.count("*").alias("copies"), F.min("doc_id").alias("low"))
    copies = stored(copies, "text-copies")
    found = stored(find_chunks(keyed, short, piece, length), "chunks")
    # Sums stand in tables of their own before they are joined back, so that adaptive execution
    # can split an anchor that very many chunks have.
    common = found.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor")
    common = stored(common, "common-anchors")
    shared = stored(found.join(common, "anchor"), "shared-chunks")
    rep = F.min(F.struct("t1", "t2", "begin")).alias("rep")
    folded = shared.groupBy("anchor", "chunk").agg(
        F.count("*").alias("n"), F.max("count").alias("count"), F.max("size").alias("size"), F.max("anchor_at").alias("anchor_at"), rep
    )
    folded = stored(folded, "folded-chunks")
    groups = folded.groupBy("anchor").agg(F.count("*").alias("kinds")).filter("kinds > 1")
    groups = stored(groups, "anchor-kinds")
    various = folded.join(groups, "anchor").withColumn("large", F.col("kinds") > group)
    parts = stored(_chunk_bytes(keyed, various, copies), "chunk-bytes")
    seen = parts.groupBy("large").agg(F.sum(F.length("bytes")).alias("b")).collect()
    size = {r.large: r.b for r in seen}


    def whole(of: int) -> Column:
        last = F.least(F.col("count") - 1, F.col("size") - of)
        run = F.array(F.struct(F.lit(0).alias("first"), last.alias("last")))
        return F.when(last >= 0, run).otherwise(F.array()).cast(_RUNS)

    runs = folded.filter("n > 1").select("anchor", "chunk", whole(length).alias("runs"), whole(short).alias("short_runs"))
    if False in size:
        collections = math.ceil(size[False] / COLLECTION_BYTES)
        runs = runs.unionByName(_sorted_runs(parts.filter("NOT large"), collections, (length, short)))
    if True in size:
        runs = runs.unionByName(_large_runs(parts.filter("large"), (length, short)))
    runs = stored(runs, "repeated-runs")
    placed = shared.select("t1", "t2", "begin", "anchor", "chunk").join(runs, ["anchor", "chunk"])
    single = placed.join(copies.filter("copies > 1").select("t1", "t2"), ["t1", "t2"], "left_anti")
    cut = single.groupBy("t1", "t2").agg(F.collect_list(F.struct("begin", "runs", "short_runs")).alias("cut"))
    return keyed, copies, cut


def remove_repeats(
    docs: DataFrame,
    length: int = LENGTH,
    piece: int = PIECE,
    group: int = GROUP,
    id_column: str = "doc_id",
    text_column: str = "text",
    short: int = SHORT,
) -> DataFrame:
    """Per row: ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` of what remains, the removed
    byte ``spans``, and ``n_repeated``, the bytes in strings of ``short`` bytes that occur more than
    once. The remaining bytes may split a character, so they are not a string."""
    if not piece <= short <= length:
        raise ValueError("a piece is at most as long as a short string, and that as a string")
    keyed, copies, cut = repeated_runs(docs, length, short, piece, group, id_column, text_column)

    def covered(size: int, cut: list[dict], runs: str, of: int) -> np.ndarray:
        cover = np.zeros(size + 1, np.int32)
        for c in cut:
            for run in c[runs]:
                cover[c["begin"] + run["first"]] += 1
                cover[c["begin"] + run["last"] + of] -= 1
        return np.cumsum(cover)[:-1] > 0

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for text, cut in zip(batch.column(2).cast(pa.binary()).to_pylist(), batch.column(3).to_pylist()):
            gone = covered(len(text), cut, "runs", length)
            spans = [(a, b + 1) for a, b in _runs(gone)]
            kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
            again = int(covered(len(text), cut, "short_runs", short).sum())
            rows.append((int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), again))
        removed, spans, sha, again = zip(*rows)
        told = pa.array(
            [[{"begin": a, "end": b} for a, b in s] for s in spans], pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        )
        columns = [batch.column(0), batch.column(1), pa.array(removed, pa.int64()), told, pa.array(sha), pa.array(again, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["t1", "t2", "removed", "cut_spans", "sha", "again"])

    schema = "t1 long, t2 long, removed long, cut_spans array<struct<begin:long,end:long>>, sha string, again long"
    texts = keyed.select("t1", "t2", "text").join(cut, ["t1", "t2"])
    trimmed = map_arrow(texts, ["t1", "t2", "text", "cut"], work, schema)
    plain = keyed.select(
        "doc_id", "t1", "t2", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.col("text"), 256).alias("all_sha")
    )
    gone = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    whole = F.array(F.struct(F.lit(0).cast("long").alias("begin"), F.col("n_bytes").alias("end")))
    no_spans = F.array().cast("array<struct<begin:long,end:long>>")
    spans = F.when(gone, whole).otherwise(F.coalesce("cut_spans", no_spans))
    per_text = stored(copies.select("t1", "t2", "copies").join(trimmed, ["t1", "t2"], "left"), "trimmed-texts")
    return (
        plain.join(per_text, ["t1", "t2"])
        .select(
            "doc_id",
            "n_bytes",
            F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("removed", F.lit(0))).cast("long").alias("n_removed"),
            F.size(spans).cast("long").alias("n_spans"),
            F.when(gone, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("sha", "all_sha")).alias("kept_sha256"),
            spans.alias("spans"),
            F.when((F.col("copies") > 1) & (F.col("n_bytes") >= short), F.col("n_bytes")).otherwise(F.coalesce("again", F.lit(0))).cast("long").alias("n_repeated"),
        )
    )


def op1_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{folder}/documents.parquet")).drop("spans")
