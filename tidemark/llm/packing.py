"""Packing token ids into sequences of a fixed length.

Documents are dealt into random groups of bounded size, and each group is packed on its own:
whole sequences are cut off long documents, what remains is placed by first-fit decreasing, with
a tournament tree over the free room of the open sequences to find the first that fits, and last
the emptiest sequences are cut up to fill the gaps of the others. So a group has at most one
sequence that is not full.

A group's number is drawn per row from a fixed seed, not from a key, so copies and repeated ids
spread evenly, and a task that runs again draws the same numbers. Only ids are shuffled, once, into
partitions of a fixed number of groups, so tasks do not grow with the table. A very long text is in one group
as a whole and makes that group larger; texts are tokenized in passes of bounded length.

Defined results: a null or empty text is just the closing id; repeated rows are packed each on
their own; a null id is kept, and ids may be numbers or text; of documents of one length the one with
the least id goes first, and of equal ids that with the least token ids; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import tokens
from tidemark.llm.common import map_arrow, task_count

LENGTH = 1024
CLOSING = 0
# Bytes of text that a group is meant to hold.
GROUP_BYTES = 4_000_000
# Groups of one task at most, and at least where cores are idle.
TASK_GROUPS, SMALL_TASK_GROUPS = 8, 2
SEED = 20

PIECES = "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def tokenized(docs: DataFrame, closing: int, tokenizer: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Each row's id and its token ids with the closing one, as little-endian 16-bit numbers
    when the vocabulary allows it, else 32-bit."""
    width = "<u2" if tokens.encoder(tokenizer).library.get_vocab_size() <= 1 << 16 else "<u4"

    def work(batch: pa.RecordBatch):
        texts = batch.column(1).fill_null("").to_pylist()
        ids, counts = tokens.encoder(tokenizer).encode(texts)
        ends = np.cumsum(counts)
        rows = [np.append(ids[e - n : e], closing).astype(width).tobytes() for e, n in zip(ends.tolist(), counts.tolist())]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], ["doc_id", "ids"])

    named = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    kind = named.schema["doc_id"].dataType.simpleString()
    return map_arrow(named, ["doc_id", "text"], work, f"doc_id {kind}, ids binary").withColumn("width", F.lit(int(width[-1])))


def first_fit_decreasing(sizes: list[int], room: int) -> list[list[int]]:
    """Bins of item numbers. The tree's leaves hold each bin's free room and its inner nodes the
    larger of two children, so the first bin that fits is found in one walk down."""
    leaves = 1 << max(0, (len(sizes) - 1).bit_length())
    tree = [room] * (2 * leaves)
    bins: list[list[int]] = []
    for item in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        size, node = sizes[item], 1
        while node < leaves:
            node *= 2
            if tree[node] < size:
                node += 1
        if node - leaves == len(bins):
            bins.append([])
        bins[node - leaves].append(item)
        tree[node] -= size
        while node > 1:
            node //= 2
            larger = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == larger:
                break
            tree[node] = larger
    return bins


def fill_gaps(bins: list[list[tuple[int, int, int]]], room: int) -> list[list[tuple[int, int, int]]]:
    """Cuts up the emptiest bins to fill the others; pieces are (item, start, length). At most
    one bin stays short."""
    order = sorted(bins, key=lambda b: -sum(p[2] for p in b))
    load = [sum(p[2] for p in b) for b in order]
    taker, giver = 0, len(order) - 1
    while taker < giver:
        gap = room - load[taker]
        if not gap:
            taker += 1
            continue
        item, start, length = order[giver].pop()
        moved = min(gap, length)
        order[taker].append((item, start + length - moved, moved))
        if moved < length:
            order[giver].append((item, start, length - moved))
        load[taker] += moved
        load[giver] -= moved
        if not load[giver]:
            giver -= 1
    return [b for b in order if b]


def pack_sizes(sizes: list[int], room: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of (item, start, length) that hold every position of every item once."""
    whole = [[(i, at, room)] for i, n in enumerate(sizes) for at in range(0, n - n % room, room)]
    rest = [i for i, n in enumerate(sizes) if n % room]
    found = first_fit_decreasing([sizes[i] % room for i in rest], room) if rest else []
    open_bins = [[(rest[k], sizes[rest[k]] - sizes[rest[k]] % room, sizes[rest[k]] % room) for k in b] for b in found]
    return whole + fill_gaps(open_bins, room)


def pack(
    docs: DataFrame,
    length: int = LENGTH,
    closing: int = CLOSING,
    tokenizer: str | None = None,
    group_bytes: int = GROUP_BYTES,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per piece, with its ids as little-endian unsigned 32-bit numbers."""
    total = docs.agg(F.sum(F.octet_length(text_column) + 1)).first()[0] or 0
    groups = max(1, math.ceil(total / group_bytes))
    coded = tokenized(docs, closing, tokenizer or tokens.tokenizer_path(), id_column, text_column)

    def work(table: pa.Table) -> pa.Table:
        group = table.column("g")[0].as_py()
        kind = f"<u{table.column('width')[0].as_py()}"
        order = table.sort_by([("doc_id", "ascending"), ("ids", "ascending")])
        ids = [np.frombuffer(b, kind) for b in order.column("ids").to_pylist()]
        names = order.column("doc_id").to_pylist()
        out: list[tuple] = []
        for number, sequence in enumerate(pack_sizes([len(x) for x in ids], length)):
            offset = 0
            for item, start, n in sequence:
                piece = ids[item][start : start + n].astype("<u4").tobytes()
                out.append((names[item], start, n, piece, len(ids[item]), (group << 32) + number, offset))
                offset += n
        kinds = [order.schema.field("doc_id").type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        fields = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
        columns = list(zip(*out)) if out else [()] * len(fields)
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], fields)

    grouped = coded.withColumn("g", F.floor(F.rand(SEED) * groups).cast("long"))
    tasks = task_count(docs.sparkSession, groups, TASK_GROUPS, SMALL_TASK_GROUPS)
    kind = coded.schema["doc_id"].dataType.simpleString()
    return grouped.repartition(tasks, "g").groupBy("g").applyInArrow(work, f"doc_id {kind}, {PIECES}")


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    return digest(pack(spark.read.parquet(f"{folder}/documents.parquet")))


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
