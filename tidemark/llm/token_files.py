"""Token ids in binary files, and back.

Ids are numbered anew by how often all documents use them, the commonest first, and written in
byte-aligned variable length: one control byte tells the lengths of four numbers (1 to 4 bytes
each), and control bytes stand apart from the numbers' bytes. Reading looks the control bytes up
in a table of lengths and gathers the numbers with numpy.

Files lie in ascending id order in the shared folder, a bounded number of ids each, and are
written under another name first, so a task that runs again replaces its file whole. A task sorts one range
of documents and cuts it into files as it goes. Where a file begins is summed up in three levels (files of a range, ranges of a
block, blocks), so what one task sees of the whole is a row for each ``BLOCK_RANGES`` ranges.

Defined results: a null or empty text is just the closing id; null ids come first; repeated rows
are written each, those of one id by the checksum of their token ids and then as they were read, and a range may end
between them; document ids are integers (others are refused); a very long text makes a longer file; an
empty table gives no files and no rows; other columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tidemark.llm import tokens
from tidemark.llm.common import map_arrow, prepare, task_count
from tidemark.llm.packing import tokenized
from tidemark.session import scratch_dir

CLOSING = 2
# Ids of one file (a longer document makes a longer file).
FILE_IDS = 4_000_000
# Bytes of the ids in one sorted range at most, and at least where cores are idle; files that one task reads, likewise.
RANGE_BYTES, SMALL_RANGE_BYTES = 256_000_000, 16_000_000
READ_FILES, SMALL_READ_FILES = 16, 2
BLOCK_RANGES = 1024
MAGIC = b"SVB1"

_LENGTHS = np.array([[(c >> shift & 3) + 1 for shift in (0, 2, 4, 6)] for c in range(256)], np.uint8)


def encode(numbers: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit numbers."""
    numbers = numbers.astype("<u4")
    extra = (numbers > 0xFF).astype(np.uint8) + (numbers > 0xFFFF) + (numbers > 0xFFFFFF)
    codes = np.zeros(-(-len(numbers) // 4) * 4, np.uint8)
    codes[: len(numbers)] = extra
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    data = numbers.view(np.uint8).reshape(-1, 4)[np.arange(4) <= extra[:, None]]
    return control.astype(np.uint8).tobytes(), data.tobytes()


def decode(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` numbers of these control and data bytes."""
    lengths = _LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)
    first = np.cumsum(lengths) - lengths
    out = raw[first].astype(np.uint32)
    for k in (1, 2, 3):
        longer = lengths > k
        if longer.any():
            out[longer] |= raw[first[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def file_bytes(doc_ids: list[int | None], counts: np.ndarray, numbers: np.ndarray) -> bytes:
    """One file: the head, which ids are null, the ids, their counts, control and data bytes."""
    control, data = encode(numbers)
    return b"".join(
        (
            MAGIC,
            struct.pack("<QQQ", len(doc_ids), len(numbers), len(control)),
            np.array([d is None for d in doc_ids], np.uint8).tobytes(),
            np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
            counts.astype("<i8").tobytes(),
            control,
            data,
        )
    )


def parse_file(raw: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    docs, n, n_control = struct.unpack_from("<QQQ", raw, 4)
    if raw[:4] != MAGIC:
        raise ValueError("not a file of token ids")
    at = 28
    null = np.frombuffer(raw, np.uint8, docs, at)
    names = np.frombuffer(raw, "<i8", docs, at + docs)
    counts = np.frombuffer(raw, "<i8", docs, at + 9 * docs)
    at += 17 * docs
    numbers = decode(raw[at : at + n_control], raw[at + n_control :], n)
    return [None if z else int(d) for z, d in zip(null, names)], counts, numbers


def write_ids(
    docs: DataFrame,
    path: str,
    closing: int = CLOSING,
    tokenizer: str | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> None:
    """Writes ``path/ids`` (the files), ``path/files`` (a row per file) and ``path/ranks`` (a row
    per id in use)."""
    spark = docs.sparkSession
    if not isinstance(docs.schema[id_column].dataType, IntegralType):
        raise TypeError(f"{id_column} must hold integers")
    docs = docs.withColumn(id_column, F.col(id_column).cast("long"))
    coded = tokenized(docs, closing, tokenizer or tokens.tokenizer_path(), id_column, text_column)
    plain = scratch_dir(spark, "token-ids")
    coded.write.option("compression", "zstd").parquet(plain)
    coded = spark.read.schema(coded.schema).parquet(plain)

    def count(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        kind = f"<u{batch.column(1)[0].as_py()}"
        joined = np.frombuffer(b"".join(batch.column(0).to_pylist()), kind)
        used = np.bincount(joined)
        ids = np.flatnonzero(used)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(used[ids], pa.int64())], ["id", "n"])

    used = map_arrow(coded, ["ids", "width"], count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    # At most one row per id of the vocabulary.
    order = [r.id for r in used.orderBy(F.desc("n"), "id").collect()]
    spark.createDataFrame(list(enumerate(order)), "rank long, id long").coalesce(1).write.parquet(f"{path}/ranks")
    rank_of = np.zeros(max(order, default=0) + 1, np.uint32)
    rank_of[order] = np.arange(len(order))
    table = spark.sparkContext.broadcast(rank_of)
    target = f"{path}/ids"

    def save(number: int, names: list, counts: list[int], parts: list[bytes], kind: str) -> tuple:
        numbers = table.value[np.frombuffer(b"".join(parts), kind)]
        fs, folder = pafs.FileSystem.from_uri(target)
        fs.create_dir(folder, recursive=True)
        task = TaskContext.get()
        name = f"part-{task.partitionId():06d}-{number:06d}.svb"
        draft = f"{folder}/.{name}-{uuid.uuid4().hex}"
        with fs.open_output_stream(draft) as out:
            out.write(file_bytes(names, np.array(counts), numbers))
        fs.move(draft, f"{folder}/{name}")
        return task.partitionId(), number, name, len(names), len(numbers)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, names, counts, parts, size, kind = [], [], [], [], 0, "<u4"
        for batch in batches:
            for name, ids, width in zip(*(c.to_pylist() for c in batch.columns)):
                kind = f"<u{width}"
                names.append(name)
                parts.append(ids)
                counts.append(len(ids) // width)
                size += counts[-1]
                if size >= FILE_IDS:
                    rows.append(save(len(rows), names, counts, parts, kind))
                    names, counts, parts, size = [], [], [], 0
        if names:
            rows.append(save(len(rows), names, counts, parts, kind))
        if rows:
            columns = [pa.array(c) for c in zip(*rows)]
            yield pa.RecordBatch.from_arrays(columns, ["part", "number", "name", "docs", "ids"])

    size = coded.agg(F.sum(F.length("ids"))).first()[0] or 0
    prepare(spark)
    # The place in the stored table parts rows of one id, copies too, and is the same when a task runs again.
    order = ["doc_id", "check", "place"]
    files = (
        coded.withColumns({"check": F.crc32("ids"), "place": F.monotonically_increasing_id()})
        .repartitionByRange(task_count(spark, size, RANGE_BYTES, SMALL_RANGE_BYTES), *order)
        .sortWithinPartitions(*order)
        .select("doc_id", "ids", "width")
        .mapInArrow(write, "part long, number long, name string, docs long, ids long")
    )
    files.write.parquet(f"{path}/files")


def begins(files: DataFrame) -> DataFrame:
    """``name`` of every file and ``begin``, the ids in all files before it."""

    def before(level: DataFrame, order: str, *within: str) -> DataFrame:
        window = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return level.withColumn("before", F.coalesce(F.sum("ids").over(window), F.lit(0)))

    listed = files.withColumn("block", F.expr(f"part DIV {BLOCK_RANGES}"))
    parts = listed.groupBy("block", "part").agg(F.sum("ids").alias("ids"))
    blocks = parts.groupBy("block").agg(F.sum("ids").alias("ids"))
    of_block = before(blocks, "block").select("block", F.col("before").alias("b"))
    of_part = before(parts, "part", "block").select("block", "part", F.col("before").alias("p"))
    joined = before(listed, "number", "part").join(of_part, ["block", "part"]).join(of_block, "block")
    return joined.select("name", (F.col("before") + F.col("p") + F.col("b")).alias("begin"))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it) and ``ids`` (little-endian unsigned
    32-bit numbers) of every document in the files."""
    # A row per id of the vocabulary at most.
    order = np.array([r.id for r in spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()], np.uint32)
    table = spark.sparkContext.broadcast(order)
    files = spark.read.parquet(f"{path}/files")
    listed = begins(files)
    target = f"{path}/ids"

    def read(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        fs, folder = pafs.FileSystem.from_uri(target)
        for name, begin in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            with fs.open_input_stream(f"{folder}/{name}") as source:
                names, counts, numbers = parse_file(source.read())
            ids = table.value[numbers].astype("<u4")
            ends = np.cumsum(counts)
            for lo in range(0, len(names), 2000):
                some = range(lo, min(lo + 2000, len(names)))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([names[i] for i in some], pa.int64()),
                        pa.array([begin + int(ends[i] - counts[i]) for i in some], pa.int64()),
                        pa.array([ids[ends[i] - counts[i] : ends[i]].tobytes() for i in some], pa.binary()),
                    ],
                    ["doc_id", "start", "ids"],
                )

    dealt = task_count(spark, files.count(), READ_FILES, SMALL_READ_FILES)
    return map_arrow(listed.repartition(dealt, "name"), ["name", "begin"], read, "doc_id long, start long, ids binary")


def op4_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_dir(spark, "token-files")
    write_ids(spark.read.parquet(f"{folder}/documents.parquet"), path)
    return read_ids(spark, path).select(
        "doc_id",
        "start",
        F.expr("CAST(length(ids) DIV 4 AS BIGINT)").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
