"""Very many small files in a mounted folder (``file:``), made and read by tasks without Hadoop's file system.

Hadoop starts a process for the permissions of each file and folder that it makes there, the driver commits and
lists them one by one, and a scan has a task for every few of them.
"""

from __future__ import annotations

import math
import os
import re
import sys
import unicodedata
import uuid
from collections.abc import Callable, Iterator, Sequence
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import storage

# Workers get the functions of this module themselves, so they need not find the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Folders that a reading task takes on, where there are more than a shuffle has partitions.
FOLDERS_PER_TASK = 2048
# Bytes that are read at once, and bytes and rows of one batch of records.
READ_BYTES = 4 * 1024 * 1024
BATCH_ROWS = 2000

# With this on, Spark deletes the files of an execution's shuffles when it ends, and not when the driver collects garbage.
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_HADOOP_LOCAL = (None, "org.apache.hadoop.fs.LocalFileSystem", "org.apache.hadoop.fs.RawLocalFileSystem")
# What Spark escapes in the name of a partition's folder, what Hadoop takes for a pattern, and files that Spark would unpack.
_ESCAPED = re.compile("[\x01-\x1f\"#%'*/:=?\\\\\x7f{\\[\\]^]")
_PATTERN = re.compile(r"[{}\[\]*?\\]")
_PACKED = (".gz", ".bz2", ".deflate", ".lz4", ".snappy", ".zst")


def local_path(spark: SparkSession, path: str) -> str | None:
    """The plain path of a folder that is, or would be, in a mounted file system; nothing for any other."""
    fs, p = storage._path(spark, path)
    if fs.getUri().getScheme() != "file" or spark._jsc.hadoopConfiguration().get("fs.file.impl") not in _HADOOP_LOCAL:
        return None
    return fs.makeQualified(p).toUri().getPath()


def folder_name(column: str, value: str) -> str:
    """The name that Spark gives to a partition's folder."""
    return "=".join(_ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", x) for x in (column, value))


def file_uri(path: str) -> str:
    """The name that Spark's readers give to a file."""

    def encoded(c: str) -> str:
        kept = not c.isascii() and unicodedata.category(c) not in ("Zs", "Zl", "Zp", "Cc")
        return c if kept else quote(c, safe="/!$&'()*+,;=:@~", errors="replace")

    return "file:" + "".join(map(encoded, path))


def _writer(root: str, column: str, name: str, header: bytes, umask: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Files are filled in a folder of this attempt and renamed, so one that broke off leaves none in part."""
        task = TaskContext.get()
        file, attempt = f"part-{task.partitionId():05d}-{name}.c000.csv", f"{root}/_attempts/{task.taskAttemptId()}"
        key, stream, files = None, None, 0

        def finish() -> None:
            stream.close()
            folder = f"{root}/{folder_name(column, key)}"
            try:
                os.mkdir(folder)
            except FileExistsError:  # a large key has files of several tasks
                pass
            os.rename(f"{attempt}/{file}", f"{folder}/{file}")

        before = os.umask(umask)
        try:
            os.mkdir(attempt)
            for batch in batches:
                keys, lines = batch.column(0).to_pylist(), batch.column(1)
                width = np.int64 if pa.types.is_large_binary(lines.type) else np.int32
                ends = np.frombuffer(lines.buffers()[1], width)[lines.offset : lines.offset + len(lines) + 1]
                data = memoryview(lines.buffers()[2] or b"")
                start = 0
                # Rows of a key stand together, and so do their bytes.
                for i in range(1, len(keys) + 1):
                    if i < len(keys) and keys[i] == keys[start]:
                        continue
                    if stream is None or keys[start] != key:
                        if stream is not None:
                            finish()
                        key, stream, files = keys[start], open(f"{attempt}/{file}", "wb"), files + 1
                        stream.write(header)
                    stream.write(data[ends[start] : ends[i]])
                    start = i
            if stream is not None:
                finish()
            os.rmdir(attempt)
        finally:
            if stream is not None:
                stream.close()
            os.umask(before)
        yield pa.RecordBatch.from_pydict({"files": pa.array([files], pa.int64())})

    return write


def write_by_key(lines: DataFrame, out: str, column: str, header: str) -> None:
    """Writes the second column, bytes of whole lines, into ``{column}={first column}`` folders below ``out``, one file for
    each value and task. The rows of a task are in the order of the first column. The folder is
    written aside and replaces the older one when it is whole."""
    spark = lines.sparkSession
    fs, p = storage._path(spark, out)
    place, name = fs.makeQualified(p), uuid.uuid4()
    making = f"{place.getParent().toString().rstrip('/')}/.{place.getName().replace('=', '-')}.{name.hex}"
    umask = spark._jvm.org.apache.hadoop.fs.permission.FsPermission.getUMask(spark._jsc.hadoopConfiguration()).toShort()
    root, free = local_path(spark, making), spark.conf.get(_FREE_SHUFFLES, "false")
    fs.mkdirs(storage._path(spark, f"{making}/_attempts")[1])
    try:
        write = _writer(root, column, str(name), header.encode(), umask)
        spark.conf.set(_FREE_SHUFFLES, "true")
        try:
            lines.mapInArrow(write, "files long").agg(F.sum("files")).collect()
        finally:
            spark.conf.set(_FREE_SHUFFLES, free)
        storage.delete(spark, f"{making}/_attempts")
        open(f"{root}/_SUCCESS", "wb").close()
        storage.move(spark, making, place.toString())
    except BaseException:
        storage.delete(spark, making)
        raise
    spark.catalog.refreshByPath(out)


def _hidden(name: str) -> bool:
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


def _names(root: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            found: list[bytes] = []
            with os.scandir(os.fsencode(root)) as entries:
                for entry in entries:
                    found.append(entry.name)
                    if len(found) == BATCH_ROWS:
                        yield pa.RecordBatch.from_pydict({"entry": pa.array(found, pa.binary())})
                        found = []
            yield pa.RecordBatch.from_pydict({"entry": pa.array(found, pa.binary())})

    return names


def _files(path: str, name: str) -> Iterator[str]:
    """The files that Spark would find at a path."""
    if _hidden(name):
        return
    if not os.path.isdir(path):
        yield path
        return
    with os.scandir(path) as entries:
        below = [e.name for e in entries]
    for n in below:
        yield from _files(f"{path}/{n}", n)


def _records(path: str) -> Iterator[list[bytes]]:
    """The records of a CSV file, some at once. A line break inside quotes is part of its record."""
    if path.endswith(_PACKED):
        raise ValueError(f"{path}: packed files are not read with given columns")
    with open(path, "rb", buffering=0) as stream:
        begun: list[bytes] = []  # pieces of a record that goes on in the next block
        inside = False
        while block := stream.read(READ_BYTES):
            if begun or inside or b'"' in block:
                codes = np.frombuffer(block, np.uint8)
                quoted = np.logical_xor.accumulate(codes == 34) ^ inside
                ends, inside = np.flatnonzero((codes == 10) & ~quoted), bool(quoted[-1])
                if not len(ends):
                    begun.append(block)
                    continue
                starts = [0, *(ends[:-1] + 1).tolist()]
                found = [block[a:b] for a, b in zip(starts, ends.tolist(), strict=True)]
                found[0] = b"".join((*begun, found[0]))
                begun = [block[ends[-1] + 1 :]]
            else:
                *found, last = block.split(b"\n")
                begun = [last] if last else []
            yield found
        if last := b"".join(begun):
            yield [last]


def _reader(root: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files: list[str] = []
        rows: list[int] = []
        records: list[bytes] = []
        size = 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(
                {"file": pa.array(files, pa.string()), "row": pa.array(rows, pa.int64()), "record": pa.array(records, pa.binary())}
            )

        for entries in batches:
            for name in map(os.fsdecode, entries.column(0).to_pylist()):
                for path in _files(f"{root}/{name}", name):
                    uri, row = file_uri(path), -1  # the first record is the header
                    for found in _records(path):
                        for record in found:
                            if not record:
                                continue
                            if row >= 0:
                                files.append(uri)
                                rows.append(row)
                                records.append(record)
                                size += len(record)
                            row += 1
                            if size >= READ_BYTES or len(rows) == BATCH_ROWS:
                                yield batch()
                                files, rows, records, size = [], [], [], 0
        yield batch()

    return read


def readable(spark: SparkSession, folder: str) -> str | None:
    """The plain path of a mounted folder that is there, and whose name is no pattern."""
    if _PATTERN.search(folder) or not (path := local_path(spark, folder)) or not os.path.isdir(path):
        return None
    return path


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``file``, ``row`` (a rank in it) and ``record`` (bytes) of the CSV files below a mounted folder, without their headers.

    One task lists the folder, and many read what stands in it, each file by one of them.
    """
    with os.scandir(path) as entries:
        folders = sum(1 for _ in entries)
    tasks = max(math.ceil(folders / FOLDERS_PER_TASK), min(folders, int(spark.conf.get("spark.sql.shuffle.partitions"))), 1)
    listed = spark.range(0, 1, 1, 1).mapInArrow(_names(path), "entry binary")
    return listed.repartition(tasks, "entry").mapInArrow(_reader(path), "file string, row long, record binary")


def as_lines(columns: Sequence[str], options: dict[str, str]) -> Column:
    """The bytes of a row's line, as Spark's writer has them."""
    return F.concat(F.to_csv(F.struct(*(F.col(c) for c in columns)), options), F.lit("\n")).cast("binary")
