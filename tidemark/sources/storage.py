"""Folder-level questions that the DataFrame API has no reader for."""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> bool:
    """Deletes a folder with all it holds; false when there was none."""
    fs, p = _path(spark, path)
    return fs.delete(p, True)


def move(spark: SparkSession, path: str, place: str) -> None:
    """Puts a folder in the place of another one, which is renamed first and deleted last, so that at
    every moment one of them is there whole. A move that broke off is mended by the next one."""
    fs, p = _path(spark, path)
    _, q = _path(spark, place)
    old = _aside(spark, place)
    restore(spark, place)
    fs.mkdirs(q.getParent())
    if fs.exists(q) and not fs.rename(q, old):
        raise OSError(f"cannot replace {place}")
    if not fs.rename(p, q):
        restore(spark, place)
        raise OSError(f"cannot move {path} to {place}")
    fs.delete(old, True)


def _aside(spark: SparkSession, place: str):
    """Where a folder is put while another one takes its place: beside it, hidden from readers."""
    parent, name = place.rstrip("/").rsplit("/", 1)
    return _path(spark, f"{parent}/.{name.replace('=', '-')}.replaced")[1]


def restore(spark: SparkSession, place: str) -> None:
    """Brings back what a move that broke off had taken from its place."""
    fs, q = _path(spark, place)
    old = _aside(spark, place)
    if fs.exists(old):
        if fs.exists(q):
            fs.delete(old, True)
        elif not fs.rename(old, q):
            raise OSError(f"cannot restore {place}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small file, which is there whole or not at all."""
    fs, p = _path(spark, path)
    _, making = _path(spark, f"{path}_making")
    out = fs.create(making, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    fs.delete(p, False)
    if not fs.rename(making, p):
        raise OSError(f"cannot write {path}")


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; nothing where there is no such file."""
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """Paths of the folders that a pattern matches."""
    fs, p = _path(spark, pattern)
    return sorted(s.getPath().toString() for s in fs.globStatus(p) or [] if s.isDirectory())


def complete_folders(spark: SparkSession, root: str) -> list[str]:
    """Names of the folders under the root whose write finished, that is, with a success
    marker. One listing entry per folder, however many files the folders hold."""
    fs, p = _path(spark, f"{root.rstrip('/')}/*/_SUCCESS")
    return sorted(status.getPath().getParent().getName() for status in fs.globStatus(p) or [])


def snapshot_dates(spark: SparkSession, root: str) -> list[date]:
    """Dates of the complete snapshots under the root, oldest first."""
    names = complete_folders(spark, root)
    return [date.fromisoformat(n) for n in names if re.fullmatch(r"\d{4}-\d{2}-\d{2}", n)]


def complete(spark: SparkSession, folder: str) -> bool:
    """Whether a write into the folder itself finished."""
    return exists(spark, f"{folder.rstrip('/')}/_SUCCESS")


def count_files(spark: SparkSession, pattern: str) -> int:
    fs, p = _path(spark, pattern)
    return sum(s.isFile() for s in fs.globStatus(p) or [])
