"""File listings as DataFrames: day filter, report file names, set checks."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.snapshots import only_left


def files_on(files: DataFrame, day: date, column: str = "modificationTime") -> DataFrame:
    """Files modified on a UTC day. A range on the column itself is pushed to the listing
    and does not depend on the session's time zone."""
    start = datetime.combine(day, time(), timezone.utc)
    return files.filter((F.col(column) >= F.lit(start)) & (F.col(column) < F.lit(start + timedelta(days=1))))


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def part_of(path: Column) -> Column:
    """What follows the last ``_`` of the file name; null where the name has none."""
    return F.when(F.contains(file_name(path), F.lit("_")), F.substring_index(path, "_", -1))


def base_path(path: Column) -> Column:
    """The path without its last ``_part``; unchanged where it has none."""
    return F.coalesce(F.left(path, F.length(path) - F.length(part_of(path)) - 1), path)


def _with_parts(files: DataFrame) -> DataFrame:
    """Adds ``base`` and ``parts``, the number of files that share the base.

    Counted by aggregation and joined back, with a condition that lets adaptive execution
    split a base with very many files: a window would bring them all to one task.
    """
    based = files.withColumn("base", base_path(F.col("path")))
    counts = based.groupBy(F.col("base").alias("_base")).agg(F.count(F.lit(1)).alias("parts"))
    return based.join(counts, F.col("base").eqNullSafe(F.col("_base"))).drop("_base")


def multipart_groups(files: DataFrame) -> DataFrame:
    """Bases that occur more than once, with their number of parts."""
    return (
        files.select(base_path(F.col("path")).alias("base"))
        .groupBy("base")
        .agg(F.count(F.lit(1)).alias("parts"))
        .filter("parts > 1")
    )


def normalize_file_names(files: DataFrame) -> DataFrame:
    """Adds ``name``: the base with its part number where there are several parts, else the
    base alone; ``.csv`` is added. Leading zeros go, any number of digits is fine."""
    part = F.regexp_replace(part_of(F.col("path")), r"^0+(?=.)", "")
    name = F.when(F.col("parts") > 1, F.concat_ws("_", file_name(F.col("base")), part)).otherwise(
        file_name(F.col("base"))
    )
    return _with_parts(files).withColumn("name", F.concat(name, F.lit(".csv"))).drop("base", "parts")


def files_reconcile(expected: DataFrame, present: DataFrame, name: str = "name") -> DataFrame:
    """Names whose counts differ: each expected name must be present exactly once.

    Empty when the sets agree. Blank names are ignored.
    """
    e = expected.select(name, F.lit(1).alias("e"), F.lit(0).alias("p"))
    p = present.select(name, F.lit(0).alias("e"), F.lit(1).alias("p"))
    return (
        e.union(p)
        .filter(F.trim(F.col(name)) != "")
        .groupBy(name)
        .agg(F.max("e").cast("long").alias("expected"), F.sum("p").alias("present"))
        .filter(F.col("expected") != F.col("present"))
    )


def require_same_files(expected: DataFrame, present: DataFrame, name: str = "name") -> None:
    """Raises when the two listings disagree."""
    wrong = files_reconcile(expected, present, name).limit(5).collect()
    if wrong:
        raise ValueError(f"file lists differ, for example at {[r[name] for r in wrong]}")


def files_missing(expected: DataFrame, present: DataFrame, name: str = "name") -> DataFrame:
    """Expected names that are not present."""
    return only_left(expected, present, [name])
