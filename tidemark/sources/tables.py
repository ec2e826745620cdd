"""Reading tables and dated snapshots, and writing snapshots."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidemark.sources import storage


def read_table(spark: SparkSession, fmt: str, options: dict) -> DataFrame:
    """A table through any connector, with the connector's own options."""
    options = dict(options)
    path = options.pop("path", None)
    return spark.read.format(fmt).options(**options).load(path)


def jdbc_split(options: dict, column: str, lower: int, upper: int, partitions: int) -> dict:
    """Options for a JDBC read in parallel ranges of a column, instead of on one connection."""
    return {
        **options,
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def snapshot_path(root: str, day: date) -> str:
    return f"{root.rstrip('/')}/{day.isoformat()}"


def read_snapshot(spark: SparkSession, root: str, day: date, schema: StructType) -> DataFrame:
    """One day's snapshot. The schema is given, so no file is opened to infer it."""
    reader = spark.read.schema(schema).option("recursiveFileLookup", True)
    return reader.parquet(snapshot_path(root, day))


def write_snapshot(df: DataFrame, root: str, day: date) -> DataFrame:
    """Writes a day's snapshot, replacing it, and returns it as read back from storage.

    Later steps start from the stored files: lost executors cost a re-read of the
    columns needed, never a second read of the source.
    """
    df.write.mode("overwrite").parquet(snapshot_path(root, day))
    return read_snapshot(df.sparkSession, root, day, df.schema)


def previous_date(spark: SparkSession, root: str, run_date: date) -> date:
    """The newest complete snapshot below the run date, so a re-run on a day is stable."""
    older = [d for d in storage.snapshot_dates(spark, root) if d < run_date]
    if not older:
        raise ValueError(f"no snapshot before {run_date} under {root}: run the initial load first")
    return older[-1]


def drop_old_snapshots(spark: SparkSession, root: str, keep: int = 2) -> list[date]:
    """Deletes all but the newest ``keep`` snapshots and returns the dates deleted."""
    dates = storage.snapshot_dates(spark, root)
    expired = dates[:-keep] if keep else dates
    for day in expired:
        storage.delete(spark, snapshot_path(root, day))
    return expired
