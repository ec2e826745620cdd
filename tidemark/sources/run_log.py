"""The append-only run log, in one folder per batch date, so that questions about a date read that
date."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.sources import storage

RUN_LOG = T.StructType(
    [
        T.StructField("step_id", T.LongType()),
        T.StructField("batch_dt", T.DateType()),
        T.StructField("status", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("message", T.StringType()),
        T.StructField("ts", T.TimestampType()),
    ]
)

_DATE = "batch_dt"
# The columns inside a date's folder.
_ROWS = T.StructType([f for f in RUN_LOG if f.name != _DATE])

# Statuses of an unload.
START = "START"
UNLOADED = "UNLOAD_TO_S3"
SKIPPED = "UNLOAD_SKIPPED"
END = "END"
FAILED = "FAILED"


def append_log(entries: DataFrame, path: str) -> None:
    """Adds entries to their dates' folders. A log of an earlier form, without such folders, is put into
    them first."""
    spark = entries.sparkSession
    if storage.exists(spark, path) and not storage.folders(spark, f"{path}/{_DATE}=*") and storage.complete(spark, path):
        dated = f"{path.rstrip('/')}_dated"
        spark.read.schema(RUN_LOG).parquet(path).write.mode("overwrite").partitionBy(_DATE).parquet(dated)
        storage.move(spark, dated, path)
    by_date = entries.select(*RUN_LOG.fieldNames()).hint("rebalance", _DATE)
    by_date.write.mode("append").partitionBy(_DATE).parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_LOG).parquet(path).select(*RUN_LOG.fieldNames())


def compact_log(spark: SparkSession, path: str, before: date) -> list[date]:
    """Puts the entries of each date below ``before`` that has several files into one, and returns
    these dates. No job should be writing to them any more; readers see the old or the new files."""
    closed = []
    for folder in storage.folders(spark, f"{path}/{_DATE}=????-??-??"):
        day = date.fromisoformat(folder.rsplit("=", 1)[1])
        if day < before and storage.count_files(spark, f"{folder}/*.parquet") > 1:
            making = f"{path.rstrip('/')}_compacting/{day}"
            rows = spark.read.schema(_ROWS).parquet(folder)
            rows.coalesce(1).sortWithinPartitions("ts").write.mode("overwrite").parquet(making)
            storage.move(spark, making, folder)
            closed.append(day)
    storage.delete(spark, f"{path.rstrip('/')}_compacting")
    return closed


def entry(
    step_id: int,
    batch_dt: date,
    status: str,
    rows: int | None = None,
    message: str | None = None,
    ts: datetime | None = None,
) -> tuple:
    return (step_id, batch_dt, status, rows, message, ts or datetime.now(timezone.utc))


def log_entries(spark: SparkSession, path: str, entries: list[tuple]) -> None:
    """The statuses of one job, which are a few, as one file."""
    append_log(spark.createDataFrame(entries, RUN_LOG).coalesce(1), path)
