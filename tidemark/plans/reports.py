"""Report jobs: named queries exported per account, and the payload of each file."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.reports import report_metadata, report_path, report_payload
from tidemark.sources import mounted
from tidemark.sources.export import export_by_key

log = logging.getLogger(__name__)


def report_folder(spark: SparkSession, template: str, name: str, as_of: date) -> str:
    """The template filled in for one report, for the month before ``as_of``."""
    return spark.range(1).select(report_path(template, F.lit(name), F.lit(as_of))).first()[0]


def export_reports(
    spark: SparkSession,
    queries: Mapping[str, str],
    root: str,
    template: str,
    as_of: date,
    max_size_mb: float,
    account: str = "accountid",
    order_by: Sequence[str] = (),
) -> dict[str, str]:
    """Exports each named query per account and returns the folders written.

    A report without rows writes nothing. The reports are few and each is one
    distributed job, so they run one after the other.
    """
    written = {}
    for name, sql in queries.items():
        rows = spark.sql(sql)
        if rows.isEmpty():
            log.info("report %s has no rows", name)
            continue
        out = f"{root.rstrip('/')}/{report_folder(spark, template, name, as_of)}"
        export_by_key(rows, account, out, max_size_mb, order_by=order_by)
        written[name] = out
    return written


def read_report_files(spark: SparkSession, folder: str, columns: Sequence[str] | None = None) -> DataFrame:
    """The rows of exported files as text, with ``file`` (path) and ``line`` (a rank in it).

    Fields may hold line breaks, so a file is read whole by one task; the export's cap on a
    file's size bounds that. Without ``columns``, the ones that were exported, Spark takes them from a file,
    for which the driver looks at all files one by one. With them, tasks list and read a mounted folder; it holds
    no file then in the driver.
    """
    options = {"escape": '"'}
    reader = spark.read.options(header=True, recursiveFileLookup=True, multiLine=True, **options)
    if columns is not None:
        schema = T.StructType([T.StructField(n, T.StringType()) for n in columns])
        if path := mounted.readable(spark, folder):
            # Parsed as Spark's reader does it, but for the header and the ends of records.
            record = F.from_csv(F.col("record").cast("string"), ", ".join("`" + n.replace("`", "``") + "` string" for n in columns), options)
            line = F.struct(F.lit(0).cast("long").alias("file_block_start"), F.col("row").alias("col2"))
            rows = mounted.read_records(spark, path)
            return rows.select("file", line.alias("line"), record.alias("_record")).select("file", "line", "_record.*")
        reader = reader.schema(schema)
    rows = (
        reader.csv(folder)
        .select("*", "_metadata.file_path", "_metadata.file_block_start")
    )
    data = [n for n in rows.columns if n not in ("file_path", "file_block_start")]
    line = F.struct("file_block_start", F.monotonically_increasing_id())
    return rows.select(F.col("file_path").alias("file"), line.alias("line"), *data)


def report_payloads(
    spark: SparkSession, folder: str, name: str, as_of: date, columns: Sequence[str] | None = None
) -> DataFrame:
    """The payload of every exported file of a report. The report's name stands in the files'
    name, so the type comes from it."""
    meta = report_metadata(read_report_files(spark, folder, columns), "file", "line")
    return report_payload(meta, as_of, "file", F.lit(name))
