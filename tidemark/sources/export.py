"""Exports: one file set per key, and option-driven CSV or Parquet unloads."""

from __future__ import annotations

import logging
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.spread import spread
from tidemark.session import scratch_dir
from tidemark.sources import mounted, storage
from tidemark.sources.files import list_files, write_manifest

log = logging.getLogger(__name__)

# Files per task of an export, in a mounted folder and elsewhere, and bytes of text.
MOUNTED_FILES_PER_TASK = 2048
FILES_PER_TASK = 64
BYTES_PER_TASK = 512 * 1024 * 1024
# Fixed value: timestamps as text, with their microseconds.
TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
# White space around a text is part of it; Spark's writer would drop it.
_TEXT = {
    "escape": '"', "timestampFormat": TIMESTAMP_TEXT, "timestampNTZFormat": TIMESTAMP_TEXT,
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}
# Where Spark's writer exports to a mounted folder, a file is made without a checksum file beside it.
# Hadoop starts a process for the permissions of each, which takes longer than filling it.
_MANY_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}
# The folder of an empty key.
EMPTY_KEY = "__EMPTY__"
_CSV_ONLY = ("delimiter", "header", "addquotes")


# Most bytes of a value as text, by type; text itself and types that are not here are measured.
_WIDTHS = {
    T.BooleanType: 5, T.ByteType: 4, T.ShortType: 6, T.IntegerType: 11, T.LongType: 20, T.FloatType: 16, T.DoubleType: 26,
    T.DateType: 16, T.TimestampType: 40, T.TimestampNTZType: 40, T.DecimalType: 50,
}


def _most_bytes(schema: T.StructType) -> Column:
    """At least as many bytes as a row has when it is written, without forming its text: a text may be
    quoted, and each of its quotes doubled."""
    fixed = sum(_WIDTHS.get(type(f.dataType), 0) + 1 for f in schema.fields)
    texts = [F.col(f.name).cast("string") for f in schema.fields if type(f.dataType) not in _WIDTHS]
    return sum((F.coalesce(F.octet_length(t).cast("long") * 2 + 2, F.lit(0)) for t in texts), F.lit(fixed).cast("long"))


def _header_bytes(columns: Sequence[str]) -> int:
    def written(name: str) -> int:
        quoted = any(c in name for c in ',"\r\n') or name != name.strip()
        return len(name.encode()) + (2 + name.count('"') if quoted else 0)

    return sum(written(c) + 1 for c in columns)


def _filed(rows: DataFrame, key: str, large: DataFrame, room: int, order_by: Sequence[str], text: Column) -> tuple[DataFrame, str]:
    """The rows of large keys with ``_file``, their file's number, such that no file has more than
    ``room`` bytes unless it is a single row; and the folder that holds them meanwhile.

    Bytes are summed up along the rows of a key in an input partition, and along its partitions, so a
    hot key, or copies of one row, take part in as many tasks as there are partitions. A file takes the rows
    that begin in its share of the sum. Its last row may end beyond, so shares are shorter than
    the room by the key's longest row; rows of over half the room are files of their own.
    """
    spark, path = rows.sparkSession, scratch_dir(rows.sparkSession, "large-rows")
    parted = rows.withColumn("_part", F.spark_partition_id())
    single = F.col("_bytes") * 2 > room
    along = Window.partitionBy(key, "_part").orderBy(*order_by, "_bytes").rowsBetween(Window.unboundedPreceding, 0)
    (
        parted.join(large, F.col(key) == F.col("_large"))
        .withColumn("_bytes", text)
        .withColumn("_end", F.sum(F.when(single, 0).otherwise(F.col("_bytes"))).over(along))
        .withColumn("_singles", F.sum(single.cast("int")).over(along))
        .select(*rows.columns, "_part", "_bytes", "_end", "_singles")
        .write.parquet(path)
    )
    stored = spark.read.parquet(path)
    parts = stored.groupBy(F.col(key).alias("_k"), F.col("_part").alias("_p")).agg(
        F.max("_end").alias("end"), F.max("_singles").alias("singles"), F.max(F.when(~single, F.col("_bytes"))).alias("longest"),
        F.sum("_bytes").alias("bytes"),
    )
    of_key = Window.partitionBy("_k")
    before = of_key.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    share = F.lit(room) - F.coalesce(F.max("longest").over(of_key), F.lit(0))
    shares = F.ceil(F.sum("end").over(of_key) / share)
    # As many rows as there are pairs of a large key and an input partition.
    offsets = parts.select(
        "_k",
        "_p",
        F.coalesce(F.sum("end").over(before), F.lit(0)).alias("_before"),
        F.coalesce(F.sum("singles").over(before), F.lit(0)).alias("_singles_before"),
        share.alias("_share"),
        shares.alias("_shares"),
        (F.sum("bytes").over(of_key) <= room).alias("_fits"),
    )
    number = F.when(F.col("_fits"), 0).when(single, F.col("_shares") + F.col("_singles_before") + F.col("_singles") - 1)
    number = number.otherwise(F.floor((F.col("_before") + F.col("_end") - F.col("_bytes")) / F.col("_share")))
    joined = stored.join(offsets, (F.col(key) == F.col("_k")) & (F.col("_part") == F.col("_p")))
    return joined.select(*rows.columns, number.cast("long").alias("_file")), path


def _fits_mounted(df: DataFrame, out: str, folder: str) -> bool:
    """Whether an export goes to a mounted folder, with what ``mounted`` writes just as Spark's writer would. Types that
    Spark's writer may refuse, and names that it refuses, are left to it."""
    conf = df.sparkSession.conf
    return (
        mounted.local_path(df.sparkSession, out) is not None
        and all(type(f.dataType) in _WIDTHS or f.dataType == T.StringType() for f in df.schema.fields)
        and len({n.lower() for n in (*df.columns, folder)}) == len(df.columns) + 1
        and int(conf.get("spark.sql.files.maxRecordsPerFile")) <= 0
        and conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    )


def export_by_key(
    df: DataFrame,
    key: str,
    out: str,
    max_size_mb: float,
    folder: str = "key",
    order_by: Sequence[str] = (),
) -> None:
    """One CSV file with a header per key value, under ``{folder}={value}``, in a single job.

    Rows without a key are left out; an empty text key gets the folder of ``EMPTY_KEY``. A key whose file
    would have more than ``max_size_mb`` is spread over several files and tasks, none of which has more
    unless it is a single row. Every other key stays one file. Rows of a file are in the order of
    ``order_by``.
    """
    if folder in df.columns:
        raise ValueError(f"the table has a column {folder!r} already: name another folder column")
    spark = df.sparkSession
    rows = df.filter(F.col(key).isNotNull())
    room = max(1, int(max_size_mb * 1024 * 1024) - _header_bytes(df.columns))
    # Keys that may be above the cap, at most bytes / cap of them. Stored, so that Spark knows the
    # size and broadcasts it only within its threshold.
    sizes, path = Observation(), scratch_dir(spark, "large-keys")
    (
        rows.groupBy(F.col(key).alias("_large"))
        .agg(F.sum(_most_bytes(df.schema)).alias("_most"))
        .observe(sizes, F.count("*").alias("keys"), F.sum("_most").alias("bytes"), F.count_if(F.col("_most") > room).alias("large"))
        .filter(F.col("_most") > room)
        .select("_large")
        .write.parquet(path)
    )
    total, scratch = sizes.get, [path]
    files, most = total.get("keys") or 1, 1
    exported = rows.withColumn("_file", F.lit(0).cast("long"))
    if total.get("large"):
        large = spark.read.parquet(path)
        # Written as the writer will do it, for these keys only.
        text = F.octet_length(F.to_csv(F.struct(*(F.col(c) for c in df.columns)), dict(_TEXT))).cast("long") + 1
        filed, held = _filed(rows, key, large, room, order_by, text)
        scratch.append(held)
        counted = filed.groupBy(key).agg((F.max("_file") + 1).alias("n")).agg(F.sum("n").alias("n"), F.max("n").alias("most")).first()
        files, most = files + (counted["n"] or 0), max(most, counted["most"] or 1)
        small = exported.join(large, F.col(key) == F.col("_large"), "left_anti")
        exported = small.unionByName(filed)
    # A partition folder cannot be named by an empty text.
    name = F.when(F.col(key).cast("string") == "", EMPTY_KEY).otherwise(F.col(key).cast("string"))
    # Creating files takes longer than filling small ones, so tasks are sized by both. There are at least as
    # many as any key has files, so that these go to tasks of their own.
    in_mount = _fits_mounted(df, out, folder)
    per_task = MOUNTED_FILES_PER_TASK if in_mount else FILES_PER_TASK
    tasks = math.ceil(max(files / per_task, (total.get("bytes") or 0) / BYTES_PER_TASK, most))
    place = F.pmod(F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(1 << 30)) + F.col("_file"), F.lit(tasks))
    placed = (
        exported.withColumn(folder, name)
        .repartitionById(tasks, place.cast("int"))
        .select(*df.columns, folder)
        .sortWithinPartitions(folder, *order_by)
    )
    if in_mount:
        names = F.struct(*(F.lit(n).alias(f"_{i}") for i, n in enumerate(df.columns)))
        header = spark.range(1).select(F.to_csv(names, dict(_TEXT))).first()[0] + "\n"
        mounted.write_by_key(placed.select(folder, mounted.as_lines(df.columns, dict(_TEXT))), out, folder, header)
    else:
        placed.write.partitionBy(folder).mode("overwrite").options(header=True, **_TEXT, **_MANY_FILES).csv(out)
    for one in scratch:
        storage.delete(spark, one)


def _flag(value) -> bool:
    return str(value).strip().lower() in ("true", "on", "1", "yes")


def unload(
    df: DataFrame,
    out: str,
    data_format: str = "csv",
    *,
    delimiter: str | None = None,
    header=None,
    addquotes=None,
    compression: str | None = None,
    parallel="ON",
    breakup_threshold: int | str | None = None,
    file_prefix: str | None = None,
    file_extension: str | None = None,
    manifest: bool | str = False,
    custom_headers: Sequence[str] | None = None,
    order_by: Sequence[str] | None = None,
) -> int:
    """Writes a query result as CSV or Parquet files, replacing the folder, and returns the
    number of rows written, which is observed during the write.

    ``parallel="OFF"`` gives one file, written by one task, whatever the size: that is the caller's
    request. ``breakup_threshold`` caps the records per file in either case. With ``order_by`` the files hold consecutive ranges in order. ``manifest`` lists the files in
    ``{out}_manifest``.
    """
    if data_format not in ("csv", "parquet"):
        raise ValueError(f"data_format must be csv or parquet, not {data_format!r}")
    result = df.toDF(*custom_headers) if custom_headers else df
    if custom_headers and order_by:
        order_by = [result.columns[df.columns.index(n)] for n in order_by]
    files = None if _flag(parallel) else 1
    if order_by:
        # The range key ends in a number that spreads the rows of a very frequent value.
        result = result.withColumn("_spread", spread(result))
        result = result.repartitionByRange(*([files] if files else []), *order_by, "_spread").drop("_spread")
        result = result.sortWithinPartitions(*order_by)
    elif files:
        result = result.repartition(files)
    # The count sits in the stage that writes, whose finished tasks count once each.
    written = Observation()
    writer = result.observe(written, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
    if breakup_threshold:
        writer = writer.option("maxRecordsPerFile", int(breakup_threshold))
    if file_prefix:
        writer = writer.option("mapreduce.output.basename", file_prefix)
    if data_format == "parquet":
        given = {"delimiter": delimiter, "header": header, "addquotes": addquotes}
        for name in _CSV_ONLY:
            if given[name] is not None:
                log.warning("%s is ignored for Parquet", name)
        writer.option("compression", compression or "snappy").parquet(out)
    else:
        writer = writer.option("sep", delimiter or ",").options(header=_flag(header), **_TEXT)
        writer = writer.option("quoteAll", _flag(addquotes))
        if compression:
            writer = writer.option("compression", compression)
        if file_extension:
            writer = writer.option("extension", file_extension.lstrip("."))
        writer.csv(out)
    if _flag(manifest):
        write_manifest(list_files(df.sparkSession, out), f"{out.rstrip('/')}_manifest")
    return int(written.get.get("rows", 0))


def write_rejects(rejects: DataFrame, root: str, run_id: str) -> None:
    rejects.write.mode("overwrite").parquet(f"{root.rstrip('/')}/{run_id}")


def has_rejects(spark: SparkSession, root: str, run_id: str) -> bool:
    """Whether a run left rejected records."""
    path = f"{root.rstrip('/')}/{run_id}"
    return storage.exists(spark, path) and not spark.read.parquet(path).isEmpty()
