"""File listings, manifests, and loads of listed files."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Most folders of a manifest that get a range of files each; more share one.
_MOST_RANGES = 100

_MANIFEST = T.StructType(
    [
        T.StructField(
            "entries",
            T.ArrayType(
                T.StructType(
                    [T.StructField("url", T.StringType()), T.StructField("length", T.LongType())]
                )
            ),
        )
    ]
)


def list_files(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """Path, modification time and length of the files under a folder.

    The file contents are never selected, so no file is opened.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(root).select("path", "modificationTime", "length")


def write_manifest(files: DataFrame, out: str) -> None:
    """Writes ``{"entries": [{"url", "length"}]}``, one such line per listed file, in few files and in
    this form at every size."""
    entry = F.struct(F.col("path").alias("url"), "length")
    lines = files.select(F.array(entry).alias("entries")).hint("rebalance")
    lines.write.mode("overwrite").json(out)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """``url`` and ``length`` of a manifest's entries. It may be one document over several lines, or one
    in each line."""
    head = spark.read.text(path).filter(F.trim("value") != "").first()
    try:
        lines = head is not None and json.loads(head["value"]) is not None
    except ValueError:
        lines = False
    rows = spark.read.schema(_MANIFEST).option("multiLine", not lines).option("mode", "FAILFAST").json(path)
    return rows.select(F.explode("entries").alias("e")).select("e.url", "e.length")


def _place(path: Column) -> Column:
    """A path in one form: its scheme and authority, if any, with single slashes."""
    return F.regexp_replace(F.regexp_replace(path, "/{2,}", "/"), "^file:", "")


def _decoded(path: Column) -> Column:
    """The plain form of a path as the reader's metadata has it."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def _listed(spark: SparkSession, files: DataFrame) -> tuple[DataFrame, list[str], Column]:
    """The listed files as the reader names them, their folders, and a condition on ``_file`` that Spark's
    listing can use: between the first and the last one of a folder."""
    urls = files.select("url", _place(F.col("url")).alias("_place")).dropDuplicates(["_place"])
    parents = urls.select(F.regexp_extract("url", "^(.*/)[^/]*$", 1).alias("p")).distinct()
    # As many as there are folders: Spark's reader takes these from the driver.
    folders = sorted(r["p"] for r in parents.collect())
    if not folders:
        return urls.withColumn("_file", F.lit("")), [], F.lit(False)
    there = spark.read.format("binaryFile").load(folders).select(F.col("_metadata.file_path").alias("_file"))
    there = there.withColumn("_at", _place(_decoded(F.col("_file"))))
    found = urls.join(there, F.col("_place") == F.col("_at"), "left")
    ranges = (
        found.groupBy(F.regexp_extract("_place", "^(.*/)[^/]*$", 1).alias("p"))
        .agg(F.min("_file").alias("first"), F.max("_file").alias("last"), F.min(F.when(F.col("_file").isNull(), F.col("url"))).alias("missing"))
        .collect()
    )
    for r in ranges:
        if r["missing"] is not None:
            raise FileNotFoundError(f"a manifest lists {r['missing']}, which is not there")
    if len(ranges) > _MOST_RANGES:
        spans = [(min(r["first"] for r in ranges), max(r["last"] for r in ranges))]
    else:
        spans = [(r["first"], r["last"]) for r in ranges]
    return found, folders, reduce(Column.__or__, [F.col("_file").between(*span) for span in spans])


def load_full(spark: SparkSession, files: DataFrame, schema: T.StructType, fmt: str = "json", **options) -> DataFrame:
    """A full load of the files that a manifest lists (``url``), with declared columns. A malformed
    record fails it, and a listed file that is not there does so at once.

    The folders are read, without the files before the first and after the last listed one, and
    rows of other files in between are dropped by a join. JSON lines of such files are not parsed; in
    other formats a malformed one fails the load too.
    """
    found, folders, within = _listed(spark, files)
    if not folders:
        return spark.createDataFrame([], schema)
    lines = fmt == "json" and str(options.get("multiLine", "false")).lower() != "true"
    if lines:
        rows = spark.read.text(folders).select("value", F.col("_metadata.file_path").alias("_file"))
    else:
        rows = spark.read.schema(schema).format(fmt).options(mode="FAILFAST", **options).load(folders)
        rows = rows.select("*", F.col("_metadata.file_path").alias("_file"))
    rows = rows.filter(within).join(found.select(F.col("_file").alias("_named")), F.col("_file") == F.col("_named"), "left_semi")
    if not lines:
        return rows.drop("_file")
    parsed = F.from_json("value", schema, {"mode": "FAILFAST", **{k: str(v) for k, v in options.items()}})
    return rows.filter(F.trim("value") != "").select(parsed.alias("r")).select("r.*")


def load_cdc(spark: SparkSession, files: DataFrame, schema: T.StructType, fmt: str = "json", **options) -> DataFrame:
    """The same for change files, which carry an ``op`` column besides the declared ones."""
    if "op" not in schema.fieldNames():
        schema = T.StructType([*schema.fields, T.StructField("op", T.StringType(), True)])
    return load_full(spark, files, schema, fmt, **options)
