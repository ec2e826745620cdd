"""Registering lake folders as tables, and rewriting a table's files."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from datetime import datetime, timedelta
from fnmatch import translate
from functools import reduce
from itertools import islice

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tidemark.functions.schema import wider
from tidemark.functions.spread import spread
from tidemark.sources import storage
from tidemark.sources.files import list_files

# Folder suffixes of a staging table's two loads.
STAGING_LOADS = ("_FullLoad", "_delta")
# Listed paths, and partitions of a statement, that the driver holds at once.
LISTED_AT_ONCE, PARTITIONS_AT_ONCE = 1000, 200
# Table properties: the prefix it was registered under, and its newest file's time then.
_MARK, _SEEN = "tidemark.prefix", "tidemark.newest"


def layer_paths(root: str, tables: Sequence[str], layer: str) -> dict[str, list[str]]:
    """Folders of a layer's tables, by load. The staging layer keeps full and change loads in
    separate folders; register each under its own prefix, since their columns differ."""
    root = root.rstrip("/")
    if layer == "staging":
        return {load: [f"{root}/{t}{load}" for t in tables] for load in STAGING_LOADS}
    if layer in ("bronze", "silver", "gold"):
        return {"": [f"{root}/{t.lower()}" for t in tables]}
    raise ValueError(f"layer must be staging, bronze, silver or gold, not {layer!r}")


def _pattern(glob: str) -> str:
    """A glob pattern as a regular expression of Java."""
    return translate(glob).replace(r"\Z", r"\z")


def _excluded(path: Column, exclude: Sequence[str]) -> Column:
    """Whether a file's path or name matches one of the glob patterns."""
    name = F.substring_index(path, "/", -1)
    patterns = [F.lit(_pattern(p)) for p in exclude]
    return reduce(Column.__or__, [F.regexp_like(text, p) for p in patterns for text in (path, name)], F.lit(False))


def _schema(spark: SparkSession, path: str, new: DataFrame | None, since: datetime | None) -> StructType:
    """The merged schema of a folder, of its files after a time, or of listed files, so many of
    which at a time that the driver never holds all of their paths."""
    reader = spark.read.option("mergeSchema", True)
    if new is not None:
        fields: dict[str, StructField] = {}
        for block in _blocks(new.select("path").toLocalIterator(), LISTED_AT_ONCE):
            for field in reader.option("basePath", path).parquet(*(r["path"] for r in block)).schema:
                kept = fields.setdefault(field.name, field)
                if kept.dataType != field.dataType:
                    fields[field.name] = StructField(field.name, wider(kept.dataType, field.dataType))
        return StructType(list(fields.values()))
    if since is not None:
        zone = spark.conf.get("spark.sql.session.timeZone")
        reader = reader.option("modifiedAfter", since.strftime("%Y-%m-%dT%H:%M:%S")).option("timeZone", zone)
    return reader.parquet(path).schema


def _blocks(rows: Iterable, size: int) -> Iterator[list]:
    rows = iter(rows)
    while block := list(islice(rows, size)):
        yield block


def _add_partitions(spark: SparkSession, full: str, path: str, new: DataFrame, partitions: Sequence[str]) -> int:
    """Adds the partitions of new files to a table, some hundred in a statement, and returns their number."""
    inside = "".join(f"/{re.escape(n)}=([^/]*)" for n in partitions) + "/[^/]*$"
    values = [F.url_decode(F.replace(F.regexp_extract("path", inside, k + 1), F.lit("+"), F.lit("%2B"))).alias(n) for k, n in enumerate(partitions)]
    folder = F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("_folder")
    of = new.filter(F.regexp_like("path", F.lit(inside))).select(*values, folder).distinct()
    count = 0
    for block in _blocks(of.toLocalIterator(), PARTITIONS_AT_ONCE):
        specs = " ".join(
            f"PARTITION ({', '.join(f'`{n}` = {_partition_value(r[n])}' for n in partitions)}) LOCATION {_quoted(r['_folder'])}" for r in block
        )
        spark.sql(f"ALTER TABLE {full} ADD IF NOT EXISTS {specs}")
        count += len(block)
    return count


def _partition_value(text: str) -> str:
    # Fixed value: the folder of a null.
    return "NULL" if text == "__HIVE_DEFAULT_PARTITION__" else _quoted(text)


def _partition_columns(path: str, file: str) -> list[str]:
    """Names of the ``name=value`` folders between a table's folder and one of its files."""
    folder = re.sub(r"^\w+:/*", "/", path)
    return re.findall(r"/([^/=]+)=[^/]*(?=/)", file[file.index(folder) + len(folder) :])


def register_tables(
    spark: SparkSession, database: str, paths: Sequence[str], prefix: str = "", exclude: Sequence[str] = ()
) -> list[str]:
    """Registers each folder as an external Parquet table of the database and returns the
    names. Running it again applies schema updates, adds new partitions, and drops the
    tables of this prefix whose folder is gone or no longer listed; files are not touched.
    Only files newer than the last registration are opened for their schema, so a column that
    no file has any more stays, with nulls, and only their partitions are added.

    ``exclude``: glob patterns of files that do not count. With them, the name is a view that leaves
    these files out, over a table named ``..._files``.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    registered, made = [], set()
    for path in paths:
        path = path.rstrip("/")
        folder = re.sub(r"\W", "_", path.rsplit("/", 1)[-1].lower())
        name = f"{prefix}_{folder}" if prefix else folder
        if not storage.exists(spark, path):
            continue
        counted = list_files(spark, path).filter(~_excluded(F.col("path"), exclude))
        newest = F.date_format(F.max("modificationTime"), "yyyy-MM-dd'T'HH:mm:ss").alias("newest")
        file = counted.agg(F.min("path").alias("path"), newest).first()
        if file["path"] is None:
            continue
        table = f"{name}_files" if exclude else name
        full = f"`{database}`.`{table}`"
        columns = _register(spark, full, path, counted, bool(exclude), file, prefix)
        made.add(table)
        if exclude:
            outside = " OR ".join(
                f"regexp_like({text}, {_quoted(_pattern(p))})"
                for p in exclude
                for text in ("_metadata.file_path", "_metadata.file_name")
            )
            listed = ", ".join(f"`{c}`" for c in columns)
            _drop(spark, f"`{database}`.`{name}`")
            spark.sql(
                f"CREATE VIEW `{database}`.`{name}` TBLPROPERTIES ('{_MARK}' = {_quoted(prefix)}) "
                f"AS SELECT {listed} FROM {full} WHERE NOT ({outside})"
            )
            made.add(name)
        registered.append(name)
    for row in spark.sql(f"SHOW TABLES IN `{database}`").collect():
        if not row["isTemporary"] and row["tableName"] not in made:
            full = f"`{database}`.`{row['tableName']}`"
            if _properties(spark, full).get(_MARK) == prefix:
                _drop(spark, full)
    return registered


def _is_view(spark: SparkSession, full: str) -> bool:
    return spark.catalog.getTable(full).tableType == "VIEW"


def _drop(spark: SparkSession, full: str) -> None:
    if spark.catalog.tableExists(full.replace("`", "")):
        spark.sql(f"DROP {'VIEW' if _is_view(spark, full) else 'TABLE'} {full}")


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _properties(spark: SparkSession, full: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {full}").collect()}


def _register(
    spark: SparkSession, full: str, path: str, files: DataFrame, some: bool, file: Row, prefix: str
) -> list[str]:
    """Makes or updates a table of the listed files, which are ``some`` or all of its folder, and
    returns its columns."""
    partitions = _partition_columns(path, file["path"])
    counted, since = files if some else None, None
    schema = None
    if spark.catalog.tableExists(full.replace("`", "")) and _is_view(spark, full):
        _drop(spark, full)
    if spark.catalog.tableExists(full.replace("`", "")):
        seen = _properties(spark, full).get(_SEEN)
        now = spark.table(full).schema
        kept = {f.name: f.dataType for f in now.fields}
        if seen is None:
            found = _schema(spark, path, counted, None).fields
        else:
            # Times are whole seconds, so the second of the last registration is looked at again.
            since = datetime.fromisoformat(seen) - timedelta(seconds=1)
            new = counted.filter(F.col("modificationTime") > F.lit(since)) if counted is not None else None
            found = _schema(spark, path, new, since).fields
        added = [f for f in found if f.name not in kept]
        if any(kept.get(f.name, f.dataType) != f.dataType for f in found) or any(f.name in partitions for f in added):
            spark.sql(f"DROP TABLE {full}")
            since = None
        else:
            schema = now
            if added:
                columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
                spark.sql(f"ALTER TABLE {full} ADD COLUMNS ({columns})")
    if schema is None:
        schema = _schema(spark, path, counted, None)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        by = f"PARTITIONED BY ({', '.join(f'`{n}`' for n in partitions)})" if partitions else ""
        spark.sql(
            f"CREATE TABLE {full} ({columns}) USING parquet {by} "
            f"LOCATION {_quoted(path)} TBLPROPERTIES ('{_MARK}' = {_quoted(prefix)})"
        )
    spark.sql(f"ALTER TABLE {full} SET TBLPROPERTIES ('{_SEEN}' = '{file['newest']}')")
    if partitions and since is None:
        spark.sql(f"MSCK REPAIR TABLE {full}")
    elif partitions:
        _add_partitions(spark, full, path, files.filter(F.col("modificationTime") > F.lit(since)), partitions)
    spark.catalog.refreshTable(full.replace("`", ""))
    return spark.table(full).columns


def compact_table(df: DataFrame, out: str, keys: Sequence[str], files: int | None = None) -> None:
    """Rewrites a table to a new path as sorted files, in key ranges so that readers can skip.

    The range key ends in a number that spreads the rows of a very frequent key. Without a
    file count, adaptive execution sizes the files.
    """
    ranged = df.withColumn("_spread", spread(df)).repartitionByRange(*([files] if files else []), *keys, "_spread")
    ranged.drop("_spread").sortWithinPartitions(*keys).write.mode("overwrite").parquet(out)
