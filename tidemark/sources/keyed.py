"""Tables stored in key buckets, so that changes are merged without shuffling the table.

The rows are dealt to a fixed number of buckets by a hash of their key. Each version of a bucket is a
folder, ``data/_version=V/_slot=S``, whose files Spark knows as that bucket's: a join by key then
reads the table in place and shuffles only the other side. A *place* is a folder that names, for each
bucket, the version that counts; merging changes writes new versions of the buckets that they touch, and
a new place. The other buckets' files stay as they are.

Spark takes bucketed files from a table definition only, so reading defines a table and drops it again:
the definition, not the files. Nothing stays in the catalog.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Collection, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.schema import aligned
from tidemark.operators.changes import DELETE, last_changes
from tidemark.operators.snapshots import prefixed
from tidemark.sources import storage

_HASH, _SLOT, _VERSION = "_key_hash", "_slot", "_version"
_STATE = "_keyed.json"
_IN_PLACE = "spark.sql.hive.manageFilesourcePartitions"
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


@dataclass(frozen=True)
class Place:
    """Which version of each bucket counts (a bucket without rows has none), and what the rows are."""

    data: str
    keys: list[str]
    schema: T.StructType
    buckets: int
    versions: dict[int, int]

    @property
    def next_version(self) -> int:
        return max(self.versions.values(), default=0) + 1


def save_place(spark: SparkSession, path: str, place: Place) -> None:
    known = {**place.__dict__, "schema": place.schema.jsonValue()}
    storage.write_text(spark, f"{path}/{_STATE}", json.dumps(known))
    storage.write_text(spark, f"{path}/_SUCCESS", "")


def load_place(spark: SparkSession, path: str) -> Place | None:
    """The place, or nothing where the folder holds plain files."""
    text = storage.read_text(spark, f"{path}/{_STATE}")
    if text is None:
        return None
    known = json.loads(text)
    known["schema"] = T.StructType.fromJson(known["schema"])
    known["versions"] = {int(s): v for s, v in known["versions"].items()}
    return Place(**known)


def default_buckets(spark: SparkSession) -> int:
    """As many buckets as the session's shuffles have partitions to start with."""
    most = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return int(most or spark.conf.get("spark.sql.shuffle.partitions"))


def _hash(schema: T.StructType, keys: Sequence[str]) -> Column:
    """The same for a whole number of any length. Spark's hash skips nulls, so some keys share one."""
    return F.xxhash64(*(F.col(k).cast("long") if isinstance(schema[k].dataType, _INTEGRAL) else F.col(k) for k in keys))


def _hashed_alike(a: T.StructType, b: T.StructType, keys: Sequence[str]) -> bool:
    def kind(t: T.DataType) -> T.DataType:
        return T.LongType() if isinstance(t, _INTEGRAL) else t

    return all(kind(a[k].dataType) == kind(b[k].dataType) for k in keys)


def _slot(buckets: int) -> Column:
    """The number that Spark's own hash partitioning gives a row."""
    return F.pmod(F.hash(_HASH), F.lit(buckets))


def _write(rows: DataFrame, data: str, version: int, buckets: int) -> None:
    """A version of the buckets that the rows fall into; the rows are dealt out by hash already."""
    spark, name = rows.sparkSession, f"tidemark_{uuid.uuid4().hex}"
    path = f"{data}/{_VERSION}={version}"
    storage.delete(spark, path)
    writer = rows.withColumn(_SLOT, _slot(buckets)).write.format("parquet").option("path", path)
    writer.partitionBy(_SLOT).bucketBy(buckets, _HASH).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")


def _slots_of(rows: DataFrame, buckets: int) -> list[int]:
    """The buckets that rows fall into: at most as many as there are."""
    return sorted(r[0] for r in rows.select(_slot(buckets).alias("s")).distinct().collect())


def store(rows: DataFrame, path: str, data: str, keys: Sequence[str], buckets: int | None = None, version: int = 1) -> DataFrame:
    """Stores a whole table in buckets and returns it as read back; this is its one shuffle."""
    spark = rows.sparkSession
    buckets = buckets or default_buckets(spark)
    dealt = rows.withColumn(_HASH, _hash(rows.schema, keys)).repartition(buckets, _HASH)
    _write(dealt, data, version, buckets)
    place = Place(data, list(keys), rows.schema, buckets, {})
    place = replace(place, versions={s: version for s in _written(spark, data, version)})
    save_place(spark, path, place)
    return read(spark, place)


def _written(spark: SparkSession, data: str, version: int) -> list[int]:
    """The buckets of which there is such a version, by its folders."""
    found = storage.folders(spark, f"{data}/{_VERSION}={version}/{_SLOT}=*")
    return [int(f.rsplit("=", 1)[1]) for f in found]


def scan(spark: SparkSession, place: Place, slots: Sequence[int] | None = None) -> DataFrame:
    """The rows of the buckets (of all, by default) with their key's hash, as Spark knows them in buckets."""
    live: dict[int, list[int]] = {}
    for slot, version in place.versions.items():
        if slots is None or slot in set(slots):
            live.setdefault(version, []).append(slot)
    columns = [f for f in place.schema.fields] + [T.StructField(_HASH, T.LongType())]
    if not live:
        return spark.createDataFrame([], T.StructType(columns))
    name, before = f"tidemark_{uuid.uuid4().hex}", spark.conf.get(_IN_PLACE)
    listed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
    quoted = place.data.replace("\\", "\\\\").replace("'", "\\'")
    spark.conf.set(_IN_PLACE, "false")
    try:
        spark.sql(
            f"CREATE TABLE {name} ({listed}, {_VERSION} INT, {_SLOT} INT) USING parquet PARTITIONED BY ({_VERSION}, {_SLOT}) "
            f"CLUSTERED BY ({_HASH}) INTO {place.buckets} BUCKETS LOCATION '{quoted}'"
        )
        table = spark.table(name)
        spark.sql(f"DROP TABLE {name}")
    finally:
        spark.conf.set(_IN_PLACE, before)
    counts = F.lit(False)
    for version, of in live.items():
        counts = counts | ((F.col(_VERSION) == version) & F.col(_SLOT).isin(sorted(of)))
    return table.filter(counts).select(*(F.col(f.name) for f in columns))


def read(spark: SparkSession, place: Place) -> DataFrame:
    return scan(spark, place).select(*place.schema.fieldNames())


def _equal_keys(keys: Sequence[str], prefix: str) -> Column:
    """Null-safe equality by order, so that the hash stays the one join key, which the buckets have."""
    ours, theirs = F.struct(*keys), F.struct(*(F.col(f"{prefix}{k}") for k in keys))
    return (ours >= theirs) & (ours <= theirs)


def _applied(base: DataFrame, changes: DataFrame, keys: Sequence[str], buckets: int, seq: str, op: str) -> DataFrame:
    """The base rows of other keys, and the living last record of each changed key. The base stays
    where it is; changed keys and records are shuffled to it."""
    gone = changes.select(_HASH, *keys).distinct().select(F.col(_HASH).alias("_gone_hash"), *prefixed(keys, "_gone_"))
    kept = base.join(gone, (F.col(_HASH) == F.col("_gone_hash")) & _equal_keys(keys, "_gone_"), "left_anti")
    alive = last_changes(changes, keys, seq, op).filter(F.col(op).isNull() | (F.col(op) != DELETE))
    return kept.unionByName(alive.select(*base.columns).repartition(buckets, _HASH))


def _hashed(changes: DataFrame, fields: Sequence[T.StructField], keys: Sequence[str], seq: str, op: str) -> DataFrame:
    whole = [*fields, *(changes.schema[c] for c in (seq, op) if c not in {f.name for f in fields})]
    same = aligned(changes, whole)
    return same.withColumn(_HASH, _hash(same.schema, keys))


def apply_changes(
    spark: SparkSession,
    place: Place,
    changes: DataFrame,
    fields: Sequence[T.StructField],
    seq: str,
    op: str,
    had: Collection[str] | None = None,
) -> DataFrame:
    """The table with the changes, as the given columns; only the changes are shuffled. Of the stored
    columns those in ``had`` count, all by default.

    A key whose type changed so that its hash did moves the table once, until it is stored anew.
    """
    after = T.StructType(list(fields))
    base = _fitted(scan(spark, place), fields, had)
    if not _hashed_alike(place.schema, after, place.keys):
        base = base.withColumn(_HASH, _hash(after, place.keys))
    merged = _applied(base, _hashed(changes, fields, place.keys, seq, op), place.keys, place.buckets, seq, op)
    return merged.select(*(f.name for f in fields))


def merge(
    spark: SparkSession,
    path: str,
    place: Place,
    changes: DataFrame,
    fields: Sequence[T.StructField],
    seq: str,
    op: str,
    had: Collection[str] | None = None,
) -> Place:
    """Writes the buckets that the changes touch anew and the place that counts from then on.

    Columns may be added, and whole numbers become longer, as the reader fits older files to that. Other changes of
    types, or columns left out, write the whole table.
    """
    after = T.StructType(list(fields))
    seen = set(place.schema.fieldNames()) if had is None else set(had)
    if not _reads_older_files(place.schema, after, seen) or not _hashed_alike(place.schema, after, place.keys):
        whole = apply_changes(spark, place, changes, fields, seq, op, had)
        store(whole, path, place.data, place.keys, place.buckets, place.next_version)
        return load_place(spark, path)
    hashed = _hashed(changes, fields, place.keys, seq, op)
    touched = _slots_of(hashed, place.buckets)
    moved, version = replace(place, schema=after), place.next_version
    if touched:
        base = _fitted(scan(spark, place, touched), fields, had)
        _write(_applied(base, hashed, place.keys, place.buckets, seq, op), place.data, version, place.buckets)
        versions = {s: v for s, v in place.versions.items() if s not in set(touched)}
        moved = replace(moved, versions={**versions, **{s: version for s in _written(spark, place.data, version)}})
    save_place(spark, path, moved)
    return moved


def upsert(spark: SparkSession, path: str, place: Place, rows: DataFrame) -> Place:
    """Replaces rows by key and adds new ones, in the buckets that they touch. Of several rows of one
    key one stays, always the same."""
    changes = rows.withColumns({"_seq": F.lit(0), "_op": F.lit(None).cast("string")})
    return merge(spark, path, place, changes, place.schema.fields, "_seq", "_op")


def _fitted(base: DataFrame, fields: Sequence[T.StructField], had: Collection[str] | None) -> DataFrame:
    return aligned(base, [*fields, base.schema[_HASH]], None if had is None else {*had, _HASH})


def _reads_older_files(before: T.StructType, after: T.StructType, seen: set[str]) -> bool:
    names = set(after.fieldNames()) & seen
    return all(
        f.name in names
        and (after[f.name].dataType == f.dataType or (isinstance(f.dataType, _INTEGRAL[:3]) and isinstance(after[f.name].dataType, T.LongType)))
        for f in before.fields
    )


def drop_stale(spark: SparkSession, place: Place) -> None:
    """Deletes the versions of buckets that the place no longer counts."""
    for folder in storage.folders(spark, f"{place.data}/{_VERSION}=*/{_SLOT}=*"):
        version, slot = map(int, re.search(rf"{_VERSION}=(\d+)/{_SLOT}=(\d+)$", folder).groups())
        if place.versions.get(slot) != version:
            storage.delete(spark, folder)
    live = set(place.versions.values())
    for folder in storage.folders(spark, f"{place.data}/{_VERSION}=*"):
        if int(folder.rsplit("=", 1)[1]) not in live:
            storage.delete(spark, folder)
