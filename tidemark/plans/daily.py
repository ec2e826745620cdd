"""The daily job: snapshot, compare with the day before, stage, add to the target.

A target is its newest full version, ``target/yyyy-mm-dd``, and the changes of every day since,
``target_changes/yyyy-mm-dd``. A day writes its changes only, so its cost follows them and not
the table; ``fold_target`` makes a full version of them now and then. Snapshots and changes are
written elsewhere and moved to their place when they are whole and accepted.

A full version made with the keys at hand is stored in key buckets (``sources.keyed``, files under
``target_data``): reading it with its changes shuffles the changes only, and folding writes
only the buckets that they touch.

Columns may change between days. Every snapshot and every day's changes carry their columns in a log
beside the files; reading fits older files to the newest day's columns. A column that comes
later is null in older rows, one that is dropped goes, one whose type gets wider is cast. One that
comes back starts anew: what it held before it was dropped is not seen again.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.schema import aligned, wider
from tidemark.operators.changes import DELETE, cdc_apply
from tidemark.operators.projection import EmptySource, add_audit_columns, require_rows, strip_nul
from tidemark.operators.snapshots import OP, ROWS, changed_keys, rows_of
from tidemark.sources import keyed, storage
from tidemark.sources.tables import drop_old_snapshots, read_snapshot, snapshot_path, write_snapshot


# Run time and run day of a row's last change.
AUDIT_COLUMNS = ("load_ts", "load_date")


class RepeatedKeys(ValueError):
    """A snapshot holds several rows of one key."""


class ChangedKeys(ValueError):
    """The keys are not those that the target has been kept by."""


# What a change does, and its day; and the mark of key columns in the files' schema.
_OP, _DAY, _KEY = "_op", "_day", "tidemark.key"
# The log of a folder's columns.
_COLUMNS = "_columns.json"


def _changes_folder(target: str) -> str:
    return f"{target.rstrip('/')}_changes"


def _data_folder(target: str) -> str:
    return f"{target.rstrip('/')}_data"


def _log_columns(spark: SparkSession, folder: str, schema: T.StructType) -> None:
    storage.write_text(spark, f"{folder}/{_COLUMNS}", schema.json())


def _columns(spark: SparkSession, folder: str) -> T.StructType:
    """The columns of a folder's files, by its log or else by the files."""
    text = storage.read_text(spark, f"{folder}/{_COLUMNS}")
    return T.StructType.fromJson(json.loads(text)) if text else spark.read.parquet(folder).schema


def _keys(schema: T.StructType) -> list[str]:
    return [f.name for f in schema if f.metadata.get(_KEY)]


def _refuse_late(spark: SparkSession, run_date: date, *folders: str) -> None:
    newer = [d for folder in folders for d in storage.snapshot_dates(spark, folder) if d > run_date]
    if newer:
        raise ValueError(f"{run_date} is before {max(newer)}, which has been run already")


def _take_in(source: DataFrame, root: str, run_date: date, strings: Sequence[str]) -> DataFrame:
    """The source as the day's snapshot, from one read. An empty source leaves all as it was."""
    spark, incoming = source.sparkSession, f"{root.rstrip('/')}_incoming"
    rows = write_snapshot(strip_nul(source, strings), incoming, run_date)
    try:
        require_rows(rows)
    except EmptySource:
        storage.delete(spark, snapshot_path(incoming, run_date))
        raise
    _log_columns(spark, snapshot_path(incoming, run_date), rows.schema)
    storage.move(spark, snapshot_path(incoming, run_date), snapshot_path(root, run_date))
    return read_snapshot(spark, root, run_date, rows.schema)


def initial_load(
    source: DataFrame,
    target: str,
    root: str,
    run_date: date,
    strings: Sequence[str],
    at: datetime | None = None,
    audit: tuple[str, str] = AUDIT_COLUMNS,
    keep: int = 2,
    keys: Sequence[str] = (),
    buckets: int | None = None,
) -> DataFrame:
    """First run: the whole source becomes the first snapshot and the first target version.

    Give ``at`` where the source does not bring the audit columns itself. With ``keys`` the version
    is stored in so many key buckets (as many as a shuffle has partitions, by default); without, the
    first folding does that. A date below that of an earlier run is refused.
    """
    spark = source.sparkSession
    _refuse_late(spark, run_date, root, target, _changes_folder(target))
    rows = _take_in(source, root, run_date, strings)
    if at is not None and not set(audit) <= set(rows.columns):
        rows = add_audit_columns(rows, at, *audit)
    if keys:
        storage.delete(spark, snapshot_path(target, run_date))
        loaded = keyed.store(rows, snapshot_path(target, run_date), _data_folder(target), keys, buckets)
    else:
        loaded = write_snapshot(rows, target, run_date)
    drop_old_snapshots(spark, root, keep)
    return loaded


def daily_snapshot(
    source: DataFrame,
    target: str,
    root: str,
    run_date: date,
    keys: Sequence[str],
    compare: Sequence[str],
    strings: Sequence[str],
    at: datetime,
    audit: tuple[str, str] = AUDIT_COLUMNS,
    publish: Callable[[DataFrame, DataFrame], None] | None = None,
    keep: int = 2,
) -> DataFrame:
    """One day's run; returns the target after it.

    The day's snapshot is compared with that of the newest day the target has, so a day that
    failed half-way can be left out. The comparison is one shuffle of keys and row hashes; whole rows
    are shuffled for changed keys only. The target has the ``compare`` columns, which must include
    the keys, and the audit columns, which are set on changed rows only. The compare columns may
    differ from the days before; the keys may not.
    ``publish(delta, deleted_keys)`` also hands the changes to a serving database, for example
    with the sinks of ``sources.jdbc``; they become part of the target when it is done.

    A day can be run again until a later one has been run or it was folded. Earlier days, and
    snapshots with several rows of one key, are refused and leave the target as it was.
    """
    spark, changes = source.sparkSession, _changes_folder(target)
    _refuse_late(spark, run_date, root, target, changes)
    full = storage.snapshot_dates(spark, target)
    before = [d for d in {*full, *storage.snapshot_dates(spark, changes)} if d < run_date]
    if not before or full[-1:] == [run_date]:
        raise ValueError(f"no target version before {run_date} under {target}: run the initial load first")
    if max(before) not in storage.snapshot_dates(spark, root):
        raise ValueError(f"the snapshot of {max(before)} is gone from {root}")
    _refuse_other_keys(spark, target, full, keys)
    latest = _take_in(source, root, run_date, strings)
    before_rows = read_snapshot(spark, root, max(before), _columns(spark, snapshot_path(root, max(before))))
    fields = [_widened(f, before_rows.schema) for f in (latest.schema[c] for c in compare)]
    now, then = aligned(latest, fields), aligned(before_rows, fields)

    staging = f"{root.rstrip('/')}_staging"
    found = write_snapshot(changed_keys(now, then, keys, compare), f"{root.rstrip('/')}_keys", run_date)
    repeated = found.filter(F.col(ROWS) > 1).drop(ROWS, OP).first()
    if repeated:
        raise RepeatedKeys(f"the snapshot of {run_date} has several rows of a key, such as {repeated.asDict()}")
    deleted = found.filter(F.col(OP) == DELETE).select(*keys)
    changed = rows_of(now, found.filter(F.col(OP) != DELETE), keys)
    changed = add_audit_columns(changed, at, *audit).withColumn(_OP, F.lit("U"))
    gone = deleted.withColumn(_OP, F.lit(DELETE))
    both = changed.unionByName(gone, allowMissingColumns=True).withColumn(_DAY, F.lit(run_date))
    marked = {k: F.col(k).alias(k, metadata={_KEY: True}) for k in keys}
    staged = write_snapshot(both.select(*(marked.get(c, c) for c in both.columns)), staging, run_date)
    _log_columns(spark, snapshot_path(staging, run_date), staged.schema)
    if publish is not None:
        publish(staged.filter(F.col(_OP) != DELETE).drop(_OP, _DAY), deleted)

    storage.move(spark, snapshot_path(staging, run_date), snapshot_path(changes, run_date))
    drop_old_snapshots(spark, root, keep)
    drop_old_snapshots(spark, f"{root.rstrip('/')}_keys", 1)
    return current_version(spark, target)


def _widened(field: T.StructField, before: T.StructType) -> T.StructField:
    """The column as it can hold the values of the day before too."""
    if field.name not in before.fieldNames():
        return field
    try:
        return T.StructField(field.name, wider(field.dataType, before[field.name].dataType))
    except ValueError as error:
        raise ValueError(f"column {field.name} changed: {error}") from None


def _refuse_other_keys(spark: SparkSession, target: str, full: Sequence[date], keys: Sequence[str]) -> None:
    days = storage.snapshot_dates(spark, _changes_folder(target))
    place = keyed.load_place(spark, snapshot_path(target, full[-1])) if full else None
    known = place.keys if place else _keys(_columns(spark, snapshot_path(_changes_folder(target), days[-1]))) if days else None
    if known is not None and set(known) != set(keys):
        raise ChangedKeys(f"{target} is kept by {', '.join(known)}, not by {', '.join(keys)}")


def _days_changes(
    spark: SparkSession, target: str, since: date, base: T.StructType
) -> tuple[DataFrame | None, list[T.StructField], set[str]]:
    """The changes of the days since a full version, fitted to one set of columns; these columns: those
    of the newest day, in types that hold all of their values; and which of them the full version has."""
    days = [d for d in storage.snapshot_dates(spark, _changes_folder(target)) if d > since]
    if not days:
        return None, list(base.fields), set(base.fieldNames())
    paths = [snapshot_path(_changes_folder(target), d) for d in days]
    logs = [_columns(spark, p) for p in paths]
    names = [n for n in logs[-1].fieldNames() if n not in (_OP, _DAY)]
    # A column counts as far back as every day since has it.
    visible = [set(logs[-1].fieldNames())]
    for log in reversed(logs[:-1]):
        visible.insert(0, visible[0] & set(log.fieldNames()))
    fields = []
    for name in names:
        kinds = [s[name].dataType for s, seen in zip([base, *logs], [visible[0], *visible], strict=True) if name in seen and name in s.fieldNames()]
        fields.append(T.StructField(name, reduce(wider, kinds), True, logs[-1][name].metadata))
    whole = [*fields, logs[-1][_OP], logs[-1][_DAY]]
    # Days of equal columns are read together.
    alike: dict[tuple, list[int]] = {}
    for k, log in enumerate(logs):
        alike.setdefault((log.json(), tuple(sorted(visible[k]))), []).append(k)
    parts = [aligned(spark.read.schema(logs[of[0]]).parquet(*(paths[k] for k in of)), whole, visible[of[0]]) for of in alike.values()]
    return reduce(DataFrame.unionByName, parts), fields, visible[0] & set(base.fieldNames())


def current_version(spark: SparkSession, target: str) -> DataFrame:
    """The newest full version with the changes of the days since."""
    full = storage.snapshot_dates(spark, target)
    if not full:
        raise ValueError(f"no target version under {target}: run the initial load first")
    place = keyed.load_place(spark, snapshot_path(target, full[-1]))
    base = keyed.read(spark, place) if place else spark.read.parquet(snapshot_path(target, full[-1]))
    changes, fields, had = _days_changes(spark, target, full[-1], base.schema)
    if changes is None:
        return base
    if place:
        return keyed.apply_changes(spark, place, changes, fields, _DAY, _OP, had)
    return cdc_apply(aligned(base, fields, had), changes, _keys(T.StructType(fields)), _DAY, _OP)


def fold_target(spark: SparkSession, target: str, buckets: int | None = None) -> DataFrame:
    """Makes a full version of the newest day, in key buckets, and then deletes what that replaces.
    Readers of the older version should be done by then.

    Buckets that no change touched stay as they are. Another number of ``buckets`` writes all of them,
    as does the first folding of a target that was loaded without keys.
    """
    days = storage.snapshot_dates(spark, _changes_folder(target))
    full = storage.snapshot_dates(spark, target)
    if days and days[-1] > full[-1]:
        old = snapshot_path(target, full[-1])
        place = keyed.load_place(spark, old)
        new = snapshot_path(target, days[-1])
        base = place.schema if place else spark.read.parquet(old).schema
        changes, fields, had = _days_changes(spark, target, full[-1], base)
        storage.delete(spark, new)
        if place and buckets in (None, place.buckets):
            keyed.merge(spark, new, place, changes, fields, _DAY, _OP, had)
        else:
            keys = place.keys if place else _keys(T.StructType(fields))
            version = place.next_version if place else 1
            keyed.store(current_version(spark, target), new, _data_folder(target), keys, buckets, version)
        full.append(days[-1])
    for day in full[:-1]:
        storage.delete(spark, snapshot_path(target, day))
    for day in days:
        storage.delete(spark, snapshot_path(_changes_folder(target), day))
    place = keyed.load_place(spark, snapshot_path(target, full[-1]))
    if place:
        keyed.drop_stale(spark, place)
    return current_version(spark, target)
