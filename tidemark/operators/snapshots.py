"""Comparing and merging snapshots.

Keys and rows are compared null-safe, as EXCEPT does. Comparisons are written as one
``groupBy`` over both sides with presence flags, not as EXCEPT: map-side aggregation
folds equal rows before the shuffle (so a hot value costs one row per task), both
sides share one exchange, and no second one is needed to make the result distinct.

Where rows must be joined to an aggregate, the condition is null-safe on the plain
columns. Beyond keeping rows with null keys, this gives the aggregate an exchange of its
own right below the join, which is what adaptive execution needs to split a skewed
partition of the other side; without it a hot key would stay in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_IN_LEFT, _IN_RIGHT = "_in_left", "_in_right"
# Rows of a key in the latest snapshot.
ROWS = "_rows"


def null_safe(columns: Sequence[str], prefix: str) -> Column:
    """The join condition of columns with their namesakes under a prefix."""
    return reduce(Column.__and__, [F.col(n).eqNullSafe(F.col(f"{prefix}{n}")) for n in columns])


def prefixed(columns: Sequence[str], prefix: str) -> list[Column]:
    return [F.col(n).alias(f"{prefix}{n}") for n in columns]


def presence(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The distinct rows of both sides, with a flag for each side that has the row."""
    a = left.select(*columns, F.lit(True).alias(_IN_LEFT), F.lit(False).alias(_IN_RIGHT))
    b = right.select(*columns, F.lit(False).alias(_IN_LEFT), F.lit(True).alias(_IN_RIGHT))
    return a.union(b).groupBy(*columns).agg(F.max(_IN_LEFT).alias(_IN_LEFT), F.max(_IN_RIGHT).alias(_IN_RIGHT))


def only_left(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct rows of the left side that the right side lacks."""
    return presence(left, right, columns).filter(~F.col(_IN_RIGHT)).select(*columns)


def snapshot_delta(latest: DataFrame, previous: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Inserted or changed rows, over the compare columns."""
    return only_left(latest, previous, columns)


def snapshot_deletes(latest: DataFrame, previous: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of the previous snapshot that the latest one lacks."""
    return only_left(previous, latest, keys)


def key_changes(latest: DataFrame, previous: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of which the latest snapshot has other than one row, with the number of its rows: 0
    for those that only the previous one has. One shuffle tells deletes and repeated keys."""
    a = latest.select(*keys, F.lit(1).alias(ROWS))
    b = previous.select(*keys, F.lit(0).alias(ROWS))
    return a.union(b).groupBy(*keys).agg(F.sum(ROWS).alias(ROWS)).filter(F.col(ROWS) != 1)


# What happened to a key between two snapshots.
OP, INSERT, UPDATE, DELETE = "op", "I", "U", "D"
# Bits that tell roughly which keys a table has, and those of a row of them: at most 8 MB in all.
_BITS, _ROW_BITS, _WORD_BITS = 26, 12, 6


def row_hash(schema: T.StructType, columns: Sequence[str]) -> Column:
    """128 bits of these columns' values. Nulls are told from their absence, nested values by their
    JSON form."""
    nested = (T.ArrayType, T.StructType, T.MapType)
    values = [F.to_json(F.struct(c)) if isinstance(schema[c].dataType, nested) else F.col(c) for c in columns]
    nulls = F.array(*(F.col(c).isNull() for c in columns))
    return F.struct(F.xxhash64(*values, nulls).alias("a"), F.xxhash64(nulls, *reversed(values)).alias("b"))


def changed_keys(
    latest: DataFrame, previous: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Keys that were inserted, updated or deleted, with ``op`` and the number of their rows in the
    latest snapshot, and those with several rows there.

    Both snapshots send a key and the hash of the compare columns a row, in one shuffle. The columns must
    have the same types on both sides. An update whose hash of 128 bits stays the same is missed.
    """
    now, then = F.when(F.col("_now"), F.col("_hash")), F.when(~F.col("_now"), F.col("_hash"))
    sides = [df.select(*keys, row_hash(df.schema, columns).alias("_hash"), F.lit(flag).alias("_now")) for df, flag in ((latest, True), (previous, False))]
    both = sides[0].union(sides[1]).groupBy(*keys).agg(
        F.count_if("_now").alias(ROWS), F.max(now).alias("_new"), F.max(then).alias("_old")
    )
    op = F.when(F.col("_old").isNull(), INSERT).when(F.col("_new").isNull(), DELETE).when(F.col("_new") != F.col("_old"), UPDATE)
    return both.select(*keys, op.alias(OP), ROWS).filter(F.col(OP).isNotNull() | (F.col(ROWS) > 1))


def rows_of(table: DataFrame, keyed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The table's rows whose key occurs in ``keyed``, which has each key once.

    Before the join, rows are held against a bitmap of the keys' hashes, which has a fixed size and so is
    broadcast. What is shuffled is about as much as the result, while the keys are few beside
    the bits (2^26); with more of them, more of the table.
    """
    place = F.pmod(F.xxhash64(*keys), F.lit(1 << _BITS))
    words = 1 << (_ROW_BITS - _WORD_BITS)
    bits = (
        keyed.select(place.alias("p"))
        .groupBy(F.shiftright("p", _ROW_BITS).alias("_row"), F.pmod(F.shiftright("p", _WORD_BITS), F.lit(words)).cast("int").alias("w"))
        .agg(F.bit_or(F.expr(f"shiftleft(1L, CAST(pmod(p, {1 << _WORD_BITS}) AS INT))")).alias("bits"))
        .groupBy("_row")
        .agg(F.map_from_entries(F.collect_list(F.struct("w", "bits"))).alias("m"))
        .select("_row", F.transform(F.sequence(F.lit(0), F.lit(words - 1)), lambda w: F.coalesce(F.col("m")[w], F.lit(0).cast("long"))).alias("_bits"))
    )
    word = F.pmod(F.shiftright("_place", _WORD_BITS), F.lit(words)).cast("int")
    bit = F.getbit(F.get("_bits", word), F.pmod("_place", F.lit(1 << _WORD_BITS)).cast("int"))
    likely = (
        table.withColumn("_place", place)
        .join(F.broadcast(bits), F.shiftright("_place", _ROW_BITS) == F.col("_row"))
        .filter(bit == 1)
        .select(*table.columns)
    )
    # Not a semi join: Spark would push that below the bitmap's.
    return likely.join(keyed.select(*prefixed(keys, "_of_")), null_safe(keys, "_of_")).select(*table.columns)


def change_feed(
    latest: DataFrame, previous: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Delta rows with ``op`` I (new key) or U, and one D row for each deleted key.

    ``columns`` must hold the keys; a D row has nulls in the others.
    """
    delta = snapshot_delta(latest, previous, columns)
    # Keys of the previous snapshot, and whether the latest one still has them.
    known = presence(latest, previous, keys).filter(_IN_RIGHT)
    known = known.select(*prefixed(keys, "_known_"), _IN_LEFT)
    upserts = delta.join(known, null_safe(keys, "_known_"), "left").select(
        F.when(F.col(_IN_LEFT).isNull(), "I").otherwise("U").alias("op"), *columns
    )
    # Taken from the same aggregate, so that Spark reuses its exchange.
    gone = known.filter(~F.col(_IN_LEFT)).select(
        F.lit("D").alias("op"), *[F.col(f"_known_{n}").alias(n) for n in keys]
    )
    return upserts.unionByName(gone, allowMissingColumns=True)


def anti_keys(target: DataFrame, keyed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the target whose key does not occur in ``keyed``.

    Repeated keys are folded before the shuffle; adaptive execution broadcasts the key
    set when it turns out small and splits skewed partitions of the target otherwise.
    """
    gone = keyed.select(*prefixed(keys, "_gone_")).distinct()
    return target.join(gone, null_safe(keys, "_gone_"), "left_anti")


def upsert_merge(target: DataFrame, upserts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target with rows of the same key replaced and new keys added."""
    return anti_keys(target, upserts, keys).unionByName(upserts)


# --- snapshot dates -------------------------------------------------------------


def with_snapshot_date(files: DataFrame, token: int | None = None, path_col: str = "path") -> DataFrame:
    """Adds ``snapshot_date``: the path token at that position (from 0), or else the last
    folder named ``yyyy-MM-dd``. Null where there is none."""
    if token is None:
        text = F.regexp_extract(path_col, r"^.*/(\d{4}-\d{2}-\d{2})/", 1)
    else:
        text = F.get(F.split(path_col, "/"), F.lit(token))
    return files.withColumn("snapshot_date", text.try_cast("date"))


def latest_n_dates(files: DataFrame, n: int = 2) -> DataFrame:
    """The newest ``n`` snapshot dates; ``files`` has a ``snapshot_date`` column."""
    return (
        files.filter(F.col("snapshot_date").isNotNull())
        .select("snapshot_date")
        .distinct()
        .orderBy(F.desc("snapshot_date"))
        .limit(n)
    )


def previous_snapshot_date(files: DataFrame, run_date: date | None = None) -> DataFrame:
    """The newest date below the run date, or the second newest where none is given.

    Empty when there is no such date.
    """
    if run_date is None:
        return latest_n_dates(files, 2).orderBy(F.desc("snapshot_date")).offset(1).limit(1)
    older = files.filter(F.col("snapshot_date") < F.lit(run_date))
    return older.agg(F.max("snapshot_date").alias("snapshot_date")).filter(F.col("snapshot_date").isNotNull())


def snapshot_retention(files: DataFrame, keep: int = 2) -> DataFrame:
    """The dates to drop: all but the newest ``keep``. Empty when there are no more."""
    dates = files.filter(F.col("snapshot_date").isNotNull()).select("snapshot_date").distinct()
    # At most ``keep`` rows by construction, so safe to broadcast.
    kept = F.broadcast(latest_n_dates(files, keep))
    return dates.join(kept, "snapshot_date", "left_anti")
