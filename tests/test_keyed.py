"""Targets in key buckets, the one-pass comparison, and columns that change between days."""

from __future__ import annotations

import glob
import os
import re
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.schema import wider
from tidemark.operators.changes import cdc_apply
from tidemark.operators.snapshots import changed_keys, rows_of
from tidemark.plans.daily import ChangedKeys, current_version, daily_snapshot, fold_target, initial_load
from tidemark.sources import keyed, storage

KEYED = "a int, b string, x double"
CHANGES = "a int, b string, x double, op string, seq long"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def files(folder) -> dict[str, float]:
    return {f: os.path.getmtime(f) for f in glob.glob(f"{folder}/**/*.parquet", recursive=True)}


def table(spark, rows=200):
    keys = [(None if n % 50 == 0 else n, "k" if n % 3 else None, float(n)) for n in range(1, rows)]
    return spark.createDataFrame([*keys, (None, None, -1.0)], KEYED)


def fixed(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


@pytest.fixture
def place(spark, tmp_path):
    keyed.store(table(spark), str(tmp_path / "1"), str(tmp_path / "data"), ["a", "b"], buckets=16)
    return keyed.load_place(spark, str(tmp_path / "1"))


SOME = [(5, "k", 0.5, "U", 1), (5, "k", 0.75, "U", 2), (7, "k", None, "D", 1), (None, "k", 9.0, "U", 1), (9000, None, 1.0, "I", 1),
        (None, None, None, "D", 3), (3, "k", 4.0, None, 1)]


def test_a_stored_table_reads_as_it_was_and_leaves_nothing_in_the_catalog(spark, place):
    assert fixed(keyed.read(spark, place)) == fixed(table(spark))
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("tidemark_")]


def test_changes_are_applied_like_to_any_table(spark, place, tmp_path):
    changes = spark.createDataFrame(SOME, CHANGES)
    want = fixed(cdc_apply(table(spark), changes, ["a", "b"]))
    seen = keyed.apply_changes(spark, place, changes, place.schema.fields, "seq", "op")
    assert fixed(seen) == want
    merged = keyed.merge(spark, str(tmp_path / "2"), place, changes, place.schema.fields, "seq", "op")
    assert fixed(keyed.read(spark, merged)) == want
    # The older place still reads as it did, until its files are dropped.
    assert fixed(keyed.read(spark, place)) == fixed(table(spark))
    keyed.drop_stale(spark, merged)
    assert fixed(keyed.read(spark, keyed.load_place(spark, str(tmp_path / "2")))) == want


def test_the_stored_table_is_not_shuffled(spark, place):
    changes = spark.createDataFrame(SOME, CHANGES)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        seen = keyed.apply_changes(spark, place, changes, place.schema.fields, "seq", "op")
        text = plan(seen)
        base = text[: text.index("Bucketed: true")]
        assert "SortMergeJoin" in base and "Exchange" not in base and "SelectedBucketsCount: 16 out of 16" in text
        # The join beside a plain table shuffles both sides.
        assert plan(cdc_apply(table(spark), changes, ["a", "b"])).count("Exchange") > text.count("Exchange") - 1
        seen.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_only_touched_buckets_are_written(spark, place, tmp_path):
    before = files(place.data)
    rows = spark.createDataFrame([(5, "k", 50.0), (100_000, "new", 1.0)], KEYED)
    after = keyed.upsert(spark, str(tmp_path / "2"), place, rows)
    written = {f: t for f, t in files(place.data).items() if f not in before}
    touched = {s for s, v in after.versions.items() if v == 2}
    assert 1 <= len(touched) <= 2 and {int(re.search(r"_slot=(\d+)", f)[1]) for f in written} == touched
    keyed.drop_stale(spark, after)
    left = files(place.data)
    assert {f: t for f, t in left.items() if f not in written}.items() <= before.items()
    assert len({re.search(r"_slot=(\d+)", f)[1] for f in left}) == len(after.versions)
    assert keyed.read(spark, after).filter("a = 5 AND x = 50").count() == 1


def test_a_bucket_can_become_empty_and_all_of_them(spark, place, tmp_path):
    gone = table(spark).withColumns({"op": F.lit("D"), "seq": F.lit(1).cast("long")})
    after = keyed.merge(spark, str(tmp_path / "2"), place, gone, place.schema.fields, "seq", "op")
    assert after.versions == {} and keyed.read(spark, after).collect() == []
    back = keyed.upsert(spark, str(tmp_path / "3"), after, table(spark).filter("a < 20"))
    assert keyed.read(spark, back).count() == table(spark).filter("a < 20").count()


def test_whole_numbers_may_become_longer_in_place(spark, place, tmp_path):
    fields = [T.StructField("a", T.LongType()), *place.schema.fields[1:], T.StructField("y", T.StringType())]
    changes = spark.createDataFrame([(2**40, "k", 1.0, "new", "I", 1), (5, "k", 6.0, "y5", "U", 1)], "a long, b string, x double, y string, op string, seq long")
    before = files(place.data)
    after = keyed.merge(spark, str(tmp_path / "2"), place, changes, fields, "seq", "op")
    # Kept rows and changed ones are a file each.
    assert len(files(place.data)) - len(before) <= 4
    got = keyed.read(spark, after)
    assert got.schema["a"].dataType == T.LongType() and got.filter("y IS NOT NULL").count() == 2
    assert got.count() == table(spark).count() + 1 and got.filter("a = 5").first().x == 6.0


def test_keys_of_another_kind_move_the_table(spark, place, tmp_path):
    fields = [T.StructField("a", T.StringType()), *place.schema.fields[1:]]
    changes = spark.createDataFrame([("5", "k", 6.0, "U", 1), ("x", "k", 7.0, "I", 1)], "a string, b string, x double, op string, seq long")
    want = fixed(cdc_apply(table(spark).withColumn("a", F.col("a").cast("string")), changes, ["a", "b"]))
    assert fixed(keyed.apply_changes(spark, place, changes, fields, "seq", "op")) == want
    after = keyed.merge(spark, str(tmp_path / "2"), place, changes, fields, "seq", "op")
    assert fixed(keyed.read(spark, after)) == want and set(after.versions.values()) == {2}


# --- comparing in one pass ---------------------------------------------------------


ROW = "k int, g string, v double, n struct<p:int,q:int>, l array<int>"


def test_changed_keys_tell_every_kind_of_change(spark, rows):
    same = (1, None, -0.0, (None, 5), [None, 1])
    old = [same, (2, "a", 1.0, None, None), (3, "a", None, (1, None), [1, None]), (None, "a", 1.0, None, []), (4, "x", float("nan"), None, None), (6, None, None, None, None)]
    new = [(1, None, 0.0, (None, 5), [None, 1]), (2, "a", None, None, None), (3, "a", None, (None, 1), [None, 1]), (None, "a", 1.0, None, None),
           (4, "x", float("nan"), None, None), (5, "b", 1.0, None, None), (7, None, 1.0, None, None), (7, None, 1.0, None, None)]
    a, b = spark.createDataFrame(new, ROW), spark.createDataFrame(old, ROW)
    got = changed_keys(a, b, ["k", "g"], a.columns)
    assert rows(got) == sorted(
        [(2, "a", "U", 1), (3, "a", "U", 1), (None, "a", "U", 1), (6, None, "D", 0), (5, "b", "I", 1), (7, None, "I", 2)],
        key=lambda r: [(v is not None, str(v)) for v in r],
    )
    found = rows_of(a, got.filter("op <> 'D'"), ["k", "g"])
    assert sorted(str(r.k) for r in found.collect()) == ["2", "3", "5", "7", "7", "None"]


def test_swapped_values_and_nulls_count_as_changes(spark):
    a = spark.createDataFrame([(1, None, 5), (2, 5, 5)], "k int, x int, y int")
    b = spark.createDataFrame([(1, 5, None), (2, 5, 5)], "k int, x int, y int")
    assert [r.k for r in changed_keys(a, b, ["k"], a.columns).collect()] == [1]


def test_the_comparison_shuffles_keys_and_hashes_once(spark, tmp_path):
    wide = spark.range(1000).select("id", *(F.concat(F.lit(f"{n}"), F.col("id")).alias(f"c{n}") for n in range(20)))
    wide.write.parquet(str(tmp_path / "a"))
    a = spark.read.parquet(str(tmp_path / "a"))
    found = changed_keys(a, a.withColumn("c3", F.when(F.col("id") == 7, "x").otherwise(F.col("c3"))), ["id"], a.columns)
    text = plan(found)
    assert text.count("Exchange") == 1 and "Join" not in text
    below = text[text.index("Exchange") :].split("HashAggregate" if "HashAggregate" in text else "SortAggregate")[1]
    assert "c0" not in below.split("\n")[0]
    assert [r.id for r in found.collect()] == [7]


def test_only_rows_of_likely_keys_reach_the_join(spark):
    table = spark.range(0, 200_000).withColumn("text", F.lit("t"))
    few = spark.range(0, 200_000, 1000)
    found = rows_of(table, few, ["id"])
    assert found.count() == 200
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(rows_of(table, few, ["id"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Below the sort-merge join's exchange, the table is held against the bitmap.
    left = text[text.index("SortMergeJoin") : text.index("BroadcastExchange")]
    assert "Exchange" in left and left.index("Exchange") < left.index("BroadcastHashJoin") < left.index("getbit")


# --- columns that change -----------------------------------------------------------

D = [date(2024, 1, 1) + timedelta(days=n) for n in range(9)]


class Job:
    def __init__(self, spark, home, keyed_from_start):
        self.spark, self.gold, self.pre = spark, str(home / "gold"), str(home / "pre")
        self.keys = ["k"] if keyed_from_start else []

    def day(self, n, rows, schema, **more):
        at = datetime(D[n].year, D[n].month, D[n].day, 6)
        source = self.spark.createDataFrame([(*r, at, D[n]) for r in rows], f"{schema}, load_ts timestamp, load_date date")
        columns = [part.split()[0] for part in schema.split(", ")]
        if n == 0:
            return initial_load(source, self.gold, self.pre, D[0], [], keys=self.keys, **more)
        return daily_snapshot(source, self.gold, self.pre, D[n], more.pop("keys", ["k"]), columns, [], at, **more)

    def rows(self, df):
        return sorted(tuple(v for c, v in r.asDict().items() if c != "load_ts") for r in df.collect())


@pytest.mark.parametrize("keyed_from_start", [True, False])
def test_columns_come_go_and_get_wider(spark, tmp_path, keyed_from_start):
    job = Job(spark, tmp_path, keyed_from_start)
    job.day(0, [(1, "a", 1), (2, "b", 2), (3, "c", 3)], "k int, v string, n int")
    # A column comes: rows with a value in it are changes, others stay as they were.
    got = job.day(1, [(1, "a", 1, None), (2, "b", 2, "new"), (3, "c", 3, None)], "k int, v string, n int, w string")
    want = [(1, "a", 1, None, D[0]), (2, "b", 2, "new", D[1]), (3, "c", 3, None, D[0])]
    assert job.rows(got) == want
    # A column goes and one gets wider; a key gets longer too.
    got = job.day(2, [(1, 1, None), (2, 2**40, "new"), (4, 4, "x")], "k long, n long, w string")
    want = [(1, 1, None, D[0]), (2, 2**40, "new", D[2]), (4, 4, "x", D[2])]
    assert got.columns == ["k", "n", "w", "load_ts", "load_date"] and job.rows(got) == want
    assert got.schema["n"].dataType == got.schema["k"].dataType == T.LongType()
    assert job.rows(fold_target(spark, job.gold)) == want
    assert storage.snapshot_dates(spark, job.gold) == [D[2]] and keyed.load_place(spark, f"{job.gold}/{D[2]}")
    # The column that went comes back: what it held before is not seen again.
    got = job.day(3, [(1, 1, None, None), (2, 2**40, "new", "back"), (4, 5, "x", None)], "k long, n long, w string, v string")
    want = [(1, 1, None, None, D[0]), (2, 2**40, "new", "back", D[3]), (4, 5, "x", None, D[3])]
    assert job.rows(got) == want and job.rows(fold_target(spark, job.gold)) == want


@pytest.mark.parametrize("keyed_from_start", [True, False])
def test_a_column_that_goes_and_comes_back_before_folding(spark, tmp_path, keyed_from_start):
    job = Job(spark, tmp_path, keyed_from_start)
    job.day(0, [(1, "a"), (2, "b")], "k int, v string")
    job.day(1, [(1, 1), (2, 2)], "k int, n int")
    want = [(1, 1, None, D[1]), (2, 2, "z", D[2])]
    assert job.rows(job.day(2, [(1, 1, None), (2, 2, "z")], "k int, n int, v string")) == want
    assert job.rows(fold_target(spark, job.gold)) == want == job.rows(current_version(spark, job.gold))


def test_types_that_cannot_be_joined_are_refused_and_change_nothing(spark, tmp_path):
    job = Job(spark, tmp_path, True)
    job.day(0, [(1, "a")], "k int, v string")
    with pytest.raises(ValueError, match="column v changed"):
        job.day(1, [(1, [1])], "k int, v array<int>")
    with pytest.raises(ChangedKeys, match="kept by k"):
        job.day(1, [(1, "a")], "k int, v string", keys=["k", "v"])
    assert job.rows(current_version(spark, job.gold)) == [(1, "a", D[0])]
    assert job.rows(job.day(1, [(1, "b")], "k int, v string")) == [(1, "b", D[1])]


def test_folding_writes_the_buckets_of_changed_keys(spark, tmp_path):
    job = Job(spark, tmp_path, True)
    rows = [(k, f"value {k}") for k in range(500)]
    job.day(0, rows, "k int, v string", buckets=32)
    before = files(f"{job.gold}_data")
    job.day(1, [(0, "changed"), *rows[1:]], "k int, v string")
    assert fold_target(spark, job.gold).filter("v = 'changed'").count() == 1
    after = files(f"{job.gold}_data")
    # Of one bucket: its kept rows, and the changed one.
    assert len(set(after) - set(before)) == 2 and len(set(before) - set(after)) == 1
    assert all(after[f] == before[f] for f in set(after) & set(before))
    # Another number of buckets writes all of them.
    job.day(2, [(0, "again"), *rows[1:]], "k int, v string")
    assert fold_target(spark, job.gold, buckets=4).count() == 500
    assert not set(files(f"{job.gold}_data")) & set(after)


def test_wider_types():
    int_, long_, text = T.IntegerType(), T.LongType(), T.StringType()
    assert wider(int_, long_) == long_ and wider(T.DateType(), T.TimestampType()) == T.TimestampType()
    assert wider(T.DecimalType(10, 2), T.DecimalType(8, 4)) == T.DecimalType(12, 4)
    assert wider(T.DecimalType(10, 2), int_) == T.DecimalType(12, 2) and wider(long_, T.DoubleType()) == T.DoubleType()
    assert wider(int_, text) == text and wider(T.DecimalType(5, 1), T.FloatType()) == T.DoubleType()
    with pytest.raises(ValueError):
        wider(T.BinaryType(), int_)


def test_a_move_that_broke_off_is_mended(spark, tmp_path):
    new, place = str(tmp_path / "new"), str(tmp_path / "place")
    spark.range(1).write.parquet(place)
    aside = str(tmp_path / ".place.replaced")
    os.rename(place, aside)
    storage.restore(spark, place)
    assert spark.read.parquet(place).count() == 1
    spark.range(2).write.parquet(new)
    storage.move(spark, new, place)
    assert spark.read.parquet(place).count() == 2 and not os.path.exists(aside)
    assert storage.read_text(spark, f"{place}/none") is None
