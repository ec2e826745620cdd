from __future__ import annotations

import random
from datetime import date

from pyspark.sql import functions as F

from tidemark.operators import changes, snapshots

SCHEMA = "k int, v string"


def _frames(spark):
    previous = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (None, "n"), (4, None), (5, "e")], SCHEMA)
    latest = spark.createDataFrame([(1, "a"), (2, "c"), (2, "d"), (3, "x"), (3, "x"), (4, None), (None, "m")], SCHEMA)
    return latest, previous


def test_delta_is_distinct_and_null_safe(spark, rows):
    latest, previous = _frames(spark)
    got = snapshots.snapshot_delta(latest, previous, ["k", "v"])
    assert rows(got) == rows(latest.subtract(previous))
    assert rows(got) == [(None, "m"), (2, "c"), (2, "d"), (3, "x")]


def test_deletes_are_distinct_and_null_safe(spark, rows):
    latest, previous = _frames(spark)
    got = snapshots.snapshot_deletes(latest.filter("k > 1"), previous, ["k"])
    assert rows(got) == [(None,), (1,), (5,)]


def test_change_feed_labels(spark, rows):
    latest, previous = _frames(spark)
    got = snapshots.change_feed(latest, previous, ["k"], ["k", "v"])
    assert rows(got) == rows(
        spark.createDataFrame(
            [("U", None, "m"), ("U", 2, "c"), ("U", 2, "d"), ("I", 3, "x"), ("D", 5, None)], "op string, k int, v string"
        )
    )


def test_merging_delta_and_deletes_gives_the_latest(spark, rows):
    rng = random.Random(7)

    def table(keys):
        return spark.createDataFrame([(k, rng.choice(["a", "b", None])) for k in keys], SCHEMA)

    for _ in range(3):
        previous = table([*rng.sample(range(60), 40), None])
        latest = table(rng.sample(range(60), 40))
        delta = snapshots.snapshot_delta(latest, previous, ["k", "v"])
        gone = snapshots.snapshot_deletes(latest, previous, ["k"])
        merged = snapshots.upsert_merge(snapshots.anti_keys(previous, gone, ["k"]), delta, ["k"])
        assert merged.exceptAll(latest).isEmpty() and latest.exceptAll(merged).isEmpty()


def test_upsert_merge_composite_null_keys(spark, rows):
    schema = "a int, b int, v string"
    target = spark.createDataFrame([(1, None, "x"), (1, 1, "y"), (None, None, "z")], schema)
    upserts = spark.createDataFrame([(1, None, "X"), (2, 2, "N")], schema)
    got = snapshots.upsert_merge(target, upserts, ["a", "b"])
    assert rows(got) == [(None, None, "z"), (1, None, "X"), (1, 1, "y"), (2, 2, "N")]


def _files(spark, *days):
    df = spark.createDataFrame([(f"s3/pre/{d}/part-{i}",) for d in days for i in (0, 1)], "path string")
    return snapshots.with_snapshot_date(df)


def test_dates(spark, rows):
    files = _files(spark, "2024-01-01", "2024-01-03", "2024-01-05", "not-a-date")
    d = [date(2024, 1, n) for n in (1, 3, 5)]
    assert [r[0] for r in snapshots.latest_n_dates(files, 2).collect()] == [d[2], d[1]]
    assert rows(snapshots.previous_snapshot_date(files)) == [(d[1],)]
    assert rows(snapshots.previous_snapshot_date(files, date(2024, 1, 3))) == [(d[0],)]
    assert rows(snapshots.previous_snapshot_date(files, date(2024, 1, 1))) == []
    assert rows(snapshots.snapshot_retention(files, 2)) == [(d[0],)]
    assert rows(snapshots.snapshot_retention(_files(spark, "2024-01-01"), 2)) == []
    assert rows(snapshots.previous_snapshot_date(_files(spark, "2024-01-01"))) == []


def test_date_by_path_token(spark):
    df = spark.createDataFrame([("a/b/2024-01-02/c",), ("a/b/x/c",), ("a",)], "path string")
    got = [r.snapshot_date for r in snapshots.with_snapshot_date(df, token=2).collect()]
    assert got == [date(2024, 1, 2), None, None]


CHANGES = "k int, v string, op string, seq long"


def test_cdc_last_record_wins(spark, rows):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "n")], SCHEMA)
    log = spark.createDataFrame(
        [
            (1, "a2", "U", 2),
            (1, "a1", "U", 1),
            (2, "b", "D", 1),
            (3, "c", "D", 1),
            (3, "c2", "I", 2),
            (4, "d", None, 1),  # a full-load record
            (5, "e", "I", 1),
            (5, "e", "D", 2),
            (None, "n2", "U", 1),
        ],
        CHANGES,
    )
    got = changes.cdc_apply(target, log, ["k"])
    assert rows(got) == [(None, "n2"), (1, "a2"), (3, "c2"), (4, "d")]
    again = changes.cdc_apply(got, log, ["k"])
    assert rows(again) == rows(got)


def test_cdc_ties_do_not_depend_on_order(spark, rows):
    records = [(1, "x", "U", 1), (1, "y", "U", 1), (2, "z", "U", 1), (2, "z", "D", 1)]
    empty = spark.createDataFrame([], SCHEMA)
    results = []
    for seed in range(3):
        random.Random(seed).shuffle(records)
        results.append(rows(changes.cdc_apply(empty, spark.createDataFrame(records, CHANGES), ["k"])))
    assert results[0] == results[1] == results[2] == [(1, "x")]


def test_hot_keys_are_folded_before_the_shuffle(spark):
    """A third of the records share one key; the shuffle gets one of them per task."""
    log = spark.range(90_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
        F.lit("v").alias("v"),
        F.lit("U").alias("op"),
        F.col("id").alias("seq"),
    )
    last = changes.last_changes(log, ["k"])
    assert last.count() == 60_001 - 0
    assert last.filter("k = 0").first().seq == 89_997
    assert last._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2
