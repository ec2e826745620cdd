from __future__ import annotations

import glob
import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.sources import catalog, storage
from tidemark.sources.catalog import compact_table, layer_paths, register_tables


@pytest.fixture
def database(spark):
    yield "lake_test"
    spark.sql("DROP DATABASE IF EXISTS lake_test CASCADE")


def _tables(spark, database):
    return sorted(r.tableName for r in spark.sql(f"SHOW TABLES IN {database}").collect())


def test_register_update_and_drop(spark, tmp_path, database):
    a, b, empty = (str(tmp_path / n) for n in ("Orders", "b-x", "none"))
    spark.range(3).write.parquet(a)
    spark.range(2).write.parquet(b)
    assert register_tables(spark, database, [a, b, empty], "raw") == ["raw_orders", "raw_b_x"]
    assert spark.table(f"{database}.raw_orders").count() == 3

    # A new column in newer files, and a folder that is gone.
    spark.range(1).withColumn("extra", F.lit("x")).write.mode("append").parquet(a)
    storage.delete(spark, b)
    assert register_tables(spark, database, [a, b], "raw") == ["raw_orders"]
    assert _tables(spark, database) == ["raw_orders"]
    table = spark.table(f"{database}.raw_orders")
    assert table.columns == ["id", "extra"] and table.count() == 4
    assert table.filter("extra = 'x'").count() == 1

    # A changed type.
    spark.range(1).select(F.lit("s").alias("id")).write.mode("overwrite").parquet(a)
    register_tables(spark, database, [a], "raw")
    assert dict(spark.table(f"{database}.raw_orders").dtypes) == {"id": "string"}


def test_prefixes_are_kept_apart(spark, tmp_path, database):
    full, delta = str(tmp_path / "full" / "t"), str(tmp_path / "delta" / "t")
    spark.range(3).write.parquet(full)
    spark.range(2).withColumn("op", F.lit("U")).write.parquet(delta)
    register_tables(spark, database, [full], "s_full")
    register_tables(spark, database, [delta], "s_delta")
    register_tables(spark, database, [str(tmp_path / "full" / "t")], "")
    assert _tables(spark, database) == ["s_delta_t", "s_full_t", "t"]
    register_tables(spark, database, [], "s_delta")
    assert _tables(spark, database) == ["s_full_t", "t"]


def test_new_partitions_are_found(spark, tmp_path, database):
    path = str(tmp_path / "p")
    spark.range(4).withColumn("day", F.lit("d1")).write.partitionBy("day").parquet(path)
    register_tables(spark, database, [path])
    spark.range(2).withColumn("day", F.lit("d2")).write.mode("append").partitionBy("day").parquet(path)
    register_tables(spark, database, [path])
    table = spark.table(f"{database}.p")
    assert {r.day: r["count"] for r in table.groupBy("day").count().collect()} == {"d1": 4, "d2": 2}
    pruned = table.filter("day = 'd2'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in pruned


def test_a_later_run_adds_the_new_partitions_only(spark, tmp_path, database, monkeypatch):
    path, past = str(tmp_path / "p"), 1_600_000_000

    def write(*days):
        rows = [(n, day, None if n % 2 else f"a b+{n}%25/é'") for n, day in enumerate(days)]
        spark.createDataFrame(rows, "id int, day date, kind string").write.mode("append").partitionBy("day", "kind").parquet(path)

    write(date(2024, 1, 1), date(2024, 1, 2))
    for file in glob.glob(f"{path}/**/*.parquet", recursive=True):
        os.utime(file, (past, past + (100 if "2024-01-02" in file else 0)))
    register_tables(spark, database, [path])
    added, statements, run = [], [], spark.sql
    monkeypatch.setattr(catalog, "_add_partitions", lambda *a, f=catalog._add_partitions: added.append(f(*a)))
    monkeypatch.setattr(catalog, "PARTITIONS_AT_ONCE", 2)
    write(*(date(2024, 2, d) for d in range(1, 6)))
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: statements.append(text) or run(text, *a, **k))
    register_tables(spark, database, [path])
    # Of the first run, files of its newest second are looked at again. Two partitions go into a statement.
    assert added == [6] and sum(t.startswith("ALTER TABLE") and " ADD IF" in t for t in statements) == 3
    assert not any("MSCK" in t for t in statements)
    table = spark.table(f"{database}.p")
    assert table.count() == 7 and table.filter("kind IS NULL").count() == 3 and table.filter("day = DATE'2024-02-03'").count() == 1
    assert {r.kind for r in table.collect()} == {None, *(f"a b+{n}%25/é'" for n in (0, 2, 4))}


def test_the_schema_of_very_many_listed_files_is_taken_in_blocks(spark, tmp_path, database, monkeypatch):
    monkeypatch.setattr(catalog, "LISTED_AT_ONCE", 2)
    path = str(tmp_path / "t")
    for n in range(5):
        spark.range(1).withColumn(f"c{n}", F.lit(n)).write.mode("append").parquet(path)
    register_tables(spark, database, [path], "", ["draft*"])
    table = spark.table(f"{database}.t")
    assert sorted(table.columns) == ["c0", "c1", "c2", "c3", "c4", "id"] and table.count() == 5


def test_excluded_files_do_not_count(spark, tmp_path, database):
    path = str(tmp_path / "t")
    spark.range(1).write.parquet(path)
    spark.range(1).withColumn("tmp", F.lit(1)).write.mode("append").option(
        "mapreduce.output.basename", "draft"
    ).parquet(path)
    register_tables(spark, database, [path], "", ["draft*"])
    assert spark.table(f"{database}.t").columns == ["id"]
    assert register_tables(spark, database, [path], "", ["*.parquet"]) == []
    assert _tables(spark, database) == []


def test_excluded_rows_are_not_read(spark, tmp_path, database):
    path, by_day = str(tmp_path / "t"), str(tmp_path / "d")
    spark.range(1).write.parquet(path)
    spark.range(5).write.mode("append").option("mapreduce.output.basename", "draft").parquet(path)
    spark.range(4).withColumn("day", F.lit("d1")).write.partitionBy("day").parquet(by_day)
    spark.range(9).withColumn("tmp", F.lit(1)).write.parquet(f"{by_day}/drafts")
    exclude = ["draft*", "*/drafts/*"]
    assert register_tables(spark, database, [path, by_day], "", exclude) == ["t", "d"]
    assert spark.table(f"{database}.t").count() == 1
    assert spark.table(f"{database}.d").columns == ["id", "day"] and spark.table(f"{database}.d").count() == 4
    # Later files, and the same folder without the patterns and with them again.
    spark.range(2).withColumn("new", F.lit(1)).write.mode("append").parquet(path)
    register_tables(spark, database, [path, by_day], "", exclude)
    assert spark.table(f"{database}.t").columns == ["id", "new"] and spark.table(f"{database}.t").count() == 3
    register_tables(spark, database, [path])
    assert _tables(spark, database) == ["t"] and spark.table(f"{database}.t").count() == 8
    register_tables(spark, database, [path], "", exclude)
    assert _tables(spark, database) == ["t", "t_files"] and spark.table(f"{database}.t").count() == 3
    register_tables(spark, database, [])
    assert _tables(spark, database) == []


def test_layer_paths():
    assert layer_paths("s3://b/stg/", ["T1"], "staging") == {
        "_FullLoad": ["s3://b/stg/T1_FullLoad"],
        "_delta": ["s3://b/stg/T1_delta"],
    }
    assert layer_paths("s3://b/gold", ["T1"], "gold") == {"": ["s3://b/gold/t1"]}
    with pytest.raises(ValueError):
        layer_paths("x", [], "iron")


def test_compaction_spreads_a_hot_key_and_sorts(spark, tmp_path):
    for n in range(6):
        spark.range(500).select(
            F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), (F.col("id") + n * 500).alias("v")
        ).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    df = spark.read.parquet(str(tmp_path / "in"))
    compact_table(df, str(tmp_path / "out"), ["k"], files=4)
    files = glob.glob(str(tmp_path / "out" / "*.parquet"))
    assert len(files) == 4
    hot = []
    for f in files:
        keys = [r.k for r in spark.read.parquet(f).collect()]
        assert keys == sorted(keys)
        hot.append(keys.count(-1))
    assert sum(hot) == df.filter("k = -1").count() and sum(1 for h in hot if h) >= 2
    assert spark.read.parquet(str(tmp_path / "out")).exceptAll(df).isEmpty()
