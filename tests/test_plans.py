"""Plans that must hold at scale."""

from __future__ import annotations

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark import queries
from tidemark.operators import files, lookups, runs, snapshots
from tidemark.sources.files import list_files
from tidemark.sources.tables import read_table

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
queries.load_all()

needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.collect()
    return plan(df)


class Executions:
    """The plans of all SQL executions since this was made, as Spark's status store holds them."""

    def __init__(self, spark):
        self.context = spark._jsparkSession.sparkContext()
        self.store = spark._jsparkSession.sharedState().statusStore()
        self.before = self._count()

    def _count(self) -> int:
        self.context.listenerBus().waitUntilEmpty()
        return self.store.executionsCount()

    def plans(self) -> list[str]:
        made = self._count() - self.before
        ids = sorted((e.executionId() for e in self._listed()), reverse=True)[:made]
        return [self.store.execution(i).get().physicalPlanDescription() for i in ids]

    def _listed(self):
        listed = self.store.executionsList()
        return [listed.apply(k) for k in range(listed.size())]


PAIRS_OR_PYTHON = ("CartesianProduct", "BroadcastNestedLoopJoin", "Python")


@needs_tables
@pytest.mark.parametrize("name", sorted(queries.BUILDERS))
def test_no_query_pairs_rows_or_runs_python(spark, name):
    """Neither the query's own plan nor those of the writes that it makes on its way, which may use
    one task, as they are sized by bytes."""
    executions = Executions(spark)
    text = plan(queries.BUILDERS[name](spark, FOLDER))
    assert not [bad for bad in (*PAIRS_OR_PYTHON, "SinglePartition, REPARTITION") if bad in text]
    for written in executions.plans():
        assert not [bad for bad in PAIRS_OR_PYTHON if bad in written]


@needs_tables
def test_plans_of_writes_are_seen(spark, tmp_path):
    executions = Executions(spark)
    nation = spark.read.parquet(f"{FOLDER}/nation.parquet")
    nation.crossJoin(nation.select("n_name").toDF("other")).write.parquet(str(tmp_path / "pairs"))
    assert any("NestedLoop" in p or "Cartesian" in p for p in executions.plans())


@needs_tables
def test_filters_and_columns_reach_the_scan(spark):
    orders = read_table(spark, "parquet", {"path": f"{FOLDER}/orders.parquet"})
    text = plan(orders.filter("o_custkey = 7").select("o_orderkey"))
    assert "EqualTo(o_custkey,7)" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in text


def test_a_day_filter_reaches_the_listing(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x")
    listed = files.files_on(list_files(spark, str(tmp_path)), date(2024, 1, 2))
    assert "PushedFilters: [IsNotNull(modificationTime), GreaterThanOrEqual(modificationTime" in plan(listed)


@needs_tables
def test_a_snapshot_comparison_shuffles_once(spark):
    latest = spark.read.parquet(f"{FOLDER}/orders.parquet")
    text = plan(snapshots.snapshot_delta(latest, latest.filter("o_custkey > 3"), latest.columns))
    assert text.count("Exchange") == 1 and "Join" not in text
    deletes = plan(snapshots.snapshot_deletes(latest, latest, ["o_orderkey"]))
    assert "ReadSchema: struct<o_orderkey:bigint>" in deletes


@needs_tables
def test_the_change_feed_aggregates_the_keys_once(spark):
    latest = spark.read.parquet(f"{FOLDER}/orders.parquet")
    feed = snapshots.change_feed(latest, latest.filter("o_custkey > 3"), ["o_orderkey"], latest.columns)
    assert "ReusedExchange" in final_plan(feed)


@needs_tables
@pytest.mark.parametrize("name", ["run_summary", "change_feed_lineitem"])
def test_two_uses_of_an_aggregate_share_its_exchange(spark, name):
    assert "ReusedExchange" in final_plan(queries.BUILDERS[name](spark, FOLDER))


@pytest.fixture
def skewed(spark):
    """Small thresholds, so that a hot key of a small table counts as skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    # Several input partitions, so that the hot partition has several blocks to split by.
    yield spark.range(0, 60_000, 1, 16).withColumn("hot", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")))
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def assert_split(df):
    assert "skewed" in final_plan(df)


def test_hot_file_bases_are_split(skewed):
    listing = skewed.select(F.concat(F.lit("raw/r_"), "hot", F.lit("_"), F.lpad(F.col("id").cast("string"), 9, "0")).alias("path"))
    named = files.normalize_file_names(listing)
    assert_split(named)
    assert named.count() == 60_000


def test_hot_target_keys_are_split(skewed):
    target = skewed.select(F.col("hot").alias("k"), F.col("id").alias("v"))
    upserts = skewed.filter("hot > 50000").select(F.col("hot").alias("k"), F.col("id").alias("v"))
    merged = snapshots.upsert_merge(target, upserts, ["k"])
    assert_split(merged)
    assert merged.count() == 60_000


def test_hot_delta_keys_are_split(skewed):
    latest = skewed.select(F.col("hot").alias("k"), F.col("id").alias("v"))
    previous = latest.withColumn("v", F.col("v") + 1)
    feed = snapshots.change_feed(latest, previous, ["k"], ["k", "v"])
    assert_split(feed)
    # Of the rows of the hot key, and of all others, none is equal to one of the day before.
    assert feed.groupBy("op").count().collect()[0]["count"] == 60_000


def test_hot_run_groups_are_split(skewed):
    steps = skewed.select(
        F.lit("2024-01-01").cast("date").alias("batch_dt"),
        F.col("hot").alias("seq"),
        F.lit(None).cast("int").alias("step_order"),
        F.col("id").alias("step_id"),
        F.lit("s").alias("name"),
    )
    grouped = runs.run_groups(steps)
    assert_split(grouped)
    assert grouped.filter("seq = 0").select("group_size").distinct().first()[0] == 20_000


def test_hot_codes_are_split_when_the_code_list_is_long(spark, skewed):
    table = skewed.select(F.lit(1).alias("id"), F.col("hot").cast("string").alias("code"), F.col("id").alias("row"))
    codes = skewed.filter("hot = id").select(
        F.lit(1).alias("id"), F.col("id").cast("string").alias("value"), F.concat(F.lit("t"), "id").alias("text")
    )
    found = lookups.state(table, "code", "found", lookups.checked(codes, limit=0))
    assert_split(found)
    assert found.count() == 60_000 and found.filter("found IS NULL").isEmpty()


def test_hot_dependencies_are_split(spark, skewed):
    """All steps wait for one of a few others; a third of them for the same."""
    steps = skewed.select(
        F.col("id").alias("step_id"),
        F.concat(F.lit("s"), "id").alias("name"),
        F.lit('{"dependency_check": "true"}').alias("info"),
        F.concat(F.lit("s"), "hot").alias("depends_on"),
    )
    log = skewed.select(
        F.col("id").alias("step_id"),
        F.lit(date(2024, 1, 1)).alias("batch_dt"),
        F.when(F.col("id") == 0, "COMPLETED").otherwise("START").alias("status"),
        F.lit(None).cast("long").alias("rows"),
        F.lit(None).cast("string").alias("message"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("ts"),
    )
    ready = runs.run_ready(steps, log)
    assert_split(ready)
    assert ready.count() == 19_999
