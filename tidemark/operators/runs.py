"""Batch-dated transforms and questions about the run log.

``run_log``: step_id, batch_dt, status, rows, message, ts.
``steps``: step_id, name, seq, step_order, info (JSON), depends_on (a step's name).
Lists are rows here, not collected arrays: the log grows with history.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMPLETED = "COMPLETED"
FAILED = "FAILED"


def bind_batch_date(
    spark: SparkSession, sql: str, batch_dt: date, adhoc: date | None = None, **tables: DataFrame
) -> DataFrame:
    """Runs a statement that names ``:batch_dt``, for its batch date or an ad-hoc one.

    ``tables`` are DataFrames that the statement names in braces.
    """
    return spark.sql(sql, args={"batch_dt": adhoc or batch_dt}, **tables)


def run_latest_status(log: DataFrame) -> DataFrame:
    """The newest status per step and batch date, and whether a re-run has to run it."""
    newest = F.max(F.struct("ts", "status")).alias("newest")
    return (
        log.groupBy("step_id", "batch_dt")
        .agg(newest)
        .select("step_id", "batch_dt", F.col("newest.status").alias("status"))
        .withColumn("to_run", ~F.col("status").eqNullSafe(COMPLETED))
    )


def run_completed(log: DataFrame, steps: DataFrame) -> DataFrame:
    """The tables whose newest status is COMPLETED, one row per batch date and table. A step
    that is no longer configured has no name."""
    done = run_latest_status(log).filter(F.col("status") == COMPLETED)
    named = done.join(steps.select("step_id", "name"), "step_id", "left")
    return named.select("batch_dt", F.col("name").alias("table_name"))


def of_schedule(log: DataFrame, schedule: DataFrame) -> DataFrame:
    """The log's entries of the schedule's batch dates. The first and the last date are found first, so
    that of a log in folders by date only these and those between are listed and read."""
    dates = schedule.select(F.col("batch_dt").alias("_due")).distinct()
    ends = dates.agg(F.min("_due").alias("first"), F.max("_due").alias("last")).first()
    # A null date is a date of its own.
    within = F.col("batch_dt").isNull() if ends["first"] is None else F.col("batch_dt").between(F.lit(ends["first"]), F.lit(ends["last"])) | F.col("batch_dt").isNull()
    return log.filter(within).join(dates, F.col("batch_dt").eqNullSafe(F.col("_due")), "left_semi")


def run_ready(
    steps: DataFrame, log: DataFrame, schedule: DataFrame | None = None, scheduled_only: bool = False
) -> DataFrame:
    """Unfinished (step, batch date) pairs that may start: the step has no dependency, does
    not check it, or its dependency is COMPLETED for that batch date.

    ``schedule`` (step_id, batch_dt) names the pairs that are to run, also those that have never
    started and so are not in the log; pairs of the log count in any case, or with ``scheduled_only``
    where their date is one of the schedule's, and then no other date of the log is read. Two steps of
    one name are an error.
    """
    if scheduled_only:
        if schedule is None:
            raise ValueError("scheduled_only needs a schedule")
        log = of_schedule(log, schedule)
    newest = run_latest_status(log)
    pending = newest.filter("to_run").select("step_id", "batch_dt")
    if schedule is not None:
        due = schedule.select(F.col("step_id").alias("_s"), F.col("batch_dt").alias("_d")).distinct()
        started = F.col("_s").eqNullSafe(F.col("step_id")) & F.col("_d").eqNullSafe(F.col("batch_dt"))
        never = due.join(newest, started, "left_anti").select(F.col("_s").alias("step_id"), F.col("_d").alias("batch_dt"))
        pending = pending.unionByName(never)
    done = newest.filter(F.col("status") == COMPLETED).select(
        F.col("step_id").alias("_dep_id"), F.col("batch_dt").alias("_dep_dt")
    ).filter(F.col("_dep_id").isNotNull())
    repeated = F.raise_error(F.concat(F.lit("two steps are named "), F.col("name"))).cast("boolean")
    names = (
        steps.groupBy("name")
        .agg(F.max("step_id").alias("_named_id"), F.count(F.lit(1)).alias("_same"))
        .filter(F.when(F.col("name").isNotNull() & (F.col("_same") > 1), repeated).otherwise(True))
        .select("_named_id", F.col("name").alias("_named"))
    )
    checks = F.upper(F.get_json_object("info", "$.dependency_check")).eqNullSafe("TRUE")
    wanted = steps.select("step_id", "name", "depends_on", checks.alias("checks")).join(
        names, F.col("depends_on") == F.col("_named"), "left"
    )
    pending = pending.join(wanted, "step_id")
    joined = pending.join(
        # Null-safe so that a dependency which very many steps share can be split.
        done,
        F.col("_named_id").eqNullSafe(F.col("_dep_id")) & F.col("batch_dt").eqNullSafe(F.col("_dep_dt")),
        "left",
    )
    free = F.col("depends_on").isNull() | ~F.col("checks") | F.col("_dep_id").isNotNull()
    return joined.filter(free).select("step_id", "name", "batch_dt")


def run_groups(steps: DataFrame) -> DataFrame:
    """Steps in run order, by batch date, sequence and order (0 where missing), with the
    size of their group (the steps of one batch date and sequence).

    The order is a range-partitioned sort, so no group has to fit in one task.
    """
    ordered = steps.withColumn("step_order", F.coalesce("step_order", F.lit(0)))
    sizes = ordered.groupBy(F.col("batch_dt").alias("_dt"), F.col("seq").alias("_seq")).agg(
        F.count(F.lit(1)).alias("group_size")
    )
    return (
        ordered.join(sizes, F.col("batch_dt").eqNullSafe(F.col("_dt")) & F.col("seq").eqNullSafe(F.col("_seq")))
        .select("batch_dt", "seq", "step_order", "step_id", "name", "group_size")
        .orderBy("batch_dt", "seq", "step_order", "step_id")
    )


def run_summary(log: DataFrame) -> DataFrame:
    """JSON lines per batch date: one for each table (``step_id`` set) and one for the whole
    batch (``step_id`` null), with counts, rows and the newest error."""
    failed = F.when(F.col("status") == FAILED, F.struct("ts", "message"))
    tables = log.groupBy("batch_dt", "step_id").agg(
        F.max(F.struct("ts", "status"))["status"].alias("status"),
        F.count(F.lit(1)).alias("entries"),
        F.count(failed).alias("failures"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.max(failed).alias("last"),
    )
    per_table = tables.select(
        "batch_dt",
        "step_id",
        F.to_json(
            F.struct("status", "entries", "failures", "rows", F.coalesce("last.message", F.lit("")).alias("error"))
        ).alias("summary"),
    )
    batches = tables.groupBy("batch_dt").agg(
        F.count(F.lit(1)).alias("tables"),
        F.count(F.when(F.col("status") == COMPLETED, 1)).alias("completed"),
        F.sum("entries").alias("entries"),
        F.sum("failures").alias("failures"),
        F.sum("rows").alias("rows"),
        F.max("last").alias("last"),
    )
    per_batch = batches.select(
        "batch_dt",
        F.lit(None).cast(log.schema["step_id"].dataType).alias("step_id"),
        F.to_json(
            F.struct(
                "tables", "completed", "entries", "failures", "rows", F.coalesce("last.message", F.lit("")).alias("error")
            )
        ).alias("summary"),
    )
    return per_table.unionByName(per_batch)
