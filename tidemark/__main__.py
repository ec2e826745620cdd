"""Runs a job: ``spark-submit`` this package with a JSON config file.

    --config PATH --load_type init|snapshot|fold|cleanse|unload|report
    [--run_date yyyy-mm-dd] [--shuffle_bytes N]

The daily job's config (``init``, ``snapshot``; ``fold`` needs the target only) names ``source``
(``format``, ``options``), ``target``, ``snapshots``, ``primary_keys``, ``select_columns``,
``string_columns`` and, if they differ from the defaults, ``audit_columns`` and ``buckets``. The others:

    cleanse  ``source``, ``target``, ``options`` of the table, ``schema``, ``lookups`` (name: source)
    unload   ``job``, ``step_id``, ``log``
    report   ``queries`` (name: SQL), ``root``, ``template``, ``max_size_mb``, ``account``, ``order_by``

``views`` (name: source) are at hand to the SQL of ``unload`` and ``report``.
"""

from __future__ import annotations

import argparse
import json
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans.cleanse import clean_table
from tidemark.plans.daily import AUDIT_COLUMNS, daily_snapshot, fold_target, initial_load
from tidemark.plans.reports import export_reports
from tidemark.plans.unload_job import run_unload_job
from tidemark.session import build_session
from tidemark.sources.tables import read_table


LOAD_TYPES = ("init", "snapshot", "fold", "cleanse", "unload", "report")


def read_config(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def _source(spark: SparkSession, named: dict) -> DataFrame:
    return read_table(spark, named["format"], named.get("options", {}))


def run(
    spark: SparkSession, config: dict, load_type: str, run_date: date, at: datetime
) -> DataFrame | int | dict[str, str]:
    """The job's table, or an unload's number of rows, or the folders of the reports. Views are
    there while the job runs."""
    views = config.get("views", {})
    try:
        for name, named in views.items():
            _source(spark, named).createOrReplaceTempView(name)
        return _run(spark, config, load_type, run_date, at)
    finally:
        for name in views:
            spark.catalog.dropTempView(name)


def _run(
    spark: SparkSession, config: dict, load_type: str, run_date: date, at: datetime
) -> DataFrame | int | dict[str, str]:
    if load_type == "fold":
        return fold_target(spark, config["target"])
    if load_type == "cleanse":
        lookups = {name: _source(spark, named) for name, named in config.get("lookups", {}).items()}
        day, time = run_date.strftime("%Y%m%d"), at.strftime("%Y-%m-%d %H:%M:%S")
        table = _source(spark, config["source"])
        clean = clean_table(table, config["options"], day, time, config.get("schema"), lookups)
        clean.write.mode("overwrite").parquet(config["target"])
        return spark.read.schema(clean.schema).parquet(config["target"])
    if load_type == "unload":
        return run_unload_job(spark, config["job"], config["step_id"], run_date, config["log"])
    if load_type == "report":
        more = {k: config[k] for k in ("account", "order_by") if k in config}
        return export_reports(
            spark, config["queries"], config["root"], config["template"], run_date, config["max_size_mb"], **more
        )
    if load_type not in ("init", "snapshot"):
        raise ValueError(f"load_type must be one of {', '.join(LOAD_TYPES)}, not {load_type!r}")
    source = _source(spark, config["source"])
    target, snapshots, strings = config["target"], config["snapshots"], config["string_columns"]
    audit = tuple(config.get("audit_columns", AUDIT_COLUMNS))
    if load_type == "init":
        keys, buckets = config.get("primary_keys", ()), config.get("buckets")
        return initial_load(source, target, snapshots, run_date, strings, at, audit, keys=keys, buckets=buckets)
    return daily_snapshot(
        source,
        target,
        snapshots,
        run_date,
        config["primary_keys"],
        config["select_columns"],
        strings,
        at,
        audit,
    )


def main() -> None:
    parser = argparse.ArgumentParser(prog="tidemark")
    parser.add_argument("--config", required=True)
    parser.add_argument("--load_type", required=True, choices=LOAD_TYPES)
    parser.add_argument("--run_date", type=date.fromisoformat, help="yesterday, if not given")
    parser.add_argument("--shuffle_bytes", type=int, help="size of the largest shuffle to expect")
    args = parser.parse_args()
    now = datetime.now(timezone.utc)
    spark = build_session(shuffle_bytes=args.shuffle_bytes)
    run(spark, read_config(spark, args.config), args.load_type, args.run_date or now.date() - timedelta(days=1), now)
    spark.stop()


if __name__ == "__main__":
    main()
