"""A configured unload: run the query, write its files, keep the run log."""

from __future__ import annotations

import json
import logging
from datetime import date

from pyspark.sql import SparkSession

from tidemark.sources import run_log
from tidemark.sources.export import unload

log = logging.getLogger(__name__)

# Option names of an unload.
_OPTIONS = (
    "delimiter",
    "header",
    "addquotes",
    "compression",
    "parallel",
    "breakup_threshold",
    "file_prefix",
    "file_extension",
    "manifest",
)


def check_job(job: dict) -> dict:
    """The job's unload options, with the query. Raises on missing or unknown settings."""
    options = job.get("unload") or {}
    if isinstance(options, str):
        options = json.loads(options)
    # The query may stand beside the unload options or among them.
    options = {**options, "query": options.get("query") or job.get("query")}
    missing = [k for k in ("bucket", "key", "data_format", "query") if not options.get(k)]
    if missing:
        raise ValueError(f"job {job.get('table_name')!r} lacks {', '.join(missing)}")
    if options["data_format"] not in ("csv", "parquet"):
        raise ValueError(f"job {job.get('table_name')!r}: data_format must be csv or parquet")
    return options


def run_unload_job(spark: SparkSession, job: dict, step_id: int, batch_dt: date, log_path: str) -> int:
    """Runs one job and returns the rows written. Its statuses go to the run log together when it
    ends, so the log gets one file per job.

    ``bucket`` is the root path of the output, ``key`` the folder below it.
    """

    entries = []

    def status(name: str, rows: int | None = None, message: str | None = None) -> None:
        entries.append(run_log.entry(step_id, batch_dt, name, rows, message))

    status(run_log.START)
    try:
        rows = 0
        if str(job.get("unload_to_s3", "false")).lower() == "true":
            options = check_job(job)
            folder = "/".join(p for p in options["key"].split("/") if p)
            settings = {k: options[k] for k in _OPTIONS if options.get(k) is not None}
            settings.setdefault("file_prefix", job["table_name"])
            rows = unload(
                spark.sql(options["query"], args={"batch_dt": batch_dt}),
                f"{options['bucket'].rstrip('/')}/{folder}",
                options["data_format"],
                custom_headers=job.get("custom_headers"),
                **settings,
            )
            status(run_log.UNLOADED, rows)
        else:
            status(run_log.SKIPPED, message="unload_to_s3 is false")
        status(run_log.END)
        return rows
    except Exception as error:
        status(run_log.FAILED, message=str(error))
        raise
    finally:
        run_log.log_entries(spark, log_path, entries)
