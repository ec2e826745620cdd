"""Session building and the shared scratch folder."""

from __future__ import annotations

import math
import re
import uuid

from pyspark.sql import SparkSession


# Shuffled bytes that one task takes on.
PARTITION_BYTES = 200 * 1024 * 1024


def build_session(
    app: str = "tidemark", master: str | None = None, shuffle_bytes: int | None = None, **conf: str
) -> SparkSession:
    """A session in UTC with adaptive execution; ANSI mode stays at Spark's default (on).

    ``shuffle_bytes`` is the size of the largest shuffle to expect, such as two snapshots of
    the largest table. It sets how many partitions shuffles start with; adaptive execution
    merges those that stay small and splits skewed ones, but never adds any, so the default
    of 200 is far too few for a very large table.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    if shuffle_bytes:
        partitions = max(200, math.ceil(shuffle_bytes / PARTITION_BYTES))
        builder = builder.config("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(partitions))
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder path for intermediate tables, under the cluster's shared folder.

    The shared folder is the session's ``spark.checkpoint.dir``. Without it the warehouse
    folder is used, which on a cluster must not be on one host's disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir")
        one_host = root.startswith("file:") or "://" not in root
        if one_host and not re.fullmatch(r"local(\[[^\]-]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{root.rstrip('/')}/tidemark/{name}-{uuid.uuid4().hex}"
