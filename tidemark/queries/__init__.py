"""Registered queries: each builder stands beside the DuckDB SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUILDERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_MODULES = ("snapshots", "cleansing", "projections", "files", "exports", "reports", "runs", "tables")


class Tables:
    """The test tables of one folder, read when named."""

    def __init__(self, spark: SparkSession, folder: str):
        # Text forms of timestamps must not depend on the host.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))


def query(name: str, sql: str | None = None, text: Sequence[str] = ()):
    """Registers a builder that takes ``Tables``.

    Columns in ``text`` (dates, decimals, whole numbers with nulls) are compared as text, since
    clients show such values in different types.
    """

    def register(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Tables(spark, folder)).withColumns({c: F.col(c).cast("string") for c in text})

        BUILDERS[name] = run
        if sql is not None:
            shown = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in text)
            ORACLES[name] = f"SELECT * REPLACE ({shown}) FROM ({sql})" if text else sql
        return build

    return register


def load_all() -> None:
    for module in _MODULES:
        import_module(f"{__name__}.{module}")
