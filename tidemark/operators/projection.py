"""Projections, casts and gates. Each one is a single ``select`` or ``withColumns``."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from tidemark.functions import cleansing as c
from tidemark.functions.schema import cast_or_null, parse_field


class EmptySource(ValueError):
    """The source holds no rows, so the run must stop before it overwrites anything."""


def strip_nul(df: DataFrame, strings: Sequence[str]) -> DataFrame:
    listed = set(strings)
    return df.select(*[c.strip_nul(F.col(n)).alias(n) if n in listed else F.col(n) for n in df.columns])


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


def add_audit_columns(
    df: DataFrame, at: datetime, ts_col: str = "load_ts", date_col: str = "load_date"
) -> DataFrame:
    """Run time and run day, passed in so that a re-run gives the same rows. Give the time its
    zone: Spark takes a time without one to be in the driver's."""
    return df.withColumns({ts_col: F.lit(at), date_col: F.lit(at.date())})


def add_load_columns(df: DataFrame, the_date: str, load_time: str, schema: str | None = None) -> DataFrame:
    """``the_date`` is ``yyyyMMdd`` and is checked here, on the driver."""
    day = datetime.strptime(the_date, "%Y%m%d").date()
    added: dict[str, Column] = {}
    if schema is not None:
        added["schema_name"] = F.lit(schema.lower())
    added["load_date"] = F.lit(day.isoformat())
    added["load_time"] = F.lit(load_time.lower())
    return df.withColumns(added)


def cast_all_string(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(n).cast("string").alias(n) for n in df.columns])


def _cast(df: DataFrame, column: str, target: str | DataType) -> Column:
    source = {f.name.lower(): f.dataType for f in df.schema.fields}
    if column.lower() not in source:
        raise ValueError(f"cannot cast column {column!r}: the table has no such column")
    return cast_or_null(F.col(column), source[column.lower()], target)


def cast_columns(df: DataFrame, specs: Sequence[dict]) -> DataFrame:
    """``specs``: ``[{"column": ..., "data_type": ...}]``; values that do not fit become null."""
    return df.withColumns({s["column"]: _cast(df, s["column"], s["data_type"]) for s in specs})


def apply_schema(df: DataFrame, specs: Sequence[str]) -> DataFrame:
    """The declared columns only, cast to their declared types, names in lower case."""
    fields = [parse_field(s) for s in specs]
    return df.select(*[_cast(df, name, f.dataType).alias(f.name) for name, f in fields])


def require_rows(df: DataFrame, what: str = "source") -> DataFrame:
    """Stops on an empty source after looking for one row, not counting them all."""
    if df.isEmpty():
        raise EmptySource(f"{what} holds no rows")
    return df


def split_rejects(df: DataFrame, specs: Sequence[dict]) -> tuple[DataFrame, DataFrame]:
    """Rows whose listed columns all cast, and the others with the columns that failed.

    Good rows carry the cast values; rejected rows keep their source values.
    """
    failed = F.concat_ws(
        ",",
        *[
            F.when(F.col(s["column"]).isNotNull() & _cast(df, s["column"], s["data_type"]).isNull(), s["column"])
            for s in specs
        ],
    )
    good = cast_columns(df.filter(failed == ""), specs)
    rejects = df.withColumn("reject_reason", failed).filter(F.col("reject_reason") != "")
    return good, rejects


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    return df.filter(F.col(key).isNotNull()).select(key).distinct()
