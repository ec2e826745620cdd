"""Payload attributes of report files."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Path template placeholders and month formats.
PLACEHOLDER_NAME = "report_name"
PLACEHOLDER_MONTH = "dd_yyyy"
MONTH_IN_PATH = "MM_yyyy"
MONTH_IN_PAYLOAD = "MM-yyyy"
NOT_ALPHANUMERIC = r"[^\p{L}\p{N}]"


def report_type(name: Column) -> Column:
    """The first three ``_`` tokens of a file name, joined."""
    return F.array_join(F.slice(F.split(name, "_"), 1, 3), "")


def previous_month(as_of: Column, fmt: str = MONTH_IN_PATH) -> Column:
    return F.date_format(F.add_months(as_of, -1), fmt)


def report_path(template: str, name: Column, as_of: Column) -> Column:
    """The template with the report's name and the month before ``as_of`` filled in."""
    named = F.replace(F.lit(template), F.lit(PLACEHOLDER_NAME), name)
    return F.replace(named, F.lit(PLACEHOLDER_MONTH), previous_month(as_of))


def report_metadata(df: DataFrame, file_col: str, order_col: str) -> DataFrame:
    """One row per file: the name (letters and digits of the second column) and the id (last
    column) of the first row whose second column is not empty; both empty if there is none.

    A ``min`` over ordered structs, so rows are folded before the shuffle.
    """
    data = [n for n in df.columns if n not in (file_col, order_col)]
    name, ident = F.col(data[1]).cast("string"), F.col(data[-1]).cast("string")
    row = F.struct(F.col(order_col).alias("at"), name.alias("name"), ident.alias("id"))
    first = F.min(F.when(name != "", row)).alias("first")
    return (
        df.groupBy(file_col)
        .agg(first)
        .select(
            file_col,
            F.coalesce(F.regexp_replace("first.name", NOT_ALPHANUMERIC, ""), F.lit("")).alias("report_name"),
            F.coalesce("first.id", F.lit("")).alias("account_id"),
        )
    )


def report_payload(
    meta: DataFrame, as_of: date, file_col: str = "file", name: Column | None = None
) -> DataFrame:
    """The JSON attributes that go with each file. The type is taken from the file's name,
    or from ``name`` where that is given."""
    attributes = F.struct(
        F.col("account_id"),
        F.col("report_name"),
        report_type(F.col(file_col) if name is None else name).alias("report_type"),
        previous_month(F.lit(as_of), MONTH_IN_PAYLOAD).alias("report_date"),
    )
    return meta.select(file_col, F.to_json(attributes).alias("payload"))
