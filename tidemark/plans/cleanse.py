"""Cleansing a table by its options."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from tidemark.operators.cleansing import apply_rules, clean_date_suffix
from tidemark.operators.projection import add_load_columns, cast_all_string, cast_columns

# Option names of a table.
RULES = "fixedColumnsCleansingRules"
CASTS = "fixed_columns"
DATE_RULE = "global_date_cleansing_rule"
ALL_STRING = "dataTypeCastingToString"


def clean_table(
    df: DataFrame,
    options: dict,
    the_date: str,
    load_time: str,
    schema: str | None = None,
    lookups: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """All steps a table's options ask for, as one lazy plan: everything to text, the
    cleansing rules, the casts, the date rule by suffix, and the load columns."""
    if options.get(ALL_STRING):
        df = cast_all_string(df)
    df = apply_rules(df, options.get(RULES) or [], lookups)
    df = cast_columns(df, options.get(CASTS) or [])
    if options.get(DATE_RULE):
        df = clean_date_suffix(df, options[DATE_RULE]["suffix"])
    return add_load_columns(df, the_date, load_time, schema)
