"""Cleansing as pure column expressions: no UDF, everything stays in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats, patterns and defaults that results must agree with.
DATE_COMPACT = "yyyyMMdd"
DATE_DASHED = "yyyy-MM-dd"
DATE_SPACED = "yyyy MM dd"
DATE_SLASHED = "MM/dd/yyyy"
DATE_MONTH_NAME = "yyyy MMMM dd"
DATE_MONTH_NAME_WEEKDAY = (
    r"^(\d{4} [A-Za-z]+ \d{2}) "
    r"(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun|Monday|Tuesday|Wednesday|Thursday|Friday|Saturday|Sunday)$"
)
DATE_DEFAULT = "1900-01-01"
TIMESTAMP_CHARS = 26
NOT_PRINTABLE_ASCII = r"[^\x20-\x7E]"
NOT_FIRST_NAME = r"[^a-zA-Z\s\-]+"
NOT_MIDDLE_NAME = r"[^a-zA-Z]+"
NOT_SUFFIX = r"[^a-zA-Z.]+"
NOT_TELEPHONE = r"[^0-9]"
NOT_TAX_ID = r"[^0-9\-]"
NOT_CITY = r"[^a-zA-Z.\-\s]+"
NOT_ZIP = r"[^a-zA-Z0-9]+"


def _keep(c: Column, unwanted: str) -> Column:
    return F.regexp_replace(c, unwanted, "")


def ascii_only(c: Column) -> Column:
    return _keep(c, NOT_PRINTABLE_ASCII)


def timestamp_text(c: Column) -> Column:
    """Timestamp as text, cut after the microseconds."""
    return F.substring(c.cast("string"), 1, TIMESTAMP_CHARS)


def timestamp_date(c: Column) -> Column:
    return c.try_cast("date")


def date_text(c: Column) -> Column:
    """A date in any accepted format as ``yyyy-MM-dd`` text, else the default date.

    A value's separators already tell which formats it can have, so each value is
    parsed once (or twice) instead of once per format: failed parses are the cost.
    A sign may open the year, hence the dash is looked for from the second character. A date
    or timestamp column is not parsed: its day is taken as it is.
    """
    text = c.cast("string")
    typed = F.typeof(c).isin("date", "timestamp", "timestamp_ntz")
    month_named = F.coalesce(
        F.try_to_date(text, DATE_MONTH_NAME),
        F.try_to_date(F.nullif(F.regexp_extract(text, DATE_MONTH_NAME_WEEKDAY, 1), F.lit("")), DATE_MONTH_NAME),
    )
    parsed = (
        F.when(F.contains(text, F.lit("/")), F.try_to_date(text, DATE_SLASHED))
        .when(
            F.contains(text, F.lit(" ")),
            F.when(text.rlike("[A-Za-z]"), month_named).otherwise(F.try_to_date(text, DATE_SPACED)),
        )
        .when(F.contains(F.substr(text, F.lit(2)), F.lit("-")), F.try_to_date(text, DATE_DASHED))
        .otherwise(F.try_to_date(text, DATE_COMPACT))
    )
    day = F.when(typed, F.split_part(text, F.lit(" "), F.lit(1))).otherwise(parsed.cast("string"))
    return F.coalesce(day, F.lit(DATE_DEFAULT))


def first_name(c: Column) -> Column:
    """Drops a one-letter second word; null when the second word is empty."""
    words = F.split(c, " ")
    second = F.get(words, F.lit(1))
    kept = F.when(F.length(second) == 1, F.get(words, F.lit(0))).when(
        second.isNull() | (F.length(second) > 1), c
    )
    return F.upper(_keep(kept, NOT_FIRST_NAME))


def middle_name(c: Column) -> Column:
    return F.upper(_keep(c, NOT_MIDDLE_NAME))


def last_name(c: Column) -> Column:
    return F.upper(F.trim(c))


def name_suffix(c: Column) -> Column:
    return F.upper(_keep(c, NOT_SUFFIX))


def full_name(first: Column, middle: Column, last: Column, suffix: Column | None = None) -> Column:
    """The cleaned parts joined by one space, skipping the null ones."""
    parts = [first_name(first), middle_name(middle), last_name(last)]
    if suffix is not None:
        parts.append(name_suffix(suffix))
    return F.concat_ws(" ", *parts)


def full_name_flag(first: Column, last: Column) -> Column:
    return F.when(first_name(first).isNotNull() & last_name(last).isNotNull(), 1).otherwise(0)


def present_flag(c: Column) -> Column:
    return F.when(c.isNotNull(), 1).otherwise(0)


def telephone(c: Column) -> Column:
    return _keep(c, NOT_TELEPHONE)


def tax_id(c: Column) -> Column:
    return _keep(c, NOT_TAX_ID)


def tax_id_hash(c: Column) -> Column:
    return F.md5(tax_id(c))


def address_line(c: Column) -> Column:
    return F.upper(F.trim(c))


def city(c: Column) -> Column:
    return F.upper(_keep(c, NOT_CITY))


def zip_code(c: Column) -> Column:
    return F.upper(_keep(c, NOT_ZIP))


def strip_nul(c: Column) -> Column:
    return F.replace(c, F.lit("\u0000"), F.lit(""))


def escape_quotes(c: Column) -> Column:
    """Doubles single quotes. For text reports only: deletes bind their values."""
    return F.replace(c, F.lit("'"), F.lit("''"))
