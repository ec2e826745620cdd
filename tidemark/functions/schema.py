"""Declared column types (``name=type`` or ``name=source>target(p,s)``) as Spark schemas."""

from __future__ import annotations

import re
from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Declared type name -> Spark type.
TYPES: dict[str, type[T.DataType]] = {
    "byte": T.ByteType,
    "short": T.ShortType,
    "smallint": T.ShortType,
    "tinyint": T.IntegerType,
    "int": T.IntegerType,
    "integer": T.IntegerType,
    "bigint": T.LongType,
    "long": T.LongType,
    "real": T.FloatType,
    "float": T.DoubleType,
    "double": T.DoubleType,
    "decimal": T.DecimalType,
    "bit": T.BooleanType,
    "boolean": T.BooleanType,
    "character": T.StringType,
    "char": T.StringType,
    "string": T.StringType,
    "varchar": T.StringType,
    "time": T.StringType,
    "xml": T.StringType,
    "clob": T.StringType,
    "blob": T.StringType,
    "binary": T.BinaryType,
    "date": T.DateType,
    "timestamp": T.TimestampType,
    "timestmp": T.TimestampType,
    "datetime": T.TimestampType,
}

_SPEC = re.compile(r"^(?P<name>[^=]+)=(?:[^>]*>)?\s*(?P<type>\w+)\s*(?:\((?P<args>[\d\s,]*)\))?\s*$")


def parse_field(spec: str) -> tuple[str, T.StructField]:
    """The declared name and its field, which is lower-cased and nullable."""
    match = _SPEC.match(spec)
    if match is None:
        raise ValueError(f"column spec {spec!r} is not name=type or name=source>target")
    name, type_name = match["name"].strip(), match["type"].lower()
    if type_name not in TYPES:
        raise ValueError(f"column {name!r} has the unknown type {type_name!r}")
    spark_type = TYPES[type_name]
    if spark_type is T.DecimalType and match["args"]:
        data_type: T.DataType = T.DecimalType(*(int(a) for a in match["args"].split(",")))
    else:
        # Lengths of character types carry no meaning in Spark.
        data_type = spark_type()
    return name, T.StructField(name.lower(), data_type, True)


def parse_schema(specs: list[str]) -> T.StructType:
    return T.StructType([parse_field(s)[1] for s in specs])


_NUMBER = re.compile(r"(tinyint|byte|smallint|short|int|integer|bigint|long|decimal|dec|numeric)\b", re.IGNORECASE)


def cast_or_null(c: Column, source: T.DataType, target: str | T.DataType) -> Column:
    """The column cast, null where a value does not fit.

    A failed cast of text to a number costs an exception for each value. Text that starts
    with a letter, or with any other character from ":" to "~", never casts, so it becomes
    null without trying.
    """
    name = target if isinstance(target, str) else target.simpleString()
    if isinstance(source, T.StringType) and _NUMBER.match(name.strip()):
        return F.when((c < ":") | (c >= "\x7f"), c.try_cast(target))
    return c.try_cast(target)


_INTEGRAL = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
_NUMERIC = [*_INTEGRAL, T.FloatType, T.DoubleType]
_TIMES = [T.DateType, T.TimestampNTZType, T.TimestampType]


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds the values of both: the longer number, the decimal with room for both, the
    double of a decimal and a fraction, the timestamp of a date, else text. Nested types must be equal."""
    if a == b:
        return a
    kinds = type(a), type(b)
    for order in (_NUMERIC, _TIMES):
        if all(k in order for k in kinds):
            return max((a, b), key=lambda t: order.index(type(t)))
    if T.DecimalType in kinds and all(k in (*_NUMERIC, T.DecimalType) for k in kinds):
        if not all(k in (*_INTEGRAL, T.DecimalType) for k in kinds):
            return T.DoubleType()
        sizes = [(t.precision, t.scale) if isinstance(t, T.DecimalType) else (_INTEGRAL[type(t)], 0) for t in (a, b)]
        scale = max(s for _, s in sizes)
        return T.DecimalType(min(38, max(p - s for p, s in sizes) + scale), scale)
    if T.NullType in kinds:
        return b if isinstance(a, T.NullType) else a
    if T.StringType in kinds and not any(isinstance(t, (T.ArrayType, T.MapType, T.StructType, T.BinaryType)) for t in (a, b)):
        return T.StringType()
    raise ValueError(f"no type holds both {a.simpleString()} and {b.simpleString()}")


def aligned(rows: DataFrame, fields: Sequence[T.StructField], visible: Collection[str] | None = None) -> DataFrame:
    """The rows with these columns, cast to their types; those that the rows do not have, or that are
    not among ``visible``, are null."""
    there = set(rows.columns) if visible is None else set(rows.columns) & set(visible)
    return rows.select(
        *((F.col(f.name) if f.name in there else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields)
    )
