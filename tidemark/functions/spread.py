"""Spreading rows that share a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def spread(df: DataFrame) -> Column:
    """A number that differs between rows of one key, and between copies of one row that come
    from different input partitions.

    It depends on a row and its partition, not on the order of rows, so a task that is run
    again after a lost executor places its rows as before; random or running numbers
    would not.
    """
    return F.xxhash64(*(f.name for f in df.schema.fields if not _has_map(f.dataType)), F.spark_partition_id())


def _has_map(kind: T.DataType) -> bool:
    """Maps have no hash, wherever they stand in a type."""
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind.fields)
    return isinstance(kind, T.MapType)
