"""Applying ordered change records (``op`` = I, U or D) to a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.snapshots import anti_keys

DELETE = "D"


def last_changes(changes: DataFrame, keys: Sequence[str], seq: str = "seq", op: str = "op") -> DataFrame:
    """The last record of each key. Records equal in ``seq`` are ordered by their content,
    deletes last, so the result does not depend on the order of arrival.

    The row-number filter lets Spark keep one row per key in each task before the
    shuffle, so a key with very many records sends few of them.
    """
    rest = [
        f.name for f in changes.schema if f.name not in {*keys, seq, op} and not isinstance(f.dataType, T.MapType)
    ]
    order = [F.desc(seq), F.when(F.col(op) == DELETE, 0).otherwise(1), F.asc(op), *rest]
    newest = Window.partitionBy(*keys).orderBy(*order)
    return changes.withColumn("_n", F.row_number().over(newest)).filter("_n = 1").drop("_n")


def cdc_apply(
    target: DataFrame, changes: DataFrame, keys: Sequence[str], seq: str = "seq", op: str = "op"
) -> DataFrame:
    """The target after all changes: the last record of a key wins, a delete removes it.

    A record without ``op`` is a full-load record and counts as an insert.
    """
    kept = anti_keys(target, changes, keys)
    alive = last_changes(changes, keys, seq, op).filter(F.col(op).isNull() | (F.col(op) != DELETE))
    return kept.unionByName(alive.select(*target.columns))
