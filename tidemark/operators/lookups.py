"""Code-list lookups: left joins to a table of ``id, value, text``."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A code list is sent to every executor only below this measured size.
BROADCAST_BYTES = 16 * 1024 * 1024
_ROW_BYTES = 64


def _named(lookup_df: DataFrame) -> DataFrame:
    named = lookup_df.select(
        F.col("id").cast("string").alias("_lk_id"),
        F.col("value").cast("string").alias("_lk_value"),
        F.col("text").alias("_lk_text"),
    )
    return named.filter(F.col("_lk_id").isNotNull() & F.col("_lk_value").isNotNull())


def checked_all(lists: Sequence[DataFrame], limit: int = BROADCAST_BYTES) -> list[DataFrame]:
    """The code lists under internal names, each hinted for broadcast if it is small enough.

    One job over all of them finds duplicate keys, which would multiply the rows
    of the table, and their sizes. A longer list is joined by shuffle instead, where
    adaptive execution splits the table's skewed keys.
    """
    keyed = [_named(df) for df in lists]
    if not keyed:
        return []
    parts = [lk.withColumn("_lk_text", F.col("_lk_text").cast("string")).withColumn("_list", F.lit(n)) for n, lk in enumerate(keyed)]
    width = sum(
        (F.coalesce(F.octet_length(n).cast("long"), F.lit(0)) for n in keyed[0].columns), F.lit(_ROW_BYTES).cast("long")
    )
    found = (
        reduce(DataFrame.unionByName, parts)
        .groupBy("_list", "_lk_id", "_lk_value")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("bytes"))
        .groupBy("_list")
        .agg(F.max("n").alias("copies"), F.sum("bytes").alias("bytes"))
        .collect()
    )
    if any(r["copies"] > 1 for r in found):
        raise ValueError("the code list has several rows for one (id, value)")
    sizes = {r["_list"]: r["bytes"] for r in found}
    return [F.broadcast(lk) if sizes.get(n, 0) <= limit else lk for n, lk in enumerate(keyed)]


def checked(lookup_df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """The same for one list."""
    return checked_all([lookup_df], limit)[0]


def lookup(
    df: DataFrame,
    src: str,
    tgt: str,
    lookup_df: DataFrame,
    take: str = "text",
    default: str | None = None,
    id_col: str = "id",
) -> DataFrame:
    """Adds ``tgt``: the code list's ``take`` column for this row's code, else ``default``.

    Every column of the table is kept, its ``id`` too. A list used several times can be
    passed through ``checked`` once.
    """
    lk = lookup_df if "_lk_id" in lookup_df.columns else checked(lookup_df)
    joined = df.join(
        lk,
        (F.col(src).cast("string") == F.col("_lk_value")) & (F.col(id_col).cast("string") == F.col("_lk_id")),
        "left",
    )
    found: Column = F.col(f"_lk_{take}")
    if default is not None:
        found = F.coalesce(found, F.lit(default))
    return joined.withColumn(tgt, found).drop("_lk_id", "_lk_value", "_lk_text")


def gender(df: DataFrame, src: str, tgt: str, codes: DataFrame) -> DataFrame:
    return lookup(df, src, tgt, codes, "text")


def marital_status(df: DataFrame, src: str, tgt: str, codes: DataFrame) -> DataFrame:
    return lookup(df, src, tgt, codes, "text", "N/A")


def state(df: DataFrame, src: str, tgt: str, codes: DataFrame) -> DataFrame:
    return lookup(df, src, tgt, codes, "value")


def country(df: DataFrame, src: str, tgt: str, codes: DataFrame) -> DataFrame:
    return lookup(df, src, tgt, codes, "text")
