"""Serving-database sinks."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence
from itertools import batched

from pyspark.sql import DataFrame, Row

# Connections used for loads and for key deletes.
LOAD_CONNECTIONS = 30
DELETE_CONNECTIONS = 20
DELETE_BATCH = 1000

_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_$]*(\.[A-Za-z_][A-Za-z0-9_$]*)*")


def append_table(
    df: DataFrame, url: str, table: str, properties: dict[str, str], connections: int = LOAD_CONNECTIONS
) -> None:
    """Initial load: appends on a bounded number of connections of even size.

    Each partition commits by itself, so a task that is run again after its commit can
    repeat rows: load a staging table and merge it by key where that matters.
    """
    df.repartition(connections).write.jdbc(url, table, mode="append", properties=properties)


def replace_rows(
    df: DataFrame, url: str, table: str, properties: dict[str, str], connections: int = LOAD_CONNECTIONS
) -> None:
    """Replaces a staging table's rows and keeps the table, its grants and its indexes."""
    df.repartition(connections).write.jdbc(
        url, table, mode="overwrite", properties={**properties, "truncate": "true"}
    )


def delete_statement(table: str, keys: Sequence[str], placeholder: str = "%s") -> str:
    for name in (table, *keys):
        if not _NAME.fullmatch(name):
            raise ValueError(f"{name!r} is not a plain identifier")
    return f"DELETE FROM {table} WHERE " + " AND ".join(f"{k} = {placeholder}" for k in keys)


def delete_keys(
    df: DataFrame,
    connect: Callable,
    table: str,
    keys: Sequence[str],
    max_conn: int = DELETE_CONNECTIONS,
    placeholder: str = "%s",
) -> None:
    """Deletes the rows of the given keys: one connection and one commit per partition,
    values bound in batches. A task that is run again deletes nothing more.

    ``connect`` returns a DB-API connection; it is called on the executors.
    """
    statement = delete_statement(table, keys, placeholder)
    names = list(keys)

    def delete_partition(rows: Iterable[Row]) -> None:
        connection = None
        try:
            for batch in batched(rows, DELETE_BATCH):
                if connection is None:
                    connection = connect()
                connection.cursor().executemany(statement, [tuple(r[n] for n in names) for r in batch])
            if connection is not None:
                connection.commit()
        finally:
            if connection is not None:
                connection.close()

    df.select(*keys).repartition(max_conn).foreachPartition(delete_partition)
