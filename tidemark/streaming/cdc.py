"""Change files as a stream into a table.

A target holds generations, ``gen-NNNN``, each with the full load it started from
(``base``), the stream's checkpoint, and one folder of changes per micro-batch. A
batch writes only its own changes, so its cost follows the batch and not the table;
a replayed batch overwrites its own folder. The table is base plus changes. Folding
the changes now and then keeps the number of folders small, and folding those that no
late change can precede into a new base, ``base-SEQ``, keeps the changes few.

Bases are stored in key buckets (``sources.keyed``, files under ``base_data``): the table is read
without shuffling its base, and folding writes only the buckets that changes touch.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.changes import cdc_apply, last_changes
from tidemark.sources import keyed, storage

START, RESUME, RELOAD = "start", "resume", "reload"


def _generations(spark: SparkSession, target: str) -> list[int]:
    found, number = [], 1
    while _bases(spark, _generation(target, number)):
        found.append(number)
        number += 1
    return found


def _bases(spark: SparkSession, home: str) -> dict[int | None, str]:
    """The complete bases by the sequence number up to which they hold the changes; the full load
    itself, which holds none, comes first."""
    names = [n for n in storage.complete_folders(spark, home) if re.fullmatch(r"base(-\d+)?", n)]
    settled = {n: int(n.removeprefix("base-")) if n != "base" else None for n in names}
    ordered = sorted(names, key=lambda n: (settled[n] is not None, settled[n] or 0))
    return {settled[n]: n for n in ordered}


def _generation(target: str, number: int) -> str:
    return f"{target.rstrip('/')}/gen-{number:04d}"


def _newest(spark: SparkSession, target: str) -> str:
    known = _generations(spark, target)
    if not known:
        raise ValueError(f"no table under {target}")
    return _generation(target, known[-1])


def cdc_stream(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    target: str,
    keys: Sequence[str],
    seq: str = "seq",
    mode: str = RESUME,
    full: DataFrame | None = None,
    start_time: datetime | None = None,
    time_col: str | None = None,
    fmt: str = "json",
    buckets: int | None = None,
    **reader_options: str,
) -> StreamingQuery:
    """Takes all change files that have arrived and then stops.

    ``start`` begins with the full load and a new checkpoint, ``resume`` goes on from the
    last checkpoint, ``reload`` begins again with a new full load. ``start_time`` drops
    changes of ``time_col`` before it. The full load is stored in so many key ``buckets``, by default
    as many as a shuffle has partitions.
    """
    known = _generations(spark, target)
    if mode == RESUME:
        if not known:
            raise ValueError(f"nothing to resume under {target}")
        home = _generation(target, known[-1])
    elif mode in (START, RELOAD):
        if mode == START and known:
            raise ValueError(f"{target} has been started: resume or reload it")
        if full is None:
            raise ValueError(f"{mode} needs the full load")
        home = _generation(target, len(known) + 1)
        keyed.store(full, f"{home}/base", f"{home}/base_data", keys, buckets)
    else:
        raise ValueError(f"mode must be start, resume or reload, not {mode!r}")

    changes = spark.readStream.schema(schema).format(fmt).options(**reader_options).load(source)
    if start_time is not None:
        changes = changes.filter(F.col(time_col) >= F.lit(start_time))

    def store(batch: DataFrame, batch_id: int) -> None:
        last_changes(batch, keys, seq).write.mode("overwrite").parquet(f"{home}/changes/batch-{batch_id}")

    return (
        changes.writeStream.foreachBatch(store)
        .option("checkpointLocation", f"{home}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )


def _finished(spark: SparkSession, home: str) -> tuple[int, list[str]]:
    """The newest finished batch, and the folders that hold all changes up to it."""
    batches: dict[int, str] = {}
    folded: dict[int, str] = {}
    for name in storage.complete_folders(spark, f"{home}/changes"):
        kind, number = name.rsplit("-", 1)
        (folded if kind == "upto" else batches)[int(number)] = name
    start = max(folded, default=-1)
    names = [folded[start]] if folded else []
    names += [name for number, name in batches.items() if number > start]
    return max([start, *batches]), [f"{home}/changes/{name}" for name in names]


def stored_changes(spark: SparkSession, home: str, schema: T.StructType) -> DataFrame:
    """The changes of all finished batches."""
    _, folders = _finished(spark, home)
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def _base(spark: SparkSession, home: str) -> tuple[keyed.Place | None, DataFrame, int | None]:
    settled, name = list(_bases(spark, home).items())[-1]
    place = keyed.load_place(spark, f"{home}/{name}")
    # A base of plain files is one that an earlier version of this module left.
    return place, keyed.read(spark, place) if place else spark.read.parquet(f"{home}/{name}"), settled


def _open_changes(changes: DataFrame, seq: str, settled: int | None) -> DataFrame:
    """Without the changes that the base already holds, or that came after they had to."""
    return changes if settled is None else changes.filter(F.col(seq) > settled)


def fold_changes(
    spark: SparkSession,
    target: str,
    schema: T.StructType,
    keys: Sequence[str],
    seq: str = "seq",
    settle: int | None = None,
) -> None:
    """Writes the finished batches of the newest generation as one folder, which takes their
    place; the folders it replaces are deleted. Deletes and sequence numbers are kept, so late
    changes still settle rightly.

    With ``settle``, a whole number of ``seq``, the changes up to it first become part of a new
    base. Changes up to it that arrive later are ignored, so it must be old enough. Readers of
    the older folders should be done by then.
    """
    home = _newest(spark, target)
    place, base, settled = _base(spark, home)
    last, folders = _finished(spark, home)
    changes = stored_changes(spark, home, schema)
    if settle is not None and (settled is None or settle > settled):
        due = _open_changes(changes, seq, settled).filter(F.col(seq).isNull() | (F.col(seq) <= settle))
        new = f"{home}/base-{settle}"
        if place:
            keyed.merge(spark, new, place, due, base.schema.fields, seq, "op")
        else:
            keyed.store(cdc_apply(base, due, keys, seq), new, f"{home}/base_data", keys)
        settled = settle
    elif len(folders) < 2:
        return
    place = f"{home}/changes/upto-{last}"
    if folders and folders != [place]:
        last_changes(_open_changes(changes, seq, settled), keys, seq).write.mode("overwrite").parquet(place)
        for folder in folders:
            storage.delete(spark, folder)
    for name in list(_bases(spark, home).values())[:-1]:
        storage.delete(spark, f"{home}/{name}")
    place, _, _ = _base(spark, home)
    if place:
        keyed.drop_stale(spark, place)


def current_table(
    spark: SparkSession, target: str, schema: T.StructType, keys: Sequence[str], seq: str = "seq"
) -> DataFrame:
    """The newest generation's table: late and repeated changes are settled by ``seq``."""
    home = _newest(spark, target)
    place, base, settled = _base(spark, home)
    changes = _open_changes(stored_changes(spark, home, schema), seq, settled)
    if place:
        return keyed.apply_changes(spark, place, changes, base.schema.fields, seq, "op")
    return cdc_apply(base, changes, keys, seq)
