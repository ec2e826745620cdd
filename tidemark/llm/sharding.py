"""Sharding by fixed virtual slots.

A record's slot comes from its id by hash and never changes. Bytes are summed per slot, and a
table maps slots to shards: whole slots are dealt so that shards get nearly equal bytes. The map
is stored with a version; rebalancing or growing writes the next version, in which as few slots
as needed change their shard, and no record is hashed again.

The map has one row per slot (a parameter, thousands), whatever the data; only it and the sums
per slot are ever seen by the driver. To number the records of a shard, a slot is cut by hash into pieces
of some ``PIECE_ROWS`` rows, each one group of a shuffle, and rows that are alike are counted
before it; so neither a larger table nor an id with a third of all rows makes a task larger. What
is shuffled has no text.

Defined results: a null text has size 1 and the checksum of empty text; a null id is placed by
its text's checksum and size; rows with equal ids share a slot and get places of their own, so an id with
more bytes than a shard's share makes its shard larger than the others; slots with equal bytes are dealt by
their number; an empty table gives no rows; other columns are ignored. A text is only measured,
however long it is.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import settled, stored
from tidemark.session import scratch_dir
from tidemark.sources.storage import complete_folders

SLOTS = 4096
SHARDS = 8
# Rows that are numbered as one group.
PIECE_ROWS = 200_000
# Rows alike that a task unfolds in one go.
UNFOLD = 10_000


def _sized(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    text = F.coalesce(F.col(text_column), F.lit(""))
    return docs.select(
        F.col(id_column).alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )


def slot_of(slots: int) -> Column:
    """The virtual slot of a row of ``doc_id``, ``size`` and ``text_crc32``."""
    by_text = F.xxhash64("text_crc32", "size")
    return F.pmod(F.when(F.col("doc_id").isNull(), by_text).otherwise(F.xxhash64("doc_id")), F.lit(slots))


def slot_sums(folded: DataFrame) -> dict[int, tuple[int, int]]:
    """Bytes and rows of each slot that has any: a row for each slot at most."""
    sums = folded.groupBy("virtual_slot").agg(F.sum(F.col("size") * F.col("n")).alias("b"), F.sum("n").alias("rows"))
    return {r.virtual_slot: (r.b, r.rows) for r in sums.collect()}


def first_map(sums: dict[int, tuple[int, int]], slots: int, shards: int) -> dict[int, int]:
    """Slots to shards, the heaviest slot first, each to the shard with the fewest bytes."""
    load = [(0, shard) for shard in range(shards)]
    mapped = {}
    for slot in sorted(range(slots), key=lambda s: (-sums.get(s, (0, 0))[0], s)):
        size, shard = heapq.heappop(load)
        mapped[slot] = shard
        heapq.heappush(load, (size + sums.get(slot, (0, 0))[0], shard))
    return mapped


def edited_map(mapped: dict[int, int], sums: dict[int, tuple[int, int]], shards: int, slack: float = 0.01) -> dict[int, int]:
    """The map after moving slots to the emptiest shard, from the fullest that has one small enough,
    until all are within ``slack`` of the mean or no move helps. New shards start empty."""
    mapped = dict(mapped)
    held: dict[int, list[int]] = {k: [] for k in range(shards)}
    load = dict.fromkeys(range(shards), 0)
    for slot, shard in mapped.items():
        held[shard].append(slot)
        load[shard] += sums.get(slot, (0, 0))[0]
    mean = sum(load.values()) / shards
    for _ in range(len(mapped)):
        empty = min(load, key=lambda k: (load[k], k))
        for full in sorted(load, key=lambda k: (-load[k], k)):
            gap = load[full] - load[empty]
            fits = [s for s in held[full] if 0 < sums.get(s, (0, 0))[0] < gap]
            if fits or gap <= slack * mean:
                break
        if gap <= slack * mean:
            break
        slot = min(fits, key=lambda s: (abs(gap / 2 - sums[s][0]), s))
        held[full].remove(slot)
        held[empty].append(slot)
        load[full] -= sums[slot][0]
        load[empty] += sums[slot][0]
        mapped[slot] = empty
    return mapped


def save_map(spark: SparkSession, path: str, mapped: dict[int, int], sums: dict[int, tuple[int, int]]) -> int:
    """Writes the map as the next version and returns that version."""
    version = max([0, *versions(spark, path)]) + 1
    rows = [(s, shard, *sums.get(s, (0, 0))) for s, shard in sorted(mapped.items())]
    table = spark.createDataFrame(rows, "virtual_slot long, shard int, bytes long, rows long")
    table.coalesce(1).write.parquet(f"{path}/version={version}")
    return version


def versions(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(name.split("=")[1]) for name in complete_folders(spark, path) if name.startswith("version="))


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The map of a version, the newest one by default: one row per slot."""
    version = version or versions(spark, path)[-1]
    return spark.read.parquet(f"{path}/version={version}")


def rebalance(docs: DataFrame, path: str, shards: int, id_column: str = "doc_id", text_column: str = "text") -> int:
    """Edits the stored map for today's sizes and this number of shards; returns the version."""
    old = {r.virtual_slot: r.shard for r in load_map(docs.sparkSession, path).collect()}
    sized = _sized(docs, id_column, text_column).withColumns({"virtual_slot": slot_of(len(old)), "n": F.lit(1)})
    sums = slot_sums(sized)
    return save_map(docs.sparkSession, path, edited_map(old, sums, shards), sums)


def _numbered(folded: DataFrame, mapped: DataFrame, piece_rows: int) -> DataFrame:
    """Each row with its ``shard`` and ``slot``, its place there, and its virtual slot. Places of a shard
    go slot by slot and piece by piece; ``folded`` has a row for the ``rows`` that are alike."""
    # One row for each slot.
    upto = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    pieces = F.greatest(F.ceil(F.col("rows") / piece_rows), F.lit(1)).alias("pieces")
    starts = mapped.select("virtual_slot", "shard", pieces, F.coalesce(F.sum("rows").over(upto), F.lit(0)).alias("begin"))
    piece = F.pmod(F.xxhash64(F.lit(1), "doc_id", "text_crc32", "size"), F.col("pieces"))
    placed = folded.join(F.broadcast(starts), "virtual_slot").withColumn("piece", piece)
    # One row for each piece.
    counted = placed.groupBy("virtual_slot", "piece").agg(F.sum("n").alias("held"))
    ahead = Window.partitionBy("virtual_slot").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    counted = counted.select(
        F.col("virtual_slot").alias("_slot"), F.col("piece").alias("_piece"), F.coalesce(F.sum("held").over(ahead), F.lit(0)).alias("skipped")
    )
    before = Window.partitionBy("virtual_slot", "piece").orderBy("doc_id", "text_crc32", "size").rowsBetween(Window.unboundedPreceding, -1)
    first = placed.withColumn("within", F.coalesce(F.sum("n").over(before), F.lit(0))).join(
        counted, (F.col("virtual_slot") == F.col("_slot")) & (F.col("piece") == F.col("_piece"))
    )
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {UNFOLD}")))
    until = F.least(F.col("n"), (F.col("part") + 1) * UNFOLD) - 1
    each = first.withColumn("part", part).withColumn("k", F.explode(F.sequence(F.col("part") * UNFOLD, until)))
    place = (F.col("begin") + F.col("skipped") + F.col("within") + F.col("k")).alias("slot")
    return each.select("doc_id", "size", "text_crc32", "shard", place, "virtual_slot")


def shard_rows(
    docs: DataFrame,
    shards: int = SHARDS,
    slots: int = SLOTS,
    path: str | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """Each row's size, checksum, virtual slot, shard and gapless place in its shard, under a
    map made for these rows and stored at ``path`` (a scratch folder by default)."""
    spark = docs.sparkSession
    path = path or scratch_dir(spark, "slot-map")
    sized = _sized(docs, id_column, text_column).withColumn("virtual_slot", slot_of(slots))
    alike = sized.groupBy("virtual_slot", "doc_id", "text_crc32", "size").agg(F.count("*").alias("n"))
    folded = stored(alike, "sized-rows")
    sums = slot_sums(folded)
    mapped = first_map(sums, slots, shards)
    version = save_map(spark, path, mapped, sums)
    rows = _numbered(folded, load_map(spark, path, version), piece_rows)
    return rows.withColumn("map_version", F.lit(version))


def op2_sharding(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = settled(spark, lambda: shard_rows(docs), "shards")
    return rows.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
    )
