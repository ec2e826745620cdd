"""Table reads, snapshots, the catalog and table maintenance."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.queries import Tables, query
from tidemark.session import scratch_dir
from tidemark.sources.catalog import compact_table, register_tables
from tidemark.sources.tables import read_snapshot, read_table, write_snapshot

_DAY = date(2024, 1, 1)


@query("scan_table", "SELECT * FROM orders")
def _scan(t: Tables) -> DataFrame:
    return read_table(t.spark, "parquet", {"path": t.path("orders")})


@query("scan_snapshot", "SELECT * FROM customer")
def _scan_snapshot(t: Tables) -> DataFrame:
    root = scratch_dir(t.spark, "snapshots")
    # Below the date there are folders, which the read goes through.
    t.customer.withColumn("part", F.col("c_mktsegment")).write.partitionBy("part").parquet(f"{root}/{_DAY}")
    return read_snapshot(t.spark, root, _DAY, t.customer.schema)


@query("sink_snapshot", "SELECT * FROM events")
def _sink(t: Tables) -> DataFrame:
    root = scratch_dir(t.spark, "snapshots")
    write_snapshot(t.orders, root, _DAY)
    return write_snapshot(t.events, root, _DAY)


@query(
    "register_tables",
    """SELECT c.c_mktsegment, n.n_name, count(*) AS customers FROM customer c
JOIN nation n ON n.n_nationkey = c.c_nationkey GROUP BY ALL""",
)
def _register(t: Tables) -> DataFrame:
    root = scratch_dir(t.spark, "lake")
    database = f"tidemark_{uuid.uuid4().hex[:12]}"
    t.customer.write.partitionBy("c_mktsegment").parquet(f"{root}/customer")
    t.nation.write.parquet(f"{root}/nation")
    # A folder and files that do not count, though they hold rows.
    t.customer.write.parquet(f"{root}/customer/drafts")
    t.nation.write.mode("append").option("mapreduce.output.basename", "draft").parquet(f"{root}/nation")
    register_tables(t.spark, database, [f"{root}/customer", f"{root}/nation"], "bronze", ["*/drafts/*", "draft*"])
    return t.spark.sql(
        f"""SELECT c.c_mktsegment, n.n_name, count(*) AS customers FROM {database}.bronze_customer c
            JOIN {database}.bronze_nation n ON n.n_nationkey = c.c_nationkey GROUP BY ALL"""
    )


@query("compact_table", "SELECT * FROM lineitem")
def _compact(t: Tables) -> DataFrame:
    out = f"{scratch_dir(t.spark, 'compact')}/lineitem"
    compact_table(t.lineitem, out, ["l_orderkey", "l_linenumber"])
    return t.spark.read.parquet(out)
