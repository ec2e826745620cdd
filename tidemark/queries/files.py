"""File listings, manifests and file-name operators."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import files as f
from tidemark.queries import Tables, query
from tidemark.session import scratch_dir
from tidemark.sources.export import export_by_key, unload
from tidemark.sources.files import list_files, load_cdc, load_full, read_manifest, write_manifest


@query(
    "list_files",
    """SELECT CAST(c_nationkey AS VARCHAR) AS nation, count(DISTINCT 1) AS files, true AS filled
FROM customer GROUP BY 1""",
)
def _list(t: Tables) -> DataFrame:
    out = f"{scratch_dir(t.spark, 'list')}/by-nation"
    export_by_key(t.customer, "c_nationkey", out, 512)
    nation = F.regexp_extract("path", "/key=([^/]*)/", 1).alias("nation")
    listed = list_files(t.spark, out, "*.csv")
    return listed.groupBy(nation).agg(F.count(F.lit(1)).alias("files"), F.every(F.col("length") > 0).alias("filled"))


@query(
    "files_modified_on",
    """SELECT 'landing/' || user_id || '/' || event_id AS path, length(props) AS length
FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'""",
)
def _modified(t: Tables) -> DataFrame:
    path = F.concat_ws("/", F.lit("landing"), F.col("user_id").cast("string"), F.col("event_id").cast("string"))
    files = t.events.select(
        path.alias("path"),
        F.col("ts").cast("timestamp").alias("modificationTime"),
        F.length("props").cast("long").alias("length"),
    )
    return f.files_on(files, date(2024, 1, 15)).select("path", "length")


@query("load_manifest", "SELECT * FROM orders")
def _manifest(t: Tables) -> DataFrame:
    home = scratch_dir(t.spark, "full")
    t.orders.write.json(f"{home}/files")
    write_manifest(list_files(t.spark, f"{home}/files"), f"{home}/manifest")
    return load_full(t.spark, read_manifest(t.spark, f"{home}/manifest"), t.orders.schema)


@query(
    "load_cdc",
    """SELECT *, CASE o_orderstatus WHEN 'O' THEN 'I' WHEN 'P' THEN 'U' ELSE 'D' END AS op FROM orders""",
)
def _cdc(t: Tables) -> DataFrame:
    home = scratch_dir(t.spark, "changes")
    status = F.col("o_orderstatus")
    op = F.when(status == "O", "I").when(status == "P", "U").otherwise("D")
    t.orders.withColumn("op", op).write.json(f"{home}/files")
    write_manifest(list_files(t.spark, f"{home}/files"), f"{home}/manifest")
    return load_cdc(t.spark, read_manifest(t.spark, f"{home}/manifest"), t.orders.schema)


@query("unload_manifest", "SELECT * FROM customer")
def _unload_manifest(t: Tables) -> DataFrame:
    out = f"{scratch_dir(t.spark, 'manifest')}/customer"
    unload(t.customer, out, "parquet", manifest=True, breakup_threshold=1000)
    return load_full(t.spark, read_manifest(t.spark, f"{out}_manifest"), t.customer.schema, "parquet")


# One file per order, named after account, priority and status, with the order as part number:
# some accounts have several parts, others one.
_PARTS = """(SELECT 'raw/reports/Account_Order_Report_' || o_custkey || '-' || substr(o_orderpriority, 1, 1)
    || o_orderstatus || '_' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS path,
  'raw/reports/Account_Order_Report_' || o_custkey || '-' || substr(o_orderpriority, 1, 1) || o_orderstatus AS base,
  CAST(o_orderkey AS VARCHAR) AS part FROM orders)"""


def part_files(t: Tables) -> DataFrame:
    path = F.concat(
        F.lit("raw/reports/Account_Order_Report_"),
        F.col("o_custkey").cast("string"),
        F.lit("-"),
        F.substring("o_orderpriority", 1, 1),
        F.col("o_orderstatus"),
        F.lit("_"),
        F.lpad(F.col("o_orderkey").cast("string"), 12, "0"),
    )
    return t.orders.select(path.alias("path"))


@query("multipart_groups", f"SELECT base, count(*) AS parts FROM {_PARTS} GROUP BY base HAVING count(*) > 1")
def _groups(t: Tables) -> DataFrame:
    return f.multipart_groups(part_files(t))


@query(
    "normalize_file_names",
    f"""SELECT path, replace(CASE WHEN count(*) OVER (PARTITION BY base) > 1 THEN base || '_' || part ELSE base END,
  'raw/reports/', '') || '.csv' AS name FROM {_PARTS}""",
)
def _normalize(t: Tables) -> DataFrame:
    return f.normalize_file_names(part_files(t))


def _names(df: DataFrame, key: str, late: Column | None = None) -> DataFrame:
    suffix = F.lit("") if late is None else F.when(late, "_late").otherwise("")
    return df.select(F.concat(F.lit("report_"), F.col(key).cast("string"), suffix).alias("name"))


@query(
    "files_reconcile",
    """SELECT coalesce(e.name, p.name) AS name, CAST(coalesce(e.n, 0) AS BIGINT) AS expected,
  CAST(coalesce(p.n, 0) AS BIGINT) AS present
FROM (SELECT DISTINCT 'report_' || c_custkey AS name, 1 AS n FROM customer) e
FULL JOIN (SELECT 'report_' || o_custkey || CASE WHEN o_orderpriority = '1-URGENT' THEN '' ELSE '_late' END AS name,
             count(*) AS n FROM orders GROUP BY 1) p ON e.name = p.name
WHERE coalesce(e.n, 0) <> coalesce(p.n, 0)""",
)
def _reconcile(t: Tables) -> DataFrame:
    present = _names(t.orders, "o_custkey", F.col("o_orderpriority") != "1-URGENT")
    return f.files_reconcile(_names(t.customer, "c_custkey"), present)


@query(
    "files_missing",
    """SELECT 'report_' || c_custkey AS name FROM customer
EXCEPT SELECT 'report_' || o_custkey || CASE WHEN o_orderstatus = 'F' THEN '' ELSE '_late' END FROM orders""",
)
def _missing(t: Tables) -> DataFrame:
    present = _names(t.orders, "o_custkey", F.col("o_orderstatus") != "F")
    return f.files_missing(_names(t.customer, "c_custkey"), present)
