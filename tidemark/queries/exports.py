"""Exports and unloads, read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.queries import Tables, query
from tidemark.session import scratch_dir
from tidemark.sources.export import export_by_key, unload
from tidemark.sources.files import list_files


def _read_csv(t: Tables, path: str, schema: T.StructType, **options) -> DataFrame:
    return t.spark.read.schema(schema).options(header=True, escape='"', **options).csv(path)


# One account holds a third of all rows, and those without an account are left out.
_ACCOUNT = """CASE WHEN l_returnflag = 'A' THEN 0 WHEN l_tax > 0.07 THEN NULL ELSE l_suppkey + 1 END"""
# In MB: below the size of the account that holds a third of all rows, above all others.
_CAP = 0.1
_SMALL_CAP = 0.01


def account_lines(t: Tables) -> DataFrame:
    account = F.when(F.col("l_returnflag") == "A", F.lit(0)).when(F.col("l_tax") <= 0.07, F.col("l_suppkey") + 1)
    return t.lineitem.withColumn("account", account)


@query("export_by_key", f"SELECT * FROM (SELECT *, {_ACCOUNT} AS account FROM lineitem) WHERE account IS NOT NULL")
def _export(t: Tables) -> DataFrame:
    out = f"{scratch_dir(t.spark, 'export')}/by-account"
    lines = account_lines(t)
    export_by_key(lines, "account", out, max_size_mb=_CAP)
    return _read_csv(t, out, lines.schema, recursiveFileLookup=True)


@query(
    "export_by_key_files",
    f"""SELECT CAST(account AS VARCHAR) AS account, true AS headed,
  length('account,l_orderkey,l_linenumber') + 1 + sum(length(concat_ws(',', account, l_orderkey, l_linenumber)) + 1)
    > floor({_SMALL_CAP} * 1024 * 1024) AS split,
  true AS within
FROM (SELECT {_ACCOUNT} AS account, l_orderkey, l_linenumber FROM lineitem) WHERE account IS NOT NULL GROUP BY account""",
)
def _export_files(t: Tables) -> DataFrame:
    """Per account: that it has files, none above the cap, and several of them only when it is."""
    out = f"{scratch_dir(t.spark, 'export')}/by-account"
    export_by_key(account_lines(t).select("account", "l_orderkey", "l_linenumber"), "account", out, max_size_mb=_SMALL_CAP)
    account = F.regexp_extract("path", "/key=([^/]*)/", 1).alias("account")
    return (
        list_files(t.spark, out)
        .groupBy(account)
        .agg(
            F.every(F.col("length") > 0).alias("headed"),
            (F.count(F.lit(1)) > 1).alias("split"),
            F.every(F.col("length") <= _SMALL_CAP * 1024 * 1024).alias("within"),
        )
    )


@query(
    "unload_csv",
    """SELECT event_id AS "Id", ts AS "At", user_id AS "User", event_type AS "Kind", value AS "Value",
  props AS "Props" FROM events""",
)
def _csv(t: Tables) -> DataFrame:
    out = f"{scratch_dir(t.spark, 'unload')}/events"
    headers = ["Id", "At", "User", "Kind", "Value", "Props"]
    unload(
        t.events,
        out,
        delimiter="|",
        header=True,
        addquotes=True,
        compression="gzip",
        breakup_threshold=4000,
        file_prefix="export_",
        custom_headers=headers,
    )
    return _read_csv(t, out, t.events.toDF(*headers).schema, sep="|")


@query("unload_csv_text", "SELECT doc_id, text, lang FROM documents")
def _csv_text(t: Tables) -> DataFrame:
    """Whole texts, with their quotes and line ends."""
    out = f"{scratch_dir(t.spark, 'unload')}/documents"
    documents = t.documents.select("doc_id", "text", "lang")
    unload(documents, out, header=True)
    return _read_csv(t, out, documents.schema, multiLine=True)


@query("unload_parquet", "SELECT * FROM lineitem")
def _parquet(t: Tables) -> DataFrame:
    out = f"{scratch_dir(t.spark, 'unload')}/lineitem"
    unload(t.lineitem, out, "parquet", order_by=["l_shipdate"])
    return t.spark.read.parquet(out)


@query("unload_row_count", "SELECT count(*) AS rows_written FROM orders")
def _row_count(t: Tables) -> DataFrame:
    out = f"{scratch_dir(t.spark, 'unload')}/orders"
    rows = unload(t.orders, out, "parquet")
    return t.spark.range(1).select(F.lit(rows).cast("long").alias("rows_written"))
