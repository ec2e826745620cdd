"""Projections, casts, schemas, counts and rejects."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import cleansing as c
from tidemark.operators import projection as p
from tidemark.queries import Tables, query
from tidemark.session import scratch_dir
from tidemark.sources.export import write_rejects

_AT = datetime(2024, 1, 2, 6, 30, tzinfo=timezone.utc)


@query("strip_nul", "SELECT doc_id, text, lang FROM documents")
def _strip(t: Tables) -> DataFrame:
    spoiled = F.replace(F.col("text"), F.lit(" "), F.lit(" \u0000")).alias("text")
    return p.strip_nul(t.documents.select("doc_id", spoiled, "lang"), ["text"])


@query("project_columns", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def _columns(t: Tables) -> DataFrame:
    return p.project(t.orders, ["o_orderkey", "o_custkey", "o_totalprice"])


@query("project_keys", "SELECT l_orderkey, l_linenumber FROM lineitem")
def _keys(t: Tables) -> DataFrame:
    return p.project(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "add_audit_columns",
    "SELECT c_custkey, c_name, '2024-01-02 06:30:00' AS load_ts, DATE '2024-01-02' AS load_date FROM customer",
    text=["load_date"],
)
def _audit(t: Tables) -> DataFrame:
    audited = p.add_audit_columns(t.customer.select("c_custkey", "c_name"), _AT)
    return audited.withColumn("load_ts", F.date_format("load_ts", "yyyy-MM-dd HH:mm:ss"))


@query(
    "add_load_columns",
    """SELECT c_custkey, 'sales' AS schema_name, '2024-01-02' AS load_date, '06:30:00z' AS load_time FROM customer""",
)
def _load_columns(t: Tables) -> DataFrame:
    return p.add_load_columns(t.customer.select("c_custkey"), "20240102", "06:30:00Z", "SALES")


@query(
    "cast_all_string",
    """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
  o_orderstatus, CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) AS o_totalprice,
  CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority FROM orders""",
)
def _all_string(t: Tables) -> DataFrame:
    # Large doubles differ between engines as text, so the price is a decimal first.
    return p.cast_all_string(t.orders.withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)")))


@query(
    "cast_columns",
    """SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, TRY_CAST(o_orderstatus AS INTEGER) AS o_orderstatus,
  CAST(o_totalprice AS DECIMAL(18, 2)) AS o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
  TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS o_orderpriority FROM orders""",
    text=["o_totalprice", "o_orderdate", "o_orderstatus"],
)
def _casts(t: Tables) -> DataFrame:
    coded = t.orders.withColumn("o_orderpriority", F.substring("o_orderpriority", 1, 1))
    specs = {
        "o_custkey": "string",
        "o_orderstatus": "int",
        "o_totalprice": "decimal(18,2)",
        "o_orderdate": "date",
        "o_orderpriority": "int",
    }
    return p.cast_columns(coded, [{"column": n, "data_type": d} for n, d in specs.items()])


@query(
    "apply_schema",
    """SELECT CAST(l_orderkey AS INTEGER) AS l_orderkey, CAST(l_linenumber AS SMALLINT) AS l_linenumber,
  CAST(l_extendedprice AS DECIMAL(12, 2)) AS l_extendedprice, CAST(l_discount AS VARCHAR) AS l_discount,
  l_returnflag, CAST(l_shipdate AS DATE) AS l_shipdate FROM lineitem""",
    text=["l_extendedprice", "l_shipdate"],
)
def _schema(t: Tables) -> DataFrame:
    specs = [
        "L_ORDERKEY=bigint>int",
        "l_linenumber=smallint",
        "l_extendedprice=double>decimal(12,2)",
        "l_discount=double>varchar(10)",
        "l_returnflag=char(1)",
        "l_shipdate=timestamp>date",
    ]
    return p.apply_schema(t.lineitem, specs)


@query("require_rows", "SELECT count(*) AS row_count FROM lineitem")
def _require(t: Tables) -> DataFrame:
    return p.count_rows(p.require_rows(t.lineitem, "lineitem"))


@query("escape_quotes", "SELECT doc_id, replace(replace(text, 'e', ''''), '''', '''''') AS text FROM documents")
def _quotes(t: Tables) -> DataFrame:
    quoted = F.replace(F.col("text"), F.lit("e"), F.lit("'"))
    return t.documents.select("doc_id", c.escape_quotes(quoted).alias("text"))


_CODED = """(SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'x' ELSE '' END || o_custkey AS account,
  CASE WHEN o_orderpriority = '5-LOW' THEN o_orderpriority WHEN o_orderpriority = '2-HIGH' THEN NULL
       ELSE strftime(o_orderdate, '%Y-%m-%d') END AS due FROM orders)"""
_SPECS = [{"column": "account", "data_type": "bigint"}, {"column": "due", "data_type": "date"}]


def _coded(t: Tables) -> DataFrame:
    account = F.concat(F.when(F.col("o_orderstatus") == "P", "x").otherwise(""), F.col("o_custkey").cast("string"))
    priority = F.col("o_orderpriority")
    due = F.when(priority == "5-LOW", priority).when(
        priority != "2-HIGH", F.date_format("o_orderdate", "yyyy-MM-dd")
    )
    return t.orders.select("o_orderkey", account.alias("account"), due.alias("due"))


_FAILED = """concat_ws(',', CASE WHEN TRY_CAST(account AS BIGINT) IS NULL THEN 'account' END,
  CASE WHEN due IS NOT NULL AND TRY_CAST(due AS DATE) IS NULL THEN 'due' END)"""


@query(
    "rejected_rows",
    f"""SELECT o_orderkey, account, due, {_FAILED} AS reject_reason FROM {_CODED} WHERE {_FAILED} <> ''""",
)
def _rejects(t: Tables) -> DataFrame:
    root = scratch_dir(t.spark, "rejects")
    _, rejects = p.split_rejects(_coded(t), _SPECS)
    write_rejects(rejects, root, "run-1")
    return t.spark.read.parquet(f"{root}/run-1")


@query(
    "accepted_rows",
    f"""SELECT o_orderkey, CAST(account AS BIGINT) AS account, CAST(due AS DATE) AS due
FROM {_CODED} WHERE {_FAILED} = ''""",
    text=["due"],
)
def _accepted(t: Tables) -> DataFrame:
    return p.split_rejects(_coded(t), _SPECS)[0]


@query("query_count", "SELECT count(*) AS row_count FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey")
def _count(t: Tables) -> DataFrame:
    joined = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
    return p.count_rows(joined)


@query(
    "distinct_keys",
    "SELECT DISTINCT o_custkey AS account FROM orders WHERE o_orderstatus <> 'O'",
)
def _distinct(t: Tables) -> DataFrame:
    account = F.when(F.col("o_orderstatus") != "O", F.col("o_custkey")).alias("account")
    return p.distinct_keys(t.orders.select(account), "account")
