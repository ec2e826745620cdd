"""Report payload attributes."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import reports as r
from tidemark.plans.reports import report_payloads
from tidemark.queries import Tables, query
from tidemark.session import scratch_dir
from tidemark.sources.export import export_by_key

# One report file per customer: a row per order, with the priority as display name
# (empty for low priority) and the account last.
_META = """(SELECT file, coalesce(regexp_replace(min_by(shown, o_orderkey) FILTER (shown <> ''), '[^A-Za-z0-9]', '', 'g'),
    '') AS report_name, coalesce(min_by(account, o_orderkey) FILTER (shown <> ''), '') AS account_id
  FROM (SELECT 'Account_Order_Report_' || o_custkey AS file, o_orderkey, CAST(o_custkey AS VARCHAR) AS account,
          CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE o_orderpriority END AS shown FROM orders)
  GROUP BY file)"""


def report_rows(t: Tables) -> DataFrame:
    priority = F.col("o_orderpriority")
    account = F.col("o_custkey").cast("string")
    return t.orders.select(
        F.concat(F.lit("Account_Order_Report_"), account).alias("file"),
        F.col("o_orderkey").alias("line"),
        F.col("o_orderstatus").alias("status"),
        F.when(priority == "5-LOW", "").otherwise(priority).alias("shown"),
        F.col("o_totalprice").alias("total"),
        account.alias("account"),
    )


@query("report_metadata", f"SELECT * FROM {_META}")
def _metadata(t: Tables) -> DataFrame:
    return r.report_metadata(report_rows(t), "file", "line")


@query(
    "report_payload",
    f"""SELECT file, CAST(to_json({{'account_id': account_id, 'report_name': report_name,
  'report_type': 'AccountOrderReport', 'report_date': '12-2023'}}) AS VARCHAR) AS payload FROM {_META}""",
)
def _payload(t: Tables) -> DataFrame:
    return r.report_payload(r.report_metadata(report_rows(t), "file", "line"), date(2024, 1, 31))


@query(
    "report_type",
    """SELECT p_partkey, replace(p_name, ' ', '') || p_type AS report_type FROM part""",
)
def _type(t: Tables) -> DataFrame:
    name = F.concat_ws("_", F.replace(F.col("p_name"), F.lit(" "), F.lit("_")), "p_type", "p_brand")
    return t.part.select("p_partkey", r.report_type(name).alias("report_type"))


@query(
    "report_period",
    """SELECT o_orderkey, 'sales/' || o_orderpriority || '/' || o_orderpriority || '_Report_'
  || strftime(o_orderdate - INTERVAL 1 MONTH, '%m_%Y') AS path,
  strftime(o_orderdate - INTERVAL 1 MONTH, '%m-%Y') AS period FROM orders""",
)
def _period(t: Tables) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    path = r.report_path("sales/report_name/report_name_Report_dd_yyyy", F.col("o_orderpriority"), day)
    return t.orders.select("o_orderkey", path.alias("path"), r.previous_month(day, r.MONTH_IN_PAYLOAD).alias("period"))


@query(
    "report_export",
    """SELECT CAST(to_json({'account_id': CAST(c_nationkey AS VARCHAR),
  'report_name': replace(min_by(c_name, c_custkey) FILTER (c_mktsegment <> 'BUILDING'), '#', ''),
  'report_type': 'NationCustomerReport', 'report_date': '05-2024'}) AS VARCHAR) AS payload
FROM customer GROUP BY c_nationkey""",
)
def _export(t: Tables) -> DataFrame:
    """Customers exported per nation, and the payload of each file written."""
    out = f"{scratch_dir(t.spark, 'report')}/nation"
    shown = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_name")).alias("shown")
    rows = t.customer.select("c_custkey", shown, "c_acctbal", "c_nationkey")
    export_by_key(rows, "c_nationkey", out, 512, order_by=["c_custkey"])
    return report_payloads(t.spark, out, "Nation_Customer_Report", date(2024, 6, 15), rows.columns).select("payload")


@query(
    "report_export_text",
    r"""SELECT CAST(to_json({'account_id': CASE WHEN coalesce(text, '') = '' THEN '' ELSE CAST(doc_id AS VARCHAR) END,
  'report_name': regexp_replace(coalesce(text, ''), '[^\p{L}\p{N}]', '', 'g'),
  'report_type': 'DocumentTextReport', 'report_date': '05-2024'}) AS VARCHAR) AS payload FROM documents""",
)
def _export_text(t: Tables) -> DataFrame:
    """Whole texts, line breaks included, as the display names of one report per document."""
    out = f"{scratch_dir(t.spark, 'report')}/text"
    rows = t.documents.select("lang", "text", "source", "doc_id")
    export_by_key(rows, "doc_id", out, 512)
    return report_payloads(t.spark, out, "Document_Text_Report", date(2024, 6, 15), rows.columns).select("payload")
