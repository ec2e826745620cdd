"""Batch-dated transforms and the run log, with the events as the log."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import runs
from tidemark.queries import Tables, query
from tidemark.session import scratch_dir
from tidemark.sources.run_log import append_log, read_log

# Steps are users; the kind of event is the status; the step's settings and its dependency
# come from the customer of that number.
_LOG = """log AS (SELECT user_id AS step_id, CAST(ts AS DATE) AS batch_dt,
  CASE event_type WHEN 'view' THEN 'START' WHEN 'click' THEN 'UNLOAD_TO_S3' WHEN 'purchase' THEN 'COMPLETED'
    WHEN 'signup' THEN 'END' ELSE 'FAILED' END AS status, event_id AS rows, props AS message, ts FROM events)"""
_STEPS = """steps AS (SELECT c_custkey AS step_id, c_name AS name, c_nationkey AS seq,
  CASE WHEN c_mktsegment <> 'BUILDING' THEN CAST(round(c_acctbal) AS INTEGER) END AS step_order,
  CASE c_mktsegment WHEN 'HOUSEHOLD' THEN '{"dependency_check": "false"}' WHEN 'FURNITURE' THEN '{}'
    ELSE '{"dependency_check": "True"}' END AS info,
  CASE WHEN c_custkey > 0 AND c_mktsegment <> 'MACHINERY'
    THEN 'Customer#' || lpad(CAST(c_custkey - 1 AS VARCHAR), 9, '0') END AS depends_on FROM customer)"""
_NEWEST = """newest AS (SELECT step_id, batch_dt, arg_max(status, (ts, status)) AS status FROM log GROUP BY ALL)"""


def run_log(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    status = (
        F.when(kind == "view", "START")
        .when(kind == "click", "UNLOAD_TO_S3")
        .when(kind == "purchase", "COMPLETED")
        .when(kind == "signup", "END")
        .otherwise("FAILED")
    )
    return t.events.select(
        F.col("user_id").alias("step_id"),
        F.col("ts").cast("date").alias("batch_dt"),
        status.alias("status"),
        F.col("event_id").alias("rows"),
        F.col("props").alias("message"),
        F.col("ts").cast("timestamp").alias("ts"),
    )


def steps(t: Tables) -> DataFrame:
    segment = F.col("c_mktsegment")
    info = (
        F.when(segment == "HOUSEHOLD", '{"dependency_check": "false"}')
        .when(segment == "FURNITURE", "{}")
        .otherwise('{"dependency_check": "True"}')
    )
    before = F.concat(F.lit("Customer#"), F.lpad((F.col("c_custkey") - 1).cast("string"), 9, "0"))
    return t.customer.select(
        F.col("c_custkey").alias("step_id"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("seq"),
        F.when(segment != "BUILDING", F.round("c_acctbal").cast("int")).alias("step_order"),
        info.alias("info"),
        F.when((F.col("c_custkey") > 0) & (segment != "MACHINERY"), before).alias("depends_on"),
    )


@query(
    "bind_batch_date",
    """SELECT o_orderpriority, count(*) AS n_orders, DATE '1998-07-01' AS batch_dt FROM orders
WHERE o_orderdate < TIMESTAMP '1998-07-01' GROUP BY 1""",
    text=["batch_dt"],
)
def _bind(t: Tables) -> DataFrame:
    sql = """SELECT o_orderpriority, count(*) AS n_orders, :batch_dt AS batch_dt FROM {orders}
             WHERE o_orderdate < :batch_dt GROUP BY o_orderpriority"""
    return runs.bind_batch_date(t.spark, sql, date(2024, 1, 1), date(1998, 7, 1), orders=t.orders)


@query("run_latest_status", f"WITH {_LOG}, {_NEWEST} SELECT *, status <> 'COMPLETED' AS to_run FROM newest", text=["batch_dt"])
def _latest(t: Tables) -> DataFrame:
    return runs.run_latest_status(run_log(t))


@query(
    "run_completed",
    f"""WITH {_LOG}, {_STEPS}, {_NEWEST}
SELECT batch_dt, name AS table_name FROM newest LEFT JOIN steps USING (step_id) WHERE status = 'COMPLETED'""",
    text=["batch_dt"],
)
def _completed(t: Tables) -> DataFrame:
    return runs.run_completed(run_log(t), steps(t))


@query(
    "run_ready",
    f"""WITH {_LOG}, {_STEPS}, {_NEWEST},
pairs AS (SELECT o_custkey AS step_id, CAST(o_orderdate AS DATE) AS batch_dt FROM orders
          UNION SELECT step_id, batch_dt FROM newest)
SELECT n.step_id, s.name, n.batch_dt FROM pairs n JOIN steps s ON s.step_id = n.step_id
LEFT JOIN newest l ON l.step_id = n.step_id AND l.batch_dt = n.batch_dt
WHERE coalesce(l.status, '') <> 'COMPLETED' AND (s.depends_on IS NULL
  OR coalesce(upper(json_extract_string(s.info, '$.dependency_check')), '') <> 'TRUE'
  OR EXISTS (SELECT 1 FROM newest d JOIN steps ds ON ds.step_id = d.step_id
             WHERE ds.name = s.depends_on AND d.batch_dt = n.batch_dt AND d.status = 'COMPLETED'))""",
    text=["batch_dt"],
)
def _ready(t: Tables) -> DataFrame:
    """Every customer's order days are scheduled for the step of that number."""
    schedule = t.orders.select(F.col("o_custkey").alias("step_id"), F.col("o_orderdate").cast("date").alias("batch_dt"))
    return runs.run_ready(steps(t), run_log(t), schedule)


@query(
    "run_ready_scheduled",
    f"""WITH {_LOG}, {_STEPS}, {_NEWEST},
due AS (SELECT step_id, CAST(ts AS DATE) + 1 AS batch_dt FROM log WHERE rows % 7 = 0),
pairs AS (SELECT step_id, batch_dt FROM due
          UNION SELECT step_id, batch_dt FROM newest WHERE batch_dt IN (SELECT batch_dt FROM due))
SELECT n.step_id, s.name, n.batch_dt FROM pairs n JOIN steps s ON s.step_id = n.step_id
LEFT JOIN newest l ON l.step_id = n.step_id AND l.batch_dt = n.batch_dt
WHERE coalesce(l.status, '') <> 'COMPLETED' AND (s.depends_on IS NULL
  OR coalesce(upper(json_extract_string(s.info, '$.dependency_check')), '') <> 'TRUE'
  OR EXISTS (SELECT 1 FROM newest d JOIN steps ds ON ds.step_id = d.step_id
             WHERE ds.name = s.depends_on AND d.batch_dt = n.batch_dt AND d.status = 'COMPLETED'))""",
    text=["batch_dt"],
)
def _ready_scheduled(t: Tables) -> DataFrame:
    """Some steps are scheduled again for the day after, and only those days of a stored log count."""
    path = scratch_dir(t.spark, "log")
    append_log(run_log(t), path)
    log = read_log(t.spark, path)
    schedule = log.filter("rows % 7 = 0").select("step_id", F.date_add(F.col("ts").cast("date"), 1).alias("batch_dt"))
    return runs.run_ready(steps(t), log, schedule, scheduled_only=True)


@query(
    "run_groups",
    """SELECT CAST(o_orderdate AS DATE) AS batch_dt, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS seq,
  CASE WHEN o_orderstatus = 'O' THEN 0 ELSE o_custkey END AS step_order, o_orderkey AS step_id,
  o_orderpriority AS name, count(*) OVER (PARTITION BY o_orderdate, o_orderpriority) AS group_size FROM orders""",
    text=["batch_dt"],
)
def _groups(t: Tables) -> DataFrame:
    dated = t.orders.select(
        F.col("o_orderdate").cast("date").alias("batch_dt"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("seq"),
        F.when(F.col("o_orderstatus") != "O", F.col("o_custkey")).alias("step_order"),
        F.col("o_orderkey").alias("step_id"),
        F.col("o_orderpriority").alias("name"),
    )
    return runs.run_groups(dated)


@query(
    "run_summary",
    f"""WITH {_LOG}, tables AS (
  SELECT batch_dt, step_id, arg_max(status, (ts, status)) AS status, count(*) AS entries,
    count(*) FILTER (status = 'FAILED') AS failures, CAST(sum(rows) AS BIGINT) AS rows,
    coalesce(arg_max(message, (ts, message)) FILTER (status = 'FAILED'), '') AS error,
    max(ts) FILTER (status = 'FAILED') AS failed_at FROM log GROUP BY ALL)
SELECT batch_dt, step_id, CAST(to_json({{'status': status, 'entries': entries, 'failures': failures, 'rows': rows,
  'error': error}}) AS VARCHAR) AS summary FROM tables
UNION ALL
SELECT batch_dt, NULL, CAST(to_json({{'tables': count(*), 'completed': count(*) FILTER (status = 'COMPLETED'),
  'entries': CAST(sum(entries) AS BIGINT), 'failures': CAST(sum(failures) AS BIGINT),
  'rows': CAST(sum(rows) AS BIGINT),
  'error': coalesce(arg_max(error, (failed_at, error)) FILTER (failed_at IS NOT NULL), '')}}) AS VARCHAR)
FROM tables GROUP BY batch_dt""",
    text=["batch_dt", "step_id"],
)
def _summary(t: Tables) -> DataFrame:
    return runs.run_summary(run_log(t))


@query(
    "sink_run_log",
    f"WITH {_LOG} SELECT step_id, batch_dt, status, rows, message, CAST(ts AS VARCHAR) AS ts FROM log",
    text=["batch_dt"],
)
def _sink(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "log")
    entries = run_log(t)
    append_log(entries.filter(F.col("status") == "START"), path)
    append_log(entries.filter(F.col("status") != "START"), path)
    return read_log(t.spark, path).withColumn("ts", F.col("ts").cast("string"))
