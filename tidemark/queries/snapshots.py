"""Snapshot comparison, change capture and dataset merges over orders and lineitem."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import changes, snapshots
from tidemark.plans.daily import daily_snapshot, fold_target, initial_load
from tidemark.queries import Tables, query
from tidemark.session import scratch_dir
from tidemark.sources import keyed
from tidemark.streaming.cdc import START, cdc_stream, current_table

ORDER_KEYS = ["o_orderkey"]
LINE_KEYS = ["l_orderkey", "l_linenumber"]

# The day before lacks the orders of 2001; the latest day lacks archived orders (finished,
# low priority) and has new prices for urgent pending ones.
_PREVIOUS = "prev AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01')"
_LATEST = """latest AS (
  SELECT o_orderkey, o_custkey, o_orderstatus,
         CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'
              THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
         o_orderdate, o_orderpriority
  FROM orders WHERE NOT (o_orderstatus = 'F' AND o_orderpriority = '5-LOW'))"""
_BOTH = f"WITH {_PREVIOUS}, {_LATEST}"


def archived():
    return (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "5-LOW")


def previous_orders(t: Tables) -> DataFrame:
    return t.orders.filter(F.col("o_orderdate") < F.lit("2001-01-01").cast("timestamp_ntz"))


def latest_orders(t: Tables) -> DataFrame:
    urgent = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT")
    price = F.col("o_totalprice")
    return t.orders.filter(~archived()).withColumn("o_totalprice", F.when(urgent, price + 1).otherwise(price))


# Line items repeat some (order, line) keys, which the comparison must survive.
_LINES = """WITH prev AS (SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '2001-06-01'),
latest AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
         CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN l_quantity + 1 ELSE l_quantity END AS l_quantity,
         l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
  FROM lineitem WHERE NOT (l_returnflag = 'A' AND l_tax = 0))"""


def previous_lines(t: Tables) -> DataFrame:
    return t.lineitem.filter(F.col("l_shipdate") < F.lit("2001-06-01").cast("timestamp_ntz"))


def latest_lines(t: Tables) -> DataFrame:
    returned = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O")
    quantity = F.col("l_quantity")
    kept = t.lineitem.filter(~((F.col("l_returnflag") == "A") & (F.col("l_tax") == 0)))
    return kept.withColumn("l_quantity", F.when(returned, quantity + 1).otherwise(quantity))


@query("snapshot_delta", f"{_BOTH} SELECT * FROM latest EXCEPT SELECT * FROM prev")
def _delta(t: Tables) -> DataFrame:
    latest = latest_orders(t)
    return snapshots.snapshot_delta(latest, previous_orders(t), latest.columns)


@query("snapshot_delta_lineitem", f"{_LINES} SELECT * FROM latest EXCEPT SELECT * FROM prev")
def _delta_lines(t: Tables) -> DataFrame:
    latest = latest_lines(t)
    return snapshots.snapshot_delta(latest, previous_lines(t), latest.columns)


@query("snapshot_deletes", f"{_BOTH} SELECT o_orderkey FROM prev EXCEPT SELECT o_orderkey FROM latest")
def _deletes(t: Tables) -> DataFrame:
    return snapshots.snapshot_deletes(latest_orders(t), previous_orders(t), ORDER_KEYS)


@query(
    "snapshot_deletes_lineitem",
    f"{_LINES} SELECT l_orderkey, l_linenumber FROM prev EXCEPT SELECT l_orderkey, l_linenumber FROM latest",
)
def _deletes_lines(t: Tables) -> DataFrame:
    return snapshots.snapshot_deletes(latest_lines(t), previous_lines(t), LINE_KEYS)


@query(
    "change_feed",
    f"""{_BOTH},
delta AS (SELECT * FROM latest EXCEPT SELECT * FROM prev),
gone AS (SELECT o_orderkey FROM prev EXCEPT SELECT o_orderkey FROM latest)
SELECT CASE WHEN o_orderkey IN (SELECT o_orderkey FROM prev) THEN 'U' ELSE 'I' END AS op, * FROM delta
UNION ALL SELECT 'D', o_orderkey, NULL, NULL, NULL, NULL, NULL FROM gone""",
    text=["o_custkey"],
)
def _feed(t: Tables) -> DataFrame:
    latest = latest_orders(t)
    return snapshots.change_feed(latest, previous_orders(t), ORDER_KEYS, latest.columns)


def change_counts(t: Tables) -> DataFrame:
    """The flagship: how many rows were inserted, updated and deleted."""
    return _feed(t).groupBy("op").agg(F.count(F.lit(1)).alias("n_rows"))


query(
    "change_counts",
    f"""{_BOTH},
delta AS (SELECT * FROM latest EXCEPT SELECT * FROM prev)
SELECT CASE WHEN o_orderkey IN (SELECT o_orderkey FROM prev) THEN 'U' ELSE 'I' END AS op, count(*) AS n_rows
FROM delta GROUP BY 1
UNION ALL
SELECT 'D', count(*) FROM (SELECT o_orderkey FROM prev EXCEPT SELECT o_orderkey FROM latest) HAVING count(*) > 0""",
)(change_counts)


@query(
    "change_feed_lineitem",
    f"""{_LINES},
delta AS (SELECT * FROM latest EXCEPT SELECT * FROM prev),
gone AS (SELECT l_orderkey, l_linenumber FROM prev EXCEPT SELECT l_orderkey, l_linenumber FROM latest)
SELECT CASE WHEN EXISTS (SELECT 1 FROM prev p WHERE p.l_orderkey = d.l_orderkey AND p.l_linenumber = d.l_linenumber)
            THEN 'U' ELSE 'I' END AS op, d.* FROM delta d
UNION ALL SELECT 'D', l_orderkey, NULL, NULL, l_linenumber, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM gone""",
    text=["l_partkey", "l_suppkey"],
)
def _feed_lines(t: Tables) -> DataFrame:
    latest = latest_lines(t)
    return snapshots.change_feed(latest, previous_lines(t), LINE_KEYS, latest.columns)


@query(
    "upsert_merge",
    f"""{_BOTH},
delta AS (SELECT * FROM latest EXCEPT SELECT * FROM prev)
SELECT * FROM prev WHERE o_orderkey NOT IN (SELECT o_orderkey FROM delta) UNION ALL SELECT * FROM delta""",
)
def _merge(t: Tables) -> DataFrame:
    return snapshots.upsert_merge(previous_orders(t), _delta(t), ORDER_KEYS)


@query(
    "upsert_merge_keyed",
    f"""{_BOTH},
delta AS (SELECT * FROM latest EXCEPT SELECT * FROM prev)
SELECT * FROM prev WHERE o_orderkey NOT IN (SELECT o_orderkey FROM delta) UNION ALL SELECT * FROM delta""",
)
def _merge_keyed(t: Tables) -> DataFrame:
    """The same into a stored target: only the buckets of changed keys are written."""
    home = scratch_dir(t.spark, "keyed")
    keyed.store(previous_orders(t), f"{home}/1", f"{home}/data", ORDER_KEYS)
    place = keyed.load_place(t.spark, f"{home}/1")
    return keyed.read(t.spark, keyed.upsert(t.spark, f"{home}/2", place, _delta(t)))


# Several records per order: an update, then a delete of archived orders, then for the dear
# ones among them a new insert; and a first record for the orders of 2001.
_CHANGES = f"""WITH {_PREVIOUS},
changes AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderdate, o_orderpriority,
         'U' AS op, CAST(1 AS BIGINT) AS seq FROM orders WHERE o_orderstatus IN ('P', 'F')
  UNION ALL SELECT *, 'D', 2 FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '5-LOW'
  UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 3, o_orderdate, o_orderpriority, 'I', 3
    FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '5-LOW' AND o_totalprice > 300000
  UNION ALL SELECT *, 'I', 0 FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01'),
newest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY seq DESC) AS n FROM changes)
  WHERE n = 1)
SELECT * FROM prev WHERE o_orderkey NOT IN (SELECT o_orderkey FROM changes)
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM newest WHERE op <> 'D'"""


def order_changes(t: Tables) -> DataFrame:
    def records(rows: DataFrame, op: str, seq: int, added: int) -> DataFrame:
        price = (F.col("o_totalprice") + added).alias("o_totalprice")
        columns = [price if n == "o_totalprice" else F.col(n) for n in rows.columns]
        return rows.select(*columns, F.lit(op).alias("op"), F.lit(seq).cast("long").alias("seq"))

    orders = t.orders
    return (
        records(orders.filter(F.col("o_orderstatus").isin("P", "F")), "U", 1, 1)
        .union(records(orders.filter(archived()), "D", 2, 0))
        .union(records(orders.filter(archived() & (F.col("o_totalprice") > 300000)), "I", 3, 3))
        .union(
            records(
                orders.filter(F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz")), "I", 0, 0
            )
        )
    )


@query("cdc_apply", _CHANGES)
def _apply(t: Tables) -> DataFrame:
    return changes.cdc_apply(previous_orders(t), order_changes(t), ORDER_KEYS)


@query("cdc_apply_keyed", _CHANGES)
def _apply_keyed(t: Tables) -> DataFrame:
    home = scratch_dir(t.spark, "keyed")
    base = keyed.store(previous_orders(t), f"{home}/1", f"{home}/data", ORDER_KEYS)
    place = keyed.load_place(t.spark, f"{home}/1")
    return keyed.apply_changes(t.spark, place, order_changes(t), base.schema.fields, "seq", "op")


@query("cdc_stream", _CHANGES)
def _stream(t: Tables) -> DataFrame:
    home = scratch_dir(t.spark, "cdc")
    records = order_changes(t)
    records.write.json(f"{home}/landing")
    run = cdc_stream(
        t.spark, f"{home}/landing", records.schema, f"{home}/table", ORDER_KEYS, mode=START, full=previous_orders(t)
    )
    run.awaitTermination()
    return current_table(t.spark, f"{home}/table", records.schema, ORDER_KEYS)


_FIRST, _SECOND = (datetime(2024, 1, day, 6, tzinfo=timezone.utc) for day in (1, 2))


def _with_nul(df: DataFrame) -> DataFrame:
    return df.withColumn("o_orderpriority", F.concat("o_orderpriority", F.lit("\u0000")))


def _audited(df: DataFrame, at: datetime) -> DataFrame:
    return df.withColumns({"load_ts": F.lit(at), "load_date": F.lit(at.date())})


@query("initial_load", "SELECT * FROM orders")
def _initial(t: Tables) -> DataFrame:
    home = scratch_dir(t.spark, "initial")
    return initial_load(_with_nul(t.orders), f"{home}/gold", f"{home}/curated", _FIRST.date(), ["o_orderpriority"])


@query(
    "daily_snapshot",
    f"""{_BOTH}
SELECT l.*,
  CASE WHEN p.o_orderkey IS NULL OR p.o_totalprice <> l.o_totalprice
       THEN '2024-01-02 06:00:00' ELSE '2024-01-01 06:00:00' END AS load_ts,
  CASE WHEN p.o_orderkey IS NULL OR p.o_totalprice <> l.o_totalprice
       THEN '2024-01-02' ELSE '2024-01-01' END AS load_date
FROM latest l LEFT JOIN prev p ON p.o_orderkey = l.o_orderkey""",
)
def _daily(t: Tables) -> DataFrame:
    home = scratch_dir(t.spark, "daily")
    strings = ["o_orderpriority"]
    first = _audited(_with_nul(previous_orders(t)), _FIRST)
    initial_load(first, f"{home}/gold", f"{home}/curated", _FIRST.date(), strings, keys=ORDER_KEYS)
    version = daily_snapshot(
        _audited(_with_nul(latest_orders(t)), _SECOND),
        f"{home}/gold",
        f"{home}/curated",
        _SECOND.date(),
        ORDER_KEYS,
        t.orders.columns,
        strings,
        _SECOND,
    )
    return version.withColumns(
        {
            "load_ts": F.date_format("load_ts", "yyyy-MM-dd HH:mm:ss"),
            "load_date": F.col("load_date").cast("string"),
        }
    )


# The days' columns differ: the first day has no priority and a short customer number, the second has both as
# they are, and the third has no status.
@query(
    "daily_columns",
    f"""{_BOTH}
SELECT l.o_orderkey, l.o_custkey, l.o_totalprice, l.o_orderpriority,
  CASE WHEN l.o_totalprice <> p.o_totalprice THEN '2024-01-03' WHEN p.o_orderpriority IS NOT NULL THEN '2024-01-02'
       WHEN p.o_orderkey IS NOT NULL THEN '2024-01-01' ELSE '2024-01-03' END AS load_date
FROM latest l LEFT JOIN prev p ON p.o_orderkey = l.o_orderkey""",
    text=["o_custkey"],
)
def _columns(t: Tables) -> DataFrame:
    home = scratch_dir(t.spark, "daily")
    gold, curated = f"{home}/gold", f"{home}/curated"
    days = [datetime(2024, 1, day, 6, tzinfo=timezone.utc) for day in (1, 2, 3)]
    short = previous_orders(t).select("o_orderkey", F.col("o_custkey").cast("int"), "o_orderstatus", "o_totalprice")
    initial_load(_audited(short, days[0]), gold, curated, days[0].date(), [], keys=ORDER_KEYS)
    second, third = previous_orders(t).drop("o_orderdate"), latest_orders(t).drop("o_orderdate", "o_orderstatus")
    for rows, at in ((second, days[1]), (third, days[2])):
        daily_snapshot(_audited(rows, at), gold, curated, at.date(), ORDER_KEYS, rows.columns, [], at)
    return fold_target(t.spark, gold).drop("load_ts").withColumn("load_date", F.col("load_date").cast("string"))


# A listing with one file per order, dated by the order's day in the third path token.
_DATED = """WITH files AS (
  SELECT CAST(o_orderdate AS DATE) AS snapshot_date FROM orders)"""


def dated_files(t: Tables) -> DataFrame:
    path = F.concat(
        F.lit("lake/curated/"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("/part-"), F.col("o_orderkey")
    )
    return snapshots.with_snapshot_date(t.orders.select(path.alias("path")), token=2)


@query("latest_n_dates", f"{_DATED} SELECT DISTINCT snapshot_date FROM files ORDER BY 1 DESC LIMIT 2", text=["snapshot_date"])
def _latest_dates(t: Tables) -> DataFrame:
    return snapshots.latest_n_dates(dated_files(t), 2)


@query(
    "previous_snapshot_date",
    f"{_DATED} SELECT DISTINCT snapshot_date FROM files ORDER BY 1 DESC LIMIT 1 OFFSET 1",
    text=["snapshot_date"],
)
def _previous_date(t: Tables) -> DataFrame:
    return snapshots.previous_snapshot_date(dated_files(t))


@query(
    "previous_snapshot_date_rerun",
    f"{_DATED} SELECT max(snapshot_date) AS snapshot_date FROM files WHERE snapshot_date < DATE '2000-06-15'",
    text=["snapshot_date"],
)
def _previous_date_rerun(t: Tables) -> DataFrame:
    return snapshots.previous_snapshot_date(dated_files(t), date(2000, 6, 15))


@query(
    "snapshot_retention",
    f"""{_DATED} SELECT DISTINCT snapshot_date FROM files
WHERE snapshot_date NOT IN (SELECT DISTINCT snapshot_date FROM files ORDER BY 1 DESC LIMIT 2)""",
    text=["snapshot_date"],
)
def _retention(t: Tables) -> DataFrame:
    return snapshots.snapshot_retention(dated_files(t), 2)
