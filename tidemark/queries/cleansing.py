"""Cleansing rules and lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import cleansing, lookups
from tidemark.queries import Tables, query


def _rule(rule: str, *columns) -> list[dict]:
    return [{"rule": rule, "columns": list(columns)}]


def _map(src, tgt: str, action: str | None = None) -> dict:
    entry = {"src_col": src, "tgt_col": tgt}
    return entry if action is None else {**entry, "action": action}


@query("clean_ascii", "SELECT doc_id, regexp_replace(text, '[^ -~]', '', 'g') AS text FROM documents")
def _ascii(t: Tables) -> DataFrame:
    return cleansing.apply_rules(t.documents.select("doc_id", "text"), _rule("ascii_only", {"src_col": "text"}))


@query("clean_timestamp", "SELECT event_id, substr(CAST(ts AS VARCHAR), 1, 26) AS ts FROM events")
def _timestamp(t: Tables) -> DataFrame:
    return cleansing.apply_rules(t.events.select("event_id", "ts"), _rule("timestamp", "ts"))


@query(
    "clean_timestamp_date",
    "SELECT event_id, CAST(ts AS DATE) AS ts, TRY_CAST(props AS DATE) AS props FROM events",
    text=["ts", "props"],
)
def _timestamp_date(t: Tables) -> DataFrame:
    return cleansing.apply_rules(t.events.select("event_id", "ts", "props"), _rule("timestamp_date", "ts", "props"))


# Order dates in every accepted format, and junk for one group.
_DATES = """(SELECT o_orderkey, CASE
    WHEN o_orderpriority = '1-URGENT' THEN strftime(o_orderdate, '%Y%m%d')
    WHEN o_orderpriority = '2-HIGH' THEN strftime(o_orderdate, '%Y-%m-%d')
    WHEN o_orderpriority = '3-MEDIUM' THEN strftime(o_orderdate, '%Y %m %d')
    WHEN o_orderpriority = '4-NOT SPECIFIED' THEN strftime(o_orderdate, '%m/%d/%Y')
    WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%Y %B %d')
    WHEN o_orderstatus = 'P' THEN strftime(o_orderdate, '%Y %B %d %a')
    ELSE o_orderpriority END AS due_dt FROM orders)"""


def _clean_date_sql(c: str) -> str:
    weekday = "(Mon|Tue|Wed|Thu|Fri|Sat|Sun|Monday|Tuesday|Wednesday|Thursday|Friday|Saturday|Sunday)"
    with_day = rf"regexp_extract({c}, '^(\d{{4}} [A-Za-z]+ \d{{2}}) {weekday}$', 1)"
    tries = [f"try_strptime({c}, '{f}')" for f in ("%Y%m%d", "%Y-%m-%d", "%Y %m %d", "%m/%d/%Y", "%Y %B %d")]
    tries.append(f"try_strptime({with_day}, '%Y %B %d')")
    return f"coalesce(strftime(coalesce({', '.join(tries)}), '%Y-%m-%d'), '1900-01-01')"


def formatted_dates(t: Tables) -> DataFrame:
    day, priority, status = F.col("o_orderdate"), F.col("o_orderpriority"), F.col("o_orderstatus")
    text = (
        F.when(priority == "1-URGENT", F.date_format(day, "yyyyMMdd"))
        .when(priority == "2-HIGH", F.date_format(day, "yyyy-MM-dd"))
        .when(priority == "3-MEDIUM", F.date_format(day, "yyyy MM dd"))
        .when(priority == "4-NOT SPECIFIED", F.date_format(day, "MM/dd/yyyy"))
        .when(status == "O", F.date_format(day, "yyyy MMMM dd"))
        .when(status == "P", F.date_format(day, "yyyy MMMM dd EEE"))
        .otherwise(priority)
    )
    return t.orders.select("o_orderkey", text.alias("due_dt"))


@query("clean_date", f"SELECT o_orderkey, due_dt, {_clean_date_sql('due_dt')} AS due FROM {_DATES}")
def _date(t: Tables) -> DataFrame:
    return cleansing.apply_rules(formatted_dates(t), _rule("date", _map("due_dt", "due")))


@query(
    "clean_date_suffix",
    f"""SELECT d.o_orderkey, due_dt, CAST(o_orderdate AS DATE) AS order_dt, o_custkey AS cust_dt_key,
  {_clean_date_sql('due_dt')} AS c_due_dt, strftime(o_orderdate, '%Y-%m-%d') AS c_order_dt
FROM {_DATES} d JOIN orders o ON o.o_orderkey = d.o_orderkey""",
    text=["order_dt"],
)
def _date_suffix(t: Tables) -> DataFrame:
    due = formatted_dates(t)
    other = t.orders.select(
        F.col("o_orderkey").alias("k"),
        F.col("o_orderdate").cast("date").alias("order_dt"),
        F.col("o_custkey").alias("cust_dt_key"),
    )
    return cleansing.clean_date_suffix(due.join(other, F.col("o_orderkey") == F.col("k")).drop("k"), ["_dt"])


@query(
    "clean_date_timestamp",
    "SELECT event_id, ts, strftime(ts, '%Y-%m-%d') AS day FROM events",
)
def _date_timestamp(t: Tables) -> DataFrame:
    return cleansing.apply_rules(t.events.select("event_id", "ts"), _rule("date", _map("ts", "day")))


@query(
    "clean_date_suffix_timestamp",
    """SELECT o_orderkey, o_orderdate, strftime(o_orderdate, '%Y-%m-%d') AS c_o_orderdate FROM orders""",
)
def _date_suffix_timestamp(t: Tables) -> DataFrame:
    return cleansing.clean_date_suffix(t.orders.select("o_orderkey", "o_orderdate"), ["date"])


# Names with a second word that is long, one letter, empty or absent, and with other signs.
_NAMES = """(SELECT p_partkey, p_brand, p_type,
  CASE WHEN p_type = 'ECONOMY' THEN p_name
       WHEN p_type = 'SMALL' THEN split_part(p_name, ' ', 1) || ' ' || substr(p_brand, 7, 1)
       WHEN p_type = 'LARGE' THEN split_part(p_name, ' ', 1) || ' '
       WHEN p_type = 'STANDARD' THEN split_part(p_name, ' ', 2)
       ELSE p_name || '-' || p_brand END AS first,
  CASE WHEN p_type = 'SMALL' THEN NULL ELSE p_brand END AS middle,
  CASE WHEN p_type = 'STANDARD' THEN NULL ELSE '  ' || p_name || ' ' END AS last,
  p_brand || '.' AS suffix FROM part)"""
_FIRST_SQL = """upper(regexp_replace(CASE
  WHEN length(string_split(first, ' ')[2]) = 1 THEN string_split(first, ' ')[1]
  WHEN string_split(first, ' ')[2] IS NULL OR length(string_split(first, ' ')[2]) > 1 THEN first
  END, '[^a-zA-Z\\s-]+', '', 'g'))"""
_MIDDLE_SQL = "upper(regexp_replace(middle, '[^a-zA-Z]+', '', 'g'))"
_LAST_SQL = "upper(trim(last))"
_SUFFIX_SQL = "upper(regexp_replace(suffix, '[^a-zA-Z.]+', '', 'g'))"


def names(t: Tables) -> DataFrame:
    kind, name, brand = F.col("p_type"), F.col("p_name"), F.col("p_brand")
    one, two = F.split_part(name, F.lit(" "), F.lit(1)), F.split_part(name, F.lit(" "), F.lit(2))
    first = (
        F.when(kind == "ECONOMY", name)
        .when(kind == "SMALL", F.concat_ws(" ", one, F.substring(brand, 7, 1)))
        .when(kind == "LARGE", F.concat(one, F.lit(" ")))
        .when(kind == "STANDARD", two)
        .otherwise(F.concat(name, F.lit("-"), brand))
    )
    return t.part.select(
        "p_partkey",
        first.alias("first"),
        F.when(kind != "SMALL", brand).alias("middle"),
        F.when(kind != "STANDARD", F.concat(F.lit("  "), name, F.lit(" "))).alias("last"),
        F.concat(brand, F.lit(".")).alias("suffix"),
    )


def _name_sql(column: str, cleaned: str, flag: bool = True) -> str:
    present = f", CASE WHEN {column} IS NOT NULL THEN 1 ELSE 0 END AS flag_valid_{column}" if flag else ""
    return f"SELECT p_partkey, {cleaned} AS c_{column}{present} FROM {_NAMES}"


def _name_part(t: Tables, column: str, action: str) -> DataFrame:
    rules = _rule("name", _map(column, f"c_{column}", action))
    flag = [f"flag_valid_{column}"] if action != "suffix" else []
    return cleansing.apply_rules(names(t), rules).select("p_partkey", f"c_{column}", *flag)


@query("clean_first_name", _name_sql("first", _FIRST_SQL))
def _first(t: Tables) -> DataFrame:
    return _name_part(t, "first", "first_name")


@query("clean_middle_name", _name_sql("middle", _MIDDLE_SQL))
def _middle(t: Tables) -> DataFrame:
    return _name_part(t, "middle", "middle_name")


@query("clean_last_name", _name_sql("last", _LAST_SQL))
def _last(t: Tables) -> DataFrame:
    return _name_part(t, "last", "last_name")


@query("clean_suffix", _name_sql("suffix", _SUFFIX_SQL, flag=False))
def _suffix(t: Tables) -> DataFrame:
    return _name_part(t, "suffix", "suffix")


@query(
    "clean_full_name",
    f"""SELECT p_partkey, concat_ws(' ', {_FIRST_SQL}, {_MIDDLE_SQL}, {_LAST_SQL}, {_SUFFIX_SQL}) AS full_name,
  CASE WHEN {_FIRST_SQL} IS NOT NULL AND last IS NOT NULL THEN 1 ELSE 0 END AS flag_valid_fullname
FROM {_NAMES}""",
)
def _full(t: Tables) -> DataFrame:
    parts = ["first", "middle", "last", "suffix"]
    rules = _rule("name", _map(parts, "full_name", "full_name"))
    return cleansing.apply_rules(names(t), rules).select("p_partkey", "full_name", "flag_valid_fullname")


@query(
    "clean_full_name_no_suffix",
    f"""SELECT p_partkey, concat_ws(' ', {_FIRST_SQL}, {_MIDDLE_SQL}, {_LAST_SQL}) AS full_name,
  CASE WHEN {_FIRST_SQL} IS NOT NULL AND last IS NOT NULL THEN 1 ELSE 0 END AS flag_valid_fullname
FROM {_NAMES}""",
)
def _full_three(t: Tables) -> DataFrame:
    rules = _rule("name", _map(["first", "middle", "last"], "full_name", "full_name"))
    return cleansing.apply_rules(names(t), rules).select("p_partkey", "full_name", "flag_valid_fullname")


@query(
    "clean_telephone",
    "SELECT c_custkey, c_name, regexp_replace(c_name, '[^0-9]', '', 'g') AS phone FROM customer",
)
def _telephone(t: Tables) -> DataFrame:
    customers = t.customer.select("c_custkey", "c_name")
    return cleansing.apply_rules(customers, _rule("telephone", _map("c_name", "phone")))


_TAX = "regexp_replace(c_name || '-' || c_custkey, '[^0-9-]', '', 'g')"


@query(
    "clean_taxid",
    f"SELECT c_custkey, c_name || '-' || c_custkey AS raw, md5({_TAX}) AS tax_hash, {_TAX} AS tax FROM customer",
)
def _taxid(t: Tables) -> DataFrame:
    raw = F.concat_ws("-", "c_name", F.col("c_custkey").cast("string")).alias("raw")
    return cleansing.apply_rules(t.customer.select("c_custkey", raw), _rule("taxid", _map("raw", "tax")))


@query("clean_address_line", "SELECT p_partkey, upper(trim('  ' || p_name || ' ')) AS line FROM part")
def _address(t: Tables) -> DataFrame:
    raw = F.concat(F.lit("  "), "p_name", F.lit(" ")).alias("raw")
    rules = _rule("address", _map("raw", "line", "address_line_1"))
    return cleansing.apply_rules(t.part.select("p_partkey", raw), rules).drop("raw")


@query("clean_city", r"SELECT doc_id, upper(regexp_replace(text, '[^a-zA-Z.\-\s]+', '', 'g')) AS city FROM documents")
def _city(t: Tables) -> DataFrame:
    rules = _rule("address", _map("text", "city", "city"))
    return cleansing.apply_rules(t.documents.select("doc_id", "text"), rules).drop("text")


@query(
    "clean_zip",
    """SELECT c_custkey, upper(regexp_replace(c_name, '[^a-zA-Z0-9]+', '', 'g')) AS zip5,
  upper(regexp_replace(c_mktsegment, '[^a-zA-Z0-9]+', '', 'g')) AS zip4 FROM customer""",
)
def _zip(t: Tables) -> DataFrame:
    columns = [_map("c_name", "zip5", "zipcode5"), _map("c_mktsegment", "zip4", "zipcode4")]
    return cleansing.apply_rules(t.customer, _rule("address", *columns)).select("c_custkey", "zip5", "zip4")


_PADDED = "(SELECT p_partkey, '  ' || p_name || ' ' AS name, p_brand || '  ' AS brand FROM part)"


def _padded(t: Tables) -> DataFrame:
    name = F.concat(F.lit("  "), "p_name", F.lit(" ")).alias("name")
    return t.part.select("p_partkey", name, F.concat("p_brand", F.lit("  ")).alias("brand"))


@query("clean_trim", f"SELECT p_partkey, trim(name) AS name, name AS raw_name, trim(brand) AS brand FROM {_PADDED}")
def _trim(t: Tables) -> DataFrame:
    rules = _rule("trim_whitespace", _map("name", "raw_name"), _map("brand", "brand"))
    return cleansing.apply_rules(_padded(t), rules)


@query("clean_rtrim", f"SELECT p_partkey, rtrim(name) AS name, brand FROM {_PADDED}")
def _rtrim(t: Tables) -> DataFrame:
    return cleansing.apply_rules(_padded(t), _rule("rtrim", {"src_col": "name"}))


# --- lookups: the code list is the nation table, codes above it have no match ----------


def codes(t: Tables) -> DataFrame:
    return t.nation.select(
        F.lit(1).alias("id"), F.col("n_nationkey").cast("string").alias("value"), F.col("n_name").alias("text")
    )


def coded_customers(t: Tables) -> DataFrame:
    code = F.when(F.col("c_mktsegment") != "BUILDING", (F.col("c_nationkey") + 5).cast("string"))
    return t.customer.select(F.lit(1).alias("id"), "c_custkey", code.alias("code"))


def _lookup_sql(taken: str) -> str:
    return f"""SELECT c.id, c.c_custkey, c.code, {taken} AS found
FROM (SELECT 1 AS id, c_custkey,
        CASE WHEN c_mktsegment <> 'BUILDING' THEN CAST(c_nationkey + 5 AS VARCHAR) END AS code FROM customer) c
LEFT JOIN (SELECT CAST(n_nationkey AS VARCHAR) AS value, n_name AS text FROM nation) k ON c.code = k.value"""


@query("lookup_gender", _lookup_sql("k.text"))
def _gender(t: Tables) -> DataFrame:
    return lookups.gender(coded_customers(t), "code", "found", codes(t))


@query("lookup_marital", _lookup_sql("coalesce(k.text, 'N/A')"))
def _marital(t: Tables) -> DataFrame:
    return lookups.marital_status(coded_customers(t), "code", "found", codes(t))


@query("lookup_state", _lookup_sql("k.value"))
def _state(t: Tables) -> DataFrame:
    return lookups.state(coded_customers(t), "code", "found", codes(t))


@query("lookup_country", _lookup_sql("k.text"))
def _country(t: Tables) -> DataFrame:
    return lookups.country(coded_customers(t), "code", "found", codes(t))


@query(
    "clean_rules",
    rf"""SELECT o.o_orderkey, d.due_dt, {_clean_date_sql('d.due_dt')} AS due,
  c.c_name AS name, 1 AS id, CAST(c.c_nationkey + 5 AS VARCHAR) AS code,
  regexp_replace(c.c_name, '[^0-9]', '', 'g') AS phone,
  md5(regexp_replace(c.c_name, '[^0-9-]', '', 'g')) AS tax_hash,
  regexp_replace(c.c_name, '[^0-9-]', '', 'g') AS tax,
  upper(trim(c.c_name)) AS line, upper(regexp_replace(c.c_name, '[^a-zA-Z.\-\s]+', '', 'g')) AS city,
  n.n_name AS gender, coalesce(n.n_name, 'N/A') AS marital,
  CAST(n.n_nationkey AS VARCHAR) AS state, n.n_name AS country
FROM orders o JOIN {_DATES} d ON d.o_orderkey = o.o_orderkey
JOIN customer c ON c.c_custkey = o.o_custkey LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey + 5""",
)
def _rules(t: Tables) -> DataFrame:
    due = formatted_dates(t).join(t.orders.select("o_orderkey", "o_custkey"), "o_orderkey")
    owner = t.customer.select(
        F.col("c_custkey").alias("o_custkey"),
        F.lit(1).alias("id"),
        F.concat("c_name", F.lit("é ")).alias("name"),
        (F.col("c_nationkey") + 5).cast("string").alias("code"),
    )
    rules = [
        {"rule": "ascii_only", "columns": [{"src_col": "name"}]},
        {"rule": "rtrim", "columns": [{"src_col": "name"}]},
        {"rule": "dob", "columns": [_map("due_dt", "due")]},
        {"rule": "telephone", "columns": [_map("name", "phone")]},
        {"rule": "taxid", "columns": [_map("name", "tax")]},
        {"rule": "address", "columns": [_map("name", "line", "address_line_2"), _map("name", "city", "city")]},
        {"rule": "gender", "columns": [_map("code", "gender")]},
        {"rule": "marital_status", "columns": [_map("code", "marital")]},
        {"rule": "state", "columns": [_map("code", "state")]},
        {"rule": "country", "columns": [_map("code", "country")]},
    ]
    lists = dict.fromkeys(("gender", "marital_status", "state", "country"), codes(t))
    return cleansing.apply_rules(due.join(owner, "o_custkey").drop("o_custkey"), rules, lists)
