from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import cleansing as c
from tidemark.operators import cleansing, lookups

from tidemark.operators.cleansing import clean_date_suffix  # noqa: E402


def one(spark, values, clean):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(clean(F.col("v"))).collect()]


DATES = {
    "20240105": "2024-01-05",
    "2024-01-05": "2024-01-05",
    "2024 01 05": "2024-01-05",
    "01/05/2024": "2024-01-05",
    "2024 January 05": "2024-01-05",
    "2024 january 05": "2024-01-05",
    "2024 January 05 Fri": "2024-01-05",
    "2024 January 05 Friday": "2024-01-05",
    "2024 January 05 Mon": "2024-01-05",  # the weekday is not checked
    "2024-1-5": "1900-01-01",
    "1/5/2024": "1900-01-01",
    " 2024-01-05": "1900-01-01",
    "2024-01-05 x": "1900-01-01",
    "2024-01-05 00:00:00": "1900-01-01",
    "20240230": "1900-01-01",
    "2024 Jan 05": "1900-01-01",
    "2024 January 05 Xyz": "1900-01-01",
    "": "1900-01-01",
    "junk": "1900-01-01",
}


def test_dates(spark):
    assert one(spark, [*DATES, None], c.date_text) == [*DATES.values(), "1900-01-01"]


def plain_date_text(column):
    """Every format tried in turn."""
    formats = [c.DATE_COMPACT, c.DATE_DASHED, c.DATE_SPACED, c.DATE_SLASHED, c.DATE_MONTH_NAME]
    tries = [F.date_format(F.try_to_date(column, f), "yyyy-MM-dd") for f in formats]
    return F.coalesce(*tries, F.lit("1900-01-01"))


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text("0123456789-+/ Jaunry", max_size=18), min_size=200, max_size=400))
def test_choosing_the_format_by_separator_loses_nothing(spark, values):
    near = ["2024-13-01", "-20240101", "+20240101", "-2024-01-01", "+12024-01-01", "12/31/1999", "0001-01-01"]
    values = [*values, *near]
    assert one(spark, values, c.date_text) == one(spark, values, plain_date_text)


def test_first_names(spark):
    cases = {
        "Mary": "MARY",
        "Mary J": "MARY",
        "Mary Jane": "MARY JANE",
        "Mary Jane X": "MARY JANE X",
        "Anne-Marie": "ANNE-MARIE",
        "O'Neil 2": "ONEIL",
        "Mary ": None,
        "Mary  Jane": None,
        " Mary": " MARY",
        "": "",
        None: None,
    }
    assert one(spark, list(cases), c.first_name) == list(cases.values())


def test_other_names(spark):
    assert one(spark, ["J. 2", None], c.middle_name) == ["J", None]
    assert one(spark, [" de la Cruz ", "", None], c.last_name) == ["DE LA CRUZ", "", None]
    assert one(spark, ["Jr.", "III!", None], c.name_suffix) == ["JR.", "III", None]


def test_full_name_rule(spark):
    df = spark.createDataFrame(
        [("Ann B", "c.", " Dee ", "jr."), ("Ann ", None, "Dee", None), ("Ann", "c", None, "x")],
        "f string, m string, l string, s string",
    )
    with_suffix = {"src_col": ["f", "m", "l", "s"], "tgt_col": "full", "action": "full_name"}
    got = cleansing.apply_rules(df, [{"rule": "name", "columns": [with_suffix]}])
    assert [tuple(r) for r in got.select("full", "flag_valid_fullname").collect()] == [
        ("ANN C DEE JR.", 1),
        ("DEE", 0),
        ("ANN C X", 0),
    ]
    without = {**with_suffix, "src_col": ["f", "m", "l"]}
    got = cleansing.apply_rules(df, [{"rule": "name", "columns": [without]}])
    assert [r.full for r in got.collect()] == ["ANN C DEE", "DEE", "ANN C"]


def test_name_flags_follow_the_source(spark):
    df = spark.createDataFrame([("Ann ",), (None,)], "f string")
    rules = [{"rule": "name", "columns": [{"src_col": "f", "tgt_col": "c_f", "action": "first_name"}]}]
    assert [tuple(r) for r in cleansing.apply_rules(df, rules).collect()] == [("Ann ", None, 1), (None, None, 0)]


def test_simple_rules(spark):
    assert one(spark, ["a\tb\né~", None], c.ascii_only) == ["ab~", None]
    assert one(spark, ["(555) 12-3", None], c.telephone) == ["555123", None]
    assert one(spark, ["12-34 x", None], c.tax_id) == ["12-34", None]
    assert one(spark, ["St. Paul-2!", None], c.city) == ["ST. PAUL-", None]
    assert one(spark, ["ab1 2-3", None], c.zip_code) == ["AB123", None]
    assert one(spark, ["a\u0000b", None], c.strip_nul) == ["ab", None]
    assert one(spark, ["it's", None], c.escape_quotes) == ["it''s", None]
    assert one(spark, ["2024-01-02 03:04:05.1234567", None], c.timestamp_text) == ["2024-01-02 03:04:05.123456", None]


def test_tax_hash_is_of_the_cleaned_source(spark):
    import hashlib

    df = spark.createDataFrame([("a12-3",)], "tax string")
    rules = [{"rule": "taxid", "columns": [{"src_col": "tax", "tgt_col": "tax"}]}]
    row = cleansing.apply_rules(df, rules).first()
    assert (row.tax, row.tax_hash) == ("12-3", hashlib.md5(b"12-3").hexdigest())


def test_trim_swaps_names_or_trims_in_place(spark):
    df = spark.createDataFrame([(" a ", " b ")], "x string, y string")
    columns = [{"src_col": "x", "tgt_col": "raw"}, {"src_col": "y", "tgt_col": "y"}]
    row = cleansing.apply_rules(df, [{"rule": "trim_whitespace", "columns": columns}]).first()
    assert (row.x, row.raw, row.y) == ("a", " a ", "b")


def test_entries_of_a_rule_build_on_each_other(spark):
    df = spark.createDataFrame([("a1b2",)], "x string")
    columns = [{"src_col": "x", "tgt_col": "y"}, {"src_col": "y", "tgt_col": "z"}]
    row = cleansing.apply_rules(df, [{"rule": "telephone", "columns": columns}]).first()
    assert (row.y, row.z) == ("12", "12")


def test_rules_keep_column_order(spark):
    df = spark.createDataFrame([(" a ", 1, "b ")], "x string, n int, y string")
    got = cleansing.apply_rules(df, [{"rule": "rtrim", "columns": [{"src_col": "y"}]}])
    assert got.columns == ["x", "n", "y"] and tuple(got.first()) == (" a ", 1, "b")


def test_unknown_rule_and_missing_list(spark):
    df = spark.createDataFrame([("a",)], "x string")
    with pytest.raises(ValueError, match="unknown cleansing rule"):
        cleansing.apply_rules(df, [{"rule": "nope", "columns": []}])
    with pytest.raises(ValueError, match="code list"):
        cleansing.apply_rules(df, [{"rule": "gender", "columns": []}])


def test_date_suffix_takes_text_and_dates_and_skips_others(spark):
    df = spark.sql("SELECT '01/05/2024' AS a_dt, DATE'2024-02-03' AS b_dt, array(1) AS c_dt, 'x' AS other")
    row = cleansing.clean_date_suffix(df, ["_dt"]).first().asDict()
    assert row["c_a_dt"] == "2024-01-05" and row["c_b_dt"] == "2024-02-03"
    assert "c_c_dt" not in row and "c_other" not in row


def _codes(spark, rows):
    return spark.createDataFrame(rows, "id int, value string, text string")


def test_lookups(spark, rows):
    df = spark.createDataFrame([(1, "M"), (1, "X"), (1, None), (2, "M"), (None, "M")], "id int, code string")
    codes = _codes(spark, [(1, "M", "Male"), (1, "F", "Female"), (2, "F", "Femme")])

    def found(lookup):
        got = lookup(df, "code", "t", codes)
        assert got.columns == ["id", "code", "t"]
        return {(r.id, r.code): r.t for r in got.collect()}

    keys = [(1, "M"), (1, "X"), (1, None), (2, "M"), (None, "M")]
    text = dict(zip(keys, ["Male", None, None, None, None]))
    assert found(lookups.gender) == text
    assert found(lookups.country) == text
    assert found(lookups.marital_status) == dict(zip(keys, ["Male", "N/A", "N/A", "N/A", "N/A"]))
    assert found(lookups.state) == dict(zip(keys, ["M", None, None, None, None]))


def test_duplicate_codes_are_refused(spark):
    df = spark.createDataFrame([(1, "M")], "id int, code string")
    with pytest.raises(ValueError, match="several rows"):
        lookups.gender(df, "code", "t", _codes(spark, [(1, "M", "a"), (1, "M", "b")]))


def test_a_long_code_list_is_not_broadcast(spark):
    codes = _codes(spark, [(1, "M", "Male")])
    assert "broadcast" in lookups.checked(codes)._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in lookups.checked(codes, limit=10)._jdf.queryExecution().logical().toString().lower()


AGAIN = [
    c.ascii_only, c.middle_name, c.last_name, c.name_suffix, c.telephone, c.tax_id, c.address_line, c.city, c.zip_code,
    c.date_text, c.timestamp_text, c.strip_nul,
]


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.text(max_size=30)), min_size=100, max_size=200))
def test_cleaning_twice_changes_nothing_more(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    once = df.select(*[clean(F.col("v")).alias(f"c{i}") for i, clean in enumerate(AGAIN)])
    twice = once.select(*[clean(F.col(f"c{i}")).alias(f"c{i}") for i, clean in enumerate(AGAIN)])
    assert once.collect() == twice.collect()


def test_rule_lists_are_one_projection(spark):
    df = spark.createDataFrame([("a", "b", "c")], "x string, y string, z string")
    rules = [
        {"rule": "ascii_only", "columns": [{"src_col": "x"}]},
        {"rule": "telephone", "columns": [{"src_col": "y", "tgt_col": "phone"}]},
        {"rule": "dob", "columns": [{"src_col": "z", "tgt_col": "born"}]},
        {"rule": "rtrim", "columns": [{"src_col": "y"}]},
    ]
    plan = cleansing.apply_rules(df, rules)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Project") == 1


def test_dates_of_typed_columns(spark):
    row = spark.sql(
        "SELECT timestamp'2024-01-05 10:11:12' AS a_dt, timestamp_ntz'2023-02-03 00:00:00' AS b_dt, date'2022-03-04' AS c_dt,"
        " CAST(NULL AS timestamp) AS d_dt"
    )
    got = clean_date_suffix(row, ["_dt"]).first()
    assert (got.c_a_dt, got.c_b_dt, got.c_c_dt, got.c_d_dt) == ("2024-01-05", "2023-02-03", "2022-03-04", "1900-01-01")


def test_all_code_lists_are_measured_in_one_job(spark, monkeypatch):
    lists = [spark.createDataFrame([(f"i{n}", "v", "t"), (None, "v", "t")], "id string, value string, text string") for n in range(4)]
    jobs, collect = [], type(lists[0]).collect
    monkeypatch.setattr(type(lists[0]), "collect", lambda self: jobs.append(1) or collect(self))
    names = ["gender", "marital_status", "state", "country"]
    table = spark.createDataFrame([("i0", "v")], "id string, c string")
    rules = [{"rule": r, "columns": [{"src_col": "c", "tgt_col": f"t{n}"}]} for n, r in enumerate(names)]
    result = cleansing.apply_rules(table, rules, dict(zip(names, lists, strict=True)))
    assert len(jobs) == 1
    assert [tuple(r) for r in collect(result)] == [("i0", "v", "t", "N/A", None, None)]
