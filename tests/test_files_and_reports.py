from __future__ import annotations

from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from tidemark.operators import files, reports


def paths(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "path string")


def test_normalized_names(spark):
    names = {
        "raw/Rep_A_1_000": "Rep_A_1_0.csv",
        "raw/Rep_A_1_001": "Rep_A_1_1.csv",
        "raw/Rep_A_1_010": "Rep_A_1_10.csv",
        "raw/Rep_A_1_0120": "Rep_A_1_120.csv",
        "raw/Rep_A_2_000": "Rep_A_2.csv",
        "raw_x/plain": "plain.csv",
        "raw/é_000": "é.csv",
    }
    got = files.normalize_file_names(paths(spark, *names))
    assert {r.path: r.name for r in got.collect()} == names
    assert got.columns == ["path", "name"]


def test_equal_names_in_two_folders_are_not_parts(spark):
    got = files.normalize_file_names(paths(spark, "a/r_1", "b/r_1"))
    assert sorted(r.name for r in got.collect()) == ["r.csv", "r.csv"]
    assert files.multipart_groups(paths(spark, "a/r_1", "b/r_1")).isEmpty()
    assert tuple(files.multipart_groups(paths(spark, "a/r_1", "a/r_2")).first()) == ("a/r", 2)


def named(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "name string")


def test_reconcile(spark):
    expected, present = named(spark, "a", "a", "b", "c", " "), named(spark, "a", "b", "b", "d")
    got = {r.name: (r.expected, r.present) for r in files.files_reconcile(expected, present).collect()}
    assert got == {"b": (1, 2), "c": (1, 0), "d": (0, 1)}
    files.require_same_files(named(spark, "a", "a"), named(spark, "a"))
    with pytest.raises(ValueError, match="differ"):
        files.require_same_files(expected, present)


def test_missing(spark):
    present = named(spark, "path/to/file1.csv", "another/file2.csv")
    assert files.files_missing(named(spark, "path/to/file1.csv"), present).isEmpty()
    got = files.files_missing(named(spark, "missing/file1.csv", "missing/file2.csv"), present)
    assert sorted(r.name for r in got.collect()) == ["missing/file1.csv", "missing/file2.csv"]


def test_files_on_a_day_is_a_utc_day(spark):
    times = [datetime(2024, 1, d, h, tzinfo=timezone.utc) for d, h in ((1, 23), (2, 0), (2, 23), (3, 0))]
    df = spark.createDataFrame([(t,) for t in times], "modificationTime timestamp")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/Chicago"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert files.files_on(df, date(2024, 1, 2)).count() == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_metadata_takes_the_first_row_with_a_name(spark):
    rows = [
        ("f1", 2, "x", "Ann & Co. é", 1.0, "acct1"),
        ("f1", 1, "x", "", 1.0, "acct0"),
        ("f1", 3, "x", "Later", 1.0, "acct3"),
        ("f2", 1, "x", None, 1.0, "acct9"),
    ]
    df = spark.createDataFrame(rows, "file string, line int, a string, b string, c double, d string")
    meta = reports.report_metadata(df, "file", "line")
    assert {r.file: (r.report_name, r.account_id) for r in meta.collect()} == {
        "f1": ("AnnCoé", "acct1"),
        "f2": ("", ""),
    }


def test_payload(spark):
    meta = spark.createDataFrame([("A_B_C_7", 'N"1', "7")], "file string, report_name string, account_id string")
    payload = reports.report_payload(meta, date(2024, 1, 31)).first().payload
    assert payload == '{"account_id":"7","report_name":"N\\"1","report_type":"ABC","report_date":"12-2023"}'


def test_types_and_periods(spark):
    df = spark.createDataFrame([("A_B",), ("A_B_C_D_E",), ("A",)], "n string")
    assert [r[0] for r in df.select(reports.report_type(F.col("n"))).collect()] == ["AB", "ABC", "A"]
    day = F.lit(date(2024, 3, 31))
    path = reports.report_path("d/report_name/report_name_Report_dd_yyyy", F.lit("Sales"), day)
    assert spark.range(1).select(path).first()[0] == "d/Sales/Sales_Report_02_2024"
    assert spark.range(1).select(reports.previous_month(day, reports.MONTH_IN_PAYLOAD)).first()[0] == "02-2024"
