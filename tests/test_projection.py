from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.schema import TYPES, parse_schema
from tidemark.operators import projection as p


def test_every_type_name_is_known():
    specs = [f"C{i}={name}" for i, name in enumerate(TYPES)]
    schema = parse_schema(specs)
    assert len(TYPES) == 27
    assert [f.name for f in schema] == [f"c{i}" for i in range(27)]
    assert all(f.nullable for f in schema)


def test_schema_forms():
    schema = parse_schema(
        ["A=varchar(20)", "b=Float", "c=number>decimal(12,3)", "d=decimal", "e=tinyint", "f=real", "g=timestmp"]
    )
    assert [f.dataType for f in schema] == [
        T.StringType(),
        T.DoubleType(),
        T.DecimalType(12, 3),
        T.DecimalType(10, 0),
        T.IntegerType(),
        T.FloatType(),
        T.TimestampType(),
    ]


@pytest.mark.parametrize("spec", ["a=nope", "a", "a=int)", "a=int(__import__('os'))"])
def test_bad_specs_are_refused(spec):
    with pytest.raises(ValueError):
        parse_schema([spec])


def test_apply_schema_nulls_what_does_not_fit(spark):
    df = spark.createDataFrame([("1", "2024-01-02"), ("x", "y")], "ID string, Day string")
    got = p.apply_schema(df, ["ID=varchar>int", "Day=varchar>date"])
    assert got.columns == ["id", "day"]
    assert [tuple(r) for r in got.collect()] == [(1, date(2024, 1, 2)), (None, None)]


def test_cast_columns_names_a_missing_column(spark):
    df = spark.createDataFrame([("1",)], "a string")
    with pytest.raises(ValueError, match="'b'"):
        p.cast_columns(df, [{"column": "b", "data_type": "int"}])
    assert p.cast_columns(df, [{"column": "a", "data_type": "int"}]).first()[0] == 1


def test_load_columns(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert tuple(p.add_load_columns(df, "20240102", "T1", "Sales").first()) == (1, "sales", "2024-01-02", "t1")
    assert p.add_load_columns(df, "20240102", "t").columns == ["a", "load_date", "load_time"]
    with pytest.raises(ValueError):
        p.add_load_columns(df, "2024-01-02", "t")


def test_audit_columns(spark):
    df = spark.createDataFrame([(1,)], "a int")
    at = datetime(2024, 1, 2, 3, 4, 5)
    assert tuple(p.add_audit_columns(df, at).first()) == (1, at, date(2024, 1, 2))


def test_strip_nul_leaves_other_columns(spark):
    df = spark.createDataFrame([("a\u0000", "b\u0000", 1)], "x string, y string, z int")
    got = p.strip_nul(df, ["x"])
    assert got.columns == ["x", "y", "z"] and tuple(got.first()) == ("a", "b\u0000", 1)


def test_require_rows(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert p.require_rows(df) is df
    with pytest.raises(p.EmptySource):
        p.require_rows(df.filter("a > 1"))


def test_cast_all_string(spark):
    got = p.cast_all_string(spark.sql("SELECT 1 AS a, true AS b, DATE'2024-01-02' AS c"))
    assert tuple(got.first()) == ("1", "true", "2024-01-02")


def test_split_rejects_covers_every_row(spark):
    df = spark.createDataFrame([("1", "x"), ("y", "2024-01-02"), ("y", "x"), (None, None), ("2", "2024-01-02")], "a string, b string")
    good, rejects = p.split_rejects(df, [{"column": "a", "data_type": "int"}, {"column": "b", "data_type": "date"}])
    assert sorted(r.reject_reason for r in rejects.collect()) == ["a", "a,b", "b"]
    assert {tuple(r) for r in good.collect()} == {(None, None), (2, date(2024, 1, 2))}


def test_distinct_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (2,)], "k int")
    assert sorted(r.k for r in p.distinct_keys(df, "k").collect()) == [1, 2]


TEXTS = ["1", " 12 ", "+3", "-4", "\t5", "6\n", "1.5", ".5", "5.", "1e3", "-1e-2", "x", "", " ", "12ab", "é1", "\u00a01"]
TEXTS += ["99999999999", "--1", "+", "NaN", "Infinity", "0x10", "1_000", "\u0000" + "7", "\u0661", ":1", "\x7f7", "~", None]


@pytest.mark.parametrize("target", ["tinyint", "int", "bigint", "decimal(12,2)", "DECIMAL(38, 0)", "double", "boolean", "date"])
def test_skipping_hopeless_casts_loses_nothing(spark, target):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    got = p.cast_columns(df.withColumn("plain", F.col("t").try_cast(target)), [{"column": "t", "data_type": target}])
    assert got.filter(~F.col("t").eqNullSafe(F.col("plain"))).collect() == []
