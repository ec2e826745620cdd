"""Serving-database sinks. No database is started: a recording connection stands in for one,
and Spark's own JDBC writer is replaced to see what it is asked to do."""

from __future__ import annotations

import json
import os
import uuid

import pytest
from pyspark.sql.readwriter import DataFrameWriter

from tidemark.sources import jdbc
from tidemark.sources.tables import jdbc_split


def recorder(folder, fail=False):
    """A connect function, whose connections append what they commit to a file each."""

    # Defined here, so that it travels to the executors by value.
    class Connection:
        def __init__(self):
            self.calls = []

        def cursor(self):
            return self

        def executemany(self, statement, values):
            if fail:
                raise RuntimeError("no such table")
            self.calls.append([statement, values])

        def commit(self):
            with open(os.path.join(folder, uuid.uuid4().hex), "w") as out:
                json.dump(self.calls, out)

        def close(self):
            pass

    return Connection


def test_deletes_are_bound_batched_and_committed_once_per_partition(spark, tmp_path):
    folder = str(tmp_path)
    keys = spark.range(5000).selectExpr("id", "concat('it''s ', id) AS number", "id AS unused")
    jdbc.delete_keys(keys, recorder(folder), "gold.reports", ["id", "number"], max_conn=3)
    commits = [json.loads((tmp_path / f).read_text()) for f in os.listdir(folder)]
    assert len(commits) == 3
    calls = [c for commit in commits for c in commit]
    assert {c[0] for c in calls} == {"DELETE FROM gold.reports WHERE id = %s AND number = %s"}
    assert max(len(c[1]) for c in calls) <= jdbc.DELETE_BATCH
    assert sorted(tuple(v) for c in calls for v in c[1]) == [(i, f"it's {i}") for i in range(5000)]


def test_no_connection_without_keys(spark, tmp_path):
    jdbc.delete_keys(spark.range(0), recorder(str(tmp_path)), "t", ["id"])
    assert os.listdir(tmp_path) == []


def test_a_failed_delete_commits_nothing(spark, tmp_path):
    folder = str(tmp_path)
    with pytest.raises(Exception, match="no such table"):
        jdbc.delete_keys(spark.range(10), recorder(folder, fail=True), "t", ["id"], max_conn=1)
    assert os.listdir(tmp_path) == []


def test_names_cannot_carry_sql():
    assert jdbc.delete_statement("t", ["a"], "?") == "DELETE FROM t WHERE a = ?"
    for table, keys in (("t; drop table x", ["a"]), ("t", ["a = a or b"])):
        with pytest.raises(ValueError):
            jdbc.delete_statement(table, keys)


@pytest.fixture
def asked(monkeypatch):
    calls = []

    def record(writer, url, table, mode=None, properties=None):
        calls.append((url, table, mode, properties))

    monkeypatch.setattr(DataFrameWriter, "jdbc", record)
    return calls


def test_loads(spark, asked):
    properties = {"user": "u"}
    jdbc.append_table(spark.range(3), "jdbc:x", "gold.t", properties)
    jdbc.replace_rows(spark.range(3), "jdbc:x", "bronze.t", properties)
    assert asked == [
        ("jdbc:x", "gold.t", "append", {"user": "u"}),
        ("jdbc:x", "bronze.t", "overwrite", {"user": "u", "truncate": "true"}),
    ]
    assert properties == {"user": "u"}


def test_parallel_read_options():
    got = jdbc_split({"url": "jdbc:x", "dbtable": "t"}, "id", 0, 100, 8)
    assert got["numPartitions"] == "8" and got["partitionColumn"] == "id" and got["dbtable"] == "t"
