from __future__ import annotations

import glob
import os
import stat
from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.plans.reports import read_report_files, report_payloads
from tidemark.sources import export, mounted
from tidemark.sources.export import export_by_key

TEXTS = [
    "plain", "", None, " led and trailed ", 'say "hi", all', "two\nlines", "carriage\rreturn", "both\r\nof them", "\n", "\r", '"', '""', '"\n"\n', ",", "a,b", "#x",
    "back\\slash", '\\"', "tab\t", "\ttab", "nul\x00nul", "\x00", "é ü 漢字 😀", "﻿mark", " sep\x85", "'", "null", "\\N", "x" * 10_000, '"\n' * 5_000,
]


def _rows(spark):
    """Odd texts, also as keys, in files of one row and of many."""
    rows = [(n, t, None if t is None else t[::-1], f"k{n % 7}") for n, t in enumerate(TEXTS)]
    rows += [(n, "row", t, t[:40]) for n, t in enumerate(TEXTS) if t is not None and "\x00" not in t]
    rows += [(n, "code", None, f"<{chr(n)}>") for n in [*range(1, 0x250), 0x2000, 0x3000, 0x1F600] if chr(n) not in "/"]
    return spark.createDataFrame(rows, "id int, `shown, \"so\"` string, t string, account string")


def _tree(out):
    """Files by folder, with the bytes and modes; a name's part that is drawn anew is left out."""
    found = {}
    for path in glob.glob(f"{glob.escape(out)}/**", recursive=True):
        if path.endswith(".csv"):
            folder, name = os.path.split(path)
            key = (os.path.relpath(folder, out), name.split("-")[0], name.rsplit(".", 2)[1:])
            modes = [stat.S_IMODE(os.stat(p).st_mode) for p in (folder, path)]
            found.setdefault(str(key), []).append((open(path, "rb").read(), modes))
    return {k: sorted(v) for k, v in found.items()}


@pytest.mark.parametrize("cap", [512, 0.004])
def test_a_mounted_export_is_that_of_sparks_writer(spark, tmp_path, monkeypatch, cap):
    rows, order = _rows(spark).coalesce(1), ["id", "t"]
    made = str(tmp_path / "made")
    export_by_key(rows, "account", made, cap, order_by=order)
    monkeypatch.setattr(export, "_fits_mounted", lambda *a: False)
    export_by_key(rows, "account", str(tmp_path / "other"), cap, order_by=order)
    ours, theirs = _tree(made), _tree(str(tmp_path / "other"))
    assert len(ours) > 590 and ours == theirs
    assert sorted(os.listdir(tmp_path)) == ["made", "other"]
    assert sorted(n for n in os.listdir(made) if "=" not in n) == ["_SUCCESS"]


def test_mounted_reports_are_read_as_by_sparks_reader(spark, tmp_path, monkeypatch):
    rows = _rows(spark)
    out = str(tmp_path / "re port%25é")
    export_by_key(rows, "account", out, 512, order_by=["id"])
    os.makedirs(f"{out}/_hidden")
    for name in ("_hidden/x.csv", ".x.csv", "key=k1/_x.csv"):
        with open(f"{out}/{name}", "w") as f:
            f.write("a\nb\n")
    os.makedirs(f"{out}/a/_b=c/d")
    for n, text in enumerate(('i,s,t,a\n1,"a\nb",,', 'i,s,t,a\n\n1,2\n1,2,3,4,5\n\n', "i,s,t,a\n", "", 'i,s,t,a\n1,"open,\n2,2,3,4\n')):
        with open(f"{out}/a/_b=c/d/{n}.csv", "w") as f:
            f.write(text)
    monkeypatch.setattr(mounted, "READ_BYTES", 777)
    ours = read_report_files(spark, out, rows.columns)
    monkeypatch.setattr(mounted, "readable", lambda *a: None)
    theirs = read_report_files(spark, out, rows.columns)
    assert ours.dtypes == theirs.dtypes

    def by_file(df):
        found = {}
        for r in df.collect():
            found.setdefault(r.file, []).append((tuple(r.line), *r[2:]))
        return {k: [r[1:] for r in sorted(v, key=lambda r: r[0])] for k, v in found.items()}

    ours, theirs = by_file(ours), by_file(theirs)
    assert len(ours) > 590
    assert ours == theirs


def test_an_export_of_many_keys_has_few_tasks(spark, tmp_path, monkeypatch):
    """Spark's writer has a task for each 64 files, and its reader opens them in a task for some thirty."""
    rows = spark.range(3000).select(F.lit("en").alias("lang"), F.concat(F.lit("Text\n"), "id").alias("text"), F.col("id").alias("doc_id"))
    out = str(tmp_path / "r")
    export_by_key(rows, "doc_id", out, 512)
    paths = glob.glob(f"{out}/key=*/*.csv")
    assert len(paths) == 3000 and len({os.path.basename(p) for p in paths}) == 2
    read = read_report_files(spark, out, rows.columns)
    assert read.rdd.getNumPartitions() <= 8 and "FileScan" not in read._jdf.queryExecution().toString()
    payloads = report_payloads(spark, out, "Document_Text_Report", date(2024, 6, 15), rows.columns)
    want = {f'{{"account_id":"{n}","report_name":"Text{n}","report_type":"DocumentTextReport","report_date":"05-2024"}}' for n in range(3000)}
    assert {r.payload for r in payloads.collect()} == want and payloads.count() == 3000


def test_an_export_that_fails_leaves_the_older_one(spark, tmp_path):
    out = str(tmp_path / "out")
    export_by_key(spark.createDataFrame([(1, "x")], "id int, account string"), "account", out, 1)
    with pytest.raises(Exception, match="long"):
        export_by_key(spark.createDataFrame([(1, "y" * 300)], "id int, account string"), "account", out, 1)
    assert os.listdir(tmp_path) == ["out"] and sorted(n for n in os.listdir(out) if n[0] != ".") == ["_SUCCESS", "key=x"]


def test_long_rows_are_written_in_pieces_of_a_bounded_size(spark, tmp_path):
    """A file of some tens of MB, of rows of one MB."""
    rows = spark.range(0, 40, 1, 4).select("id", F.repeat(F.lit('a"'), 500_000).alias("text"), F.lit("one").alias("account"))
    out = str(tmp_path / "out")
    export_by_key(rows, "account", out, 512, order_by=["id"])
    (path,) = glob.glob(f"{out}/key=one/*.csv")
    assert os.path.getsize(path) > 60_000_000
    back = read_report_files(spark, out, rows.columns).orderBy("line").select("id", F.md5("text").alias("text"), "account")
    assert [tuple(r) for r in back.collect()] == [tuple(r) for r in rows.select(F.col("id").cast("string"), F.md5("text"), "account").collect()]


def test_what_spark_may_refuse_is_left_to_its_writer(spark, tmp_path):
    out, rows = str(tmp_path / "out"), spark.createDataFrame([(1, "x")], "id int, account string")
    fits = lambda df, out=out, folder="key": export._fits_mounted(df, out, folder)
    assert fits(rows) and fits(rows, f"file://{out}")
    assert not fits(rows.withColumn("list", F.array("id"))) and not fits(rows.withColumn("bytes", F.lit(b"x"))) and not fits(rows, out, "ID")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "5")
    try:
        assert not fits(rows)
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")


def test_python_runs_on_executors_for_files_in_mounted_folders_only():
    """The plans' tests look for the word Python, which a map over Arrow batches does not have."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(export.__file__)))
    words = ("mapInArrow", "mapInPandas", "applyIn", "udf", "cogroup", "foreachPartition", ".rdd")
    found = set()
    for path in glob.glob(f"{root}/**/*.py", recursive=True):
        name = os.path.relpath(path, root)
        with open(path) as f:
            text = f.read()
        if not name.startswith("llm/") and any(w in text for w in words):
            found.add(name)
    assert found == {"sources/mounted.py", "sources/jdbc.py"}
