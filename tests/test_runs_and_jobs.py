from __future__ import annotations

import glob
import json
import os
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import runs
from tidemark.plans.daily import RepeatedKeys, current_version, daily_snapshot, fold_target, initial_load
from tidemark.plans.unload_job import run_unload_job
from tidemark.operators.projection import EmptySource
from tidemark.sources import storage
from tidemark.sources.run_log import RUN_LOG, append_log, compact_log, read_log
from tidemark.sources.tables import drop_old_snapshots, previous_date, write_snapshot

D1, D2 = date(2024, 1, 1), date(2024, 1, 2)


def log(spark, *entries):
    start = datetime(2024, 1, 1)
    data = [(s, d, status, n, m, start + timedelta(minutes=i)) for i, (s, d, status, n, m) in enumerate(entries)]
    return spark.createDataFrame(data, RUN_LOG)


def steps(spark, *rows):
    return spark.createDataFrame(rows, "step_id long, name string, info string, depends_on string")


@pytest.fixture
def history(spark):
    return log(
        spark,
        (1, D1, "START", None, None),
        (1, D1, "COMPLETED", 5, None),
        (2, D1, "START", None, None),
        (2, D1, "FAILED", None, "first"),
        (2, D1, "FAILED", None, "second"),
        (3, D1, "START", None, None),
        (4, D1, "START", None, None),
        (1, D2, "START", None, None),
        (3, D2, "COMPLETED", 7, None),
        (4, D2, "START", None, None),
    )


def test_latest_status(history):
    got = {(r.step_id, r.batch_dt): (r.status, r.to_run) for r in runs.run_latest_status(history).collect()}
    assert got[1, D1] == ("COMPLETED", False) and got[2, D1] == ("FAILED", True) and got[1, D2] == ("START", True)


def test_completed_and_ready(spark, history):
    check, skip = '{"dependency_check": "True"}', '{"dependency_check": "false"}'
    config = steps(spark, (1, "t1", None, None), (2, "t2", check, "t1"), (3, "t3", check, "t2"), (4, "t4", skip, "t2"))
    done = {tuple(r) for r in runs.run_completed(history, config).collect()}
    assert done == {(D1, "t1"), (D2, "t3")}
    ready = {(r.step_id, r.batch_dt) for r in runs.run_ready(config, history).collect()}
    # t2 waits for t1, which is done on the first day; t3 waits for t2; t4 does not check.
    assert ready == {(2, D1), (4, D1), (1, D2), (4, D2)}


def test_groups_default_the_order_and_keep_null_groups(spark):
    df = spark.createDataFrame(
        [(D1, 2, 1, 10, "a"), (D1, 1, 5, 11, "b"), (D1, 1, None, 12, "c"), (D1, None, 1, 13, "d")],
        "batch_dt date, seq int, step_order int, step_id long, name string",
    )
    got = [(r.seq, r.step_order, r.step_id, r.group_size) for r in runs.run_groups(df).collect()]
    assert got == [(None, 1, 13, 1), (1, 0, 12, 2), (1, 5, 11, 2), (2, 1, 10, 1)]


def test_summary(history):
    got = {(r.batch_dt, r.step_id): json.loads(r.summary) for r in runs.run_summary(history).collect()}
    assert got[D1, None] == {
        "tables": 4, "completed": 1, "entries": 7, "failures": 2, "rows": 5, "error": "second"
    }
    assert got[D1, 2] == {"status": "FAILED", "entries": 3, "failures": 2, "rows": 0, "error": "second"}
    assert got[D2, 3] == {"status": "COMPLETED", "entries": 1, "failures": 0, "rows": 7, "error": ""}


def test_bind_batch_date_is_a_parameter(spark):
    sql = "SELECT :batch_dt AS d, 'batch_dt' AS text"
    assert tuple(runs.bind_batch_date(spark, sql, D1).first()) == (D1, "batch_dt")
    assert runs.bind_batch_date(spark, sql, D1, adhoc=D2).first().d == D2


# --- unload jobs ------------------------------------------------------------------


def _job(tmp_path, **more):
    return {
        "table_name": "numbers",
        "unload_to_s3": "true",
        "unload": {"bucket": str(tmp_path), "key": "//out//numbers/", "data_format": "csv", "header": True},
        "query": "SELECT id, :batch_dt AS day FROM range(7)",
        **more,
    }


def _statuses(spark, path):
    return [(r.status, r.rows) for r in read_log(spark, path).orderBy("ts").collect()]


def test_unload_job(spark, tmp_path):
    path = str(tmp_path / "log")
    assert run_unload_job(spark, _job(tmp_path), 1, D1, path) == 7
    assert _statuses(spark, path) == [("START", None), ("UNLOAD_TO_S3", 7), ("END", None)]
    assert glob.glob(str(tmp_path / "out" / "numbers" / "numbers-*.csv"))


def test_skipped_and_failed_jobs(spark, tmp_path):
    path = str(tmp_path / "log")
    assert run_unload_job(spark, _job(tmp_path, unload_to_s3="false"), 1, D1, path) == 0
    assert [s for s, _ in _statuses(spark, path)] == ["START", "UNLOAD_SKIPPED", "END"]
    path = str(tmp_path / "log2")
    with pytest.raises(Exception):
        run_unload_job(spark, _job(tmp_path, query="SELECT * FROM nowhere"), 1, D1, path)
    assert [s for s, _ in _statuses(spark, path)] == ["START", "FAILED"]
    assert "nowhere" in read_log(spark, path).filter("status = 'FAILED'").first().message


def test_jobs_are_checked(spark, tmp_path):
    incomplete = _job(tmp_path, unload=json.dumps({"bucket": "b", "data_format": "orc"}))
    with pytest.raises(ValueError, match="lacks key"):
        run_unload_job(spark, incomplete, 1, D1, str(tmp_path / "log"))


# --- the daily job ----------------------------------------------------------------


def _source(spark, rows, at):
    return spark.createDataFrame([(k, v, at, at.date()) for k, v in rows], "k int, v string, load_ts timestamp, load_date date")


def _run(spark, tmp_path, rows, day, **more):
    at = datetime(day.year, day.month, day.day, 6)
    return daily_snapshot(
        _source(spark, rows, at), str(tmp_path / "gold"), str(tmp_path / "pre"), day, ["k"], ["k", "v"], ["v"], at, **more
    )


def _first(spark, tmp_path, rows, day):
    at = datetime(day.year, day.month, day.day, 6)
    return initial_load(_source(spark, rows, at), str(tmp_path / "gold"), str(tmp_path / "pre"), day, ["v"])


def test_days_in_a_row(spark, tmp_path):
    days = [D1 + timedelta(days=n) for n in range(4)]
    _first(spark, tmp_path, [(1, "a\u0000"), (2, "b")], days[0])
    seen = []
    got = _run(spark, tmp_path, [(1, "a"), (2, "B"), (3, "c")], days[1], publish=lambda *dfs: seen.extend(d.count() for d in dfs))
    assert sorted((r.k, r.v, r.load_date) for r in got.collect()) == [
        (1, "a", days[0]), (2, "B", days[1]), (3, "c", days[1])
    ]
    assert seen == [2, 0]
    # Running the day again, with other data, replaces it.
    again = _run(spark, tmp_path, [(1, "a"), (3, "c")], days[1])
    assert sorted((r.k, r.load_date) for r in again.collect()) == [(1, days[0]), (3, days[1])]
    # A missed day does not matter: the newest snapshot below the run date is compared with.
    last = _run(spark, tmp_path, [(3, "c"), (4, None)], days[3])
    assert sorted((r.k, r.v, r.load_date) for r in last.collect()) == [(3, "c", days[1]), (4, None, days[3])]
    assert storage.snapshot_dates(spark, str(tmp_path / "pre")) == [days[1], days[3]]
    assert current_version(spark, str(tmp_path / "gold")).count() == 2


def test_an_empty_source_stops_the_run(spark, tmp_path):
    _first(spark, tmp_path, [(1, "a")], D1)
    with pytest.raises(EmptySource):
        _run(spark, tmp_path, [], D2)
    assert storage.snapshot_dates(spark, str(tmp_path / "pre")) == [D1]


def test_without_an_initial_load(spark, tmp_path):
    with pytest.raises(ValueError, match="initial load"):
        _run(spark, tmp_path, [(1, "a")], D1)


def test_unfinished_snapshots_do_not_count(spark, tmp_path):
    root = str(tmp_path)
    write_snapshot(spark.range(1), root, D1)
    spark.range(1).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{root}/{D2}")
    assert storage.snapshot_dates(spark, root) == [D1]
    assert previous_date(spark, root, date(2024, 1, 3)) == D1


def test_retention_keeps_two(spark, tmp_path):
    root = str(tmp_path)
    for n in range(1, 5):
        write_snapshot(spark.range(1), root, date(2024, 1, n))
        dropped = drop_old_snapshots(spark, root, 2)
        assert dropped == ([date(2024, 1, n - 2)] if n > 2 else [])
    assert storage.snapshot_dates(spark, root) == [date(2024, 1, 3), date(2024, 1, 4)]


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    from tidemark.session import scratch_dir

    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


def test_job_config(spark, tmp_path):
    from tidemark.__main__ import read_config, run

    at = datetime(2024, 1, 1, 6)
    config = {
        "source": {"format": "parquet", "options": {"path": str(tmp_path / "src")}},
        "target": str(tmp_path / "gold"),
        "snapshots": str(tmp_path / "pre"),
        "primary_keys": ["k"],
        "select_columns": ["k", "v"],
        "string_columns": ["v"],
    }
    (tmp_path / "job.json").write_text(json.dumps(config, indent=2))
    config = read_config(spark, str(tmp_path / "job.json"))
    # This source has no audit columns of its own.
    spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string").write.parquet(str(tmp_path / "src"))
    run(spark, config, "init", D1, at)
    spark.createDataFrame([(1, "A")], "k int, v string").write.mode("overwrite").parquet(str(tmp_path / "src"))
    got = run(spark, config, "snapshot", D2, at + timedelta(days=1))
    assert [(r.k, r.v, r.load_date) for r in got.collect()] == [(1, "A", D2)]
    with pytest.raises(ValueError, match="load_type"):
        run(spark, config, "other", D2, at)


def test_clean_table(spark):
    from tidemark.plans.cleanse import clean_table

    df = spark.createDataFrame([(1, "M", " 5 ", "01/05/2024")], "id int, sex string, n string, born_dt string")
    options = {
        "dataTypeCastingToString": True,
        "fixedColumnsCleansingRules": [
            {"rule": "trim_whitespace", "columns": [{"src_col": "n", "tgt_col": "raw"}]},
            {"rule": "gender", "columns": [{"src_col": "sex", "tgt_col": "gender"}]},
        ],
        "fixed_columns": [{"column": "n", "data_type": "int"}],
        "global_date_cleansing_rule": {"suffix": ["_dt"]},
    }
    codes = spark.createDataFrame([(1, "M", "Male")], "id int, value string, text string")
    row = clean_table(df, options, "20240102", "T", "S", {"gender": codes}).first().asDict()
    assert row == {
        "id": "1", "sex": "M", "n": 5, "raw": " 5 ", "born_dt": "01/05/2024", "gender": "Male",
        "c_born_dt": "2024-01-05", "schema_name": "s", "load_date": "2024-01-02", "load_time": "t",
    }


def test_export_reports(spark, tmp_path):
    from tidemark.plans.reports import export_reports, report_payloads

    queries = {
        "Sales": "SELECT id, concat('N', id) AS name, id % 2 AS accountid FROM range(10)",
        "None": "SELECT id, 'x' AS name, id AS accountid FROM range(0)",
    }
    folders = export_reports(
        spark, queries, str(tmp_path), "lake/report_name/report_name_Report_dd_yyyy", date(2024, 3, 31), 512, order_by=["id"]
    )
    assert folders == {"Sales": f"{tmp_path}/lake/Sales/Sales_Report_02_2024"}
    payloads = [json.loads(r.payload) for r in report_payloads(spark, folders["Sales"], "Sales_Report_02_2024", date(2024, 3, 31)).collect()]
    assert sorted(p["account_id"] + p["report_name"] for p in payloads) == ["0N0", "1N1"]
    assert {(p["report_type"], p["report_date"]) for p in payloads} == {("SalesReport02", "02-2024")}


def test_a_run_that_failed_half_way_is_run_again(spark, tmp_path):
    _first(spark, tmp_path, [(1, "a"), (2, "b")], D1)

    def fail(*args):
        raise RuntimeError("database is down")

    with pytest.raises(RuntimeError):
        _run(spark, tmp_path, [(1, "A")], D2, publish=fail)
    # The snapshot of the day is there, but the target is as it was.
    assert storage.snapshot_dates(spark, str(tmp_path / "pre")) == [D1, D2]
    assert current_version(spark, str(tmp_path / "gold")).count() == 2
    got = _run(spark, tmp_path, [(1, "A")], D2)
    assert [(r.k, r.v, r.load_date) for r in got.collect()] == [(1, "A", D2)]


def test_a_scheduled_step_that_never_started_is_ready(spark):
    steps = spark.createDataFrame(
        [(1, "t1", None, None), (2, "t2", "t1", '{"dependency_check": "TRUE"}'), (3, "t3", "t2", '{"dependency_check": "TRUE"}')],
        "step_id long, name string, depends_on string, info string",
    )
    log = spark.createDataFrame(
        [(1, D1, "COMPLETED", datetime(2024, 1, 1))], "step_id long, batch_dt date, status string, ts timestamp"
    )
    schedule = spark.createDataFrame([(1, D1), (2, D1), (3, D1)], "step_id long, batch_dt date")
    ready = runs.run_ready(steps, log, schedule)
    assert [(r.step_id, r.batch_dt) for r in ready.collect()] == [(2, D1)]
    assert runs.run_ready(steps, log).collect() == []
    plan = ready._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_two_steps_of_one_name_are_an_error(spark):
    steps = spark.createDataFrame(
        [(1, "t1", None, None), (9, "t1", None, None), (2, "t2", "t1", "{}")],
        "step_id long, name string, depends_on string, info string",
    )
    log = spark.createDataFrame(
        [(2, D1, "FAILED", datetime(2024, 1, 1))], "step_id long, batch_dt date, status string, ts timestamp"
    )
    with pytest.raises(Exception, match="two steps are named"):
        runs.run_ready(steps, log).collect()


def test_report_names_with_line_breaks(spark, tmp_path):
    from tidemark.plans.reports import report_payloads
    from tidemark.sources.export import export_by_key

    rows = spark.createDataFrame([(1, "Line\nbreak", 7)], "id int, report_name string, account_id int")
    export_by_key(rows, "account_id", str(tmp_path / "r"), 512)
    (payload,) = report_payloads(spark, str(tmp_path / "r"), "Sales_Report_02_2024", date(2024, 3, 31)).collect()
    got = json.loads(payload.payload)
    assert (got["account_id"], got["report_name"]) == ("7", "Linebreak")


def test_reports_with_known_columns_open_no_file_for_their_header(spark, tmp_path):
    from tidemark.plans.reports import read_report_files, report_payloads
    from tidemark.sources.export import export_by_key

    rows = spark.createDataFrame([(1, "One", 7), (2, None, 8)], "id int, report_name string, account_id int")
    export_by_key(rows, "account_id", str(tmp_path / "r"), 512)
    args = (spark, str(tmp_path / "r"), "Sales_Report_02_2024", date(2024, 3, 31))
    known = report_payloads(*args, rows.columns).collect()
    assert len(known) == 2 and sorted(known) == sorted(report_payloads(*args).collect())
    # There is no file whose header could tell the columns.
    export_by_key(rows.filter("id > 2"), "account_id", str(tmp_path / "none"), 512)
    none = read_report_files(spark, str(tmp_path / "none"), rows.columns)
    assert none.columns == ["file", "line", *rows.columns] and none.isEmpty()


def test_scratch_without_a_checkpoint_folder_is_in_the_warehouse(spark, monkeypatch):
    from tidemark import session

    class Conf:
        def get(self, key, default=None):
            return {"spark.sql.warehouse.dir": "file:/w"}.get(key, default)

    class Context:
        master = "local[4]"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    assert session.scratch_dir(Session(), "x").startswith("file:/w/tidemark/x-")
    Context.master = "spark://host:7077"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_dir(Session(), "x")


def _size(folder):
    return sum(os.path.getsize(f) for f in glob.glob(f"{folder}/**/*.parquet", recursive=True))


def test_a_late_run_is_refused_before_anything_is_written(spark, tmp_path):
    days = [D1 + timedelta(days=n) for n in range(4)]
    _first(spark, tmp_path, [(1, "a")], days[0])
    _run(spark, tmp_path, [(1, "b")], days[2])
    before = sorted(glob.glob(f"{tmp_path}/**/*.parquet", recursive=True))
    with pytest.raises(ValueError, match="has been run already"):
        _run(spark, tmp_path, [(1, "c")], days[1])
    with pytest.raises(ValueError, match="has been run already"):
        _first(spark, tmp_path, [(1, "c")], days[1])
    assert sorted(glob.glob(f"{tmp_path}/**/*.parquet", recursive=True)) == before
    assert [r.v for r in current_version(spark, str(tmp_path / "gold")).collect()] == ["b"]


def test_a_run_without_an_initial_load_leaves_nothing(spark, tmp_path):
    with pytest.raises(ValueError, match="initial load"):
        _run(spark, tmp_path, [(1, "a")], D1)
    assert glob.glob(f"{tmp_path}/**/*.parquet", recursive=True) == []


def test_repeated_keys_are_refused(spark, tmp_path):
    _first(spark, tmp_path, [(1, "a")], D1)
    for rows in ([(1, "a"), (1, "c")], [(1, "a"), (2, "x"), (2, "x")]):
        with pytest.raises(RepeatedKeys, match="several rows of a key"):
            _run(spark, tmp_path, rows, D2)
        assert [r.v for r in current_version(spark, str(tmp_path / "gold")).collect()] == ["a"]
    # The day that failed is not compared with.
    got = _run(spark, tmp_path, [(1, "a"), (2, "x")], D2 + timedelta(days=1))
    assert sorted((r.k, r.v) for r in got.collect()) == [(1, "a"), (2, "x")]


def test_a_day_writes_its_changes_only_until_they_are_folded(spark, tmp_path):
    rows = [(k, f"value {k * 7919}") for k in range(20000)]
    gold = str(tmp_path / "gold")
    _first(spark, tmp_path, rows, D1)
    _run(spark, tmp_path, [(0, "new"), *rows[2:]], D2)
    assert storage.snapshot_dates(spark, gold) == [D1]
    assert _size(f"{gold}_changes") < _size(gold) / 10
    day = D2 + timedelta(days=1)
    table = _run(spark, tmp_path, [(0, "newer"), (1, "back"), *rows[3:]], day)
    # The rows before folding are taken first, since folding deletes their files.
    before = sorted(tuple(r) for r in table.collect())
    assert len(before) == 19999 and before[:2] == [(0, "newer", *before[0][2:]), (1, "back", *before[1][2:])]
    folded = fold_target(spark, gold)
    assert sorted(tuple(r) for r in folded.collect()) == before
    assert storage.snapshot_dates(spark, gold) == [day]
    assert storage.snapshot_dates(spark, f"{gold}_changes") == []
    with pytest.raises(ValueError, match="initial load"):
        _run(spark, tmp_path, rows, day)
    assert _run(spark, tmp_path, rows, day + timedelta(days=1)).count() == 20000


def test_a_job_logs_to_one_file(spark, tmp_path):
    job = {"table_name": "t", "unload_to_s3": "false"}
    run_unload_job(spark, job, 1, D1, str(tmp_path / "log"))
    assert len(glob.glob(f"{tmp_path}/log/*/*.parquet")) == 1
    assert [r.status for r in read_log(spark, str(tmp_path / "log")).orderBy("ts").collect()] == ["START", "UNLOAD_SKIPPED", "END"]


def test_other_jobs_from_a_config(spark, tmp_path):
    from tidemark.__main__ import run

    at, src = datetime(2024, 1, 2, 6), {"format": "parquet", "options": {"path": str(tmp_path / "src")}}
    spark.createDataFrame([(1, " a "), (2, "b")], "accountid int, v string").write.parquet(str(tmp_path / "src"))
    rule = {"rule": "trim_whitespace", "columns": [{"src_col": "v", "tgt_col": "raw"}]}
    cleanse = {"source": src, "target": str(tmp_path / "clean"), "options": {"fixedColumnsCleansingRules": [rule]}}
    assert sorted(r.v for r in run(spark, cleanse, "cleanse", D2, at).collect()) == ["a", "b"]
    unload = {
        "views": {"job_rows": src}, "step_id": 1, "log": str(tmp_path / "log"),
        "job": {"table_name": "t", "unload_to_s3": "true", "query": "SELECT * FROM job_rows",
                "unload": {"bucket": str(tmp_path), "key": "out", "data_format": "parquet"}},
    }
    assert run(spark, unload, "unload", D2, at) == 2
    report = {
        "views": {"job_rows": src}, "queries": {"Sales": "SELECT * FROM job_rows"}, "root": str(tmp_path / "reports"),
        "template": "lake/report_name/report_name_Report_dd_yyyy", "max_size_mb": 1,
    }
    folder = run(spark, report, "report", D2, at)["Sales"]
    assert len(glob.glob(f"{folder}/*/*.csv")) == 2
    assert not spark.catalog.tableExists("job_rows")


# --- the log by dates ------------------------------------------------------------


def _scanned(df):
    """Files that the scans of the log open, by the plan as it ran."""
    df.collect()

    def leaves(plan):
        inner = plan.finalPhysicalPlan() if "AdaptiveSparkPlan" in plan.nodeName() else plan.plan() if "QueryStage" in plan.nodeName() else None
        below = [inner] if inner is not None else [plan.children().apply(i) for i in range(plan.children().size())]
        return [leaf for b in below for leaf in leaves(b)] if below else [plan]

    found = {leaf.hashCode(): leaf for leaf in leaves(df._jdf.queryExecution().executedPlan()) if "Scan parquet" in leaf.nodeName()}
    return max(leaf.metrics().apply("numFiles").value() for leaf in found.values())


def _log_of_days(spark, path, days, files=2):
    for n in range(files):
        rows = [(s, d, "COMPLETED" if s == 1 else "FAILED", 1, None, datetime(2024, 1, 1, n, s)) for d in days for s in (1, 2)]
        append_log(spark.createDataFrame(rows, RUN_LOG).coalesce(1), path)


def test_questions_about_a_date_read_that_date(spark, tmp_path):
    path, days = str(tmp_path / "log"), [D1 + timedelta(days=n) for n in range(30)]
    _log_of_days(spark, path, days)
    log = read_log(spark, path)
    steps = spark.createDataFrame([(1, "a", None, None), (2, "b", "{}", "a"), (3, "c", '{"dependency_check": "true"}', "a")], "step_id long, name string, info string, depends_on string")
    due = spark.createDataFrame([(s, d) for d in days[4:6] for s in (1, 2, 3)], "step_id long, batch_dt date")
    ready = runs.run_ready(steps, log, due, scheduled_only=True)
    assert sorted((r.step_id, r.batch_dt) for r in ready.collect()) == [(s, d) for s in (2, 3) for d in days[4:6]]
    # Two of thirty dates, of two files each; without a schedule all are read.
    assert _scanned(ready) == 4 and _scanned(runs.run_ready(steps, log)) == 60
    assert _scanned(runs.run_latest_status(log.filter(F.col("batch_dt") == days[0]))) == 2
    want = {(r.step_id, r.batch_dt) for r in runs.run_ready(steps, log, due).collect() if r.batch_dt in days[4:6]}
    assert {(r.step_id, r.batch_dt) for r in ready.collect()} == want
    with pytest.raises(ValueError, match="schedule"):
        runs.run_ready(steps, log, scheduled_only=True)


def test_null_dates_of_a_schedule(spark, tmp_path):
    path = str(tmp_path / "log")
    append_log(spark.createDataFrame([(1, None, "FAILED", 1, None, datetime(2024, 1, 1)), (2, D1, "FAILED", 1, None, datetime(2024, 1, 1))], RUN_LOG), path)
    due = spark.createDataFrame([(1, None)], "step_id long, batch_dt date")
    assert [(r.step_id, r.batch_dt) for r in runs.of_schedule(read_log(spark, path), due).collect()] == [(1, None)]


def test_closed_dates_are_compacted(spark, tmp_path):
    path, days = str(tmp_path / "log"), [D1 + timedelta(days=n) for n in range(4)]
    _log_of_days(spark, path, days, files=3)
    _log_of_days(spark, path, days[:1], files=0)
    before = sorted(map(str, read_log(spark, path).collect()))
    assert compact_log(spark, path, days[2]) == days[:2]
    assert sorted(map(str, read_log(spark, path).collect())) == before
    assert {d: len(glob.glob(f"{path}/batch_dt={d}/*.parquet")) for d in days} == dict(zip(days, [1, 1, 3, 3], strict=True))
    assert compact_log(spark, path, days[2]) == []


def test_a_log_without_date_folders_is_put_into_them(spark, tmp_path):
    path = str(tmp_path / "log")
    old = spark.createDataFrame([(1, D1, "END", 1, None, datetime(2024, 1, 1))], RUN_LOG)
    old.write.parquet(path)
    assert read_log(spark, path).count() == 1
    append_log(old.withColumn("batch_dt", F.lit(D2)), path)
    assert sorted(r.batch_dt for r in read_log(spark, path).collect()) == [D1, D2]
    assert not glob.glob(f"{path}/*.parquet")
