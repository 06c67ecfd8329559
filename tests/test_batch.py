"""Whole runs over a landing folder: load, idempotency, increments, failures."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from mailtrail import layout
from mailtrail.functions.rules import RuleProfile
from mailtrail.operators import checks, control, reports, visitors
from mailtrail.plans import batch
from mailtrail.plans.batch import run_batch
from mailtrail.plans.publish import Warehouse, constraint_report

REFERENCE = date(2013, 2, 15)


def visit(email, sent="08/02/2013 18:30", opens="1"):
    return f"{email},,,,{sent},-,{opens},0,-,0,0,-,-,-,-"


def put(folder, name, *rows, header=layout.REPORT_HEADER):
    (folder / name).write_bytes("\n".join([header, *rows, ""]).encode())


@pytest.fixture
def place(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    house = Warehouse(spark, f"{tmp_path}/warehouse")

    def go(run_id, minute=0, **more):
        return run_batch(
            spark, str(inbox), house.root, REFERENCE, run_id,
            datetime(2013, 2, 15, 6, minute), scratch=f"{tmp_path}/scratch/{run_id}", **more,
        )

    return inbox, house, go


def test_two_runs(spark, place):
    inbox, house, go = place
    put(inbox, "report_1.txt", visit("A@example.com"), visit("bad"), visit("b@example.com"))
    put(inbox, "report_2.txt", visit("a@example.com", "01/01/2012 00:00"))
    put(inbox, "report_3.txt", visit("a@example.com", "01/01/2012 00:00"))  # same as 2
    put(inbox, "report_4.txt", visit("c@example.com"), header="email,jyv,Badmail")
    (inbox / "report_5.txt").write_bytes(b"")
    put(inbox, "report_6.txt")  # header only
    (inbox / "report_7.txt").write_bytes(layout.REPORT_HEADER.encode() + b"\n\xff\xfe,bad bytes\n")

    assert go("run1") == "FAILED"  # the undecodable file
    files = {r.file_name: r for r in house.files().collect()}
    assert {n: (r.status, r.error_code) for n, r in files.items()} == {
        "report_1.txt": ("BACKED_UP", None),
        "report_2.txt": ("BACKED_UP", None),
        "report_3.txt": ("SKIPPED_ALREADY_PROCESSED", "ALREADY_PROCESSED"),
        "report_4.txt": ("REJECTED_LAYOUT", "INVALID_COLUMN_COUNT"),
        "report_5.txt": ("REJECTED_LAYOUT", "EMPTY_FILE"),
        "report_6.txt": ("BACKED_UP", None),
        "report_7.txt": ("FAILED", "UnicodeDecodeError"),
    }
    first = files["report_1.txt"]
    assert [r.file_id for r in sorted(files.values(), key=lambda r: r.file_name)] == list(range(1, 8))
    assert (first.records_read, first.records_valid, first.records_invalid) == (3, 2, 1)
    assert (first.records_loaded, first.visitors_inserted, first.visitors_updated) == (2, 2, 0)
    assert (files["report_2.txt"].visitors_inserted, files["report_2.txt"].visitors_updated) == (0, 1)
    errors = house.table("errores").collect()
    assert [(r.file_id, r.line_number, r.error_code) for r in errors] == [(1, 3, "INVALID_EMAIL")]
    assert {r.email: tuple(r)[1:] for r in house.visitors().collect()} == {
        "a@example.com": (date(2012, 1, 1), date(2013, 2, 8), 2, 1, 1),
        "b@example.com": (date(2013, 2, 8), date(2013, 2, 8), 1, 1, 1),
    }

    # second run: the same files again plus one new one
    put(inbox, "report_8.txt", visit("b@example.com", "10/01/2013 10:00"), visit("d@example.com"))
    (inbox / "report_7.txt").unlink()
    assert go("run2", minute=30) == "PARTIAL_SUCCESS"
    second = {r.file_name: r for r in house.files().filter("run_id = 'run2'").collect()}
    assert {n for n, r in second.items() if r.status == "BACKED_UP"} == {"report_8.txt"}
    assert (second["report_8.txt"].visitors_inserted, second["report_8.txt"].visitors_updated) == (1, 1)
    assert house.table("estadistica").count() == 5
    rebuilt = visitors.visitors(house.table("estadistica"), REFERENCE)
    assert sorted(map(tuple, rebuilt.collect())) == sorted(map(tuple, house.visitors().collect()))

    runs = {r.run_id: r for r in house.runs().collect()}
    assert (runs["run1"].files_detected, runs["run1"].files_rejected, runs["run1"].files_failed) == (7, 2, 1)
    assert runs["run2"].status == "PARTIAL_SUCCESS" and runs["run2"].records_loaded == 2
    alerts = reports.alert_messages(house.files(), "run1").collect()
    assert sorted(r.severity for r in alerts if "report_7" in r.message) == ["ERROR"]
    assert constraint_report(house).count() == 0
    assert house.missing_outputs() == []


def test_failure_publishes_nothing(spark, place, monkeypatch):
    inbox, house, go = place
    put(inbox, "report_1.txt", visit("a@example.com"))
    assert go("run1") == "SUCCESS"
    put(inbox, "report_2.txt", visit("z@example.com"))

    def fail(*_):
        raise OSError("test")

    with monkeypatch.context() as patch:
        patch.setattr(batch, "_archive_and_settle", fail)
        with pytest.raises(OSError):
            go("run2", minute=10)
    assert house.table("estadistica").count() == 1
    assert [r.email for r in house.visitors().collect()] == ["a@example.com"]
    assert {r.run_id: r.status for r in house.runs().collect()} == {"run1": "SUCCESS", "run2": "FAILED"}
    # running it again under the same id makes it good
    assert go("run2", minute=20) == "SUCCESS"
    assert house.table("estadistica").count() == 2


def test_a_broken_file_fails_alone(spark, place, monkeypatch):
    inbox, house, go = place
    put(inbox, "report_1.txt", visit("a@example.com"), visit("bad"))
    put(inbox, "report_2.txt", visit("b@example.com", "08/03/2013 18:30"), visit("lost@example.com"))
    put(inbox, "report_3.txt", visit("c@example.com").replace(",,,,", f",{'j' * 300},,,", 1))
    real = batch.records.visits
    with monkeypatch.context() as patch:
        patch.setattr(
            batch.records, "visits", lambda rows: real(rows).filter("email <> 'lost@example.com'")
        )
        assert go("run1") == "FAILED"
    files = {r.file_name: r for r in house.files().collect()}
    assert {n: (r.status, r.error_code) for n, r in files.items()} == {
        "report_1.txt": ("BACKED_UP", None),
        "report_2.txt": ("FAILED", "RECONCILIATION_ERROR"),
        "report_3.txt": ("FAILED", "DataError"),
    }
    assert [r.email for r in house.table("estadistica").collect()] == ["a@example.com"]
    assert [r.email for r in house.visitors().collect()] == ["a@example.com"]
    assert house.table("reconciliation").count() == 2
    # the failed files are tried again
    assert go("run2", minute=1) == "FAILED"
    assert sorted(r.email for r in house.table("estadistica").collect()) == [
        "a@example.com", "b@example.com", "lost@example.com"]


def test_known_files_are_not_read_again(spark, place, monkeypatch):
    inbox, house, go = place
    put(inbox, "report_1.txt", visit("a@example.com"))
    put(inbox, "report_[2].txt", visit("d@example.com"))
    assert go("run1") == "SUCCESS"
    put(inbox, "report_2.txt", visit("b@example.com"))
    read = []
    real = batch.landing.file_contents
    monkeypatch.setattr(
        batch.landing, "file_contents", lambda s, paths: read.append(paths) or real(s, paths)
    )
    assert go("run2", minute=1) == "SUCCESS"
    assert [[p.rsplit("/", 1)[-1] for p in paths] for paths in read] == [["report_2.txt"]] * 2
    assert {r.file_name: r.status for r in house.files().filter("run_id = 'run2'").collect()} == {
        "report_1.txt": "SKIPPED_ALREADY_PROCESSED", "report_2.txt": "BACKED_UP"}


def test_paths_are_listed_in_shares(spark, tmp_path):
    names = [f"report_{n}.txt" for n in range(120)]
    for name in names:
        put(tmp_path, name, visit(f"{name}@example.com"))
    files = spark.createDataFrame([(f"{tmp_path}/{n}",) for n in names], "file_path string")
    before = spark.conf.get(batch.landing.LISTING_TASKS, None)
    spark.sparkContext.setJobGroup("listing", "listing")
    try:
        read = batch._of_files(lambda paths: batch.landing.file_contents(spark, paths), str(tmp_path), files)
        told = spark.sparkContext.statusTracker()
        stages = [told.getStageInfo(s) for j in told.getJobIdsForGroup("listing") for s in told.getJobInfo(j).stageIds]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.sparkContext.setLocalProperty("spark.job.description", None)
    most = max(s.numTasks for s in stages if s)
    assert 1 < most <= 4 * spark.sparkContext.defaultParallelism
    assert spark.conf.get(batch.landing.LISTING_TASKS, None) == before
    assert sorted(r.file_name for r in read.collect()) == sorted(names)


def test_a_source_replaced_during_the_run_is_not_archived(spark, place, monkeypatch):
    inbox, house, go = place
    put(inbox, "report_1.txt", visit("a@example.com"))
    real = batch._archive_and_settle

    def replace_first(*given):
        put(inbox, "report_1.txt", visit("x@example.com"))
        return real(*given)

    monkeypatch.setattr(batch, "_archive_and_settle", replace_first)
    assert go("run1") == "FAILED"
    (row,) = house.files().collect()
    assert (row.status, row.error_code) == ("PENDING_BACKUP", "BACKUP_ERROR")
    assert row.error_message == "Archive check failed: CHECKSUM_MISMATCH"


def test_deleted_sources_are_settled(spark, place):
    inbox, house, go = place
    put(inbox, "report_1.txt", visit("a@example.com"))
    put(inbox, "report_2.txt", visit("b@example.com"))
    go("run1")
    (inbox / "report_1.txt").unlink()
    go("run2", minute=1)
    files = {(r.run_id, r.file_name): r for r in house.files().collect()}
    gone = files["run1", "report_1.txt"]
    assert (gone.status, files["run1", "report_2.txt"].status) == ("SUCCESS", "BACKED_UP")
    assert gone.source_deleted_at > gone.backup_at > gone.load_finished_at > gone.load_started_at
    assert checks.broken_success(house.files()).isEmpty()
    assert {r.run_id: r.files_success for r in house.runs().collect()} == {"run1": 1, "run2": 0}
    go("run3", minute=2)  # settled once
    assert house.files().filter("status = 'SUCCESS'").count() == 1


def test_lenient_run_takes_other_names_and_headers(spark, place):
    inbox, house, go = place
    put(inbox, "report_small_test.txt", visit("a@example.com"), visit("x"), "", header="whatever")
    assert go("run1", profile=RuleProfile.LENIENT) == "SUCCESS"
    assert house.table("estadistica").count() == 1
    assert [r.error_code for r in house.table("errores").collect()] == ["INVALID_EMAIL"]


def test_repeating_a_published_run_changes_nothing(spark, place):
    inbox, house, go = place
    put(inbox, "report_1.txt", visit("a@example.com"))
    assert go("run1") == "SUCCESS"
    put(inbox, "report_2.txt", visit("b@example.com"))
    assert go("run2", minute=1) == "SUCCESS"
    assert go("run1", minute=2) == "SUCCESS" and go("run2", minute=3) == "SUCCESS"
    put(inbox, "report_3.txt", visit("c@example.com"))
    go("run3", minute=4)
    assert house.table("estadistica").count() == 3
    assert {r.email: r.total_visits for r in house.visitors().select(
        "email", F.col(house.visitors().columns[3]).alias("total_visits")).collect()} == {
        "a@example.com": 1, "b@example.com": 1, "c@example.com": 1}


def test_unpublished_files_are_loaded_by_the_next_run(spark, place, monkeypatch):
    inbox, house, go = place
    put(inbox, "report_1.txt", visit("a@example.com", "01/01/2013 00:00"))

    def fail(*_):
        raise OSError("no marker")

    with monkeypatch.context() as patch:
        patch.setattr(Warehouse, "publish", fail)
        with pytest.raises(OSError):
            go("run1")
    assert {r.run_id: r.status for r in house.runs().collect()} == {"run1": "FAILED"}
    go("run2", minute=1)
    assert house.table("estadistica").count() == 1
    # a repeat drops what the failed attempt wrote, in whatever partitions
    put(inbox, "report_1.txt", visit("z@example.com", "01/02/2013 00:00"))
    with monkeypatch.context() as patch:
        patch.setattr(Warehouse, "publish", fail)
        with pytest.raises(OSError):
            go("run3", minute=2)
    put(inbox, "report_1.txt", visit("z@example.com", "01/03/2013 00:00"))
    assert go("run3", minute=3) == "SUCCESS"
    assert house.run_rows("estadistica", "run3").count() == 1


def test_twins_of_refused_files_are_refused(spark, place):
    inbox, house, go = place
    put(inbox, "report_1.txt", visit("a@example.com"), header="email,jyv,Badmail")
    put(inbox, "report_2.txt", visit("a@example.com"), header="email,jyv,Badmail")
    put(inbox, "report_3.txt", visit("b@example.com"))
    put(inbox, "report_4.txt", visit("b@example.com"))
    go("run1")
    assert [r.status for r in house.files().orderBy("file_name").collect()] == [
        "REJECTED_LAYOUT", "REJECTED_LAYOUT", "BACKED_UP", "SKIPPED_ALREADY_PROCESSED"]


def test_lenient_numbers_count_blank_lines(spark, place):
    inbox, house, go = place
    rows = [x for i in range(400) for x in (visit(f"u{i}@example.com"), "", " ")]
    put(inbox, "report_1.txt", *rows)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        assert go("run1", profile=RuleProfile.LENIENT) == "SUCCESS"
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    got = house.table("estadistica").select("email", "source_line").collect()
    assert {(r.email, r.source_line) for r in got} == {(f"u{i}@example.com", 2 + 3 * i) for i in range(400)}


def test_status_event_clears_code(spark):
    events = spark.createDataFrame(
        [(1, 1, "detected", "r", "DETECTED", None), (1, 2, "status", None, "FAILED", "Oops"),
         (1, 3, "status", None, "PREPARED", None), (1, 4, "load_finished", None, "LOADED", None)],
        "file_id bigint, seq bigint, event string, run_id string, status string, error_code string",
    )
    for part in control.FILE_EVENT_SCHEMA.split(","):
        name, kind = part.strip().split(" ")
        if name not in events.columns:
            events = events.selectExpr("*", f"CAST(NULL AS {kind}) AS {name}")
    (row,) = control.fold_files(events).collect()
    assert (row.status, row.error_code, row.run_id) == ("LOADED", None, "r")
