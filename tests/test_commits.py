"""Late, repeated and overlapping runs, folders, compaction, and the log they go through."""

from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from mailtrail import layout
from mailtrail.operators import checks, visitors
from mailtrail.plans import batch
from mailtrail.plans.batch import run_batch
from mailtrail.plans.commits import CommitLog, LostRace
from mailtrail.plans.publish import Warehouse, bucket_of

REFERENCE = date(2013, 2, 15)


def visit(email, sent="08/02/2013 18:30"):
    return f"{email},,,,{sent},-,1,0,-,0,0,-,-,-,-"


def put(folder, name, *rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes("\n".join([layout.REPORT_HEADER, *rows, ""]).encode())


@pytest.fixture
def place(spark, tmp_path):
    house = Warehouse(spark, f"{tmp_path}/warehouse")

    def go(run_id, folder, minute=0, reference=REFERENCE):
        return run_batch(spark, str(tmp_path / folder), house.root, reference, run_id, datetime(2013, 2, 15, 6, minute))

    return tmp_path, house, go


def rows(frame):
    return sorted(map(tuple, frame.collect()))


# The log


def test_each_number_is_taken_once(spark, tmp_path):
    log = CommitLog(spark, f"{tmp_path}/commits")
    assert (log.version(), log.entries("publish")) == (0, [])
    with ThreadPoolExecutor(8) as pool:
        taken = list(pool.map(lambda n: log.append("publish", run_id=f"r{n}"), range(24)))
    assert sorted(taken) == list(range(1, 25))
    entries = log.entries("publish")
    assert [e["version"] for e in entries] == list(range(1, 25))
    assert {e["run_id"]: e["version"] for e in entries} == {f"r{n}": v for n, v in enumerate(taken)}
    assert not [p.name for p in (tmp_path / "commits").iterdir() if "draft" in p.name]


def test_names_are_given_once_in_other_stores_too(spark, tmp_path):
    log = CommitLog(spark, f"{tmp_path}/commits")

    def renamed(version):
        target, draft = log._path(f"{version}.json"), log._path(f".{version}.draft")
        store = target.getFileSystem(spark._jsc.hadoopConfiguration())
        store.mkdirs(target.getParent())
        store.create(draft, True).close()
        return log._renamed(store, draft, target)

    assert [renamed(1), renamed(1), renamed(2)] == [True, False, True]


def test_facts_are_asked_for_each_number(spark, tmp_path):
    log = CommitLog(spark, f"{tmp_path}/commits")
    asked = []

    def facts():
        asked.append(log.version())
        if len(asked) == 1:
            log.append("ids", first_id=1, n_files=1, run_id="other")  # somebody is faster
        return {"covers": len(asked)}

    assert log.append("base", facts) == 2 and asked == [0, 1]
    assert [e["covers"] for e in log.entries("base")] == [2]


def test_file_ids_are_dealt_once(spark, tmp_path):
    house = Warehouse(spark, f"{tmp_path}/warehouse")
    counts = [3, 0, 5, 1, 2, 4]
    with ThreadPoolExecutor(6) as pool:
        firsts = list(pool.map(lambda n: house.reserve_file_ids(f"r{n}", n), counts))
    dealt = [i for first, n in zip(firsts, counts) for i in range(first, first + n)]
    assert sorted(dealt) == list(range(1, sum(counts) + 1))


# Runs


def test_a_late_run_keeps_its_visitors(place):
    """Published second under an earlier time, and repeated: nobody is lost, the order is that of publishing."""
    top, house, go = place
    put(top / "new", "report_2.txt", visit("a@example.com"), visit("b@example.com"))
    put(top / "old", "report_1.txt", visit("a@example.com", "01/02/2012 10:00"), visit("late@example.com"))
    assert go("r2", "new", minute=30) == "SUCCESS"
    assert go("r1", "old", minute=5, reference=date(2012, 2, 1)) == "SUCCESS"
    wanted = [
        ("a@example.com", date(2012, 2, 1), date(2013, 2, 8), 2, 1, 1),  # as of r1's day
        ("b@example.com", date(2013, 2, 8), date(2013, 2, 8), 1, 1, 1),  # as of r2's day
        ("late@example.com", date(2013, 2, 8), date(2013, 2, 8), 1, 0, 0),
    ]
    assert rows(house.visitors()) == wanted
    assert go("r1", "old", minute=50) == "SUCCESS" and go("r2", "new", minute=55) == "SUCCESS"
    assert rows(house.visitors()) == wanted and house.table("estadistica").count() == 4
    assert [r["run_id"] for r in house.published().orderBy("version").collect()] == ["r2", "r1"]
    assert house.register_views() == ["file_operational_detail", "monthly_summary", "run_operational_summary"]
    told = house.spark.sql("SELECT total_runs, files_detected, records_loaded FROM monthly_summary").collect()
    assert [tuple(r) for r in told] == [(2, 2, 4)]
    assert house.spark.sql("SELECT DISTINCT operational_category FROM file_operational_detail").collect()[0][0] == "IN_PROGRESS"


def test_two_runs_at_once(place, monkeypatch):
    """One publishes; the other fails, and its repeat finds the files loaded."""
    top, house, go = place
    put(top / "in", "report_1.txt", visit("a@example.com"))
    put(top / "in", "report_2.txt", visit("b@example.com"))
    real, inner = batch._archive_and_settle, []

    def overtaken(*given):
        if not inner:
            inner.append("fast")
            inner.append(go("fast", "in", minute=1))
        return real(*given)

    monkeypatch.setattr(batch, "_archive_and_settle", overtaken)
    with pytest.raises(LostRace, match="fast"):
        go("slow", "in")
    assert inner == ["fast", "SUCCESS"]
    assert {r.run_id: (r.status, r.error_code) for r in house.runs().collect()} == {
        "fast": ("SUCCESS", None), "slow": ("FAILED", "LostRace")}
    assert house.table("estadistica").count() == 2 and {r.run_id for r in house.files().collect()} == {"fast"}
    assert go("slow", "in", minute=2) == "SUCCESS"
    assert house.table("estadistica").count() == 2
    assert {r.status for r in house.files().filter("run_id = 'slow'").collect()} == {"SKIPPED_ALREADY_PROCESSED"}
    ids = [r.file_id for r in house.files().collect()]
    assert len(ids) == len(set(ids)) == 4


def test_runs_over_other_files_may_overlap(place, monkeypatch):
    top, house, go = place
    put(top / "a", "report_1.txt", visit("a@example.com"))
    put(top / "b", "report_1.txt", visit("a@example.com", "08/01/2013 18:30"))
    real, inner = batch._archive_and_settle, []

    def meanwhile(*given):
        if not inner:
            inner.append("b")
            go("b", "b", minute=1)
        return real(*given)

    monkeypatch.setattr(batch, "_archive_and_settle", meanwhile)
    assert go("a", "a") == "SUCCESS"
    assert [r["visitas_totales"] for r in house.visitors().collect()] == [2]
    assert house.files().select("file_id").distinct().count() == 2


# Folders


def test_only_the_listed_folder_is_settled(place):
    top, house, go = place
    put(top / "dayA", "report_1.txt", visit("a@example.com"))
    put(top / "dayB", "report_2.txt", visit("b@example.com"))
    go("r1", "dayA")
    go("r2", "dayB", minute=1)
    assert {r.status for r in house.files().collect()} == {"BACKED_UP"}
    (top / "dayA" / "report_1.txt").unlink()
    put(top / "dayA", "report_3.txt", visit("c@example.com"))
    go("r3", "dayA", minute=2)
    states = {r.file_name: r for r in house.files().collect()}
    assert {n: r.status for n, r in states.items()} == {
        "report_1.txt": "SUCCESS", "report_2.txt": "BACKED_UP", "report_3.txt": "BACKED_UP"}
    assert states["report_1.txt"].source_deleted_at and checks.broken_success(house.files()).isEmpty()


def test_a_replaced_source_settles_the_old_file(place):
    top, house, go = place
    put(top / "in", "report_1.txt", visit("a@example.com"))
    put(top / "in", "report_2.txt", visit("b@example.com"))
    go("r1", "in")
    put(top / "in", "report_1.txt", visit("other@example.com"))
    go("r2", "in", minute=1)
    got = {(r.run_id, r.file_name): r.status for r in house.files().collect()}
    assert got == {
        ("r1", "report_1.txt"): "SUCCESS", ("r1", "report_2.txt"): "BACKED_UP",
        ("r2", "report_1.txt"): "BACKED_UP", ("r2", "report_2.txt"): "SKIPPED_ALREADY_PROCESSED"}
    # A listing hands on who lies where: the second file is settled two runs later.
    (top / "in" / "report_2.txt").unlink()
    go("r3", "in", minute=2)
    assert {r.status for r in house.files().filter("run_id = 'r1'").collect()} == {"SUCCESS"}


def test_a_known_time_and_size_in_another_folder_is_read(place, monkeypatch):
    """Equal names, sizes and times do not make equal files."""
    import os
    top, house, go = place
    for folder, email in (("a", "a@example.com"), ("b", "b@example.com")):
        put(top / folder, "report_1.txt", visit(email))
        os.utime(top / folder / "report_1.txt", (1_360_000_000, 1_360_000_000))
    go("r1", "a")
    go("r2", "b", minute=1)
    assert sorted(r.email for r in house.visitors().collect()) == ["a@example.com", "b@example.com"]


# Compaction


def test_compaction_changes_nothing_and_is_all_that_is_read(spark, place):
    top, house, go = place
    emails = [f"u{i}@example.com" for i in range(12)]
    put(top / "in", "report_1.txt", *[visit(e) for e in emails])
    put(top / "in", "report_2.txt", visit(emails[0], "01/01/2012 00:00"), visit("bad"))
    go("r1", "in")
    (top / "in" / "report_2.txt").unlink()
    go("r2", "in", minute=1)
    before = rows(house.files()), rows(house.visitors()), rows(house.runs())
    assert house.runs_since_compaction() == 2
    first = house.compact(buckets=8)
    assert house.compact() is None and house.runs_since_compaction() == 0
    assert (rows(house.files()), rows(house.visitors()), rows(house.runs())) == before
    assert not [f for f in house.files().inputFiles() if "file_events" in f]

    # A run that meets one visitor opens that visitor's bucket and no other.
    one = spark.createDataFrame([(emails[3],), ("new@example.com",)], "email string")
    found = house.known_visitors(one)
    assert [r.email for r in found.collect()] == [emails[3]]
    wanted = {r[0] for r in one.select(bucket_of(F.col("email"), 8)).collect()}
    opened = {f.split("bucket=")[1].split("/")[0] for f in house._activity(
        house._base(), house.log.entries("publish"), sorted(wanted)).inputFiles()}
    assert opened <= {str(b) for b in wanted}

    put(top / "in", "report_3.txt", visit(emails[3]), visit("new@example.com"))
    go("r3", "in", minute=2)
    third = house.files().filter("run_id = 'r3' AND file_name = 'report_3.txt'").first()
    assert (third.visitors_inserted, third.visitors_updated) == (1, 1)
    assert {f.split("run_id=")[1].split("/")[0] for f in house.files().inputFiles() if "run_id=" in f} == {"r3"}
    rebuilt = visitors.visitors(house.table("estadistica"), REFERENCE)
    assert rows(house.visitors()) == rows(rebuilt)

    # The next compaction writes touched buckets anew and leaves the others where they lie.
    after = rows(house.files())
    house.compact()
    old, new = house.log.entries("base")
    assert old["version"] == first
    moved = {b for b in range(8) if old["buckets"][b] != new["buckets"][b]}
    assert moved == {r[0] for r in one.select(bucket_of(F.col("email"), 8)).collect()}
    assert rows(house.visitors()) == rows(rebuilt) and rows(house.files()) == after
    dropped = house.tidy()
    assert dropped == [f"file_state/{old['state']}"]
    assert rows(house.visitors()) == rows(rebuilt) and rows(house.files()) == after


def test_runs_compact_now_and_then(place, monkeypatch):
    top, house, go = place
    monkeypatch.setattr(batch, "COMPACT_AFTER", 2)
    for n in range(3):
        put(top / "in", f"report_{n}.txt", visit(f"u{n}@example.com"))
        go(f"r{n}", "in", minute=n)
    assert [e["covers"] for e in house.log.entries("base")] == [
        e["version"] for e in house.log.entries("publish")][1:2]
    assert house.visitors().count() == 3 and house.files().count() == 6


def test_the_latest_run_gives_the_reference_day(spark):
    day = date(2013, 2, 8)
    months = [
        ("a", 2013, 2, day, day, 2, 5, date(2013, 2, 15)), ("a", 2013, 1, day, day, 3, 7, date(2013, 1, 31)),
        ("a", 2013, 2, day, day, 1, 6, date(2013, 2, 15)), ("b", 2013, 2, day, day, 4, 1, date(2014, 2, 1)),
    ]
    activity = spark.createDataFrame(months, visitors.ACTIVITY_SCHEMA)
    wanted = [("a", day, day, 6, 6, 3), ("b", day, day, 4, 0, 0)]
    assert rows(visitors.visitors_of_runs(activity)) == wanted
    merged = visitors.merged_activity(activity)
    assert merged.count() == 3 and rows(visitors.visitors_of_runs(merged)) == wanted
