"""One run over a landing folder, from manifest to published tables.

All files are handled together: each step is a job over the whole batch, and what a step
decides about a file is a row, not a branch of a loop. The folder is listed once. A file with
the path, size and time that the folder's last published listing has keeps its checksum, and
text and archive bytes are read of files with new contents only: a run costs what is new, not
what lies in the folder, and reads neither the events nor the visits of earlier runs. A file
that fails is FAILED with its code; the others load.
"""

from __future__ import annotations

import re
import uuid
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import layout
from ..functions.rules import RuleProfile
from ..operators import archive, checks, control, layout_gate, records, visitors
from ..session import scratch_folder
from ..sources import landing, lines
from ..sources.lines import written
from .commits import LostRace
from .publish import COMPACT_AFTER, Warehouse


# Comes after all events of the run that loaded a file.
SETTLEMENT_SEQ = 20


def new_run_id(prefix: str = "manual") -> str:
    return f"{prefix}_{uuid.uuid4()}"


def run_batch(
    spark: SparkSession,
    folder: str,
    warehouse_root: str,
    reference: date,
    run_id: str | None = None,
    now: datetime | None = None,
    profile: RuleProfile = RuleProfile.STRICT,
    dag_id: str = "visit_reports_daily",
    scratch: str | None = None,
) -> str:
    """Load every new report file of the folder; returns the final run status.

    A failure leaves the published tables as they were and the run recorded as FAILED. A run
    that is not published can be repeated under its id, from nothing; repeating a published one
    changes nothing and returns its recorded status. Runs may overlap: one whose files another
    has published meanwhile fails with ``LostRace``, and its repeat skips them. ``now`` only
    dates a run; what counts last is what is published last.
    """
    run_id = run_id or new_run_id()
    now = now or datetime.now()
    house = Warehouse(spark, warehouse_root)
    own_scratch = scratch or scratch_folder(spark, "batch")
    run = (house, run_id, dag_id, now)
    if house.is_published(run_id):
        return _published_status(*run)
    house.drop_run(run_id)
    _record_run(*run)
    try:
        folder, read_at = landing.full_path(spark, folder), house.log.version()
        files = _load(spark, folder, house, run_id, reference, now, profile, own_scratch)
        house.publish(run_id, read_at, folder, reference)
        status = _final_status(house, run_id, files)
    except Exception as error:
        _record_run(*run, "FAILED", type(error).__name__, str(error))
        raise
    finally:
        if scratch is None:
            landing.delete(spark, own_scratch)
    _record_run(*run, status)
    if house.runs_since_compaction() >= COMPACT_AFTER:
        try:
            house.compact()
        except LostRace:
            pass  # another run has done it
    return status


def _final_status(house: Warehouse, run_id: str, files: DataFrame) -> str:
    this_run = house.spark.createDataFrame([(run_id,)], "run_id string")
    return control.final_status(this_run, files).first()["final_status"]


def _published_status(house, run_id, dag_id, now) -> str:
    """The recorded status; if the run ended between its marker and its record, that of its files."""
    ended = house.run_rows("run_events", run_id).filter("event = 'finished'").first()
    if ended is not None:
        return ended["status"]
    status = _final_status(house, run_id, house.run_files(run_id))
    _record_run(house, run_id, dag_id, now, status)
    return status


class _Clock:
    """Times of a run's steps: the run's own time plus what has passed since."""

    def __init__(self, now: datetime):
        self.now, self.began, self.steps = now, datetime.now(), {}

    def reached(self, *steps: str) -> None:
        for step in steps:
            self.steps[step] = self.now + (datetime.now() - self.began)

    def at(self, step: str):
        return F.lit(self.steps[step]).cast("timestamp_ntz")


def _load(spark, folder, house, run_id, reference, now, profile, scratch) -> DataFrame:
    clock = _Clock(now)
    listed = written(
        landing.file_manifest(spark, folder, layout.REPORT_GLOB), f"{scratch}/manifest"
    )
    manifest = landing.candidate_files(listed) if profile.strict else listed
    clock.reached("detected")
    last = house.last_listing(folder)
    sums = written(_checksums(spark, folder, manifest, last), f"{scratch}/sums")
    first_id = house.reserve_file_ids(run_id, manifest.count())
    registered = written(
        control.register_files(manifest.join(sums, "file_name"), first_id - 1, run_id, scratch),
        f"{scratch}/registered",
    )
    clock.reached("staged", "validation_started")

    looked_up = written(_looked_up(registered, house.table("loaded")), f"{scratch}/looked_up")
    fresh = looked_up.filter("original_file_id IS NULL")
    staged, offsets = _stage_records(spark, folder, fresh, run_id, profile, scratch)
    numbered = lines.with_line_numbers(staged, offsets)
    if "is_blank" in numbered.columns:
        numbered = numbered.filter("NOT is_blank")
    prepared = written(
        control.file_disposition(_facts(looked_up, numbered, profile)), f"{scratch}/prepared"
    )
    clock.reached("validation_finished", "load_started")

    ids = prepared.select(F.col("file_name").alias("source_file"), "file_id")
    records_only = numbered.filter("line_number > 1").select(
        F.col("file_name").alias("source_file"), F.col("line_number").alias("source_line"),
        *[c for c in staged.columns if c not in ("file_name", "is_blank", *lines.SPLIT_KEYS, "position")],
    )
    accepted = control.loadable(records_only, prepared).join(ids, "source_file")
    checked, stats, errors = _judged_tables(house, run_id, prepared, accepted, profile, scratch)
    loaded = written(
        control.file_disposition(prepared.join(checked, "file_id", "left")), f"{scratch}/loaded"
    )
    results = _update_visitors(house, stats, errors, loaded, run_id, scratch)
    clock.reached("load_finished")

    final = written(
        _archive_and_settle(spark, folder, house, loaded, run_id), f"{scratch}/final"
    )
    clock.reached("backed_up", "status")
    house.write_run("loaded", final.filter("archive_state IS NOT NULL").select(
        "file_id", "checksum_sha256", clock.at("load_finished").alias("load_finished_at")
    ), run_id)
    told = final.join(results, "file_id", "left")
    events = _file_events(house, told, run_id, clock)
    counters = control.run_metrics(told).withColumnRenamed("run_id", "of_run")
    present = _with_checksums(listed, sums)
    if last is not None:
        changes = written(control.listing_changes(last, present), f"{scratch}/changes")
        events = events.unionByName(
            control.deletion_events(control.settled_deletions(changes), SETTLEMENT_SEQ, clock.at("detected"))
        )
        counters = counters.unionByName(control.settled_counters(changes))
    else:
        changes = None
    house.write_run("run_counters", counters, run_id)
    house.write_run("listing", _listing(present, final, changes, run_id), run_id)
    house.write_run("file_events", written(events, f"{scratch}/events"), run_id)
    return final


def _with_checksums(listed: DataFrame, sums: DataFrame) -> DataFrame:
    """The listed files, with the checksums of those that are reports."""
    return listed.join(sums, "file_name", "left").withColumn(
        "modified_at", F.col("modified_at").cast("timestamp_ntz")
    )


def _listing(present: DataFrame, final: DataFrame, changes: DataFrame | None, run_id: str) -> DataFrame:
    """What lies in the folder, each path with the archived file of its contents that is not settled."""
    opened = final.filter("archive_state = 'OK'").select(
        "file_path", F.col("file_id").alias("open_file_id"), F.lit(run_id).alias("open_run_id")
    )
    if changes is not None:
        # A path that holds what it held is not archived again.
        kept = changes.filter("change = 'same' AND open_file_id IS NOT NULL")
        opened = opened.unionByName(kept.select(*opened.columns))
    return present.join(opened, "file_path", "left")


def _of_files(read, folder: str, files: DataFrame) -> DataFrame:
    """What ``read`` gives for these files of the folder, none of the others opened.

    Their paths go through the driver, as those of every file scan do.
    """
    paths = [re.sub(r"([\[\]{}*?\\])", r"\\\1", r[0]) for r in files.select("file_path").collect()]
    if not paths:
        return read(folder).filter(F.lit(False))
    with landing.listed_in_shares(files.sparkSession):
        return read(paths)


def _checksums(spark, folder, manifest, last) -> DataFrame:
    """(file_name, checksum_sha256): as listed last by path, size and time, the others from the bytes."""
    unread, known = manifest, None
    if last is not None:
        seen = last.filter("checksum_sha256 IS NOT NULL AND modified_at IS NOT NULL").select(
            "file_path", "size_bytes", "modified_at", "checksum_sha256"
        )
        dated = manifest.withColumn("modified_at", F.col("modified_at").cast("timestamp_ntz"))
        known = dated.join(seen, ["file_path", "size_bytes", "modified_at"]).select(
            "file_name", "checksum_sha256"
        )
        unread = manifest.join(known, "file_name", "left_anti")
    contents = _of_files(lambda paths: landing.file_contents(spark, paths), folder, unread)
    sums = landing.file_checksums(unread, contents).select("file_name", "checksum_sha256")
    return sums if known is None else sums.unionByName(known)


def _looked_up(registered: DataFrame, loaded: DataFrame | None) -> DataFrame:
    """Registered files with the loaded file of the same content, if there is one."""
    if loaded is not None:
        return control.already_processed(registered, loaded).drop("already_processed")
    return registered.select(
        "*", F.lit(None).cast("bigint").alias("original_file_id"),
        F.lit(None).cast("string").alias("original_run_id"),
    )


def _stage_records(
    spark, folder, fresh, run_id, profile, scratch
) -> tuple[DataFrame, DataFrame]:
    """One pass over the text: parsed and validated lines with their place in the split."""
    positioned = _of_files(
        lambda paths: lines.positioned_lines(spark, paths), folder, fresh
    ).withColumn("utf8_ok", F.is_valid_utf8("raw_record"))
    if not profile.strict:  # blank lines count for numbers, and go once these are given
        positioned = positioned.withColumn("is_blank", records.is_blank())
    named = positioned.withColumn("source_file", F.col("file_name"))
    validated = records.validate(named, run_id, profile).drop("source_file")
    staged = written(validated, f"{scratch}/records")
    offsets = written(lines.split_offsets(staged), f"{scratch}/offsets")
    return staged, offsets


def _facts(looked_up, numbered, profile) -> DataFrame:
    """Registered files with everything known before loading."""
    headers = lines.header_lines(numbered.select("file_name", "line_number", "raw_record"))
    facts = looked_up.join(headers, "file_name", "left").withColumn("file_size", F.col("size_bytes"))
    if profile.strict:
        facts = layout_gate.validate_layout(facts)
    counted = numbered.groupBy("file_name").agg(
        F.bool_and("utf8_ok").alias("utf8_ok"),
        F.count_if(F.expr("line_number > 1")).alias("records_read"),
        F.count_if(F.expr("line_number > 1 AND is_valid")).alias("records_valid"),
        F.count_if(F.expr("line_number > 1 AND NOT is_valid")).alias("records_invalid"),
    )
    if not profile.strict:
        counted = counted.withColumn("utf8_ok", F.lit(True))
    joined = control.batch_duplicates(facts.join(counted, "file_name", "left").drop("header_line"))
    kept = [c for c in joined.columns if not c.startswith("records_")]
    return joined.select(
        *kept,
        *[
            F.coalesce(c, F.lit(0)).alias(c)
            for c in ("records_read", "records_valid", "records_invalid")
        ],
    )


def _judged_tables(house, run_id, prepared, accepted, profile, scratch):
    """Verdicts on the staged rows of each file, and the two tables of the files that pass, as written.

    A file fails if its rows are not those that were counted, repeat a key, or break a width
    or NOT NULL rule, its control row included; its verdict goes to the table
    ``reconciliation``, and none of its rows is written.
    """
    tables = {"estadistica": records.visits(accepted), "errores": records.rejects(accepted, profile)}
    ready = prepared.filter("status = 'PREPARED'")
    counted = ready.select("file_id", "records_read", "records_valid", "records_invalid")
    own = checks.table_violations(ready.withColumnRenamed("file_path", "source_path"), "file_control")
    own = own.groupBy("file_id").agg(F.count(F.lit(1)).alias("own_values"))
    refused = F.coalesce(F.col("refused_values") + F.col("own_values"), "refused_values", "own_values")
    checked = written(
        checks.load_verdicts(counted, tables).join(own, "file_id", "left")
        .withColumn("refused_values", refused).drop("own_values"),
        f"{scratch}/checked",
    )
    is_broken = "error_code IS NOT NULL OR duplicate_lines IS NOT NULL OR refused_values IS NOT NULL"
    broken = house.write_run("reconciliation", checked.filter(is_broken), run_id).select("file_id")
    good = [
        house.write_run(name, rows.join(broken, "file_id", "left_anti"), run_id) for name, rows in tables.items()
    ]
    judged = checked.filter(f"NOT ({is_broken})").agg(F.sum("statistics_rows"), F.sum("errors_rows")).first()
    if [n or 0 for n in judged] != [rows.count() for rows in good]:
        raise RuntimeError("rows that were written are not those that were judged")
    facts = checked.select(
        "file_id", "statistics_rows", "errors_rows", "duplicate_lines", "refused_values"
    )
    return facts, *good


def _update_visitors(house, stats, errors, loaded, run_id, scratch) -> DataFrame:
    """Write what the run adds to its visitors' activity; returns the load numbers per file.

    No other visitor is read: of compacted activity only the buckets of the batch's e-mails.
    """
    batch = house.write_run("activity", visitors.monthly_activity(stats), run_id)
    known = house.known_visitors(batch.select("email").distinct())
    good = loaded.filter("status = 'LOADED'")
    return written(
        visitors.load_results(good, stats, errors, known), f"{scratch}/results"
    ).select("file_id", "visitors_inserted", "visitors_updated", "records_loaded")


def _archive_and_settle(spark, folder, house, dispositions, run_id) -> DataFrame:
    """Archive what was loaded, verify it by the registered checksums, settle every file's status."""
    loaded = dispositions.filter("status = 'LOADED'")
    contents = _of_files(lambda paths: landing.file_contents(spark, paths), folder, loaded)
    kept = house.write_run("archive", archive.archive_rows(loaded, contents, run_id), run_id)
    states = archive.verify_archive(loaded, kept).select("file_name", "archive_state")
    return control.file_disposition(dispositions.join(states, "file_name", "left"))


def _file_events(house, files: DataFrame, run_id: str, clock: _Clock) -> DataFrame:
    """The events of the run's files, each at the time its step was reached."""
    prepared = F.col("statistics_rows").isNotNull()
    loaded = F.col("archive_state").isNotNull()
    archived = F.col("archive_state") == "OK"
    steps = [
        ("detected", F.lit(True), {
            "status": F.lit("DETECTED"), "file_name": F.col("file_name"),
            "source_path": F.col("file_path"), "run_id": F.lit(run_id)}),
        ("staged", F.lit(True), {
            "status": F.lit("STAGED"), "file_size": F.col("size_bytes"),
            "source_modified_at": F.col("modified_at"),
            "checksum_sha256": F.col("checksum_sha256"), "staging_uri": F.col("file_path")}),
        ("validation_started", F.col("original_file_id").isNull(), {}),
        ("validation_finished", prepared, {
            "status": F.lit("PREPARED"),
            **{c: F.col(c) for c in ("records_read", "records_valid", "records_invalid")}}),
        ("load_started", prepared, {"status": F.lit("LOADING")}),
        ("load_finished", loaded, {
            "status": F.lit("LOADED"), "records_loaded": F.col("records_loaded"),
            "visitors_inserted": F.col("visitors_inserted"),
            "visitors_updated": F.col("visitors_updated")}),
        ("backed_up", archived, {
            "status": F.lit("BACKED_UP"), "backup_uri": F.lit(house.path("archive"))}),
        ("status", ~F.coalesce(archived, F.lit(False)), {
            "status": F.col("status"), "error_code": F.col("error_code"),
            "error_message": F.col("error_message")}),
    ]
    events = [
        control.event(
            control.FILE_EVENT_SCHEMA, condition, file_id=F.col("file_id"), seq=F.lit(seq),
            event=F.lit(name), at=clock.at(name), **given,
        )
        for seq, (name, condition, given) in enumerate(steps, start=1)
    ]
    return files.select(F.inline(F.array_compact(F.array(*events))))


def _record_run(house, run_id, dag_id, now, status=None, code=None, message=None) -> None:
    """Write the run's registration, and its end once it has a status."""
    columns = "run_id string, seq bigint, event string, dag_id string, status string, " \
        "error_code string, error_message string"
    rows = house.spark.createDataFrame(
        [
            (run_id, 1, "started", dag_id, "RUNNING", None, None),
            (run_id, 2, "finished", None, status, code, message),
        ][: 2 if status else 1],
        columns,
    )
    at = F.lit(now).cast("timestamp_ntz")
    finished = F.lit(datetime.now()).cast("timestamp_ntz")
    house.write_run(
        "run_events",
        rows.withColumn("at", F.when(F.col("event") == "started", at).otherwise(finished))
        .withColumn("execution_date", F.when(F.col("event") == "started", at)),
        run_id,
    )
