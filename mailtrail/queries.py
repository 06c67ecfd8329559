"""The registered queries: every operator over inputs derived from the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import feeds, layout
from .feeds import HISTORY_REFERENCE, REFERENCE, RUN_ID
from .functions import status, text
from .functions.rules import RuleProfile
from .operators import archive, checks, control, layout_gate, records, reports, visitors
from .plans import publish
from .plans.batch import run_batch
from .session import scratch_folder
from .sources import csv_reports, landing, lines
from .sources.lines import written

STRICT, LENIENT = RuleProfile.STRICT, RuleProfile.LENIENT
Query = Callable[[SparkSession, str], DataFrame]
KEY = ["source_file", "source_line"]


# --- shared inputs -----------------------------------------------------------------

def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.lines(spark, sf_dir).withColumn("file_id", F.col("file_no") + 1).drop("file_no")


def _validated(spark: SparkSession, sf_dir: str, profile: RuleProfile = STRICT) -> DataFrame:
    return records.validate(_lines(spark, sf_dir), RUN_ID, profile)


def _normalized(spark: SparkSession, sf_dir: str, profile: RuleProfile = STRICT) -> DataFrame:
    return records.normalize(
        records.parse_lines(_lines(spark, sf_dir), profile), RUN_ID, profile
    )


def _staged(spark: SparkSession, sf_dir: str, profile: RuleProfile = STRICT) -> DataFrame:
    """Validated records, written once: what follows scans only the columns it needs."""
    folder = scratch_folder(spark, "validated")
    return written(_validated(spark, sf_dir, profile), f"{folder}/records")


def _visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.visits(_validated(spark, sf_dir))


def _rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.rejects(_validated(spark, sf_dir))


def _history_and_batch(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All visits, those before the newest batch, and the newest batch."""
    staged = _staged(spark, sf_dir)
    newest = F.col("ts") >= F.lit(feeds.SPLIT_AT).cast("timestamp_ntz")
    parts = [staged, staged.filter(~newest), staged.filter(newest)]
    return tuple(records.visits(p) for p in parts)


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.file_control(spark, sf_dir)


def _runs(
    spark: SparkSession, sf_dir: str, registered: DataFrame | None = None
) -> DataFrame:
    """Registered runs with the counters and final status their files give them."""
    files = _files(spark, sf_dir)
    runs = feeds.registered_runs(spark, sf_dir) if registered is None else registered
    counted = control.update_runs(runs, control.run_outcomes(files))
    current = F.when(F.col("end_time").isNull(), "RUNNING").otherwise(F.col("final_status"))
    return counted.withColumn("status", current).drop("final_status")


# --- text, dates and rules over the report fields ------------------------------------

def norm_optional_text(spark, sf_dir):
    return _normalized(spark, sf_dir).select(*KEY, *layout.TEXT_FIELDS)


def norm_counters(spark, sf_dir):
    return _normalized(spark, sf_dir).select(
        *KEY, *[f"{c}_raw" for c in layout.COUNTER_FIELDS], *layout.COUNTER_FIELDS
    )


def norm_email(spark, sf_dir):
    return _normalized(spark, sf_dir).select(*KEY, "email")


def parse_dates(spark, sf_dir):
    strict = _normalized(spark, sf_dir)
    lenient = [
        LENIENT.parse_date(F.trim(f"{c}_given")).alias(f"{c}_lenient") for c in layout.DATE_FIELDS
    ]
    return strict.select(
        *KEY, *[f"{c}_raw" for c in layout.DATE_FIELDS], *layout.DATE_FIELDS, *lenient
    )


def record_fingerprint(spark, sf_dir):
    return _normalized(spark, sf_dir, LENIENT).select(*KEY, "record_id")


def email_rule_strict(spark, sf_dir):
    parsed = records.parse_lines(_lines(spark, sf_dir))
    return parsed.select(*KEY, STRICT.email_ok(text.strip(F.col("email"))).alias("email_ok"))


def email_rule_lenient(spark, sf_dir):
    parsed = records.parse_lines(_lines(spark, sf_dir), LENIENT)
    return parsed.select(*KEY, LENIENT.email_ok(F.lower(F.trim("email"))).alias("email_ok"))


def record_validation_strict(spark, sf_dir):
    return _validated(spark, sf_dir).select(
        *KEY, F.array_join("error_codes", ",").alias("error_code"), "is_valid"
    )


def record_validation_lenient(spark, sf_dir):
    return _validated(spark, sf_dir, LENIENT).select(
        *KEY, F.array_join("error_codes", ",").alias("error_code"), "is_valid"
    )


def error_descriptions(spark, sf_dir):
    return _validated(spark, sf_dir).select(*KEY, "error_description")


# --- visits, rejects, visitors ---------------------------------------------------------

def estadistica(spark, sf_dir):
    return _visits(spark, sf_dir)


def estadistica_lenient(spark, sf_dir):
    return records.visits(_validated(spark, sf_dir, LENIENT))


def errores(spark, sf_dir):
    return _rejects(spark, sf_dir)


def errores_lenient(spark, sf_dir):
    rejected = records.lenient_rejects(_validated(spark, sf_dir, LENIENT), REFERENCE)
    return rejected.withColumn("error_codes", F.array_join("error_codes", ","))


def visitors_rebuild(spark, sf_dir):
    return visitors.visitors(_visits(spark, sf_dir), REFERENCE)


def visitors_from_activity(spark, sf_dir):
    _, history, batch = _history_and_batch(spark, sf_dir)
    activity = visitors.monthly_activity(history).unionByName(visitors.monthly_activity(batch))
    return visitors.visitors_from_activity(activity, REFERENCE)


def affected_emails(spark, sf_dir):
    return visitors.affected_emails(_visits(spark, sf_dir), "source_file")


def visitors_incremental(spark, sf_dir):
    everything, _, batch = _history_and_batch(spark, sf_dir)
    return visitors.visitors_of(visitors.affected_emails(batch), everything, REFERENCE)


def visitors_merged(spark, sf_dir):
    everything, history, batch = _history_and_batch(spark, sf_dir)
    recomputed = visitors.visitors_of(visitors.affected_emails(batch), everything, REFERENCE)
    return visitors.merge_visitors(visitors.visitors(history, HISTORY_REFERENCE), recomputed)


def visitor_upsert_counts(spark, sf_dir):
    validated = _staged(spark, sf_dir)
    snapshot = records.visits(validated).filter("fecha_envio < TIMESTAMP_NTZ '2023-01-01 00:00:00'")
    return visitors.load_results(
        records.file_metrics(validated, "file_id"),
        records.visits(validated), records.rejects(validated),
        visitors.visitors(snapshot, HISTORY_REFERENCE),
    )


def error_distribution(spark, sf_dir):
    return records.error_distribution(_rejects(spark, sf_dir))


def reject_detail(spark, sf_dir):
    return reports.reject_detail(_rejects(spark, sf_dir))


def batch_reconciliation(spark, sf_dir):
    return records.batch_reconciliation(_validated(spark, sf_dir))


def file_metrics(spark, sf_dir):
    return records.file_metrics(_validated(spark, sf_dir))


def load_reconciliation(spark, sf_dir):
    """The tables miss what one platform sent and one kind of reject: both must show up."""
    validated = _staged(spark, sf_dir)
    kept_visits = records.visits(validated).filter("coalesce(plataformas, '') <> 'Android'")
    kept_rejects = records.rejects(validated).filter("error_code <> 'INVALID_INTEGER'")
    return checks.load_reconciliation(
        records.file_metrics(validated, "file_id"), kept_visits, kept_rejects
    )


# --- layout, disposition, control -------------------------------------------------------

def file_layout_validation(spark, sf_dir):
    return layout_gate.validate_layout(feeds.headers(spark, sf_dir)).drop("file_no")


def header_differences(spark, sf_dir):
    return layout_gate.list_header_differences(
        feeds.headers(spark, sf_dir).filter("header_line IS NOT NULL")
    )


def already_processed_lookup(spark, sf_dir):
    files = _files(spark, sf_dir)
    found = control.already_processed(
        files.select("file_id", "checksum_sha256"), files, layout.LOADED_STATUSES
    )
    return found


def _incoming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files detected after the split date, checked against those before."""
    files = _files(spark, sf_dir)
    late = F.col("detected_at") >= F.lit(feeds.FILE_SPLIT).cast("timestamp_ntz")
    fresh = files.filter(late).select(
        "file_id", "file_name", "checksum_sha256", "records_read", "records_valid",
        "records_invalid", F.col("records_valid").alias("statistics_rows"),
        F.col("records_invalid").alias("errors_rows"),
        F.expr("CASE file_id % 29 WHEN 3 THEN 'MISSING' WHEN 4 THEN 'SIZE_MISMATCH' ELSE 'OK' END")
        .alias("staging_state"),
        F.expr("CASE WHEN status = 'REJECTED_LAYOUT' THEN error_code END").alias("layout_code"),
        F.expr("CASE WHEN status = 'REJECTED_LAYOUT' THEN error_message END").alias(
            "layout_message"
        ),
        F.expr("file_id % 31 <> 6").alias("utf8_ok"),
        F.expr("CASE file_id % 23 WHEN 5 THEN 'CHECKSUM_MISMATCH' ELSE 'OK' END").alias(
            "archive_state"
        ),
        F.expr("CASE file_id % 7 WHEN 1 THEN false WHEN 2 THEN NULL ELSE true END").alias(
            "source_deleted"
        ),
    )
    return control.batch_duplicates(control.already_processed(fresh, files.filter(~late)))


def file_disposition(spark, sf_dir):
    return control.file_disposition(_incoming(spark, sf_dir)).select(
        "file_id", "file_name", "status", "error_code", "error_message"
    )


def loadable_records(spark, sf_dir):
    """Lines of the report files whose derived layout lets them in."""
    arrived = _lines(spark, sf_dir)
    gate = arrived.select("source_file", "file_id").distinct().select(
        F.col("source_file").alias("file_name"),
        F.expr(
            "CASE file_id % 11 WHEN 3 THEN 'REJECTED_LAYOUT' WHEN 6 THEN 'SKIPPED_ALREADY_PROCESSED'"
            " WHEN 8 THEN 'FAILED' WHEN 9 THEN 'LOADED' ELSE 'PREPARED' END"
        ).alias("status"),
    )
    return control.loadable(arrived.select(*KEY, "raw_record"), gate)


def file_state_fold(spark, sf_dir):
    return _told_state(control.fold_files(feeds.file_events(spark, sf_dir)))


def _told_state(state: DataFrame) -> DataFrame:
    unset = ["staging_uri", "visitors_inserted", "visitors_updated", "validation_started_at",
             "validation_finished_at", "load_started_at", "source_modified_at", "created_at"]
    return state.drop(*unset)


def run_state_fold(spark, sf_dir):
    return control.fold_runs(feeds.run_events(spark, sf_dir)).drop("created_at", "updated_at")


def run_metrics(spark, sf_dir):
    """Runs come with older counters, which those without files keep."""
    older = {c: F.length("run_id").cast("bigint") + i for i, c in enumerate(control.RUN_COUNTERS)}
    runs = feeds.registered_runs(spark, sf_dir).withColumns(older)
    return control.update_runs(runs, control.run_metrics(_files(spark, sf_dir)))


def run_counters_merged(spark, sf_dir):
    """Each run's counters as it left them, and what was settled of its files since."""
    files = _files(spark, sf_dir)
    late = F.expr("status = 'SUCCESS' AND file_id % 2 = 0")
    first = files.withColumn("status", F.when(late, "BACKED_UP").otherwise(F.col("status")))
    changes = files.filter(late).select(
        F.col("file_id").alias("open_file_id"), F.col("run_id").alias("open_run_id"), F.lit("gone").alias("change")
    )
    own = control.run_metrics(first).withColumnRenamed("run_id", "of_run")
    return control.merged_counters(own.unionByName(control.settled_counters(changes)))


def load_verdicts(spark, sf_dir):
    """Visits lose what one platform sent, rejects are there twice, and links are too long for a width."""
    validated = _staged(spark, sf_dir)
    visits = records.visits(validated).filter("coalesce(plataformas, '') <> 'Android'")
    rejects = records.rejects(validated)
    tables = {
        "estadistica": visits.withColumn("baja", F.coalesce("links", "baja")),
        "errores": rejects.unionByName(rejects.filter("error_code = 'INVALID_INTEGER'")),
    }
    return checks.load_verdicts(records.file_metrics(validated, "file_id"), tables)


def run_final_status(spark, sf_dir):
    return control.final_status(feeds.registered_runs(spark, sf_dir), _files(spark, sf_dir))


def purge_candidates(spark, sf_dir):
    files = _files(spark, sf_dir)
    archive = files.select(
        "file_id",
        F.expr(
            "CASE file_id % 13 WHEN 2 THEN 'CHECKSUM_MISMATCH' WHEN 3 THEN 'MISSING' ELSE 'OK' END"
        ).alias("archive_state"),
    )
    return control.purge_candidates(files, archive)


def listing_changes(spark, sf_dir):
    return control.listing_changes(*feeds.folder_listings(spark, sf_dir)).select("file_path", "change")


def deletion_settlement(spark, sf_dir):
    """Settles files of the listed folder only: those that are gone or have new contents."""
    changes = control.listing_changes(*feeds.folder_listings(spark, sf_dir))
    at = F.lit(REFERENCE).cast("timestamp_ntz")
    events = control.deletion_events(control.settled_deletions(changes), 20, at)
    return events.select("file_id", "seq", "event", "at", "status")


def file_state_checkpoint(spark, sf_dir):
    """The fold of half of the files up to a step, taken on by all later events."""
    events = feeds.file_events(spark, sf_dir)
    later = F.expr("file_id % 2 = 1 OR seq >= 9")
    state = control.updated_files(
        control.partial_files(events.filter(~later)), control.partial_files(events.filter(later))
    )
    return _told_state(control.finished_files(state))


def run_report_files(spark, sf_dir):
    """The files of the run with the greatest id, as the report by run shows them."""
    return reports.run_files(_files(spark, sf_dir), feeds.newest_run(spark, sf_dir))


def run_report_statuses(spark, sf_dir):
    return reports.file_statuses(_files(spark, sf_dir), feeds.newest_run(spark, sf_dir))


def run_report_summary(spark, sf_dir):
    return reports.run_summary(_runs(spark, sf_dir), feeds.newest_run(spark, sf_dir))


def run_report_acceptance(spark, sf_dir):
    return reports.run_acceptance(_runs(spark, sf_dir), feeds.newest_run(spark, sf_dir))


def run_report_alerts(spark, sf_dir):
    return reports.run_alerts(_files(spark, sf_dir), feeds.newest_run(spark, sf_dir))


# --- integrity ----------------------------------------------------------------------------

def duplicate_key_check(spark, sf_dir):
    lineitem = feeds.table(spark, sf_dir, "lineitem")
    return checks.duplicate_keys(lineitem, "l_orderkey", "l_linenumber")


def append_without_duplicates(spark, sf_dir):
    lineitem = feeds.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate"
    )
    late = F.col("l_shipdate") >= F.lit("2000-06-01").cast("timestamp_ntz")
    return checks.appendable(
        lineitem.filter(~late), lineitem.filter(late), "l_orderkey", "l_linenumber"
    )


def orphan_check(spark, sf_dir):
    """Every event's user id, times twenty, is to be a known customer."""
    visits = feeds.table(spark, sf_dir, "events").select(
        (F.col("user_id") * 20).alias("customer_id")
    )
    customers = feeds.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id")
    )
    return checks.orphans(visits, customers, "customer_id")


def constraint_violations(spark, sf_dir):
    """Rejects made of whole documents: text as description, source as code."""
    documents = feeds.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("file_id"), F.lit(2).alias("line_number"),
        F.lit(RUN_ID).alias("run_id"),
        F.when(F.col("lang") != "fr", F.col("source")).alias("file_name"),
        F.col("lang").alias("email"), F.col("source").alias("error_code"),
        F.col("text").alias("error_description"), F.col("text").alias("raw_record"),
    )
    return checks.table_violations(documents, "errores")


def reconcile_files(spark, sf_dir):
    return checks.unreconciled_files(_files(spark, sf_dir))


def reconcile_loads(spark, sf_dir):
    return checks.unreconciled_loads(_files(spark, sf_dir))


def success_without_backup(spark, sf_dir):
    return checks.success_without_backup(_files(spark, sf_dir))


def unsafe_deletions(spark, sf_dir):
    return checks.unsafe_deletions(_files(spark, sf_dir))


def success_contract(spark, sf_dir):
    return checks.broken_success(_files(spark, sf_dir))


# --- reports --------------------------------------------------------------------------------

def run_operational_summary(spark, sf_dir):
    """Errors and times of a run are what its events fold to."""
    folded = control.fold_runs(feeds.run_events(spark, sf_dir)).drop("status")
    return reports.run_operational_summary(_runs(spark, sf_dir, folded))


def file_operational_detail(spark, sf_dir):
    return reports.file_operational_detail(
        _files(spark, sf_dir), feeds.registered_runs(spark, sf_dir)
    )


def monthly_summary(spark, sf_dir):
    return reports.monthly_summary(_runs(spark, sf_dir))


def monthly_report(spark, sf_dir):
    return reports.monthly_report(_runs(spark, sf_dir))


def latest_runs(spark, sf_dir):
    return reports.latest_runs(_runs(spark, sf_dir))


def files_of_run(spark, sf_dir):
    return reports.run_files(_files(spark, sf_dir))


def file_statuses(spark, sf_dir):
    return reports.file_statuses(_files(spark, sf_dir))


def failed_files(spark, sf_dir):
    return reports.failed_files(_files(spark, sf_dir))


def rejected_files(spark, sf_dir):
    return reports.rejected_files(_files(spark, sf_dir))


def run_summary(spark, sf_dir):
    return reports.run_summary(_runs(spark, sf_dir))


def run_acceptance(spark, sf_dir):
    return reports.run_acceptance(_runs(spark, sf_dir))


def classify_incidents(spark, sf_dir):
    return reports.classified_files(_files(spark, sf_dir)).drop("file_name", "error_message")


def run_alerts(spark, sf_dir):
    return reports.run_alerts(_files(spark, sf_dir))


def alert_messages(spark, sf_dir):
    return reports.alert_messages(_files(spark, sf_dir))


# --- report files: derived, written as text, read back ------------------------------------------

def file_manifest(spark, sf_dir):
    manifest = landing.file_manifest(spark, feeds.write_landing(spark, sf_dir))
    return manifest.select("file_name", "size_bytes")


def candidate_files(spark, sf_dir):
    manifest = landing.file_manifest(spark, feeds.write_landing(spark, sf_dir))
    return landing.candidate_files(manifest).select("file_name", "size_bytes")


def landing_glob_check(spark, sf_dir):
    return landing.matched_files(spark, feeds.write_landing(spark, sf_dir)).select("file_name")


def file_checksums(spark, sf_dir):
    folder = feeds.write_landing(spark, sf_dir)
    return landing.file_checksums(
        landing.file_manifest(spark, folder), landing.file_contents(spark, folder)
    )


def scan_csv_reports(spark, sf_dir):
    return csv_reports.scan_csv(spark, feeds.write_landing(spark, sf_dir))


def scan_lines_numbered(spark, sf_dir):
    return lines.numbered_lines(spark, feeds.write_landing(spark, sf_dir))


def staging_size_check(spark, sf_dir):
    """Sizes as advertised, some wrong and some for files that never came."""
    staged = landing.file_manifest(spark, feeds.write_landing(spark, sf_dir))
    sized = feeds.landing_lines(spark, sf_dir).groupBy("file_name").agg(
        F.sum(F.octet_length("raw_record") + 1).alias("bytes")
    )
    advertised = sized.select(
        F.when(F.col("bytes") % 7 == 0, F.concat("file_name", F.lit(".gone")))
        .otherwise(F.col("file_name")).alias("file_name"),
        F.when(F.col("bytes") % 5 == 0, F.col("bytes") + 1).otherwise(F.col("bytes"))
        .alias("size_bytes"),
    )
    return landing.staging_check(advertised, staged)


def archive_verification(spark, sf_dir):
    """An archive that lost, emptied, changed and doubled some of its members."""
    folder = feeds.write_landing(spark, sf_dir)
    manifest, contents = landing.file_manifest(spark, folder), landing.file_contents(spark, folder)
    path = f"{scratch_folder(spark, 'archive')}/members"
    kept = written(archive.archive_rows(manifest, contents, RUN_ID), path)
    size = F.octet_length("content")
    damaged = kept.filter((size == 0) | (size % 7 != 0)).withColumn(
        "content",
        F.when((size > 0) & (size % 5 == 0), F.lit(b""))
        .when((size > 0) & (size % 5 == 1), F.concat("content", F.lit(b"x")))
        .otherwise(F.col("content")),
    )
    copies = F.when(F.octet_length("content") % 5 == 3, F.array(F.lit(1), F.lit(2))).otherwise(
        F.array(F.lit(1))
    )
    members = damaged.withColumn("copy", F.explode(copies)).drop("copy")
    verified = archive.verify_archive(landing.file_checksums(manifest, contents), members)
    return verified.withColumn(
        "archive_name", status.archive_name(F.col("file_name"), F.lit(RUN_ID))
    )


def roundtrip_estadistica(spark, sf_dir):
    path = f"{scratch_folder(spark, 'tables')}/estadistica"
    publish.write_visits(_visits(spark, sf_dir), path)
    return spark.read.parquet(path)


def roundtrip_errores(spark, sf_dir):
    path = f"{scratch_folder(spark, 'tables')}/errores"
    publish.write_table(_rejects(spark, sf_dir), path)
    return spark.read.parquet(path)


def roundtrip_visitante(spark, sf_dir):
    path = f"{scratch_folder(spark, 'tables')}/visitante"
    publish.write_table(visitors.visitors(_visits(spark, sf_dir), REFERENCE), path)
    return spark.read.parquet(path)


# --- whole runs: late, repeated, compacted ---------------------------------------------------------

def _rerun_house(spark: SparkSession, sf_dir: str) -> publish.Warehouse:
    """Odd reports are loaded and compacted; even ones come late, under an earlier time, and again."""
    even, odd = feeds.write_report_folders(spark, sf_dir)
    house = publish.Warehouse(spark, scratch_folder(spark, "warehouse"))
    run_batch(spark, odd, house.root, REFERENCE, "run_odd", datetime(2024, 1, 31, 6, 30))
    house.compact()
    for _ in range(2):
        run_batch(spark, even, house.root, HISTORY_REFERENCE, "run_even", datetime(2024, 1, 31, 6, 5))
    return house


def batch_rerun_visits(spark, sf_dir):
    return _rerun_house(spark, sf_dir).table("estadistica").drop("record_id", "file_id")


def batch_rerun_visitors(spark, sf_dir):
    return _rerun_house(spark, sf_dir).visitors()


def batch_rerun_files(spark, sf_dir):
    """What the runs tell of each file: its id, its records, and the visitors it brought."""
    return _rerun_house(spark, sf_dir).files().select(
        "file_id", "run_id", "file_name", "status", *control.RECORD_COUNTERS, "visitors_inserted",
        "visitors_updated", "retry_count",
    )


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        norm_optional_text, norm_counters, norm_email, parse_dates, record_fingerprint,
        email_rule_strict, email_rule_lenient, record_validation_strict,
        record_validation_lenient, error_descriptions, estadistica, estadistica_lenient, errores,
        errores_lenient, visitors_rebuild, visitors_from_activity, affected_emails,
        visitors_incremental, visitors_merged, visitor_upsert_counts, error_distribution,
        reject_detail, batch_reconciliation, file_metrics, load_reconciliation,
        file_layout_validation, header_differences, already_processed_lookup, file_disposition,
        loadable_records, file_state_fold, run_state_fold, run_metrics, run_final_status,
        purge_candidates, deletion_settlement, run_report_files, run_report_statuses,
        run_report_summary, run_report_acceptance, run_report_alerts, duplicate_key_check, append_without_duplicates, orphan_check,
        constraint_violations, reconcile_files, reconcile_loads, success_without_backup,
        unsafe_deletions, success_contract, run_operational_summary, file_operational_detail,
        monthly_summary, monthly_report, latest_runs, files_of_run, file_statuses, failed_files,
        rejected_files, run_summary, run_acceptance, classify_incidents, run_alerts,
        alert_messages, file_manifest, candidate_files, landing_glob_check, file_checksums,
        scan_csv_reports, scan_lines_numbered, staging_size_check, archive_verification,
        roundtrip_estadistica, roundtrip_errores, roundtrip_visitante, listing_changes, run_counters_merged, load_verdicts,
        file_state_checkpoint, batch_rerun_visits, batch_rerun_visitors, batch_rerun_files,
    )
}
