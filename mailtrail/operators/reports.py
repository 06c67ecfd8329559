"""Operational reports over run and file control."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import layout
from ..functions import dates, status
from .control import RUN_COUNTERS

_ISSUE = ["error_code", "error_message"]
# Columns that the views show where the control rows bring them.
_RUN_EXTRAS = [*_ISSUE, "created_at", "updated_at"]


def _of_run(frame: DataFrame, run_id: str | None) -> DataFrame:
    return frame if run_id is None else frame.filter(F.col("run_id") == run_id)


def run_operational_summary(runs: DataFrame) -> DataFrame:
    """Per run: counters, duration and the two percentages."""
    return runs.select(
        "run_id", "dag_id", "execution_date", "start_time", "end_time", "status", *RUN_COUNTERS,
        dates.elapsed_seconds(F.col("start_time"), F.col("end_time")).alias("duration_seconds"),
        status.percentage(F.col("files_success"), F.col("files_detected")).alias(
            "file_success_percentage"
        ),
        status.percentage(F.col("records_invalid"), F.col("records_read")).alias(
            "invalid_record_percentage"
        ),
        *[c for c in _RUN_EXTRAS if c in runs.columns],
    )


def file_operational_detail(files: DataFrame, runs: DataFrame) -> DataFrame:
    """Per file of a known run: all its columns, the run's dag and the category."""
    return files.join(runs.select("run_id", "dag_id"), "run_id").select(
        *files.columns, "dag_id",
        status.operational_category(F.col("status")).alias("operational_category"),
    )


def monthly_summary(runs: DataFrame) -> DataFrame:
    """Runs, counters and outcomes per month of execution."""
    outcomes = {
        "successful_runs": "SUCCESS",
        "partial_success_runs": "PARTIAL_SUCCESS",
        "failed_runs": "FAILED",
    }
    return runs.groupBy(dates.month_key(F.col("execution_date")).alias("processing_month")).agg(
        F.count(F.lit(1)).alias("total_runs"),
        *[F.sum(c).cast("bigint").alias(c) for c in RUN_COUNTERS],
        *[F.count_if(F.col("status") == s).alias(name) for name, s in outcomes.items()],
    )


# Column names of the business report, in order.
_MONTHLY_REPORT = {
    "processing_month": "periodo",
    "total_runs": "ejecuciones",
    "files_detected": "archivos_detectados",
    "files_processed": "archivos_procesados",
    "files_success": "archivos_exitosos",
    "files_rejected": "archivos_rechazados",
    "files_failed": "archivos_fallidos",
    "records_read": "registros_leidos",
    "records_valid": "registros_validos",
    "records_invalid": "registros_invalidos",
    "records_loaded": "registros_cargados",
}


def monthly_report(runs: DataFrame) -> DataFrame:
    """The monthly summary under its business names, in order of the month."""
    return (
        monthly_summary(runs)
        .select(*[F.col(c).alias(name) for c, name in _MONTHLY_REPORT.items()])
        .orderBy("periodo")
    )


def latest_runs(runs: DataFrame, limit: int = 20) -> DataFrame:
    """The newest runs by start time."""
    shown = [
        "run_id", "dag_id", "execution_date", "start_time", "end_time", "status", *RUN_COUNTERS,
        *[c for c in _ISSUE if c in runs.columns],
    ]
    return runs.select(*shown).orderBy(F.desc("start_time"), "run_id").limit(limit)


def run_files(files: DataFrame, run_id: str | None = None) -> DataFrame:
    """The files of a run, or of all runs, by file id."""
    return _of_run(files, run_id).select(
        "run_id", "file_id", "file_name", "status", "records_read", "records_valid",
        "records_invalid", "records_loaded", "backup_uri", "backup_at", "source_deleted_at", *_ISSUE,
    ).orderBy("run_id", "file_id")


def file_statuses(files: DataFrame, run_id: str | None = None) -> DataFrame:
    return _of_run(files, run_id).select("run_id", "file_id", "status").orderBy("run_id", "file_id")


def _newest_with_status(files: DataFrame, wanted: str) -> DataFrame:
    return (
        files.filter(F.col("status") == wanted)
        .select("file_id", "run_id", "file_name", "status", *_ISSUE, "updated_at")
        .orderBy(F.desc("updated_at"), "file_id")
    )


def failed_files(files: DataFrame) -> DataFrame:
    return _newest_with_status(files, "FAILED")


def rejected_files(files: DataFrame) -> DataFrame:
    return _newest_with_status(files, "REJECTED_LAYOUT")


def reject_detail(rejected: DataFrame) -> DataFrame:
    """Rejected records, newest file and line first."""
    return rejected.select(
        "file_id", "run_id", "file_name", "line_number", "email", "error_code",
        "error_description", "raw_record",
    ).orderBy(F.desc("file_id"), F.desc("line_number"))


def run_summary(runs: DataFrame, run_id: str | None = None) -> DataFrame:
    """Summary of one run (an error when it is unknown) or of all runs."""
    rows = _of_run(runs, run_id).select(
        "run_id", "dag_id", "status", *RUN_COUNTERS, "start_time", "end_time"
    )
    if run_id is not None and rows.isEmpty():
        raise LookupError(f"Run not found. run_id={run_id}")
    return rows


def run_acceptance(runs: DataFrame, run_id: str | None = None) -> DataFrame:
    """(run_id, status, accepted): whether downstream work may start."""
    return _of_run(runs, run_id).select(
        "run_id", "status", F.col("status").isin(layout.ACCEPTED_RUN_STATUSES).alias("accepted")
    )


def classified_files(files: DataFrame) -> DataFrame:
    """Files with incident severity and category."""
    state, code = F.col("status"), F.col("error_code")
    return files.select(
        "run_id", "file_id", "file_name", "status",
        status.incident_severity(state, code).alias("severity"),
        status.incident_category(state, code).alias("category"),
        *_ISSUE,
    )


def run_alerts(files: DataFrame, run_id: str | None = None) -> DataFrame:
    """Everything above INFO, by file id."""
    return (
        classified_files(_of_run(files, run_id))
        .filter("severity <> 'INFO'")
        .orderBy("run_id", "file_id")
    )


def alert_messages(files: DataFrame, run_id: str | None = None) -> DataFrame:
    """One alert line per alert."""
    alerts = run_alerts(files, run_id)
    names = ["run_id", "file_name", "status", "severity", "category", "error_code", "error_message"]
    return alerts.select(
        "file_id", "severity", status.alert_text(**{n: F.col(n) for n in names}).alias("message")
    )


def report_views(files: DataFrame, runs: DataFrame) -> dict[str, DataFrame]:
    """The three reporting views by name; register them with createOrReplaceTempView."""
    return {
        "run_operational_summary": run_operational_summary(runs),
        "file_operational_detail": file_operational_detail(files, runs),
        "monthly_summary": monthly_summary(runs),
    }
