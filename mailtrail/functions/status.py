"""Operational classification, percentages and message texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import layout


def percentage(part: Column, whole: Column) -> Column:
    """100 * part / whole to two decimals, exact half-up on integers; 0 without a whole."""
    numerator = part * F.lit(20000) + whole
    hundredths = F.call_function("div", numerator, whole * 2)
    return F.when(whole > 0, hundredths / F.lit(100.0)).otherwise(F.lit(0.0))


def operational_category(status: Column) -> Column:
    return (
        F.when(status == "SUCCESS", "OK")
        .when(status == "REJECTED_LAYOUT", "DATA_QUALITY")
        .when(status == "SKIPPED_ALREADY_PROCESSED", "IDEMPOTENCY")
        .when(status.isin(layout.PENDING_STATUSES), "OPERATIONAL_ACTION_REQUIRED")
        .when(status == "FAILED", "TECHNICAL_FAILURE")
        .otherwise("IN_PROGRESS")
    )


# Ordered incident rules (statuses, severity, category).
def _incidents(status: Column, code: Column) -> list[tuple[Column, str, str]]:
    """What holds for a file first gives its severity and category."""
    return [
        (status == "SUCCESS", "INFO", "NONE"),
        (status == "SKIPPED_ALREADY_PROCESSED", "INFO", "IDEMPOTENCY"),
        (status == "REJECTED_LAYOUT", "WARNING", "DATA_QUALITY"),
        (status.isin(layout.PENDING_STATUSES), "ERROR", "OPERATIONAL"),
        (code == "RECONCILIATION_ERROR", "CRITICAL", "INTEGRITY"),
        (status == "FAILED", "ERROR", "TECHNICAL"),
        (F.lit(True), "WARNING", "TECHNICAL"),
    ]


def incident_severity(status: Column, error_code: Column) -> Column:
    chain = F
    for holds, severity, _ in _incidents(status, error_code):
        chain = chain.when(holds, F.lit(severity))
    return chain


def incident_category(status: Column, error_code: Column) -> Column:
    chain = F
    for holds, _, category in _incidents(status, error_code):
        chain = chain.when(holds, F.lit(category))
    return chain


# The names in an alert line, in order.
_ALERT_PARTS = [
    "run_id", "file_name", "status", "severity", "category", "error_code", "error_message",
]


def alert_text(**values: Column) -> Column:
    """'ETL_ALERT run_id=... file_name=... ...'; a null value reads 'None'."""
    pieces = [F.lit("ETL_ALERT")]
    for name in _ALERT_PARTS:
        pieces.append(
            F.concat(F.lit(f"{name}="), F.coalesce(values[name].cast("string"), F.lit("None")))
        )
    return F.concat_ws(" ", *pieces)


def archive_name(file_name: Column, run_id: Column) -> Column:
    """<stem>_<run_id>.zip"""
    return F.concat(F.regexp_replace(file_name, r"(?<=.)\.[^.]*$", ""), F.lit("_"), run_id, F.lit(".zip"))
