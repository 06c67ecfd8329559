"""Timestamps without a zone: parsing, month keys, durations.

Nothing here depends on the session time zone or on ``spark.sql.timestampType``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import two_digits

_LENIENT = r"^[0-9]{2}/[0-9]{2}/[0-9]{4} [0-9]{2}:[0-9]{2}\z"
_STRICT = (
    r"(?U)^([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})[\s\x1c-\x1f]+([0-9]{1,2}):([0-9]{1,2})\z"
)


def _build(year: Column, month: Column, day: Column, hour: Column, minute: Column) -> Column:
    parts = [p.try_cast("int") for p in (year, month, day, hour, minute)]
    return F.try_make_timestamp_ntz(*parts, F.lit(0).cast("decimal(16,6)"))


def _fixed_places(value: Column) -> Column:
    return _build(
        F.substring(value, 7, 4), F.substring(value, 4, 2), F.substring(value, 1, 2),
        F.substring(value, 12, 2), F.substring(value, 15, 2),
    )


def parse_lenient(trimmed: Column) -> Column:
    """dd/MM/yyyy HH:mm, two-digit parts only; null when it is no such time."""
    return F.when(trimmed.rlike(_LENIENT), _fixed_places(trimmed))


def parse_strict(stripped: Column) -> Column:
    """d/M/yyyy H:m with one or two digits and any white space between date and time.

    The usual two-digit form is cut at fixed places; only other forms use the groups.
    """
    day, month, year, hour, minute = (F.regexp_extract(stripped, _STRICT, n) for n in range(1, 6))
    return F.when(
        stripped.rlike(_LENIENT) & (F.substring(stripped, 7, 4) != "0000"),
        _fixed_places(stripped),
    ).when(
        stripped.rlike(_STRICT) & (year != "0000"), _build(year, month, day, hour, minute)
    )


def month_key(ts: Column) -> Column:
    """yyyy-MM."""
    return F.concat(F.lpad(F.year(ts).cast("string"), 4, "0"), F.lit("-"), two_digits(F.month(ts)))


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Whole seconds from start to end, null while either is missing."""
    gap = end - start
    return (
        F.extract(F.lit("DAY"), gap).cast("bigint") * 86400
        + F.extract(F.lit("HOUR"), gap).cast("bigint") * 3600
        + F.extract(F.lit("MINUTE"), gap).cast("bigint") * 60
        + F.extract(F.lit("SECOND"), gap).cast("bigint")
    )
