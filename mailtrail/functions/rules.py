"""The two rule profiles for records, as Column expressions."""

from __future__ import annotations

from enum import Enum

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import layout
from . import dates, text

# Labels used in error descriptions, in reporting order.
_LABELS = {
    "email": "email",
    "fecha_envio": "Fecha envio",
    "fecha_open": "Fecha open",
    "fecha_click": "Fecha click",
    "opens": "opens",
    "opens_virales": "opens_virales",
    "clicks": "clicks",
    "clicks_virales": "clicks_virales",
}


class RuleProfile(str, Enum):
    """STRICT: line-level rules with a layout gate. LENIENT: the permissive CSV rules."""

    STRICT = "strict"
    LENIENT = "lenient"

    @property
    def strict(self) -> bool:
        return self is RuleProfile.STRICT

    def trim(self, value: Column) -> Column:
        return text.strip(value) if self.strict else F.trim(value)

    def email_ok(self, trimmed: Column) -> Column:
        """Never null."""
        pattern = layout.EMAIL_STRICT if self.strict else layout.EMAIL_LENIENT
        return F.coalesce(trimmed.rlike(pattern), F.lit(False))

    def parse_date(self, trimmed: Column) -> Column:
        return dates.parse_strict(trimmed) if self.strict else dates.parse_lenient(trimmed)

    def parse_counter(self, defaulted: Column) -> Column:
        """BIGINT, or null when the text is no counter or does not fit."""
        pattern = r"^(?:\+?[0-9]+|-0+)\z" if self.strict else r"^[0-9]+\z"
        return F.when(defaulted.rlike(pattern), defaulted.try_cast("bigint"))


def required_date_ok(parsed: Column) -> Column:
    return parsed.isNotNull()


def optional_date_ok(trimmed: Column, parsed: Column) -> Column:
    return text.is_blank_mark(trimmed) | parsed.isNotNull()


def error_codes(profile: RuleProfile, bad: dict[str, Column]) -> Column:
    """All codes of a record in reporting order; ``bad`` maps a field to its failure flag."""
    checks = [F.when(bad["email"], F.lit("INVALID_EMAIL"))]
    for name in layout.DATE_FIELDS:
        code = "INVALID_DATE_VALUE" if profile.strict else f"INVALID_{name.upper()}"
        checks.append(F.when(bad[name], F.lit(code)))
    counters = [bad[name] for name in layout.COUNTER_FIELDS]
    if profile.strict:
        checks += [F.when(flag, F.lit("INVALID_INTEGER")) for flag in counters]
    else:
        any_bad = counters[0] | counters[1] | counters[2] | counters[3]
        checks.append(F.when(any_bad, F.lit("INVALID_INTEGER")))
    return F.array_compact(F.array(*checks))


def error_description(bad: dict[str, Column], given: dict[str, Column]) -> Column:
    """One message per failed field, with the value as it came, joined by '; '."""
    messages = [
        F.when(
            bad[name],
            F.concat(F.lit(f"Invalid {label}: '"), F.coalesce(given[name], F.lit("")), F.lit("'")),
        )
        for name, label in _LABELS.items()
    ]
    return F.concat_ws("; ", *messages)


def fingerprint(*parts: Column) -> Column:
    """sha256 over the parts joined by '||', nulls as ''."""
    return F.sha2(F.concat_ws("||", *[F.coalesce(p, F.lit("")) for p in parts]), 256)
