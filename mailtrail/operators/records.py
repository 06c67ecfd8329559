"""Parse, normalise and validate visit records; split them into visits and rejects."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import layout
from ..functions import rules, text
from ..functions.rules import RuleProfile
from ..sources.csv_reports import CSV_OPTIONS, SOURCE_SCHEMA

LINEAGE = ["source_file", "source_line", "raw_record"]


def _lineage(frame: DataFrame) -> list[str]:
    return [c for c in frame.columns if c not in layout.FIELD_NAMES]


def _fenced(frame: DataFrame, keep: list[str], computed: list[Column]) -> DataFrame:
    """Add computed columns that the optimizer takes as given from here on.

    They pass through a one-row generator. Later projections and filters then refer to them
    instead of being merged with them, which would copy the parse of a line into every
    place that looks at one of its fields.
    """
    staged = frame.select(*keep, F.struct(*computed).alias("_computed"))
    return staged.select(*keep, F.inline(F.array("_computed")))


def is_blank() -> Column:
    """Whether a line holds nothing but control characters and spaces."""
    return F.btrim("raw_record", F.lit("".join(map(chr, range(33))))) == ""


def parse_lines(lines: DataFrame, profile: RuleProfile = RuleProfile.STRICT) -> DataFrame:
    """raw_record -> the 15 source fields as text, plus column_count.

    STRICT counts the fields of each line and leaves a blank line as 0 columns. LENIENT
    behaves like the permissive CSV scan: blank lines vanish, short rows are padded with
    null, extra fields are ignored. Lines that bring ``is_blank`` keep their blanks, for a
    caller who still has to count them.
    """
    keep = lines.columns
    if profile.strict:
        split = lines.select(*keep, text.split_fields(F.col("raw_record")).alias("_fields"))
        fields = [F.get("_fields", F.lit(i)).alias(n) for i, n in enumerate(layout.FIELD_NAMES)]
        return _fenced(split, keep, [F.size("_fields").alias("column_count"), *fields])
    parsed = _fenced(
        lines, keep,
        [
            is_blank().alias("_blank"),
            F.from_csv("raw_record", SOURCE_SCHEMA, CSV_OPTIONS).alias("_row"),
        ],
    )
    wanted = parsed if "is_blank" in keep else parsed.filter("NOT _blank")
    return wanted.select(
        *keep,
        F.lit(layout.REPORT_WIDTH).alias("column_count"),
        *[
            F.col("_row").getField(source).alias(name)
            for source, name in zip(layout.REPORT_COLUMNS, layout.FIELD_NAMES)
        ],
    )


def normalize(
    parsed: DataFrame, run_id: str, profile: RuleProfile = RuleProfile.STRICT
) -> DataFrame:
    """Typed columns under the field names; trimmed source text beside them as ``*_raw``.

    ``*_given`` keeps the untrimmed text for error descriptions and is dropped later.
    """
    checked = ["email", *layout.DATE_FIELDS, *layout.COUNTER_FIELDS]
    lineage = _lineage(parsed)
    trimmed = parsed.select(
        *lineage,
        *[F.col(n).alias(f"{n}_given") for n in checked],
        *[profile.trim(F.col(n)).alias(f"{n}_raw") for n in ("email", *layout.DATE_FIELDS)],
        *[
            text.counter_text(profile.trim(F.col(n))).alias(f"{n}_raw")
            for n in layout.COUNTER_FIELDS
        ],
        *[profile.trim(F.col(n)).alias(n) for n in layout.TEXT_FIELDS],
    )
    return trimmed.select(
        F.lit(run_id).alias("run_id"),
        rules.fingerprint(
            F.col("source_file"), F.col("email_raw"),
            *[F.col(f"{n}_raw") for n in layout.DATE_FIELDS],
        ).alias("record_id"),
        *lineage,
        *[f"{n}_given" for n in checked],
        *[f"{n}_raw" for n in checked],
        F.lower("email_raw").alias("email"),
        *[text.optional_text(F.col(n)).alias(n) for n in layout.TEXT_FIELDS],
        *[profile.parse_date(F.col(f"{n}_raw")).alias(n) for n in layout.DATE_FIELDS],
        *[profile.parse_counter(F.col(f"{n}_raw")).alias(n) for n in layout.COUNTER_FIELDS],
    )


def _failures(profile: RuleProfile) -> dict[str, Column]:
    bad = {
        "email": ~profile.email_ok(F.col("email_raw" if profile.strict else "email")),
        "fecha_envio": ~rules.required_date_ok(F.col("fecha_envio")),
    }
    for name in ("fecha_open", "fecha_click"):
        bad[name] = ~rules.optional_date_ok(F.col(f"{name}_raw"), F.col(name))
    for name in layout.COUNTER_FIELDS:
        bad[name] = F.col(name).isNull()
    return bad


def check(normalized: DataFrame, profile: RuleProfile = RuleProfile.STRICT) -> DataFrame:
    """Add error_codes (all of them, in order), error_description and is_valid.

    A wrong column count is the only error such a record gets.
    """
    bad = _failures(profile)
    given = {name: F.col(f"{name}_given") for name in bad}
    wrong_width = F.col("column_count") != layout.REPORT_WIDTH
    codes = F.when(wrong_width, F.array(F.lit("INVALID_COLUMN_COUNT"))).otherwise(
        rules.error_codes(profile, bad)
    )
    description = F.when(
        wrong_width,
        F.concat(
            F.lit(f"Expected {layout.REPORT_WIDTH} columns, found "),
            F.col("column_count").cast("string"),
        ),
    ).otherwise(rules.error_description(bad, given))
    keep = [c for c in normalized.columns if not c.endswith("_given") or c == "email_given"]
    flagged = _fenced(
        normalized, keep, [codes.alias("error_codes"), description.alias("error_description")]
    )
    return flagged.withColumn("is_valid", F.size("error_codes") == 0)


def validate(
    lines: DataFrame, run_id: str, profile: RuleProfile = RuleProfile.STRICT
) -> DataFrame:
    """Lines (source_file, source_line, raw_record, ...) -> validated records.

    Several outputs hang off this frame; write it once before using it more than once.
    """
    return check(normalize(parse_lines(lines, profile), run_id, profile), profile)


def validate_csv(scan: DataFrame, run_id: str) -> DataFrame:
    """Lenient rules over the CSV scan, which has no line numbers and no raw line."""
    parsed = scan.withColumn("column_count", F.lit(layout.REPORT_WIDTH))
    return check(normalize(parsed, run_id, RuleProfile.LENIENT), RuleProfile.LENIENT)


def visits(validated: DataFrame) -> DataFrame:
    """The valid visits (table estadistica) with their year/month partition columns."""
    lineage = [c for c in ("file_id", "source_file", "source_line") if c in validated.columns]
    return validated.filter("is_valid").select(
        "run_id", "record_id", *lineage, *layout.FIELD_NAMES,
        F.year("fecha_envio").alias("event_year"),
        F.month("fecha_envio").alias("event_month"),
    )


def rejects(validated: DataFrame, profile: RuleProfile = RuleProfile.STRICT) -> DataFrame:
    """The rejected records (table errores): codes as one comma-joined text."""
    lineage = [c for c in ("file_id",) if c in validated.columns]
    invalid = validated.filter(~F.col("is_valid"))
    if profile.strict:
        email = F.when(F.col("column_count") != layout.REPORT_WIDTH, F.col("email_given")).when(
            F.col("email_given") != "", F.col("email")
        )
    else:
        email = F.col("email_raw")
    return invalid.select(
        *lineage, "run_id", "record_id", F.col("source_file").alias("file_name"),
        F.col("source_line").alias("line_number"),
        email.alias("email"),
        F.array_join("error_codes", ",").alias("error_code"),
        "error_description", "raw_record",
    )


def lenient_rejects(validated: DataFrame, processing_date: date) -> DataFrame:
    """Rejects of the permissive path: raw values kept, codes as a list, dated."""
    raws = [f"{n}_raw" for n in (*layout.DATE_FIELDS, *layout.COUNTER_FIELDS)]
    return validated.filter(~F.col("is_valid")).select(
        "run_id", "record_id", "source_file", F.col("email_raw").alias("email"), "error_codes",
        *raws, F.lit(processing_date).cast("date").alias("processing_date"),
    )


def batch_reconciliation(validated: DataFrame) -> DataFrame:
    """Read / valid / invalid / visitors of a batch in one pass."""
    counts = validated.agg(
        F.count(F.lit(1)).alias("records_read"),
        F.count_if("is_valid").alias("records_valid"),
        F.count_if(~F.col("is_valid")).alias("records_invalid"),
        F.count_distinct(F.when(F.col("is_valid"), F.col("email"))).alias("visitors"),
    )
    return counts.withColumn(
        "reconciled", F.expr("records_read = records_valid + records_invalid")
    )


def file_metrics(validated: DataFrame, by: str = "source_file") -> DataFrame:
    """Read / valid / invalid per file."""
    return validated.groupBy(by).agg(
        F.count(F.lit(1)).alias("records_read"),
        F.count_if("is_valid").alias("records_valid"),
        F.count_if(~F.col("is_valid")).alias("records_invalid"),
    )


def error_distribution(rejected: DataFrame) -> DataFrame:
    """Rejects by file and code, most frequent code of a file first."""
    return (
        rejected.groupBy("file_name", "error_code")
        .agg(F.count(F.lit(1)).alias("total"))
        .orderBy("file_name", F.desc("total"), "error_code")
    )
