"""Record rules on single lines, both profiles."""

from datetime import date, datetime

import pytest

from mailtrail.functions.rules import RuleProfile
from mailtrail.operators import records, visitors

STRICT, LENIENT = RuleProfile.STRICT, RuleProfile.LENIENT


def line(email="USER@example.com", sent="08/02/2013 18:30", opens="0", clicks="0"):
    return f"{email},,,,{sent},-,{opens},0,-,{clicks},0,-,-,-,-"


CASES = [
    # line, strict codes, lenient codes (None: no record)
    (line(), [], []),
    (line(email="usuario@@example.com"), ["INVALID_EMAIL"], ["INVALID_EMAIL"]),
    (line(email="a@-b.example.com"), ["INVALID_EMAIL"], []),
    (line(email="\tuser@example.com"), [], ["INVALID_EMAIL"]),
    (line(sent="31/02/2013 18:30"), ["INVALID_DATE_VALUE"], ["INVALID_FECHA_ENVIO"]),
    (line(sent="99/99/2013 18:30"), ["INVALID_DATE_VALUE"], ["INVALID_FECHA_ENVIO"]),
    (line(sent="8/2/2013 9:05"), [], ["INVALID_FECHA_ENVIO"]),
    (line(sent="08/02/2013 18:60"), ["INVALID_DATE_VALUE"], ["INVALID_FECHA_ENVIO"]),
    (line(sent="01/02/0000 10:00"), ["INVALID_DATE_VALUE"], []),
    (line(sent="-"), ["INVALID_DATE_VALUE"], ["INVALID_FECHA_ENVIO"]),
    (line(opens="ABC"), ["INVALID_INTEGER"], ["INVALID_INTEGER"]),
    (line(clicks="-3"), ["INVALID_INTEGER"], ["INVALID_INTEGER"]),
    (line(opens="+5"), [], ["INVALID_INTEGER"]),
    (line(opens="99999999999999999999"), ["INVALID_INTEGER"], ["INVALID_INTEGER"]),
    (
        line(email="x", sent="x", opens="x", clicks="y"),
        ["INVALID_EMAIL", "INVALID_DATE_VALUE", "INVALID_INTEGER", "INVALID_INTEGER"],
        ["INVALID_EMAIL", "INVALID_FECHA_ENVIO", "INVALID_INTEGER"],
    ),
    ("a,b,c", ["INVALID_COLUMN_COUNT"], ["INVALID_EMAIL", "INVALID_FECHA_ENVIO"]),
    (line() + ",extra", ["INVALID_COLUMN_COUNT"], []),
    (line().rsplit(",", 1)[0], ["INVALID_COLUMN_COUNT"], []),
    ("", ["INVALID_COLUMN_COUNT"], None),
]


def frame(spark, raw_lines):
    rows = [("report_1.txt", n, raw) for n, raw in enumerate(raw_lines, start=2)]
    return spark.createDataFrame(rows, "source_file string, source_line bigint, raw_record string")


@pytest.mark.parametrize("profile", [STRICT, LENIENT])
def test_error_codes(spark, profile):
    validated = records.validate(frame(spark, [c[0] for c in CASES]), "r1", profile)
    got = {r.source_line: r.error_codes for r in validated.select("source_line", "error_codes").collect()}
    wanted = {
        n: case[1 if profile.strict else 2] for n, case in enumerate(CASES, start=2)
    }
    assert got == {n: codes for n, codes in wanted.items() if codes is not None}


def test_valid_record_values(spark):
    (row,) = records.visits(records.validate(frame(spark, [line()]), "r1")).collect()
    assert row.email == "user@example.com"
    assert row.fecha_envio == datetime(2013, 2, 8, 18, 30)
    assert (row.jyv, row.fecha_open, row.links) == (None, None, None)
    assert (row.opens, row.clicks, row.event_year, row.event_month) == (0, 0, 2013, 2)


def test_skipped_hour_is_kept(spark):
    (row,) = records.visits(records.validate(frame(spark, [line(sent="07/04/2013 02:30")]), "r")).collect()
    assert row.fecha_envio == datetime(2013, 4, 7, 2, 30)


def test_quoted_fields_follow_csv_rules(spark):
    import csv

    raws = [',b', 'a,"b,c",d', 'a,"b ""q"" c"x,d', 'a,"b,c', 'ab"c,d', "a,", '""', '"",x', "a"]
    from pyspark.sql import functions as F

    from mailtrail.functions.text import split_fields

    got = frame(spark, raws).select("raw_record", split_fields(F.col("raw_record")).alias("f")).collect()
    assert {r.raw_record: r.f for r in got} == {raw: next(csv.reader([raw])) for raw in raws}


def test_descriptions_and_reject_email(spark):
    raws = [line(email=" Bad ", opens="ABC"), "Only,Three,Fields", "", line(email="")]
    got = {r.line_number: r for r in records.rejects(records.validate(frame(spark, raws), "r")).collect()}
    assert got[2].error_description == "Invalid email: ' Bad '; Invalid opens: 'ABC'"
    assert (got[2].email, got[2].error_code) == ("bad", "INVALID_EMAIL,INVALID_INTEGER")
    assert (got[3].email, got[3].error_description) == ("Only", "Expected 15 columns, found 3")
    assert (got[4].email, got[4].error_description) == (None, "Expected 15 columns, found 0")
    assert got[5].email is None


def test_small_sample_lenient(spark):
    sample = [
        line("usuario.valido@example.com", opens="1"), line("email_invalido", opens="1"),
        line("fecha.invalida@example.com", sent="99/99/2013 18:30", opens="1"),
        line("numero.invalido@example.com", opens="ABC"),
    ]
    validated = records.validate(frame(spark, sample), "r", LENIENT)
    summary = records.batch_reconciliation(validated).first()
    assert (summary.records_read, summary.records_valid, summary.records_invalid) == (4, 1, 3)
    assert summary.visitors == 1 and summary.reconciled
    (visitor,) = visitors.visitors(records.visits(validated), date(2013, 2, 15)).collect()
    assert tuple(visitor) == (
        "usuario.valido@example.com", date(2013, 2, 8), date(2013, 2, 8), 1, 1, 1
    )


def test_merge_replaces_only_affected(spark):
    columns = ", ".join(
        ["email string", "fecha_primera_visita date", "fecha_ultima_visita date",
         "visitas_totales bigint", "visitas_anio_actual bigint", "visitas_mes_actual bigint"]
    )
    day = date(2013, 1, 1)
    old = spark.createDataFrame([("a", day, day, 1, 1, 1), ("b", day, day, 5, 5, 5)], columns)
    new = spark.createDataFrame([("a", day, day, 2, 2, 0), ("c", day, day, 1, 1, 1)], columns)
    merged = {r.email: r.visitas_totales for r in visitors.merge_visitors(old, new).collect()}
    assert merged == {"a": 2, "b": 5, "c": 1}
