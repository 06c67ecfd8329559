"""Layout gate, landing folder, line numbers and archive on real files."""

import hashlib

from pyspark.sql import functions as F

from mailtrail import feeds, layout
from mailtrail.operators import archive, layout_gate, records
from mailtrail.sources import csv_reports, landing, lines

HEADER = layout.REPORT_HEADER


def put(folder, **files):
    for name, content in files.items():
        (folder / f"{name}.txt").write_bytes(content)
    return str(folder)


def test_layout_rules(spark):
    wrong = HEADER.replace("jyv", "jk")
    rows = [
        ("report_7.txt", 10, wrong), ("report_8.txt", 10, HEADER), ("report_100.txt", 0, None),
        ("visitas_100.txt", 10, HEADER), ("report_101.txt", 10, "email,jyv,Badmail"),
        ("report_102.txt", None, None), ("report_103.txt", 3, None), ("report_104.txt", 5, ""),
    ]
    files = spark.createDataFrame(
        [(n, f"/in/{n}", s, h) for n, s, h in rows],
        "file_name string, file_path string, file_size bigint, header_line string",
    )
    got = {r.file_name: (r.layout_code, r.layout_message) for r in layout_gate.validate_layout(files).collect()}
    assert got["report_7.txt"] == (
        "INVALID_HEADER",
        "Invalid header in file report_7.txt. Differences: "
        "[\"column 2: expected 'jyv', found 'jk'\"]",
    )
    assert got["report_8.txt"] == (None, None)
    assert got["report_100.txt"] == ("EMPTY_FILE", "File is empty: report_100.txt")
    assert got["visitas_100.txt"][0] == "INVALID_FILENAME"
    assert got["report_101.txt"] == (
        "INVALID_COLUMN_COUNT", "Expected 15 columns, found 3 in file report_101.txt"
    )
    assert got["report_102.txt"] == ("EMPTY_FILE", "File does not exist: /in/report_102.txt")
    assert got["report_103.txt"] == ("EMPTY_FILE", "File has no header: report_103.txt")
    assert got["report_104.txt"][0] == "INVALID_COLUMN_COUNT"


def test_manifest_and_checksums(spark, tmp_path):
    folder = put(tmp_path, report_2=b"abc\n", report_10=b"", other=b"x" * 5000, report_x=b"y")
    manifest = landing.file_manifest(spark, folder)
    assert {r.file_name: r.size_bytes for r in manifest.collect()} == {
        "report_2.txt": 4, "report_10.txt": 0, "other.txt": 5000, "report_x.txt": 1
    }
    assert [r.file_name for r in landing.candidate_files(manifest).collect()] == [
        "report_10.txt", "report_2.txt"
    ]
    sums = landing.file_checksums(manifest, landing.file_contents(spark, folder)).collect()
    assert {r.file_name: r.checksum_sha256 for r in sums} == {
        f"{n}.txt": hashlib.sha256(c).hexdigest()
        for n, c in {"report_2": b"abc\n", "report_10": b"", "other": b"x" * 5000,
                     "report_x": b"y"}.items()
    }


def test_no_match_is_an_error(spark, tmp_path):
    import pytest

    with pytest.raises(Exception):
        landing.matched_files(spark, put(tmp_path, other=b"x"))


def test_line_numbers_over_many_splits(spark, tmp_path):
    body = [f"line {n} " + "x" * (n % 50) for n in range(2, 20_001)]
    crlf = "\r\n".join([HEADER, *body]).encode()
    folder = put(
        tmp_path, report_1="\n".join([HEADER, *body]).encode() + b"\n", report_2=crlf,
        report_3=b"\xef\xbb\xbf" + HEADER.encode() + b"\n\nlast",
    )
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        numbered = lines.numbered_lines(spark, folder, scratch=f"{tmp_path}/scratch")
        got = {}
        for r in numbered.collect():
            got.setdefault(r.file_name, {})[r.line_number] = r.raw_record
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    expected = dict(enumerate([HEADER, *body], start=1))
    assert got["report_1.txt"] == expected
    assert got["report_2.txt"] == expected
    assert got["report_3.txt"] == {1: HEADER, 2: "", 3: "last"}


def test_archive_states(spark, tmp_path):
    contents = {f"report_{i}": bytes([65 + i]) * (10 + i) for i in range(6)}
    contents["report_9"] = b""
    folder = put(tmp_path, **contents)
    manifest = landing.file_manifest(spark, folder)
    contents = landing.file_contents(spark, folder)
    registered = landing.file_checksums(manifest, contents)
    rows = archive.archive_rows(manifest, contents, "run1")
    assert {r.archive_state for r in archive.verify_archive(registered, rows).collect()} == {"OK"}
    name = F.col("file_name")
    damaged = rows.filter(name != "report_1.txt").withColumn(
        "content",
        F.when(name == "report_2.txt", F.lit(b"")).when(name == "report_3.txt", F.lit(b"zz"))
        .otherwise(F.col("content")),
    )
    damaged = damaged.unionByName(rows.filter(name == "report_4.txt"))
    got = {r.file_name: r.archive_state for r in archive.verify_archive(registered, damaged).collect()}
    assert got == {
        "report_0.txt": "OK", "report_1.txt": "MISSING", "report_2.txt": "EMPTY",
        "report_3.txt": "CHECKSUM_MISMATCH", "report_4.txt": "DUPLICATE_MEMBER",
        "report_5.txt": "OK", "report_9.txt": "OK",
    }
    assert rows.filter(name == "report_0.txt").first().archive_name == "report_0_run1.zip"


def test_csv_scan_is_validated(spark, tmp_path):
    """The permissive scan under the lenient rules: quoted fields, short lines, blank lines."""
    lines = [
        "a@example.com,,,,08/02/2013 18:30,-,1,0,-,2,0,\"x,y\",-,-,-", "no-at-sign,,,,08/02/2013 18:30,-,0,0,-,0,0,-,-,-,-",
        "", "b@example.com,,,,99/99/2013 18:30,-,ABC,0,-,0,0,-,-,-,-", "c@example.com,,,,08/02/2013 18:30",
    ]
    folder = put(tmp_path, report_1="\n".join([HEADER, *lines, ""]).encode())
    found = records.validate_csv(csv_reports.scan_csv(spark, folder), "r").collect()
    assert {r.email: (r.is_valid, r.error_codes, r.links) for r in found} == {
        "a@example.com": (True, [], "x,y"), "no-at-sign": (False, ["INVALID_EMAIL"], None),
        "b@example.com": (False, ["INVALID_FECHA_ENVIO", "INVALID_INTEGER"], None),
        "c@example.com": (True, [], None),
    }
    assert records.visits(records.validate_csv(csv_reports.scan_csv(spark, folder), "r")).count() == 2


def test_report_files_are_written_by_tasks(spark, tmp_path):
    rows = [
        (f"report_{f}.txt", n, None if n == 3 else f"{f};{n};\u00f1\t\"x\"" if n != 4 else "")
        for f in range(40) for n in range(1 + f % 7)
    ]
    rows.append((None, 0, "hidden from scans"))
    frame = spark.createDataFrame(rows[::-1], "file_name string, source_line bigint, raw_record string")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")  # files that go on in the next batch
    try:
        folder = feeds._write_files(spark, frame, str(tmp_path))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    wanted = {}
    for name, _, text in rows:
        wanted[name or "__HIVE_DEFAULT_PARTITION__"] = wanted.get(name or "__HIVE_DEFAULT_PARTITION__", b"") + (
            (text or "").encode() + b"\n")
    assert {p.name: p.read_bytes() for p in (tmp_path / "in").iterdir()} == wanted
    assert not (tmp_path / "parts").exists()  # no folder per file, no rename per file by the driver
    assert landing.file_manifest(spark, folder).count() == 40
