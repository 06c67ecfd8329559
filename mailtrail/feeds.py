"""Inputs of the registered queries, derived row by row from the given tables.

The given tables hold no report files, so reports are derived from ``events``, control rows
from ``orders``, ``lineitem`` and ``customer``, header lines from ``supplier``. The texts are
SQL both Spark and DuckDB understand; ``{table}`` names a given table. Defects are set by
arithmetic on ids, for every row of the table.
"""

from __future__ import annotations

import os
from datetime import date
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import layout
from .operators import control
from .session import scratch_folder

RUN_ID = "run_demo"
REFERENCE = date(2024, 1, 31)
SPLIT_AT = "2024-01-30 00:00:00"  # visits from here on are the newest batch
HISTORY_REFERENCE = date(2023, 12, 31)
FILE_SPLIT = "1999-01-01 00:00:00"  # files detected before are history, later ones incoming

LINES_PER_FILE = 250

_TS = "ts - INTERVAL 1 DAY * (event_id % 400)"


def _dmyhm(stamp: str) -> str:
    """dd/MM/yyyy HH:mm out of 'yyyy-MM-dd HH:mm:ss'."""
    return (
        f"substr({stamp}, 9, 2) || '/' || substr({stamp}, 6, 2) || '/' || substr({stamp}, 1, 4)"
        f" || ' ' || substr({stamp}, 12, 5)"
    )


# Fifteen source fields f1..f15, file and line of every event.
FIELDS = f"""
SELECT event_id, ts, file_no,
  'report_' || CAST(file_no AS STRING) || '.txt' AS source_file,
  event_id % {LINES_PER_FILE} + 2 AS source_line,
  CASE WHEN event_id % 97 = 11 THEN 14 WHEN event_id % 97 = 12 THEN 16
       WHEN event_id % 499 = 20 THEN 0 ELSE 15 END AS n_fields,
  CASE WHEN event_id % 17 = 3 THEN CASE user_id % 5
            WHEN 0 THEN 'user@@example.com' WHEN 1 THEN 'no-at-sign'
            WHEN 2 THEN 'Lead@-dash.example.com' WHEN 3 THEN '' ELSE '   ' END
       WHEN event_id % 6 = 0 THEN upper(mail)
       WHEN event_id % 7 = 0 THEN '  ' || mail || ' '
       WHEN event_id % 11 = 0 THEN chr(9) || mail
       ELSE mail END AS f1,
  CASE event_type WHEN 'click' THEN 'J' || CAST(user_id % 50 AS STRING) WHEN 'view' THEN ' V '
       WHEN 'signup' THEN '-' ELSE '' END AS f2,
  CASE WHEN event_type = 'error' THEN 'HARD' WHEN event_id % 2 = 0 THEN '-' ELSE '' END AS f3,
  CASE WHEN event_id % 50 = 0 THEN 'SI' ELSE '' END AS f4,
  CASE WHEN event_id % 19 = 4 THEN '31/02/2024 10:00'
       WHEN event_id % 19 = 9 THEN CASE user_id % 3 WHEN 0 THEN '-' WHEN 1 THEN ''
            ELSE '99/99/2013 18:30' END
       WHEN event_id % 19 = 14 THEN CAST(CAST(substr(sent, 1, 2) AS INTEGER) AS STRING) || '/'
          || CAST(CAST(substr(sent, 4, 2) AS INTEGER) AS STRING) || substr(sent, 6, 5)
          || '  ' || substr(sent, 12, 5)
       WHEN event_id % 13 = 5 THEN ' ' || sent || '  '
       ELSE sent END AS f5,
  CASE WHEN event_id % 29 = 7 THEN '30/02/2024 01:00'
       WHEN event_type IN ('view', 'click') THEN opened
       WHEN event_id % 2 = 0 THEN '-' ELSE '' END AS f6,
  CASE WHEN event_id % 23 = 1 THEN CASE user_id % 5 WHEN 0 THEN 'ABC' WHEN 1 THEN '-3'
            WHEN 2 THEN '99999999999999999999' WHEN 3 THEN '+5' ELSE '1.5' END
       WHEN event_type = 'view' THEN CAST(CAST(floor(value) AS BIGINT) AS STRING)
       WHEN event_id % 2 = 0 THEN '-' ELSE '' END AS f7,
  CASE WHEN event_id % 31 = 2 THEN '-0' WHEN event_id % 3 = 0 THEN ' 2 ' ELSE '0' END AS f8,
  CASE WHEN event_type = 'click' THEN clicked
       WHEN event_id % 37 = 5 THEN 'x' ELSE '-' END AS f9,
  CASE WHEN event_type = 'click' THEN CAST(user_id % 9 AS STRING)
       WHEN event_id % 43 = 6 THEN '-3' ELSE '0' END AS f10,
  CASE WHEN event_id % 2 = 0 THEN '0' ELSE '' END AS f11,
  CASE event_type WHEN 'click' THEN 'https://example.com/a?u=' || CAST(user_id AS STRING) || ',x'
       WHEN 'purchase' THEN props ELSE '-' END AS f12,
  '10.0.' || CAST(user_id % 256 AS STRING) || '.' || CAST(event_id % 256 AS STRING)
    || CASE WHEN event_id % 10 = 0 THEN ', 10.1.1.1' ELSE '' END AS f13,
  CASE WHEN event_id % 4 = 0 THEN 'Firefox' ELSE '-' END AS f14,
  CASE WHEN event_id % 5 = 0 THEN 'Android' ELSE '' END AS f15
FROM (
  SELECT event_id, ts, user_id, event_type, value, props,
    {_dmyhm('sent_at')} AS sent, {_dmyhm('opened_at')} AS opened,
    {_dmyhm('clicked_at')} AS clicked,
    CAST((event_id - event_id % {LINES_PER_FILE}) / {LINES_PER_FILE} AS BIGINT) AS file_no,
    'user' || CAST(user_id AS STRING) || '@mail' || CAST(user_id % 7 AS STRING)
      || '.example.com' AS mail
  FROM (
    SELECT event_id, ts, user_id, event_type, value, props, CAST({_TS} AS STRING) AS sent_at,
      CAST({_TS} + INTERVAL 2 HOUR AS STRING) AS opened_at,
      CAST({_TS} + INTERVAL 3 HOUR AS STRING) AS clicked_at
    FROM {{events}}
  ) AS stamped
) AS dated
"""


def _csv(field: str) -> str:
    return (
        f"CASE WHEN contains({field}, '\"') OR contains({field}, ',') "
        f"THEN '\"' || replace({field}, '\"', '\"\"') || '\"' ELSE {field} END"
    )


# Only links and ips can hold a comma or a quote.
_JOINED = " || ',' || ".join(
    _csv(f"f{i}") if i in (12, 13) else f"f{i}" for i in range(1, 15)
)

# Every event as one report line.
LINES = f"""
SELECT event_id, ts, file_no, source_file, source_line,
  CASE WHEN n_fields = 0 THEN '' ELSE {_JOINED}
    || CASE WHEN n_fields >= 15 THEN ',' || f15 ELSE '' END
    || CASE WHEN n_fields = 16 THEN ',extra' ELSE '' END END AS raw_record
FROM ({FIELDS}) AS fields
"""

_HEADER = f"""CASE WHEN file_no % 11 = 3 THEN '{layout.REPORT_HEADER.replace('jyv', 'jk')}'
  WHEN file_no % 11 = 6 THEN 'email,jyv,Badmail' ELSE '{layout.REPORT_HEADER}' END"""
_NAME = """CASE WHEN file_no % 13 = 5 THEN 'visitas_' || CAST(file_no AS STRING) || '.txt'
  WHEN file_no % 13 = 9 THEN 'report_' || CAST(file_no AS STRING) || '_b.txt'
  ELSE 'report_' || CAST(file_no AS STRING) || '.txt' END"""

# The landing folder: all lines with their headers; some files come twice, byte for byte.
LANDING = f"""
SELECT file_name, source_line, raw_record FROM (
  SELECT {_NAME} AS file_name, source_line, raw_record, file_no FROM ({LINES}) AS lines
  UNION ALL
  SELECT {_NAME} AS file_name, CAST(1 AS BIGINT) AS source_line, {_HEADER} AS raw_record, file_no
  FROM ({LINES}) AS lines WHERE source_line = 2
) AS originals
UNION ALL
SELECT 'report_00' || CAST(file_no AS STRING) || '.txt' AS file_name, source_line, raw_record
FROM (
  SELECT source_line, raw_record, file_no FROM ({LINES}) AS lines
  UNION ALL
  SELECT CAST(1 AS BIGINT) AS source_line, {_HEADER} AS raw_record, file_no
  FROM ({LINES}) AS lines WHERE source_line = 2
) AS copies WHERE file_no % 10 = 7
"""
EMPTY_FILE = "report_000.txt"
# Spark's name for a null in a path; files of such names are hidden from its scans.
_NO_NAME = "__HIVE_DEFAULT_PARTITION__"

# One control row per order; statuses get milder from one third of the runs to the next.
FILE_CONTROL = """
SELECT file_id, run_id, file_name, '/landing/' || file_name AS source_path,
  records_read * 180 AS file_size, content_key, detected_at,
  CASE WHEN status <> 'DETECTED' THEN detected_at + INTERVAL 1 MINUTE END AS staged_at,
  CASE WHEN checked THEN detected_at + INTERVAL 2 MINUTE END AS validation_started_at,
  CASE WHEN checked AND status <> 'REJECTED_LAYOUT' THEN detected_at + INTERVAL 3 MINUTE END
    AS validation_finished_at,
  CASE WHEN loaded OR status = 'LOADING' THEN detected_at + INTERVAL 3 MINUTE END AS load_started_at,
  CASE WHEN loaded THEN detected_at + INTERVAL 4 MINUTE END AS load_finished_at,
  CASE WHEN backed_up AND file_id % 61 <> 4 THEN detected_at + INTERVAL 5 MINUTE END AS backup_at,
  CASE WHEN status = 'SUCCESS' AND file_id % 71 <> 8 THEN detected_at
    + CASE WHEN file_id % 67 = 5 THEN INTERVAL 2 MINUTE ELSE INTERVAL 6 MINUTE END
  END AS source_deleted_at,
  status, records_read, records_valid, records_read - bad AS records_clean, bad AS records_invalid,
  CASE WHEN loaded THEN records_valid - CASE WHEN file_id % 53 = 9 THEN 1 ELSE 0 END
    ELSE 0 END AS records_loaded,
  CASE WHEN loaded THEN file_id % 5 ELSE 0 END AS visitors_inserted,
  CASE WHEN loaded THEN file_id % 3 ELSE 0 END AS visitors_updated,
  CASE WHEN status <> 'DETECTED' THEN '/staging/' || file_name END AS staging_uri,
  CASE WHEN file_id % 5 = 0 THEN 1 ELSE 0 END AS retry_count,
  CASE WHEN backed_up AND file_id % 59 <> 2 THEN '/archive/' || file_name || '.zip' END AS backup_uri,
  CASE WHEN status = 'FAILED' AND file_id % 2 = 0 THEN 'RECONCILIATION_ERROR'
    WHEN status = 'FAILED' THEN 'RuntimeError'
    WHEN status = 'REJECTED_LAYOUT' THEN 'INVALID_HEADER'
    WHEN status = 'PENDING_BACKUP' THEN 'BACKUP_ERROR'
    WHEN status = 'PENDING_SOURCE_DELETE' THEN 'SFTP_DELETE_ERROR'
    WHEN status = 'SKIPPED_ALREADY_PROCESSED' THEN 'ALREADY_PROCESSED' END AS error_code,
  CASE WHEN status IN ('FAILED', 'REJECTED_LAYOUT') THEN 'see ' || file_name END AS error_message,
  detected_at AS created_at, detected_at + INTERVAL 1 MINUTE * (file_id % 1000) AS updated_at
FROM (
  SELECT *, status IN ('LOADED', 'BACKED_UP', 'PENDING_BACKUP', 'PENDING_SOURCE_DELETE', 'SUCCESS')
      AS loaded,
    status NOT IN ('DETECTED', 'STAGED', 'SKIPPED_ALREADY_PROCESSED') AS checked,
    status IN ('BACKED_UP', 'PENDING_SOURCE_DELETE', 'SUCCESS') AS backed_up
  FROM (
    SELECT o_orderkey AS file_id, 'run_' || CAST(o_custkey AS STRING) AS run_id,
      'report_' || CAST(o_orderkey AS STRING) || '.txt' AS file_name,
      CAST(o_custkey AS STRING) || ' ' || o_orderpriority AS content_key,
      o_orderdate AS detected_at,
      CASE
        WHEN o_orderkey % 15 = 6 THEN 'SKIPPED_ALREADY_PROCESSED'
        WHEN o_custkey % 3 < 2 AND o_orderkey % 15 = 7 THEN 'REJECTED_LAYOUT'
        WHEN o_custkey % 3 > 0 THEN 'SUCCESS'
        WHEN o_orderkey % 15 = 4 THEN 'DETECTED' WHEN o_orderkey % 15 = 5 THEN 'STAGED'
        WHEN o_orderkey % 15 = 8 THEN 'FAILED' WHEN o_orderkey % 15 = 9 THEN 'PENDING_BACKUP'
        WHEN o_orderkey % 15 = 10 THEN 'PENDING_SOURCE_DELETE'
        WHEN o_orderkey % 15 = 11 THEN 'PREPARED' WHEN o_orderkey % 15 = 12 THEN 'LOADING'
        WHEN o_orderkey % 15 = 13 THEN 'LOADED' WHEN o_orderkey % 15 = 14 THEN 'BACKED_UP'
        ELSE 'SUCCESS' END AS status,
      coalesce(n, 0) AS records_read,
      coalesce(n, 0) - coalesce(bad, 0) + CASE WHEN o_orderkey % 41 = 7 THEN 1 ELSE 0 END
        AS records_valid,
      coalesce(bad, 0) AS bad
    FROM {orders} AS o LEFT JOIN (
      SELECT l_orderkey, count(*) AS n,
        count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS bad
      FROM {lineitem} GROUP BY l_orderkey
    ) AS l ON l_orderkey = o_orderkey
  ) AS keyed
) AS staged
"""

# One registered run per customer, and file-less runs from nation.
RUNS = """
SELECT run_id, 'visit_reports_daily' AS dag_id, execution_date,
  execution_date + INTERVAL 1 MINUTE * (n % 60) AS start_time,
  CASE WHEN n % 23 <> 0 THEN execution_date + INTERVAL 1 MINUTE * (n % 60)
    + INTERVAL 1 SECOND * ((n * 37) % 5400) END AS end_time
FROM (
  SELECT 'run_' || CAST(c_custkey AS STRING) AS run_id, c_custkey AS n,
    TIMESTAMP '2013-01-01 06:00:00' + INTERVAL 1 DAY * (c_custkey % 3650) AS execution_date
  FROM {customer}
  UNION ALL
  SELECT 'run_idle_' || CAST(n_nationkey AS STRING) AS run_id, CAST(n_nationkey AS BIGINT) + 1 AS n,
    TIMESTAMP '2012-12-01 06:00:00' + INTERVAL 1 DAY * n_nationkey AS execution_date
  FROM {nation}
) AS dated
"""

# One file per supplier: name, size and header line with the layout defects.
HEADERS = f"""
SELECT s_suppkey AS file_no, file_name, '/landing/' || file_name AS file_path, file_size,
  CASE WHEN file_size > 0 THEN header END AS header_line
FROM (
  SELECT s_suppkey,
    CASE WHEN s_suppkey % 9 = 4 THEN 'visitas_' || CAST(s_suppkey AS STRING) || '.txt'
      ELSE 'report_' || CAST(s_suppkey AS STRING) || '.txt' END AS file_name,
    CASE WHEN s_suppkey % 7 = 1 THEN 0 WHEN s_suppkey % 7 <> 3 THEN 1000 + s_suppkey END
      AS file_size,
    CASE s_suppkey % 6 WHEN 1 THEN '{layout.REPORT_HEADER.replace('jyv', 'jk')}'
      WHEN 2 THEN 'email,jyv,Badmail'
      WHEN 3 THEN '{layout.REPORT_HEADER.replace('jyv', 'fgh').replace('IPs', 'ips')}'
      WHEN 4 THEN '{layout.REPORT_HEADER},more'
      WHEN 5 THEN CASE WHEN s_suppkey % 12 = 5 THEN '' ELSE lower('{layout.REPORT_HEADER}') END
      ELSE '{layout.REPORT_HEADER}' END AS header
  FROM {{supplier}}
) AS named
"""

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _derived(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    used = {name: table(spark, sf_dir, name) for name in TABLES if f"{{{name}}}" in sql}
    return spark.sql(sql.replace("TIMESTAMP '", "TIMESTAMP_NTZ '"), **used)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """source_file, source_line, raw_record (and ts, which dates the batch).

    The given table is one row group, which one task reads: the lines made of it are dealt out,
    as files of their own would be.
    """
    return _derived(spark, sf_dir, LINES).drop("event_id").hint("rebalance")


def landing_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derived(spark, sf_dir, LANDING)


def file_control(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _derived(spark, sf_dir, FILE_CONTROL)
    return rows.withColumn("checksum_sha256", F.sha2("content_key", 256)).drop(
        "content_key", "records_clean"
    )


def registered_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derived(spark, sf_dir, RUNS)


def newest_run(spark: SparkSession, sf_dir: str) -> str:
    """The greatest run id that has a file, as a caller would name a run."""
    return file_control(spark, sf_dir).agg(F.max("run_id")).first()[0]


def headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derived(spark, sf_dir, HEADERS)


def duckdb_cte(name: str, sql: str) -> str:
    """A feed as a DuckDB common table expression over the registered views."""
    return f"{name} AS ({sql.format(**{t: t for t in TABLES})})"


def file_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lifecycle of every file of ``file_control`` as events."""
    files = file_control(spark, sf_dir)
    status, col = F.col("status"), F.col
    loaded = col("load_finished_at").isNotNull()
    parsed = ~status.isin("DETECTED", "STAGED", "SKIPPED_ALREADY_PROCESSED", "REJECTED_LAYOUT")
    backed_up = status.isin("BACKED_UP", "PENDING_SOURCE_DELETE", "SUCCESS")
    ended = ~status.isin("DETECTED", "STAGED", "PREPARED", "LOADED", "BACKED_UP", "SUCCESS")
    later = lambda minutes: col("detected_at") + F.expr(f"INTERVAL {minutes} MINUTE")
    steps = [
        ("detected", F.lit(True), {
            "at": col("detected_at"), "run_id": col("run_id"), "file_name": col("file_name"),
            "source_path": col("source_path"), "status": F.lit("DETECTED")}),
        ("staged", status != "DETECTED", {
            "at": col("staged_at"), "file_size": col("file_size"),
            "checksum_sha256": col("checksum_sha256"), "status": F.lit("STAGED")}),
        ("status", parsed & (col("file_id") % 5 == 0), {
            "at": later(2), "status": F.lit("FAILED"), "error_code": F.lit("TimeoutError"),
            "error_message": F.lit("first try")}),
        ("retried", parsed & (col("file_id") % 5 == 0), {"at": later(2)}),
        ("metrics", parsed, {
            "at": later(3),
            **{c: col(c) for c in ("records_read", "records_valid", "records_invalid")}}),
        ("status", parsed, {"at": later(3), "status": F.lit("PREPARED")}),
        ("load_finished", loaded, {
            "at": col("load_finished_at"), "status": F.lit("LOADED"),
            "records_loaded": col("records_loaded")}),
        ("backed_up", backed_up, {
            "at": col("backup_at"), "backup_uri": col("backup_uri"),
            "status": F.lit("BACKED_UP")}),
        ("source_deleted", status == "SUCCESS", {
            "at": col("source_deleted_at"), "status": F.lit("SUCCESS")}),
        ("status", ended, {
            "at": col("updated_at"), "status": status, "error_code": col("error_code"),
            "error_message": col("error_message")}),
    ]
    events = [
        control.event(
            control.FILE_EVENT_SCHEMA, condition, file_id=col("file_id"), seq=F.lit(seq),
            event=F.lit(name), **given,
        )
        for seq, (name, condition, given) in enumerate(steps, start=1)
    ]
    return files.select(F.inline(F.array_compact(F.array(*events))))


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registration and end of every run."""
    col = F.col
    failed = F.minute("start_time") % 3 == 0
    events = [
        control.event(
            control.RUN_EVENT_SCHEMA, F.lit(True), run_id=col("run_id"), seq=F.lit(1),
            event=F.lit("started"), at=col("start_time"), dag_id=col("dag_id"),
            execution_date=col("execution_date"), status=F.lit("RUNNING"),
        ),
        control.event(
            control.RUN_EVENT_SCHEMA, col("end_time").isNotNull(), run_id=col("run_id"),
            seq=F.lit(2), event=F.lit("finished"), at=col("end_time"),
            status=F.when(failed, "FAILED").otherwise("SUCCESS"),
            error_code=F.when(failed, "RuntimeError"),
        ),
    ]
    return registered_runs(spark, sf_dir).select(F.inline(F.array_compact(F.array(*events))))


def _named_files(folder: str):
    """Writes rows of file_name and raw_record, those of a name together, as files of a shared folder.

    A file appears under its name when it is whole; a repeated task writes the same one.
    """

    def run(batches):
        name, draft, out = None, None, None
        for batch in batches:
            lines = zip(batch.column("file_name").to_pylist(), batch.column("raw_record").to_pylist())
            for following, group in groupby(lines, key=itemgetter(0)):
                if following != name:
                    if out is not None:
                        out.close()
                        os.replace(draft, f"{folder}/{name}")
                    name, draft = following, f"{folder}/.{following}.{TaskContext.get().taskAttemptId()}"
                    out = open(draft, "wb")
                    yield pa.RecordBatch.from_arrays([pa.array([name])], names=["file_name"])
                out.write(b"".join((text or b"") + b"\n" for _, text in group))
        if out is not None:
            out.close()
            os.replace(draft, f"{folder}/{name}")

    return run


def _write_files(spark: SparkSession, rows: DataFrame, folder: str) -> str:
    """Rows of file_name, source_line and raw_record as one text file per name; returns its folder.

    On a shared disk the tasks write the files themselves. Elsewhere Spark's writer makes one part
    per file name, in a folder each; the parts then get their report names.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path
    target = path(f"{folder}/in")
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(target)
    together = (
        rows.repartition("file_name")
        .sortWithinPartitions("file_name", "source_line")
        .select("raw_record", "file_name")
    )
    if fs.getUri().getScheme() == "file":
        as_bytes = together.select(
            F.col("raw_record").cast("binary"), F.coalesce("file_name", F.lit(_NO_NAME)).alias("file_name")
        )
        as_bytes.mapInArrow(_named_files(target.toUri().getPath()), "file_name string").count()
        return f"{folder}/in"
    together.write.partitionBy("file_name").text(f"{folder}/parts")
    for part in fs.globStatus(path(f"{folder}/parts/*/part-*")):
        name = part.getPath().getParent().getName().split("=", 1)[1]
        fs.rename(part.getPath(), path(f"{folder}/in/{name}"))
    return f"{folder}/in"


def write_landing(spark: SparkSession, sf_dir: str) -> str:
    """The landing folder as real text files named like the reports; returns its path."""
    folder = _write_files(spark, landing_lines(spark, sf_dir), scratch_folder(spark, "landing"))
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{EMPTY_FILE}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path).close()
    return folder


def write_report_folders(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """All reports with right names and headers in two folders: even numbers, and odd ones."""
    records = lines(spark, sf_dir).select(
        "file_no", F.col("source_file").alias("file_name"), "source_line", "raw_record"
    )
    firsts = records.filter("source_line = 2").withColumn("source_line", F.lit(1).cast("bigint"))
    rows = records.unionByName(firsts.withColumn("raw_record", F.lit(layout.REPORT_HEADER)))
    folders = [
        _write_files(spark, rows.filter(F.col("file_no") % 2 == parity).drop("file_no"), scratch_folder(spark, "reports"))
        for parity in (0, 1)
    ]
    return folders[0], folders[1]


def folder_listings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """What a folder held by its last listing, and what it holds now.

    Of the files of even number those whose number leaves 0 by 3 are as they were, those that
    leave 1 have new contents, the others are gone; every fifth path was not there before.
    """
    files = file_control(spark, sf_dir).filter("file_id % 2 = 0").select(
        F.concat_ws("/", F.lit("/landing/even"), "file_id", "file_name").alias("file_path"),
        F.col("file_size").alias("size_bytes"), F.col("detected_at").alias("modified_at"),
        F.when(F.col("file_id") % 7 != 3, F.col("checksum_sha256")).alias("checksum_sha256"),
        "file_id", "run_id", F.expr("backup_at IS NOT NULL AND source_deleted_at IS NULL").alias("open"),
    )
    last = files.filter("file_id % 5 <> 0").withColumn("open_file_id", F.when(F.col("open"), F.col("file_id")))
    last = last.withColumn("open_run_id", F.when(F.col("open"), F.col("run_id")))
    replaced = F.col("file_id") % 3 == 1
    present = files.filter("file_id % 3 <> 2").select(
        "file_path", (F.col("size_bytes") + F.when(replaced, 1).otherwise(0)).alias("size_bytes"), "modified_at",
        F.when(replaced, F.reverse("checksum_sha256")).otherwise(F.col("checksum_sha256")).alias("checksum_sha256"),
    )
    return last.drop("open", "file_id", "run_id"), present
