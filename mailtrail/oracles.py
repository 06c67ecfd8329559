"""DuckDB SQL with the results the registered queries must have."""

from __future__ import annotations

from . import feeds, layout
from .feeds import HISTORY_REFERENCE, REFERENCE, RUN_ID
from .functions.text import WHITESPACE

_STRICT_EMAIL = layout.EMAIL_STRICT.removeprefix("^").removesuffix(r"\z").replace("'", "''")
_LENIENT_EMAIL = layout.EMAIL_LENIENT.removeprefix("^").removesuffix("$").replace("'", "''")
_DATE_COLS = {"fecha_envio": "f5", "fecha_open": "f6", "fecha_click": "f9"}
_COUNTER_COLS = {"opens": "f7", "opens_virales": "f8", "clicks": "f10", "clicks_virales": "f11"}
_TEXT_COLS = {
    "jyv": "f2", "badmail": "f3", "baja": "f4", "links": "f12", "ips": "f13",
    "navegadores": "f14", "plataformas": "f15",
}
_FIELD_LIST = ", ".join(layout.FIELD_NAMES)


def _strip(c: str) -> str:
    return f"trim({c}, '{WHITESPACE}')"


def _space(c: str) -> str:
    return f"trim({c}, ' ')"


def _date(c: str, strict: bool) -> str:
    if strict:
        guard = r"[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}\s+[0-9]{1,2}:[0-9]{1,2}"
        c = rf"regexp_replace({c}, '\s+', ' ', 'g')"
        guard = guard.replace(r"\s+", " ")
    else:
        guard = "[0-9]{2}/[0-9]{2}/[0-9]{4} [0-9]{2}:[0-9]{2}"
    return (
        f"CASE WHEN regexp_full_match({c}, '{guard}') "
        f"THEN try_strptime({c}, '%d/%m/%Y %H:%M') END"
    )


def _integer(c: str, strict: bool) -> str:
    guard = r"\+?[0-9]+|-0+" if strict else "[0-9]+"
    return f"CASE WHEN regexp_full_match({c}, '{guard}') THEN TRY_CAST(ltrim({c}, '+') AS BIGINT) END"


def _normalized(strict: bool) -> str:
    trim = _strip if strict else _space
    kept = "true" if strict else "n_fields > 0"
    trimmed = [f"{trim('f1')} AS email_raw"]
    trimmed += [f"{trim(c)} AS {n}_raw" for n, c in _DATE_COLS.items()]
    trimmed += [
        f"CASE WHEN {trim(c)} IN ('', '-') THEN '0' ELSE {trim(c)} END AS {n}_raw"
        for n, c in _COUNTER_COLS.items()
    ]
    for n, c in _TEXT_COLS.items():
        value = f"CASE WHEN {trim(c)} IN ('', '-') THEN NULL ELSE {trim(c)} END"
        if strict:
            # short lines: the last field does not exist; blank lines have none at all
            value = f"CASE WHEN n_fields > {0 if c != 'f15' else 14} THEN {value} END"
        elif c == "f15":
            value = f"CASE WHEN n_fields > 14 THEN {value} END"
        trimmed.append(f"{value} AS {n}")
    dates = ", ".join(f"{_date(n + '_raw', strict)} AS {n}" for n in _DATE_COLS)
    counters = ", ".join(f"{_integer(n + '_raw', strict)} AS {n}" for n in _COUNTER_COLS)
    blank = "" if not strict else "CASE WHEN n_fields > 0 THEN "
    end = "" if not strict else " END"
    masked = ", ".join(
        f"{blank}{n}_raw{end} AS {n}_raw"
        for n in ("email", *_DATE_COLS)
    )
    masked += ", " + ", ".join(
        f"{'CASE WHEN n_fields > 0 THEN ' + n + '_raw ELSE ' + repr('0') + ' END' if strict else n + '_raw'}"
        f" AS {n}_raw"
        for n in _COUNTER_COLS
    )
    return f"""
      SELECT *, lower(email_raw) AS email, {dates}, {counters} FROM (
        SELECT event_id, ts, file_no, file_no + 1 AS file_id, source_file, source_line, n_fields,
          f1, f5, f6, f7, f8, f9, f10, f11, {masked}, {', '.join(_TEXT_COLS)}
        FROM (SELECT *, {', '.join(trimmed)} FROM fields WHERE {kept}) AS t
      ) AS m"""


def _checked(strict: bool) -> str:
    source = "strict_norm" if strict else "lenient_norm"
    if strict:
        bad_email = f"NOT coalesce(regexp_full_match(email_raw, '{_STRICT_EMAIL}'), false)"
    else:
        bad_email = f"NOT coalesce(regexp_full_match(email, '{_LENIENT_EMAIL}'), false)"
    optional = "(coalesce({0}_raw, '') NOT IN ('', '-') AND {0} IS NULL)"
    bad = {
        "email": bad_email,
        "fecha_envio": "fecha_envio IS NULL",
        "fecha_open": optional.format("fecha_open"),
        "fecha_click": optional.format("fecha_click"),
        **{n: f"{n} IS NULL" for n in _COUNTER_COLS},
    }
    flags = ", ".join(f"({sql}) AS bad_{n}" for n, sql in bad.items())
    if strict:
        codes = ["CASE WHEN bad_email THEN 'INVALID_EMAIL' END"]
        codes += [f"CASE WHEN bad_{n} THEN 'INVALID_DATE_VALUE' END" for n in _DATE_COLS]
        codes += [f"CASE WHEN bad_{n} THEN 'INVALID_INTEGER' END" for n in _COUNTER_COLS]
        label = {"fecha_envio": "Fecha envio", "fecha_open": "Fecha open",
                 "fecha_click": "Fecha click"}
        given = {"email": "f1", **_DATE_COLS, **_COUNTER_COLS}
        texts = ", ".join(
            f"CASE WHEN bad_{n} THEN 'Invalid {label.get(n, n)}: ''' || {c} || '''' END"
            for n, c in given.items()
        )
        error_code = (
            "CASE WHEN n_fields <> 15 THEN 'INVALID_COLUMN_COUNT' "
            f"ELSE concat_ws(',', {', '.join(codes)}) END"
        )
        description = (
            "CASE WHEN n_fields <> 15 THEN 'Expected 15 columns, found ' || "
            f"CAST(n_fields AS VARCHAR) ELSE concat_ws('; ', {texts}) END"
        )
    else:
        codes = ["CASE WHEN bad_email THEN 'INVALID_EMAIL' END"]
        codes += [f"CASE WHEN bad_{n} THEN 'INVALID_{n.upper()}' END" for n in _DATE_COLS]
        any_counter = " OR ".join(f"bad_{n}" for n in _COUNTER_COLS)
        codes.append(f"CASE WHEN {any_counter} THEN 'INVALID_INTEGER' END")
        error_code = f"concat_ws(',', {', '.join(codes)})"
        description = "NULL"
    key = " || '||' || ".join(
        ["source_file"] + [f"coalesce({n}_raw, '')" for n in ("email", *_DATE_COLS)]
    )
    return f"""
      SELECT *, '{RUN_ID}' AS run_id, error_code = '' AS is_valid, sha256({key}) AS record_id FROM (
        SELECT *, {error_code} AS error_code, {description} AS error_description FROM (
          SELECT *, {flags} FROM {source}) AS f
      ) AS c"""


_VISIT_COLUMNS = (
    f"run_id, record_id, file_id, source_file, source_line, {_FIELD_LIST}, "
    "CAST(year(fecha_envio) AS INTEGER) AS event_year, "
    "CAST(month(fecha_envio) AS INTEGER) AS event_month"
)
_REJECTS = """
  SELECT file_id, run_id, record_id, c.source_file AS file_name, c.source_line AS line_number,
    CASE WHEN n_fields = 0 THEN NULL WHEN n_fields <> 15 THEN f1 WHEN f1 <> '' THEN email END AS email,
    error_code, error_description, l.raw_record
  FROM strict AS c JOIN lines AS l ON l.event_id = c.event_id WHERE NOT is_valid"""


def _metrics(source: str, reference) -> str:
    year, month = reference.year, reference.month
    return f"""
      SELECT email, CAST(min(fecha_envio) AS DATE) AS fecha_primera_visita,
        CAST(max(fecha_envio) AS DATE) AS fecha_ultima_visita, count(*) AS visitas_totales,
        count(*) FILTER (year(fecha_envio) = {year}) AS visitas_anio_actual,
        count(*) FILTER (year(fecha_envio) = {year} AND month(fecha_envio) = {month})
          AS visitas_mes_actual
      FROM {source} GROUP BY email"""


_CTES = {
    "fields": feeds.duckdb_cte("fields", feeds.FIELDS),
    "lines": feeds.duckdb_cte("lines", feeds.LINES),
    "strict_norm": f"strict_norm AS ({_normalized(True)})",
    "lenient_norm": f"lenient_norm AS ({_normalized(False)})",
    "strict": f"strict AS ({_checked(True)})",
    "lenient": f"lenient AS ({_checked(False)})",
    "visits": f"visits AS (SELECT ts, {_VISIT_COLUMNS} FROM strict WHERE is_valid)",
    "rejects": f"rejects AS ({_REJECTS})",
    "landing": feeds.duckdb_cte("landing", feeds.LANDING),
    "file_rows": feeds.duckdb_cte("file_rows", feeds.FILE_CONTROL),
    "files": """files AS (SELECT * EXCLUDE (content_key, records_clean),
      sha256(content_key) AS checksum_sha256 FROM file_rows)""",
    "registered": feeds.duckdb_cte("registered", feeds.RUNS),
    "headers": feeds.duckdb_cte("headers", feeds.HEADERS),
    "metrics": """metrics AS (SELECT run_id, count(*) AS files_detected,
      count(*) FILTER (status IN ('PREPARED', 'LOADED', 'BACKED_UP', 'SUCCESS', 'REJECTED_LAYOUT',
        'FAILED')) AS files_processed,
      count(*) FILTER (status = 'SUCCESS') AS files_success,
      count(*) FILTER (status = 'REJECTED_LAYOUT') AS files_rejected,
      count(*) FILTER (status = 'FAILED') AS files_failed,
      CAST(sum(records_read) AS BIGINT) AS records_read,
      CAST(sum(records_valid) AS BIGINT) AS records_valid,
      CAST(sum(records_invalid) AS BIGINT) AS records_invalid,
      CAST(sum(records_loaded) AS BIGINT) AS records_loaded FROM files GROUP BY run_id)""",
    "final": """final AS (SELECT r.run_id, CASE
        WHEN count(*) FILTER (f.status IN ('FAILED', 'PENDING_BACKUP', 'PENDING_SOURCE_DELETE')) > 0
          THEN 'FAILED'
        WHEN count(*) FILTER (f.status = 'REJECTED_LAYOUT') > 0 THEN 'PARTIAL_SUCCESS'
        ELSE 'SUCCESS' END AS final_status
      FROM registered AS r LEFT JOIN files AS f ON f.run_id = r.run_id GROUP BY r.run_id)""",
}
_COUNTERS = [
    "files_detected", "files_processed", "files_success", "files_rejected", "files_failed",
    "records_read", "records_valid", "records_invalid", "records_loaded",
]
_COUNTER_LIST = ", ".join(_COUNTERS)
_ZEROED = ", ".join(f"coalesce({c}, 0) AS {c}" for c in _COUNTERS)
_CTES["runs"] = f"""runs AS (SELECT r.*, {_ZEROED},
  CASE WHEN end_time IS NULL THEN 'RUNNING' ELSE final_status END AS status
  FROM registered AS r LEFT JOIN metrics AS m ON m.run_id = r.run_id
  JOIN final ON final.run_id = r.run_id)"""

# What each common table expression reads, in an order that can be declared.
_NEEDS = {
    "strict_norm": ["fields"], "lenient_norm": ["fields"], "strict": ["strict_norm"],
    "lenient": ["lenient_norm"], "visits": ["strict"], "rejects": ["strict", "lines"],
    "files": ["file_rows"], "metrics": ["files"], "final": ["registered", "files"],
    "runs": ["registered", "metrics", "final"],
}


def with_ctes(names: str, body: str) -> str:
    """The body after the named expressions and all they need."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, []):
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        add(name)
    return f"WITH {', '.join(_CTES[n] for n in ordered)} {body}"


_KEY = "source_file, source_line"
_SEVERITY = """CASE WHEN status IN ('SUCCESS', 'SKIPPED_ALREADY_PROCESSED') THEN 'INFO'
  WHEN status = 'REJECTED_LAYOUT' THEN 'WARNING'
  WHEN status IN ('PENDING_BACKUP', 'PENDING_SOURCE_DELETE') THEN 'ERROR'
  WHEN error_code = 'RECONCILIATION_ERROR' THEN 'CRITICAL'
  WHEN status = 'FAILED' THEN 'ERROR' ELSE 'WARNING' END"""
_CATEGORY = """CASE WHEN status = 'SUCCESS' THEN 'NONE'
  WHEN status = 'SKIPPED_ALREADY_PROCESSED' THEN 'IDEMPOTENCY'
  WHEN status = 'REJECTED_LAYOUT' THEN 'DATA_QUALITY'
  WHEN status IN ('PENDING_BACKUP', 'PENDING_SOURCE_DELETE') THEN 'OPERATIONAL'
  WHEN error_code = 'RECONCILIATION_ERROR' THEN 'INTEGRITY' ELSE 'TECHNICAL' END"""
_PERCENT = "CASE WHEN {1} > 0 THEN ((20000 * {0} + {1}) // (2 * {1})) / 100.0::DOUBLE ELSE 0::DOUBLE END"
_EXPECTED = ", ".join(f"'{c}'" for c in layout.REPORT_COLUMNS)
_HEADER_DIFF = f"""SELECT file_name, n, 'column ' || CAST(n AS VARCHAR) || ': expected ''' || wanted
    || ''', found ''' || given || '''' AS difference
  FROM (SELECT file_name, unnest(range(1, 16)) AS n, unnest([{_EXPECTED}]) AS wanted,
      unnest(string_split(header_line, ',')) AS given
    FROM headers WHERE header_line IS NOT NULL AND header_line <> ''
      AND len(string_split(header_line, ',')) = 15) AS u
  WHERE given <> wanted"""
_LOADED = "('LOADED', 'BACKED_UP', 'PENDING_SOURCE_DELETE', 'SUCCESS')"
_MERGED = f"""
  SELECT * FROM ({_metrics('visits', REFERENCE)}) AS fresh
  WHERE email IN (SELECT email FROM visits WHERE ts >= TIMESTAMP '{feeds.SPLIT_AT}')
  UNION ALL
  SELECT * FROM ({_metrics(f"(SELECT * FROM visits WHERE ts < TIMESTAMP '{feeds.SPLIT_AT}') AS h",
                           HISTORY_REFERENCE)}) AS old
  WHERE email NOT IN (SELECT email FROM visits WHERE ts >= TIMESTAMP '{feeds.SPLIT_AT}')"""
_MONTHLY_SUMS = ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in _COUNTERS)
_ISSUES = "error_code, error_message"

ORACLES: dict[str, str] = {
    "norm_optional_text": with_ctes("strict_norm", f"SELECT {_KEY}, {', '.join(_TEXT_COLS)} FROM strict_norm"),
    "norm_counters": with_ctes(
        "strict_norm",
        f"SELECT {_KEY}, {', '.join(f'{n}_raw, {n}' for n in _COUNTER_COLS)} FROM strict_norm",
    ),
    "norm_email": with_ctes("strict_norm", f"SELECT {_KEY}, email FROM strict_norm"),
    "parse_dates": with_ctes(
        "strict_norm",
        f"SELECT {_KEY}, {', '.join(f'{n}_raw, {n}' for n in _DATE_COLS)}, "
        + ", ".join(
            f"CASE WHEN n_fields > 0 THEN {_date(_space(c), False)} END AS {n}_lenient"
            for n, c in _DATE_COLS.items()
        )
        + " FROM strict_norm",
    ),
    "record_fingerprint": with_ctes("lenient", f"SELECT {_KEY}, record_id FROM lenient"),
    "email_rule_strict": with_ctes("strict", f"SELECT {_KEY}, NOT bad_email AS email_ok FROM strict"),
    "email_rule_lenient": with_ctes("lenient", f"SELECT {_KEY}, NOT bad_email AS email_ok FROM lenient"),
    "record_validation_strict": with_ctes("strict", f"SELECT {_KEY}, error_code, is_valid FROM strict"),
    "record_validation_lenient": with_ctes("lenient", f"SELECT {_KEY}, error_code, is_valid FROM lenient"),
    "error_descriptions": with_ctes("strict", f"SELECT {_KEY}, error_description FROM strict"),
    "estadistica": with_ctes("visits", "SELECT * EXCLUDE (ts) FROM visits"),
    "estadistica_lenient": with_ctes("lenient", f"SELECT {_VISIT_COLUMNS} FROM lenient WHERE is_valid"),
    "errores": with_ctes("rejects", "SELECT * FROM rejects"),
    "errores_lenient": with_ctes(
        "lenient",
        "SELECT run_id, record_id, source_file, CASE WHEN f1 <> '' THEN email_raw END AS email, "
        "error_code AS error_codes, "
        + ", ".join(f"CASE WHEN {c} <> '' THEN {n}_raw END AS {n}_raw" for n, c in _DATE_COLS.items())
        + ", " + ", ".join(f"{n}_raw" for n in _COUNTER_COLS)
        + f", DATE '{REFERENCE}' AS processing_date FROM lenient WHERE NOT is_valid",
    ),
    "visitors_rebuild": with_ctes("visits", _metrics("visits", REFERENCE)),
    "visitors_from_activity": with_ctes("visits", _metrics("visits", REFERENCE)),
    "affected_emails": with_ctes("visits", "SELECT DISTINCT source_file, email FROM visits"),
    "visitors_incremental": with_ctes(
        "visits",
        f"SELECT * FROM ({_metrics('visits', REFERENCE)}) AS m WHERE email IN "
        f"(SELECT email FROM visits WHERE ts >= TIMESTAMP '{feeds.SPLIT_AT}')",
    ),
    "visitors_merged": with_ctes("visits", _MERGED),
    "visitor_upsert_counts": with_ctes(
        "visits rejects",
        """, known AS (SELECT DISTINCT email FROM visits
             WHERE fecha_envio < TIMESTAMP '2023-01-01 00:00:00'),
           firsts AS (SELECT email, min(file_id) AS first_file FROM visits GROUP BY email),
           pairs AS (SELECT DISTINCT file_id, v.email, file_id = first_file
               AND v.email NOT IN (SELECT email FROM known) AS fresh
             FROM visits AS v JOIN firsts ON firsts.email = v.email)
           SELECT f.file_id,
             (SELECT count(*) FROM visits AS v WHERE v.file_id = f.file_id) AS statistics_inserted,
             (SELECT count(*) FROM rejects AS r WHERE r.file_id = f.file_id) AS errors_inserted,
             (SELECT count(*) FROM pairs AS p WHERE p.file_id = f.file_id AND fresh)
               AS visitors_inserted,
             (SELECT count(*) FROM pairs AS p WHERE p.file_id = f.file_id AND NOT fresh)
               AS visitors_updated,
             (SELECT count(*) FROM visits AS v WHERE v.file_id = f.file_id) AS records_loaded
           FROM (SELECT DISTINCT file_id FROM strict) AS f""",
    ),
    "error_distribution": with_ctes(
        "rejects",
        "SELECT file_name, error_code, count(*) AS total FROM rejects GROUP BY file_name, error_code",
    ),
    "reject_detail": with_ctes("rejects", "SELECT * EXCLUDE (record_id) FROM rejects"),
    "batch_reconciliation": with_ctes(
        "strict",
        """SELECT count(*) AS records_read, count(*) FILTER (is_valid) AS records_valid,
          count(*) FILTER (NOT is_valid) AS records_invalid,
          count(DISTINCT CASE WHEN is_valid THEN email END) AS visitors,
          true AS reconciled FROM strict""",
    ),
    "file_metrics": with_ctes(
        "strict",
        """SELECT source_file, count(*) AS records_read, count(*) FILTER (is_valid) AS records_valid,
          count(*) FILTER (NOT is_valid) AS records_invalid FROM strict GROUP BY source_file""",
    ),
    "load_reconciliation": with_ctes(
        "strict",
        """SELECT *, CASE WHEN statistics_rows <> records_valid OR errors_rows <> records_invalid
            THEN 'RECONCILIATION_ERROR' END AS error_code
          FROM (SELECT file_id, count(*) AS records_read, count(*) FILTER (is_valid) AS records_valid,
            count(*) FILTER (NOT is_valid) AS records_invalid,
            count(*) FILTER (is_valid AND coalesce(plataformas, '') <> 'Android') AS statistics_rows,
            count(*) FILTER (NOT is_valid AND error_code <> 'INVALID_INTEGER') AS errors_rows
          FROM strict GROUP BY file_id) AS c""",
    ),
    "load_verdicts": with_ctes(
        "strict rejects",
        """, counted AS (SELECT file_id, count(*) AS records_read,
             count(*) FILTER (is_valid) AS records_valid, count(*) FILTER (NOT is_valid) AS records_invalid,
             count(*) FILTER (is_valid AND coalesce(plataformas, '') <> 'Android') AS statistics_rows,
             count(*) FILTER (is_valid AND coalesce(plataformas, '') <> 'Android'
               AND length(coalesce(links, baja)) > 20) AS wide_visits FROM strict GROUP BY file_id),
           refused AS (SELECT file_id, count(*) AS n,
             count(*) FILTER (error_code = 'INVALID_INTEGER') AS twice,
             sum((length(coalesce(email, '')) > 320)::INT + (length(error_description) > 1000)::INT) AS wide,
             sum(CASE WHEN error_code = 'INVALID_INTEGER' THEN (length(coalesce(email, '')) > 320)::INT
               + (length(error_description) > 1000)::INT ELSE 0 END) AS wide_twice
             FROM rejects GROUP BY file_id),
           told AS (SELECT c.file_id, records_read, records_valid, records_invalid, statistics_rows,
             coalesce(n + twice, 0) AS errors_rows,
             CASE WHEN twice > 0 THEN twice END AS duplicate_lines,
             CAST(nullif(wide_visits + coalesce(wide + wide_twice, 0), 0) AS BIGINT) AS refused_values
             FROM counted AS c LEFT JOIN refused AS r ON r.file_id = c.file_id)
           SELECT *, CASE WHEN statistics_rows <> records_valid OR errors_rows <> records_invalid
             THEN 'RECONCILIATION_ERROR' END AS error_code FROM told""",
    ),
    "file_layout_validation": with_ctes(
        "headers",
        f""", diffs AS ({_HEADER_DIFF}),
        listed AS (SELECT file_name, string_agg('"' || difference || '"', ', ' ORDER BY n) AS texts
          FROM diffs GROUP BY file_name),
        sized AS (SELECT h.*, texts, CASE WHEN header_line = '' THEN 0
            ELSE len(string_split(header_line, ',')) END AS width
          FROM headers AS h LEFT JOIN listed ON listed.file_name = h.file_name),
        coded AS (SELECT *, CASE WHEN file_name LIKE 'visitas%' THEN 'INVALID_FILENAME'
            WHEN file_size IS NULL OR file_size = 0 THEN 'EMPTY_FILE'
            WHEN width <> 15 THEN 'INVALID_COLUMN_COUNT'
            WHEN texts IS NOT NULL THEN 'INVALID_HEADER' END AS layout_code FROM sized)
        SELECT file_name, file_path, file_size, header_line, layout_code IS NULL AS layout_ok,
          layout_code, CASE layout_code
            WHEN 'INVALID_FILENAME' THEN 'Invalid file name ''' || file_name
              || '''. Expected pattern report_<number>.txt'
            WHEN 'EMPTY_FILE' THEN CASE WHEN file_size = 0 THEN 'File is empty: ' || file_name
              ELSE 'File does not exist: ' || file_path END
            WHEN 'INVALID_COLUMN_COUNT' THEN 'Expected 15 columns, found '
              || CAST(width AS VARCHAR) || ' in file ' || file_name
            WHEN 'INVALID_HEADER' THEN 'Invalid header in file ' || file_name
              || '. Differences: [' || texts || ']' END AS layout_message
        FROM coded""",
    ),
    "header_differences": with_ctes(
        "headers", f"SELECT file_name, difference FROM ({_HEADER_DIFF}) AS d"
    ),
    "already_processed_lookup": with_ctes(
        "files",
        f""", known AS (SELECT checksum_sha256, max(file_id) AS id, arg_max(run_id, file_id) AS run
             FROM files WHERE status IN {_LOADED} GROUP BY checksum_sha256)
           SELECT file_id, f.checksum_sha256, CASE WHEN id <> file_id THEN id END AS original_file_id,
             CASE WHEN id <> file_id THEN run END AS original_run_id,
             coalesce(id <> file_id, false) AS already_processed
           FROM files AS f LEFT JOIN known ON known.checksum_sha256 = f.checksum_sha256""",
    ),
    "file_disposition": with_ctes(
        "files",
        f""", known AS (SELECT checksum_sha256, max(file_id) AS id, arg_max(run_id, file_id) AS run
             FROM files WHERE load_finished_at IS NOT NULL
               AND detected_at < TIMESTAMP '{feeds.FILE_SPLIT}' GROUP BY checksum_sha256),
           fresh AS (SELECT f.*, id, run, first_name FROM files AS f
             LEFT JOIN known ON known.checksum_sha256 = f.checksum_sha256
             JOIN (SELECT checksum_sha256, min(file_name) FILTER (status <> 'REJECTED_LAYOUT'
                 AND file_id % 29 NOT IN (3, 4) AND file_id % 31 <> 6) AS first_name FROM files
               WHERE detected_at >= TIMESTAMP '{feeds.FILE_SPLIT}' GROUP BY checksum_sha256) AS b
               ON b.checksum_sha256 = f.checksum_sha256
             WHERE detected_at >= TIMESTAMP '{feeds.FILE_SPLIT}'),
           staged AS (SELECT *, CASE
               WHEN file_id % 29 = 3 THEN 'missing' WHEN file_id % 29 = 4 THEN 'size'
               WHEN id IS NOT NULL THEN 'seen' WHEN first_name <> file_name THEN 'twin'
               WHEN status = 'REJECTED_LAYOUT' THEN 'layout' WHEN file_id % 31 = 6 THEN 'utf8'
               WHEN records_read <> records_valid + records_invalid THEN 'sum'
               WHEN file_id % 23 = 5 THEN 'archive' WHEN file_id % 7 = 2 THEN 'kept'
               WHEN file_id % 7 = 1 THEN 'delete' ELSE 'done' END AS step FROM fresh)
           SELECT file_id, file_name,
             CASE WHEN step IN ('missing', 'size', 'utf8', 'sum') THEN 'FAILED'
               WHEN step IN ('seen', 'twin') THEN 'SKIPPED_ALREADY_PROCESSED'
               WHEN step = 'layout' THEN 'REJECTED_LAYOUT' WHEN step = 'archive' THEN 'PENDING_BACKUP'
               WHEN step = 'kept' THEN 'BACKED_UP' WHEN step = 'delete' THEN 'PENDING_SOURCE_DELETE'
               ELSE 'SUCCESS' END AS status,
             CASE WHEN step IN ('missing', 'size') THEN 'StagingError'
               WHEN step IN ('seen', 'twin') THEN 'ALREADY_PROCESSED'
               WHEN step = 'layout' THEN error_code WHEN step = 'utf8' THEN 'UnicodeDecodeError'
               WHEN step = 'sum' THEN 'RECONCILIATION_ERROR' WHEN step = 'archive' THEN 'BACKUP_ERROR'
               WHEN step = 'delete' THEN 'SFTP_DELETE_ERROR' END AS error_code,
             CASE step WHEN 'missing' THEN 'Downloaded file was not created: ' || file_name
               WHEN 'size' THEN 'File size mismatch after download. File=' || file_name
               WHEN 'seen' THEN 'File content was already processed successfully. Original file_id='
                 || CAST(id AS VARCHAR) || ', original run_id=' || run
               WHEN 'twin' THEN 'Same content in this batch as file ' || first_name
               WHEN 'layout' THEN error_message
               WHEN 'utf8' THEN 'File is not valid UTF-8: ' || file_name
               WHEN 'sum' THEN 'Record reconciliation failed. File=' || file_name || ', read='
                 || CAST(records_read AS VARCHAR) || ', valid=' || CAST(records_valid AS VARCHAR)
                 || ', invalid=' || CAST(records_invalid AS VARCHAR)
               WHEN 'archive' THEN 'Archive check failed: CHECKSUM_MISMATCH'
               WHEN 'delete' THEN 'Source not deleted: ' || file_name END AS error_message
           FROM staged""",
    ),
    "loadable_records": with_ctes(
        "lines",
        f"SELECT {_KEY}, raw_record FROM lines WHERE (file_no + 1) % 11 NOT IN (3, 6, 8)",
    ),
    "file_state_fold": with_ctes(
        "files",
        """, parts AS (SELECT *, status IN ('BACKED_UP', 'PENDING_SOURCE_DELETE', 'SUCCESS') AS kept,
             status NOT IN ('DETECTED', 'STAGED', 'SKIPPED_ALREADY_PROCESSED', 'REJECTED_LAYOUT')
               AS parsed,
             status NOT IN ('DETECTED', 'STAGED', 'PREPARED', 'LOADED', 'BACKED_UP', 'SUCCESS')
               AS ended FROM files)
           SELECT file_id, run_id, file_name, source_path,
             CASE WHEN status <> 'DETECTED' THEN file_size END AS file_size,
             CASE WHEN status <> 'DETECTED' THEN checksum_sha256 END AS checksum_sha256,
             backup_uri, status, error_code, error_message,
             CASE WHEN parsed THEN records_read ELSE 0 END AS records_read,
             CASE WHEN parsed THEN records_valid ELSE 0 END AS records_valid,
             CASE WHEN parsed THEN records_invalid ELSE 0 END AS records_invalid,
             records_loaded, detected_at, staged_at, load_finished_at, backup_at, source_deleted_at,
             greatest(detected_at, staged_at,
               CASE WHEN parsed THEN detected_at + INTERVAL 3 MINUTE END, load_finished_at,
               backup_at, source_deleted_at, CASE WHEN ended THEN updated_at END) AS updated_at,
             CAST(CASE WHEN parsed AND file_id % 5 = 0 THEN 1 ELSE 0 END AS BIGINT) AS retry_count
           FROM parts""",
    ),
    "run_state_fold": with_ctes(
        "registered",
        """SELECT run_id, dag_id, execution_date, start_time, end_time,
             CASE WHEN end_time IS NULL THEN 'RUNNING' WHEN minute(start_time) % 3 = 0 THEN 'FAILED'
               ELSE 'SUCCESS' END AS status,
             CASE WHEN end_time IS NOT NULL AND minute(start_time) % 3 = 0 THEN 'RuntimeError' END
               AS error_code,
             CAST(NULL AS VARCHAR) AS error_message FROM registered""",
    ),
    "run_metrics": with_ctes(
        "registered metrics",
        "SELECT r.*, "
        + ", ".join(f"coalesce(m.{c}, length(r.run_id) + {i}) AS {c}" for i, c in enumerate(_COUNTERS))
        + " FROM registered AS r LEFT JOIN metrics AS m ON m.run_id = r.run_id",
    ),
    "run_counters_merged": with_ctes("metrics", "SELECT * FROM metrics"),
    "run_final_status": with_ctes("final", "SELECT run_id, final_status FROM final"),
    "purge_candidates": with_ctes(
        "files",
        """SELECT file_id, run_id, file_name, source_path, backup_uri, backup_at FROM files
           WHERE load_finished_at IS NOT NULL AND backup_at IS NOT NULL
             AND source_deleted_at IS NULL AND file_id % 13 NOT IN (2, 3)""",
    ),
    "listing_changes": with_ctes(
        "files",
        """SELECT '/landing/even/' || CAST(file_id AS VARCHAR) || '/' || file_name AS file_path,
             CASE WHEN file_id % 5 = 0 THEN 'appeared' WHEN file_id % 3 = 2 THEN 'gone'
               WHEN file_id % 3 = 1 THEN 'replaced' ELSE 'same' END AS change
           FROM files WHERE file_id % 2 = 0 AND NOT (file_id % 5 = 0 AND file_id % 3 = 2)""",
    ),
    "deletion_settlement": with_ctes(
        "files",
        """SELECT file_id, CAST(20 AS BIGINT) AS seq, 'source_deleted' AS event,
             TIMESTAMP '2024-01-31 00:00:00' AS at, 'SUCCESS' AS status FROM files
           WHERE backup_at IS NOT NULL AND source_deleted_at IS NULL AND file_id % 2 = 0
             AND file_id % 5 <> 0 AND file_id % 3 <> 0""",
    ),
    "run_report_files": with_ctes(
        "files",
        f"""SELECT run_id, file_id, file_name, status, records_read, records_valid, records_invalid,
             records_loaded, backup_uri, backup_at, source_deleted_at, {_ISSUES} FROM files
           WHERE run_id = (SELECT max(run_id) FROM files)""",
    ),
    "run_report_statuses": with_ctes(
        "files",
        """SELECT run_id, file_id, status FROM files
           WHERE run_id = (SELECT max(run_id) FROM files)""",
    ),
    "run_report_summary": with_ctes(
        "runs",
        f"""SELECT run_id, dag_id, status, {_COUNTER_LIST}, start_time, end_time FROM runs
           WHERE run_id = (SELECT max(run_id) FROM files)""",
    ),
    "run_report_acceptance": with_ctes(
        "runs",
        """SELECT run_id, status, status IN ('SUCCESS', 'PARTIAL_SUCCESS') AS accepted FROM runs
           WHERE run_id = (SELECT max(run_id) FROM files)""",
    ),
    "run_report_alerts": with_ctes(
        "files",
        f"""SELECT * FROM (SELECT run_id, file_id, file_name, status, {_SEVERITY} AS severity,
             {_CATEGORY} AS category, {_ISSUES} FROM files
             WHERE run_id = (SELECT max(run_id) FROM files)) AS c WHERE severity <> 'INFO'""",
    ),
    "duplicate_key_check": """SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "append_without_duplicates": """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate
        FROM lineitem AS i WHERE l_shipdate >= TIMESTAMP '2000-06-01'
          AND (l_orderkey, l_linenumber) NOT IN (SELECT (l_orderkey, l_linenumber) FROM lineitem
            WHERE l_shipdate < TIMESTAMP '2000-06-01')
          AND (l_orderkey, l_linenumber) NOT IN (SELECT (l_orderkey, l_linenumber) FROM lineitem
            WHERE l_shipdate >= TIMESTAMP '2000-06-01' GROUP BY l_orderkey, l_linenumber
            HAVING count(*) > 1)""",
    "orphan_check": """SELECT user_id * 20 AS customer_id, count(*) AS child_rows FROM events
        WHERE user_id * 20 NOT IN (SELECT c_custkey FROM customer) GROUP BY user_id * 20""",
    "constraint_violations": """SELECT doc_id AS file_id, CAST(2 AS INTEGER) AS line_number,
          'error_description' AS column_name, 'width 1000' AS rule,
          CAST(length(text) AS INTEGER) AS length FROM documents WHERE length(text) > 1000
        UNION ALL
        SELECT doc_id, CAST(2 AS INTEGER), 'error_code', 'width 100', CAST(length(source) AS INTEGER)
          FROM documents WHERE length(source) > 100
        UNION ALL
        SELECT doc_id, CAST(2 AS INTEGER), 'file_name', 'not null', CAST(NULL AS INTEGER)
          FROM documents WHERE lang = 'fr' OR lang IS NULL OR source IS NULL""",
    "reconcile_files": with_ctes(
        "files",
        """SELECT file_id, file_name, records_read, records_valid, records_invalid FROM files
           WHERE records_read <> records_valid + records_invalid""",
    ),
    "reconcile_loads": with_ctes(
        "files",
        f"""SELECT file_id, file_name, status, records_valid, records_loaded FROM files
           WHERE status IN {_LOADED} AND records_valid <> records_loaded""",
    ),
    "success_without_backup": with_ctes(
        "files",
        """SELECT file_id, file_name, backup_uri, backup_at FROM files
           WHERE status = 'SUCCESS' AND (backup_uri IS NULL OR backup_at IS NULL)""",
    ),
    "unsafe_deletions": with_ctes(
        "files",
        """SELECT file_id, file_name, backup_at, source_deleted_at FROM files
           WHERE backup_at IS NOT NULL AND source_deleted_at IS NOT NULL
             AND source_deleted_at < backup_at""",
    ),
    "success_contract": with_ctes(
        "files",
        """SELECT file_id, file_name, backup_at, backup_uri, source_deleted_at FROM files
           WHERE status = 'SUCCESS' AND (backup_at IS NULL OR backup_uri IS NULL
             OR source_deleted_at IS NULL OR source_deleted_at < backup_at)""",
    ),
    "run_operational_summary": with_ctes(
        "runs",
        f"""SELECT run_id, dag_id, execution_date, start_time, end_time, status, {_COUNTER_LIST},
             date_sub('second', start_time, end_time) AS duration_seconds,
             {_PERCENT.format('files_success', 'files_detected')} AS file_success_percentage,
             {_PERCENT.format('records_invalid', 'records_read')} AS invalid_record_percentage,
             CASE WHEN end_time IS NOT NULL AND minute(start_time) % 3 = 0 THEN 'RuntimeError' END
               AS error_code,
             CAST(NULL AS VARCHAR) AS error_message, start_time AS created_at,
             coalesce(end_time, start_time) AS updated_at
           FROM runs""",
    ),
    "file_operational_detail": with_ctes(
        "files registered",
        """SELECT f.*, dag_id, CASE f.status WHEN 'SUCCESS' THEN 'OK'
             WHEN 'REJECTED_LAYOUT' THEN 'DATA_QUALITY'
             WHEN 'SKIPPED_ALREADY_PROCESSED' THEN 'IDEMPOTENCY'
             WHEN 'PENDING_BACKUP' THEN 'OPERATIONAL_ACTION_REQUIRED'
             WHEN 'PENDING_SOURCE_DELETE' THEN 'OPERATIONAL_ACTION_REQUIRED'
             WHEN 'FAILED' THEN 'TECHNICAL_FAILURE' ELSE 'IN_PROGRESS' END AS operational_category
           FROM files AS f JOIN registered AS r ON r.run_id = f.run_id""",
    ),
    "monthly_summary": with_ctes(
        "runs",
        f"""SELECT strftime(execution_date, '%Y-%m') AS processing_month, count(*) AS total_runs,
             {_MONTHLY_SUMS}, count(*) FILTER (status = 'SUCCESS') AS successful_runs,
             count(*) FILTER (status = 'PARTIAL_SUCCESS') AS partial_success_runs,
             count(*) FILTER (status = 'FAILED') AS failed_runs
           FROM runs GROUP BY strftime(execution_date, '%Y-%m')""",
    ),
    "monthly_report": with_ctes(
        "runs",
        """SELECT strftime(execution_date, '%Y-%m') AS periodo, count(*) AS ejecuciones,
             CAST(sum(files_detected) AS BIGINT) AS archivos_detectados,
             CAST(sum(files_processed) AS BIGINT) AS archivos_procesados,
             CAST(sum(files_success) AS BIGINT) AS archivos_exitosos,
             CAST(sum(files_rejected) AS BIGINT) AS archivos_rechazados,
             CAST(sum(files_failed) AS BIGINT) AS archivos_fallidos,
             CAST(sum(records_read) AS BIGINT) AS registros_leidos,
             CAST(sum(records_valid) AS BIGINT) AS registros_validos,
             CAST(sum(records_invalid) AS BIGINT) AS registros_invalidos,
             CAST(sum(records_loaded) AS BIGINT) AS registros_cargados
           FROM runs GROUP BY 1 ORDER BY 1""",
    ),
    "latest_runs": with_ctes(
        "runs",
        f"""SELECT run_id, dag_id, execution_date, start_time, end_time, status, {_COUNTER_LIST}
           FROM runs ORDER BY start_time DESC, run_id LIMIT 20""",
    ),
    "files_of_run": with_ctes(
        "files",
        f"""SELECT run_id, file_id, file_name, status, records_read, records_valid, records_invalid,
             records_loaded, backup_uri, backup_at, source_deleted_at, {_ISSUES} FROM files""",
    ),
    "file_statuses": with_ctes("files", "SELECT run_id, file_id, status FROM files"),
    "failed_files": with_ctes(
        "files",
        f"""SELECT file_id, run_id, file_name, status, {_ISSUES}, updated_at FROM files
           WHERE status = 'FAILED'""",
    ),
    "rejected_files": with_ctes(
        "files",
        f"""SELECT file_id, run_id, file_name, status, {_ISSUES}, updated_at FROM files
           WHERE status = 'REJECTED_LAYOUT'""",
    ),
    "run_summary": with_ctes(
        "runs", f"SELECT run_id, dag_id, status, {_COUNTER_LIST}, start_time, end_time FROM runs"
    ),
    "run_acceptance": with_ctes(
        "runs",
        "SELECT run_id, status, status IN ('SUCCESS', 'PARTIAL_SUCCESS') AS accepted FROM runs",
    ),
    "classify_incidents": with_ctes(
        "files",
        f"""SELECT run_id, file_id, status, {_SEVERITY} AS severity, {_CATEGORY} AS category,
             error_code FROM files""",
    ),
    "run_alerts": with_ctes(
        "files",
        f"""SELECT * FROM (SELECT run_id, file_id, file_name, status, {_SEVERITY} AS severity,
             {_CATEGORY} AS category, {_ISSUES} FROM files) AS c WHERE severity <> 'INFO'""",
    ),
    "alert_messages": with_ctes(
        "files",
        f"""SELECT file_id, severity, 'ETL_ALERT run_id=' || run_id || ' file_name=' || file_name
             || ' status=' || status || ' severity=' || severity || ' category=' || category
             || ' error_code=' || coalesce(error_code, 'None')
             || ' error_message=' || coalesce(error_message, 'None') AS message
           FROM (SELECT *, {_SEVERITY} AS severity, {_CATEGORY} AS category FROM files) AS c
           WHERE severity <> 'INFO'""",
    ),
}

# --- report files ---------------------------------------------------------------------------

_CTES["landing_fields"] = f"""landing_fields AS (
  SELECT {feeds._NAME} AS file_name, * EXCLUDE (source_file) FROM fields
  UNION ALL
  SELECT 'report_00' || CAST(file_no AS VARCHAR) AS file_name, * EXCLUDE (source_file)
  FROM fields WHERE file_no % 10 = 7)""".replace(
    "CAST(file_no AS VARCHAR) AS file_name", "CAST(file_no AS VARCHAR) || '.txt' AS file_name"
)
_NEEDS["landing_fields"] = ["fields"]
_CTES["contents"] = f"""contents AS (
  SELECT file_name, string_agg(raw_record, chr(10) ORDER BY source_line) || chr(10) AS content
  FROM landing GROUP BY file_name
  UNION ALL SELECT '{feeds.EMPTY_FILE}', '')"""
_NEEDS["contents"] = ["landing"]

_FIELD_SOURCES = dict(zip(layout.FIELD_NAMES, [f"f{i}" for i in range(1, 16)]))
ORACLES |= {
    "file_manifest": with_ctes(
        "contents", "SELECT file_name, strlen(content) AS size_bytes FROM contents"
    ),
    "candidate_files": with_ctes(
        "contents",
        r"""SELECT file_name, strlen(content) AS size_bytes FROM contents
           WHERE regexp_full_match(file_name, 'report_[0-9]+\.txt')""",
    ),
    "landing_glob_check": with_ctes(
        "contents",
        "SELECT file_name FROM contents WHERE file_name LIKE 'report%' AND file_name LIKE '%.txt'",
    ),
    "file_checksums": with_ctes(
        "contents",
        """SELECT file_name, strlen(content) AS size_bytes, sha256(content) AS checksum_sha256
           FROM contents""",
    ),
    "scan_csv_reports": with_ctes(
        "landing_fields",
        "SELECT file_name AS source_file, "
        + ", ".join(
            f"CASE WHEN {c} <> ''{' AND n_fields > 14' if c == 'f15' else ''} THEN {c} END AS {n}"
            for n, c in _FIELD_SOURCES.items()
        )
        + " FROM landing_fields WHERE n_fields > 0 AND file_name LIKE 'report%'",
    ),
    "scan_lines_numbered": with_ctes(
        "landing",
        """SELECT file_name, source_line AS line_number, raw_record FROM landing
           WHERE file_name LIKE 'report%'""",
    ),
    "staging_size_check": with_ctes(
        "contents",
        """SELECT CASE WHEN bytes % 7 = 0 THEN file_name || '.gone' ELSE file_name END AS file_name,
             bytes + CASE WHEN bytes % 5 = 0 THEN 1 ELSE 0 END AS size_bytes,
             CASE WHEN bytes % 7 <> 0 THEN bytes END AS staged_bytes,
             CASE WHEN bytes % 7 = 0 THEN 'MISSING' WHEN bytes % 5 = 0 THEN 'SIZE_MISMATCH'
               ELSE 'OK' END AS staging_state
           FROM (SELECT file_name, strlen(content) AS bytes FROM contents) AS s WHERE bytes > 0""",
    ),
    "archive_verification": with_ctes(
        "contents",
        f"""SELECT file_name, bytes AS size_bytes,
             regexp_replace(file_name, '\\.txt$', '') || '_{RUN_ID}.zip' AS archive_name,
             CASE WHEN bytes = 0 THEN 'OK' WHEN bytes % 7 = 0 THEN 'MISSING'
               WHEN bytes % 5 = 0 THEN 'EMPTY' WHEN bytes % 5 = 1 THEN 'CHECKSUM_MISMATCH'
               WHEN bytes % 5 = 3 THEN 'DUPLICATE_MEMBER' ELSE 'OK' END AS archive_state
           FROM (SELECT file_name, strlen(content) AS bytes FROM contents) AS s""",
    ),
    "roundtrip_estadistica": ORACLES["estadistica"],
    "roundtrip_errores": ORACLES["errores"],
    "roundtrip_visitante": ORACLES["visitors_rebuild"],
    "file_state_checkpoint": ORACLES["file_state_fold"],
    "batch_rerun_visits": with_ctes(
        "visits",
        """SELECT * EXCLUDE (ts, record_id, file_id) REPLACE (
             CASE WHEN file_id % 2 = 1 THEN 'run_even' ELSE 'run_odd' END AS run_id) FROM visits""",
    ),
    # Who is in an even report was met last by the run with the earlier reference day.
    "batch_rerun_visitors": with_ctes(
        "visits",
        f"""SELECT * FROM ({_metrics('visits', HISTORY_REFERENCE)}) AS met
           WHERE email IN (SELECT email FROM visits WHERE file_id % 2 = 1)
           UNION ALL SELECT * FROM ({_metrics('visits', REFERENCE)}) AS others
           WHERE email NOT IN (SELECT email FROM visits WHERE file_id % 2 = 1)""",
    ),
    # Ids go by name within a run, odd reports first; a visitor is new in the first file that has it.
    "batch_rerun_files": with_ctes(
        "strict",
        """, placed AS (SELECT file_id AS number, source_file, count(*) AS records_read,
             count(*) FILTER (is_valid) AS records_valid, count(*) FILTER (NOT is_valid) AS records_invalid,
             row_number() OVER (ORDER BY file_id % 2, source_file) AS file_id
             FROM strict GROUP BY strict.file_id, source_file),
           met AS (SELECT DISTINCT p.file_id, email FROM strict AS s JOIN placed AS p ON p.number = s.file_id
             WHERE is_valid),
           firsts AS (SELECT email, min(file_id) AS file_id FROM met GROUP BY email),
           brought AS (SELECT m.file_id, count(*) AS affected,
             count(*) FILTER (f.file_id = m.file_id) AS inserted
             FROM met AS m JOIN firsts AS f ON f.email = m.email GROUP BY m.file_id)
           SELECT p.file_id, CASE WHEN number % 2 = 1 THEN 'run_even' ELSE 'run_odd' END AS run_id,
             source_file AS file_name, 'BACKED_UP' AS status, records_read, records_valid, records_invalid,
             records_valid AS records_loaded, coalesce(inserted, 0) AS visitors_inserted,
             coalesce(affected - inserted, 0) AS visitors_updated, CAST(0 AS BIGINT) AS retry_count
           FROM placed AS p LEFT JOIN brought AS b ON b.file_id = p.file_id""",
    ),
}
