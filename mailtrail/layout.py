"""Fixed values of the report format and of the control tables."""

from __future__ import annotations

# --- fixed values: report layout -------------------------------------------------
REPORT_COLUMNS = [
    "email",
    "jyv",
    "Badmail",
    "Baja",
    "Fecha envio",
    "Fecha open",
    "Opens",
    "Opens virales",
    "Fecha click",
    "Clicks",
    "Clicks virales",
    "Links",
    "IPs",
    "Navegadores",
    "Plataformas",
]
REPORT_HEADER = ",".join(REPORT_COLUMNS)
REPORT_WIDTH = len(REPORT_COLUMNS)
REPORT_NAME_PATTERN = r"^report_[0-9]+\.txt\z"
REPORT_GLOB = "report_*.txt"

# Column names used inside the engine for the 15 source fields, same order as above.
FIELD_NAMES = [
    "email",
    "jyv",
    "badmail",
    "baja",
    "fecha_envio",
    "fecha_open",
    "opens",
    "opens_virales",
    "fecha_click",
    "clicks",
    "clicks_virales",
    "links",
    "ips",
    "navegadores",
    "plataformas",
]
TEXT_FIELDS = ["jyv", "badmail", "baja", "links", "ips", "navegadores", "plataformas"]
COUNTER_FIELDS = ["opens", "opens_virales", "clicks", "clicks_virales"]
DATE_FIELDS = ["fecha_envio", "fecha_open", "fecha_click"]

# --- fixed values: e-mail rules --------------------------------------------------
EMAIL_STRICT = (
    r"^[A-Za-z0-9.!#$%&'*+/=?^_`{|}~-]+@"
    r"[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?"
    r"(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?)+\z"
)
EMAIL_LENIENT = r"^[A-Za-z0-9.!#$%&'*+/=?^_`{|}~-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+$"

# --- fixed values: file statuses -------------------------------------------------
LOADED_STATUSES = ["LOADED", "BACKED_UP", "PENDING_SOURCE_DELETE", "SUCCESS"]
PROCESSED_STATUSES = ["PREPARED", "LOADED", "BACKED_UP", "SUCCESS", "REJECTED_LAYOUT", "FAILED"]
PENDING_STATUSES = ["PENDING_BACKUP", "PENDING_SOURCE_DELETE"]
RUN_FAILING_STATUSES = ["FAILED", "PENDING_BACKUP", "PENDING_SOURCE_DELETE"]
ACCEPTED_RUN_STATUSES = ["SUCCESS", "PARTIAL_SUCCESS"]

# --- fixed values: table constraints (column -> widest value; NOT NULL columns) --
WIDTHS = {
    "estadistica": {
        "run_id": 255, "email": 320, "jyv": 255, "badmail": 50, "baja": 20, "source_file": 255,
    },
    "errores": {
        "run_id": 255, "file_name": 255, "email": 320, "error_code": 100,
        "error_description": 1000,
    },
    "visitante": {"email": 320},
    "run_control": {"run_id": 255, "dag_id": 255, "status": 50, "error_code": 100},
    "file_control": {
        "run_id": 255, "file_name": 255, "source_path": 1000, "checksum_sha256": 64,
        "status": 100, "staging_uri": 1000, "backup_uri": 1000, "error_code": 100,
    },
}
NOT_NULL = {
    "estadistica": [
        "file_id", "run_id", "email", "fecha_envio", "opens", "opens_virales", "clicks",
        "clicks_virales", "source_file", "source_line",
    ],
    "errores": [
        "file_id", "run_id", "file_name", "line_number", "error_code", "error_description",
        "raw_record",
    ],
    "visitante": [
        "email", "fecha_primera_visita", "fecha_ultima_visita", "visitas_totales",
        "visitas_anio_actual", "visitas_mes_actual",
    ],
    "run_control": ["run_id", "dag_id", "execution_date", "start_time", "status"],
    "file_control": ["file_id", "run_id", "file_name", "source_path", "detected_at", "status"],
}
UNIQUE_KEYS = {
    "estadistica": ["file_id", "source_line"],
    "errores": ["file_id", "line_number"],
    "visitante": ["email"],
    "run_control": ["run_id"],
    "file_control": ["file_id"],
}
