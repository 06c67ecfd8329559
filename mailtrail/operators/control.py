"""Run and file control as append-only events, folded to the current state.

Events carry a sequence number per run or file; the state is the fold of the events, so
nothing is ever updated in place and a hot run or file is combined on the map side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import layout
from ..sources.lines import written

RUN_COUNTERS = [
    "files_detected", "files_processed", "files_success", "files_rejected", "files_failed",
    "records_read", "records_valid", "records_invalid", "records_loaded",
]
RECORD_COUNTERS = ["records_read", "records_valid", "records_invalid", "records_loaded"]

# One wide event table per entity; a column an event does not set is null.
RUN_EVENT_SCHEMA = (
    "run_id string, seq bigint, event string, at timestamp_ntz, dag_id string, "
    "execution_date timestamp_ntz, status string, error_code string, error_message string"
)
FILE_EVENT_SCHEMA = (
    "file_id bigint, seq bigint, event string, at timestamp_ntz, run_id string, "
    "file_name string, source_path string, file_size bigint, checksum_sha256 string, "
    "staging_uri string, backup_uri string, status string, error_code string, "
    "error_message string, records_read bigint, records_valid bigint, records_invalid bigint, "
    "records_loaded bigint, visitors_inserted bigint, visitors_updated bigint, "
    "source_modified_at timestamp_ntz"
)
# event -> the time column it sets
FILE_EVENT_TIMES = {
    "detected": "detected_at",
    "staged": "staged_at",
    "validation_started": "validation_started_at",
    "validation_finished": "validation_finished_at",
    "load_started": "load_started_at",
    "load_finished": "load_finished_at",
    "backed_up": "backup_at",
    "source_deleted": "source_deleted_at",
}


def event(schema: str, condition: Column, **given: Column) -> Column:
    """One event row when the condition holds; columns it does not give are null."""
    fields = [part.strip().split(" ") for part in schema.split(",")]
    row = F.struct(*[given.get(n, F.lit(None)).cast(kind).alias(n) for n, kind in fields])
    return F.when(condition, row)


def _last(name: str) -> Column:
    """The newest value an event gave for a column."""
    seq = F.when(F.col(name).isNotNull(), F.col("seq"))
    return F.max_by(name, seq).alias(name)


def _first(name: str) -> Column:
    """The oldest value an event gave for a column: what a file was registered with stays."""
    seq = F.when(F.col(name).isNotNull(), F.col("seq"))
    return F.min_by(name, seq).alias(name)


def _last_of(name: str, events: list[str]) -> Column:
    """The column of the newest of these events, null included."""
    seq = F.when(F.col("event").isin(events), F.col("seq"))
    return F.max_by(name, seq).alias(name)


def fold_runs(events: DataFrame) -> DataFrame:
    """Current state of every run: registered -> RUNNING, finished -> its final status."""
    return events.groupBy("run_id").agg(
        _last("dag_id"),
        _last("execution_date"),
        F.max(F.when(F.col("event") == "started", F.col("at"))).alias("start_time"),
        F.max(F.when(F.col("event") == "finished", F.col("at"))).alias("end_time"),
        _last("status"),
        _last("error_code"),
        _last("error_message"),
        F.min("at").alias("created_at"),
        F.max("at").alias("updated_at"),
    )


FIRST_SET = ["run_id", "file_name", "source_path"]
LAST_SET = [
    "file_size", "checksum_sha256", "staging_uri", "backup_uri", "status", "records_read",
    "records_valid", "records_invalid", "records_loaded", "visitors_inserted",
    "visitors_updated", "source_modified_at",
]


def partial_files(events: DataFrame) -> DataFrame:
    """What events tell of their files, to be finished or taken on by later events.

    A ``status`` event replaces code and message, with null when it gives none; the other
    events leave them alone. The folded texts need sorted input, so the events, a handful per
    file, are brought together and sorted once; the aggregation then streams over them.
    """
    events = events.repartition("file_id").sortWithinPartitions("file_id")
    times = [
        F.max(F.when(F.col("event") == event, F.col("at"))).alias(column)
        for event, column in FILE_EVENT_TIMES.items()
    ]
    return events.groupBy("file_id").agg(
        *[_first(c) for c in FIRST_SET], *[_last(c) for c in LAST_SET],
        *[_last_of(c, ["status"]) for c in ("error_code", "error_message")],
        *times,
        F.min("at").alias("created_at"),
        F.max("at").alias("updated_at"),
        F.count_if(F.col("event") == "retried").alias("retry_count"),
        F.coalesce(F.bool_or(F.col("event") == "status"), F.lit(False)).alias("has_status"),
    )


def updated_files(state: DataFrame, later: DataFrame) -> DataFrame:
    """Partial state taken on by that of later events.

    Later events of a file that the state knows never detect it: they are few, and the state
    stays where it lies while they are small enough to be sent to it.
    """
    new = {c: F.col(f"_{c}") for c in state.columns}
    updates = later.filter("detected_at IS NULL").select(
        "file_id", *[F.col(c).alias(f"_{c}") for c in state.columns if c != "file_id"]
    )
    replaced = F.coalesce(new["has_status"], F.lit(False))
    taken_on = {
        **{c: F.coalesce(c, new[c]) for c in FIRST_SET},
        **{c: F.coalesce(new[c], c) for c in (*LAST_SET, *FILE_EVENT_TIMES.values())},
        **{c: F.when(replaced, new[c]).otherwise(F.col(c)) for c in ("error_code", "error_message")},
        "created_at": F.least("created_at", new["created_at"]),
        "updated_at": F.greatest("updated_at", new["updated_at"]),
        "retry_count": F.col("retry_count") + F.coalesce(new["retry_count"], F.lit(0)),
        "has_status": F.col("has_status") | replaced,
    }
    old = state.join(updates, "file_id", "left").select(
        *[taken_on[c].alias(c) if c in taken_on else c for c in state.columns]
    )
    return old.unionByName(later.filter("detected_at IS NOT NULL"))


def finished_files(partial: DataFrame) -> DataFrame:
    """Current state of files: counters that no event gave are zero."""
    counters = [c for c in LAST_SET if c.startswith(("records_", "visitors_"))]
    return partial.select(
        *[
            F.coalesce(c, F.lit(0)).alias(c) if c in counters else c
            for c in partial.columns if c != "has_status"
        ]
    )


def fold_files(events: DataFrame) -> DataFrame:
    """Current state of every file from all of its events."""
    return finished_files(partial_files(events))


def register_files(
    manifest: DataFrame, last_file_id: int, run_id: str, scratch: str
) -> DataFrame:
    """Give new files their ids in name order, after the highest id so far.

    An id is the file's position in the sorted order: its place in its sorted partition
    plus the sizes of the partitions before. Places are written before they are counted.
    """
    placed = written(
        manifest.orderBy("file_name").withColumn("_place", F.monotonically_increasing_id()),
        f"{scratch}/places",
    ).withColumn("_part", F.shiftright("_place", 33))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("_part").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first")
    )
    offsets = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    return placed.join(offsets, "_part").select(
        (F.lit(last_file_id) + F.col("_before") + F.col("_place") - F.col("_first") + 1)
        .cast("bigint").alias("file_id"),
        F.lit(run_id).alias("run_id"),
        *manifest.columns,
    )


def _counted() -> list[Column]:
    def having(*statuses: str) -> Column:
        return F.count_if(F.col("status").isin(*statuses))

    return [
        F.count(F.lit(1)).alias("files_detected"),
        having(*layout.PROCESSED_STATUSES).alias("files_processed"),
        having("SUCCESS").alias("files_success"),
        having("REJECTED_LAYOUT").alias("files_rejected"),
        having("FAILED").alias("files_failed"),
        *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in RECORD_COUNTERS],
    ]


def _ended() -> Column:
    """The status that its files give a run."""
    failed = F.bool_or(F.col("status").isin(layout.RUN_FAILING_STATUSES))
    rejected = F.bool_or(F.col("status") == "REJECTED_LAYOUT")
    return F.when(failed, "FAILED").when(rejected, "PARTIAL_SUCCESS").otherwise("SUCCESS").alias("final_status")


def run_metrics(files: DataFrame) -> DataFrame:
    """Counters of every run from its files."""
    return files.groupBy("run_id").agg(*_counted())


def run_outcomes(files: DataFrame) -> DataFrame:
    """Counters and final status of every run that has files, from one grouping."""
    return files.groupBy("run_id").agg(*_counted(), _ended())


def merged_counters(parts: DataFrame, by: str = "of_run") -> DataFrame:
    """Counters of every run from partial rows: each run's own, and what later runs settled of its files."""
    return parts.groupBy(F.col(by).alias("run_id")).agg(*[F.sum(c).alias(c) for c in RUN_COUNTERS])


def settled_counters(changes: DataFrame) -> DataFrame:
    """Partial counters of the runs whose files ``settled_deletions`` settles: successes, processed before."""
    zeros = [F.lit(0).cast("bigint").alias(c) for c in RUN_COUNTERS if c != "files_success"]
    settled = changes.filter(_SETTLED).groupBy(F.col("open_run_id").alias("of_run"))
    return settled.agg(F.count(F.lit(1)).alias("files_success"), *zeros).select("of_run", *RUN_COUNTERS)


def update_runs(runs: DataFrame, metrics: DataFrame) -> DataFrame:
    """Runs with fresh counters; a run without files keeps the counters it had, or zeros.

    With ``run_outcomes`` as metrics also with ``final_status``, SUCCESS for a run without files.
    """
    told = [c for c in metrics.columns if c == "final_status"]
    fresh = metrics.select("run_id", *[F.col(c).alias(f"_{c}") for c in (*RUN_COUNTERS, *told)])
    joined = runs.join(fresh, "run_id", "left")
    kept = [c for c in runs.columns if c not in RUN_COUNTERS]
    counters = [
        F.coalesce(F.col(f"_{c}"), *([F.col(c)] if c in runs.columns else []), F.lit(0)).alias(c)
        for c in RUN_COUNTERS
    ]
    return joined.select(
        *kept, *counters, *[F.coalesce(f"_{c}", F.lit("SUCCESS")).alias(c) for c in told]
    )


def final_status(runs: DataFrame, files: DataFrame) -> DataFrame:
    """(run_id, final_status) from the statuses of the run's files."""
    ended = files.groupBy("run_id").agg(_ended())
    return runs.select("run_id").join(ended, "run_id", "left").select(
        "run_id", F.coalesce("final_status", F.lit("SUCCESS")).alias("final_status")
    )


def latest_loaded(control: DataFrame, statuses: list[str] | None = None) -> DataFrame:
    """Per checksum the newest file that was loaded: original_file_id, original_run_id.

    By default a file counts as loaded once its load has finished, whatever came after.
    With ``statuses`` it counts by its current status instead.
    """
    loaded = (
        F.col("status").isin(statuses) if statuses else F.col("load_finished_at").isNotNull()
    )
    return (
        control.filter(loaded & F.col("checksum_sha256").isNotNull())
        .groupBy("checksum_sha256")
        .agg(
            F.max("file_id").alias("original_file_id"),
            F.max_by("run_id", "file_id").alias("original_run_id"),
        )
    )


def already_processed(
    files: DataFrame, control: DataFrame, statuses: list[str] | None = None
) -> DataFrame:
    """Files with the loaded file of the same content, if there is one other than itself."""
    known = latest_loaded(control, statuses)
    other = F.col("original_file_id") != F.col("file_id")
    return files.join(known, "checksum_sha256", "left").select(
        *files.columns,
        F.when(other, F.col("original_file_id")).alias("original_file_id"),
        F.when(other, F.col("original_run_id")).alias("original_run_id"),
        F.coalesce(other, F.lit(False)).alias("already_processed"),
    )


def batch_duplicates(files: DataFrame) -> DataFrame:
    """Add first_file: the first file by name with the same content inside this batch.

    A file that its staging, layout or text keeps out is no first: its copies get their own verdict.
    """
    refused = [
        refusal for name, refusal in (
            ("staging_state", F.col("staging_state").isin("MISSING", "SIZE_MISMATCH")),
            ("layout_code", F.col("layout_code").isNotNull()),
            ("utf8_ok", ~F.col("utf8_ok")),
        ) if name in files.columns
    ]
    fit = files.filter(F.col("checksum_sha256").isNotNull())
    for refusal in refused:
        fit = fit.filter(~F.coalesce(refusal, F.lit(False)))
    firsts = fit.groupBy("checksum_sha256").agg(
        F.min("file_name").alias("first_file")
    )
    return files.join(firsts, "checksum_sha256", "left")


# Columns the disposition looks at; missing ones count as null (step not reached).
_DISPOSITION_INPUTS = {
    "staging_state": "string", "original_file_id": "bigint", "original_run_id": "string",
    "first_file": "string", "layout_code": "string", "layout_message": "string",
    "utf8_ok": "boolean", "duplicate_lines": "bigint", "refused_values": "bigint", "records_read": "bigint",
    "records_valid": "bigint", "records_invalid": "bigint", "statistics_rows": "bigint",
    "errors_rows": "bigint", "archive_state": "string", "source_deleted": "boolean",
}


def file_disposition(files: DataFrame) -> DataFrame:
    """status, error_code and error_message of all files at once, in lifecycle order.

    Staging problems, then content already processed, then layout, then unreadable text,
    then reconciliation, then archive, then source deletion. What is not known yet (null)
    leaves the file at the last state it reached.
    """
    present = files.select(
        *files.columns,
        *[
            F.lit(None).cast(kind).alias(name)
            for name, kind in _DISPOSITION_INPUTS.items() if name not in files.columns
        ],
    )
    col = F.col
    text = lambda value: F.coalesce(value.cast("string"), F.lit("None"))
    fields_off = col("records_read") != col("records_valid") + col("records_invalid")
    tables_off = (col("statistics_rows") != col("records_valid")) | (
        col("errors_rows") != col("records_invalid")
    )
    rules = [
        (
            col("staging_state") == "MISSING", "FAILED", F.lit("StagingError"),
            F.concat(F.lit("Downloaded file was not created: "), col("file_name")),
        ),
        (
            col("staging_state") == "SIZE_MISMATCH", "FAILED", F.lit("StagingError"),
            F.concat(F.lit("File size mismatch after download. File="), col("file_name")),
        ),
        (
            col("original_file_id").isNotNull(), "SKIPPED_ALREADY_PROCESSED",
            F.lit("ALREADY_PROCESSED"),
            F.concat(
                F.lit("File content was already processed successfully. Original file_id="),
                text(col("original_file_id")), F.lit(", original run_id="),
                text(col("original_run_id")),
            ),
        ),
        (
            col("first_file") != col("file_name"), "SKIPPED_ALREADY_PROCESSED",
            F.lit("ALREADY_PROCESSED"),
            F.concat(F.lit("Same content in this batch as file "), col("first_file")),
        ),
        (
            col("layout_code").isNotNull(), "REJECTED_LAYOUT", col("layout_code"),
            col("layout_message"),
        ),
        (
            ~col("utf8_ok"), "FAILED", F.lit("UnicodeDecodeError"),
            F.concat(F.lit("File is not valid UTF-8: "), col("file_name")),
        ),
        (
            col("duplicate_lines") > 0, "FAILED", F.lit("IntegrityError"),
            F.concat(F.lit("Duplicate record keys: "), text(col("duplicate_lines"))),
        ),
        (
            col("refused_values") > 0, "FAILED", F.lit("DataError"),
            F.concat(F.lit("Values the tables do not take: "), text(col("refused_values"))),
        ),
        (
            fields_off | tables_off, "FAILED", F.lit("RECONCILIATION_ERROR"),
            F.concat(
                F.lit("Record reconciliation failed. File="), col("file_name"),
                F.lit(", read="), text(col("records_read")),
                F.lit(", valid="), text(col("records_valid")),
                F.lit(", invalid="), text(col("records_invalid")),
            ),
        ),
        (col("records_read").isNull(), "STAGED", F.lit(None), F.lit(None)),
        (col("statistics_rows").isNull(), "PREPARED", F.lit(None), F.lit(None)),
        (col("archive_state").isNull(), "LOADED", F.lit(None), F.lit(None)),
        (
            col("archive_state") != "OK", "PENDING_BACKUP", F.lit("BACKUP_ERROR"),
            F.concat(F.lit("Archive check failed: "), col("archive_state")),
        ),
        (col("source_deleted").isNull(), "BACKED_UP", F.lit(None), F.lit(None)),
        (
            ~col("source_deleted"), "PENDING_SOURCE_DELETE", F.lit("SFTP_DELETE_ERROR"),
            F.concat(F.lit("Source not deleted: "), col("file_name")),
        ),
    ]
    status = code = message = F
    for reached, new_status, new_code, new_message in rules:
        status = status.when(reached, F.lit(new_status))
        code = code.when(reached, new_code)
        message = message.when(reached, new_message)
    own = [c for c in files.columns if c not in ("status", "error_code", "error_message")]
    return present.select(
        *own,
        status.otherwise(F.lit("SUCCESS")).alias("status"),
        code.cast("string").alias("error_code"),
        message.cast("string").alias("error_message"),
    )


def loadable(records: DataFrame, dispositions: DataFrame, key: str = "source_file") -> DataFrame:
    """Records of files that may be loaded; skipped, rejected and failed ones stay out."""
    kept = dispositions.filter(F.col("status").isin("PREPARED", "LOADING", *layout.LOADED_STATUSES))
    return records.join(kept.select(F.col("file_name").alias(key)), key, "left_semi")


def listing_changes(last: DataFrame, present: DataFrame) -> DataFrame:
    """What became of every path between two listings of one folder: appeared, replaced, gone or same.

    A path holds the same file while its contents do; where a listing does not know a checksum,
    while size and time do. ``open_file_id``, the archived file that was seen last and is not
    settled, and ``open_run_id``, its run, come from the last listing.
    """
    facts = ["checksum_sha256", "size_bytes", "modified_at"]
    opened = ["open_file_id", "open_run_id"]
    before = last.select("file_path", *opened, *[F.col(c).alias(f"_{c}") for c in facts])
    both = before.withColumn("_was", F.lit(True)).join(
        present.select("file_path", *facts).withColumn("_is", F.lit(True)), "file_path", "full_outer"
    )
    known = F.col("checksum_sha256").isNotNull() & F.col("_checksum_sha256").isNotNull()
    alike = F.when(known, F.col("checksum_sha256") == F.col("_checksum_sha256")).otherwise(
        F.col("size_bytes").eqNullSafe(F.col("_size_bytes"))
        & F.col("modified_at").eqNullSafe(F.col("_modified_at"))
    )
    return both.select(
        "file_path", *opened,
        F.when(F.col("_was").isNull(), "appeared").when(F.col("_is").isNull(), "gone")
        .when(alike, "same").otherwise("replaced").alias("change"),
    )


_SETTLED = "open_file_id IS NOT NULL AND change IN ('gone', 'replaced')"


def settled_deletions(changes: DataFrame) -> DataFrame:
    """Archived files whose source has gone from its folder, or has given way to another: file_id, file_path."""
    return changes.filter(_SETTLED).select(
        F.col("open_file_id").alias("file_id"), "file_path"
    )


def deletion_events(settled: DataFrame, seq: int, at: Column) -> DataFrame:
    """One ``source_deleted`` event for each settled file, which makes it SUCCESS."""
    rows = event(
        FILE_EVENT_SCHEMA, F.lit(True), file_id=F.col("file_id"), seq=F.lit(seq),
        event=F.lit("source_deleted"), at=at, status=F.lit("SUCCESS"),
    )
    return settled.select(F.inline(F.array(rows)))


def purge_candidates(files: DataFrame, archive: DataFrame) -> DataFrame:
    """Sources that may be deleted: loaded, archived, archive verified, still there."""
    verified = archive.filter("archive_state = 'OK'").select("file_id")
    return (
        files.filter(
            "load_finished_at IS NOT NULL AND backup_at IS NOT NULL AND source_deleted_at IS NULL"
        )
        .join(verified, "file_id", "left_semi")
        .select("file_id", "run_id", "file_name", "source_path", "backup_uri", "backup_at")
    )
