"""Writing the tables, and making one run's output visible all at once.

Every table keeps a run's rows under ``run_id=<id>``. A run becomes visible by its entry in the
commit log, written last; until then a repeat drops what the run wrote and starts anew.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import layout
from ..operators import control, reports, visitors
from .commits import CommitLog, LostRace

PARTITIONS = {"estadistica": ["event_year", "event_month"]}
MAX_ROWS_PER_FILE = 20_000_000


def write_table(frame: DataFrame, path: str, *partitions: str) -> None:
    """Overwrite the written partitions only; few files per partition, hot ones split.

    The rebalance hint lets Spark size the files at run time and split a large partition
    over several tasks.
    """
    if partitions:
        frame = frame.hint("rebalance", *partitions)
    writer = frame.write.mode("overwrite").option("maxRecordsPerFile", MAX_ROWS_PER_FILE)
    if partitions:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partitions)
    writer.parquet(path)


def write_visits(visits: DataFrame, path: str) -> None:
    write_table(visits, path, "event_year", "event_month")


#: Published runs since the last compaction that make a run compact when it is through.
COMPACT_AFTER = 32
#: Buckets of visitors, by hash of the e-mail.
BUCKETS = 256


def _since(base: Row | None, published: list[Row]) -> list[Row]:
    """The published runs that a compaction does not cover."""
    return [e for e in published if not base or e["version"] > base["covers"]]


def bucket_of(email: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(email), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class Warehouse:
    """Paths of the tables below one root folder, and readers of their published state.

    Runs add rows and never change any. A compaction now and then folds what the runs up to a
    version wrote, the state of their files and the activity of their visitors, into new
    folders that its own log entry names; readers add what has been written since.
    """

    spark: SparkSession
    root: str

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    @property
    def log(self) -> CommitLog:
        return CommitLog(self.spark, self.path("commits"))

    # Rows of runs

    def write_run(self, table: str, frame: DataFrame, run_id: str) -> DataFrame:
        """Write a run's rows of a table, not visible before ``publish``; returns them read back."""
        rows = frame.withColumn("run_id", F.lit(run_id))
        path = self.path(table)
        write_table(rows, path, "run_id", *PARTITIONS.get(table, []))
        return self.spark.read.schema(rows.schema).parquet(path).filter(F.col("run_id") == run_id)

    def run_rows(self, table: str, run_id: str) -> DataFrame | None:
        """What a run wrote, published or not; its folder is all that is read."""
        return self._read(table, [run_id])

    def _read(self, table: str, runs: Iterable[str] | None = None) -> DataFrame | None:
        """Rows of a table, of all runs or of these; None where there are none.

        Run ids stay text whatever they look like.
        """
        folders = self._run_folders(table)
        if runs is not None:
            folders = {run: folders[run] for run in runs if run in folders}
        if not folders:
            return None
        reader = self.spark.read.option("basePath", self.path(table))
        paths = [self.path(table)] if runs is None else list(folders.values())
        try:
            inferred = reader.parquet(*paths).schema
        except AnalysisException as error:
            if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise
        schema = StructType(
            [StructField(f.name, StringType()) if f.name == "run_id" else f for f in inferred]
        )
        return reader.schema(schema).parquet(*paths)

    def _run_folders(self, table: str) -> dict[str, str]:
        """Folders of the runs that wrote to a table: names only, one per run."""
        top = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(table))
        store = top.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not store.exists(top):
            return {}
        names = [status.getPath().getName() for status in store.listStatus(top)]
        # Spark escapes special characters of a partition value like a URL does.
        return {unquote(n[7:]): f"{self.path(table)}/{n}" for n in names if n.startswith("run_id=")}

    def drop_run(self, run_id: str, name: str | None = None) -> None:
        """Remove what an unpublished run has written, of one table or of all."""
        if self.is_published(run_id):
            raise ValueError(f"run {run_id} is published")
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        store = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        for table in store.listStatus(root) if store.exists(root) else []:
            if name not in (None, table.getPath().getName()):
                continue
            for part in store.listStatus(table.getPath()):
                if unquote(part.getPath().getName()) == f"run_id={run_id}":
                    store.delete(part.getPath(), True)

    # Publishing

    def reserve_file_ids(self, run_id: str, n_files: int) -> int:
        """The first of so many ids that no other run gets, be it published or not."""
        def after_all() -> dict:
            taken = [e["first_id"] + e["n_files"] for e in self.log.entries("ids")]
            return {"first_id": max(taken, default=1)}

        version = self.log.append("ids", after_all, run_id=run_id, n_files=n_files)
        return next(e["first_id"] for e in self.log.entries("ids") if e["version"] == version)

    def publish(self, run_id: str, read_at: int, folder: str, reference: date) -> int:
        """Make a run visible: its log entry is its last write. Returns its version.

        ``read_at`` is the log's version when the run began to read. A run that was published
        since and has loaded one of the same contents, or settled one of the same files, makes
        this one fail; it can be repeated.
        """
        def unless_overtaken() -> dict:
            published = self.log.entries("publish")
            if run_id in [e["run_id"] for e in published]:
                raise LostRace(f"run {run_id} is published")
            newer = [e["run_id"] for e in published if e["version"] > read_at]
            settled = F.col("event") == "source_deleted"
            for table, key, which in (("loaded", "checksum_sha256", F.lit(True)), ("file_events", "file_id", settled)):
                theirs, ours = self._read(table, newer), self.run_rows(table, run_id)
                if theirs is not None and ours is not None:
                    if not ours.filter(which).join(theirs.filter(which), key, "left_semi").isEmpty():
                        raise LostRace(f"files of run {run_id} were published by {', '.join(newer)}")
            return {}

        return self.log.append("publish", unless_overtaken, run_id=run_id, folder=folder, reference=reference)

    def published(self) -> DataFrame:
        """(run_id, version, reference) of the published runs, a row each."""
        return self._told(self.log.entries("publish"))

    def _told(self, entries: list[Row]) -> DataFrame:
        return self.spark.createDataFrame(
            [(e["run_id"], e["version"], e["reference"]) for e in entries],
            "run_id string, version bigint, reference date",
        )

    def is_published(self, run_id: str) -> bool:
        return run_id in [e["run_id"] for e in self.log.entries("publish")]

    def table(self, name: str) -> DataFrame | None:
        """Rows of published runs only; None before there is any."""
        return self._read(name, [e["run_id"] for e in self.log.entries("publish")])

    def last_listing(self, folder: str) -> DataFrame | None:
        """What the newest published run over this folder found there."""
        runs = [e["run_id"] for e in self.log.entries("publish") if e["folder"] == folder]
        return self.run_rows("listing", runs[-1]) if runs else None

    # Visitors

    def _base(self) -> Row | None:
        bases = self.log.entries("base")
        return bases[-1] if bases else None

    def _activity(
        self, base: Row | None, published: list[Row], buckets: list[int] | None = None
    ) -> DataFrame | None:
        """Monthly activity rows with the version and reference day of their run.

        Of compacted ones those of the named buckets only; of the runs since all.
        """
        parts = []
        if base:
            wanted = range(len(base["buckets"])) if buckets is None else buckets
            paths = [f"{self.path('visitor_buckets')}/{base['buckets'][b]}/bucket={b}" for b in wanted if base["buckets"][b]]
            if paths:
                parts.append(self.spark.read.schema(visitors.ACTIVITY_SCHEMA).parquet(*paths))
        since = _since(base, published)
        rows = self._read("activity", [e["run_id"] for e in since])
        if rows is not None:
            parts.append(rows.join(self._told(since), "run_id").select(*visitors.ACTIVITY_COLUMNS))
        return reduce(DataFrame.unionByName, parts) if parts else None

    def visitors(self) -> DataFrame | None:
        """A row per e-mail over all published runs, its year and month those of the last run that met it.

        Nothing depends on when a run was begun or repeated: activity adds up in any order.
        """
        rows = self._activity(self._base(), self.log.entries("publish"))
        return None if rows is None else visitors.visitors_of_runs(rows)

    def known_visitors(self, emails: DataFrame) -> DataFrame:
        """Those of some e-mails that published runs have met; other buckets are not opened."""
        base = self._base()
        buckets = None
        if base:
            each = emails.select(bucket_of(F.col("email"), len(base["buckets"])).alias("b")).distinct()
            buckets = sorted(r["b"] for r in each.collect())  # a number per bucket at most
        rows = self._activity(base, self.log.entries("publish"), buckets)
        if rows is None:
            return emails.select("email").limit(0)
        return emails.select("email").join(rows.select("email"), "email", "left_semi")

    # Files and runs

    def files(self) -> DataFrame | None:
        """Current file control state of published runs; files that failed in them count as well."""
        partial = self._partial_files(self._base(), self.log.entries("publish"))
        return None if partial is None else control.finished_files(partial)

    def _partial_files(self, base: Row | None, published: list[Row]) -> DataFrame | None:
        """Compacted state of files, taken on by the events of the runs since: no others are read."""
        tail = self._read("file_events", [e["run_id"] for e in _since(base, published)])
        if tail is not None:
            tail = control.partial_files(_unpartitioned(tail))
        if base is None:
            return tail
        state = self.spark.read.parquet(f"{self.path('file_state')}/{base['state']}")
        return state if tail is None else control.updated_files(state, tail)

    def run_files(self, run_id: str) -> DataFrame | None:
        """State of a run's files from its own events."""
        events = self.run_rows("file_events", run_id)
        if events is None:
            return None
        return control.fold_files(_unpartitioned(events)).filter("detected_at IS NOT NULL")

    def runs(self) -> DataFrame | None:
        """Current run control state, counters added up from the rows that runs left: no file is looked at."""
        events, counters = self._read("run_events"), self.table("run_counters")
        if events is None:
            return None
        folded = control.fold_runs(events)
        if counters is None:
            return folded
        return control.update_runs(folded, control.merged_counters(counters))

    def register_views(self) -> list[str]:
        """The reporting views by name in the session's SQL; none before there is a run with files."""
        files, runs = self.files(), self.runs()
        if files is None or runs is None:
            return []
        views = reports.report_views(files, runs)
        for name, view in views.items():
            view.createOrReplaceTempView(name)
        return sorted(views)

    # Compaction

    def runs_since_compaction(self) -> int:
        return len(_since(self._base(), self.log.entries("publish")))

    def compact(self, buckets: int = BUCKETS) -> int | None:
        """Fold what published runs wrote since the last compaction; None if there is nothing.

        Buckets of visitors that no run has touched stay where they are. The number of buckets
        is that of the first compaction.
        """
        base, published = self._base(), self.log.entries("publish")
        since = [e["run_id"] for e in _since(base, published)]
        if not since:
            return None
        made = uuid.uuid4().hex
        state = self._partial_files(base, published)
        write_table(state, f"{self.path('file_state')}/{made}")
        where = list(base["buckets"]) if base else [None] * buckets
        number = bucket_of(F.col("email"), len(where))
        delta = self._read("activity", since)
        if delta is not None:
            touched = sorted(r["b"] for r in delta.select(number.alias("b")).distinct().collect())
            rows = visitors.merged_activity(self._activity(base, published, touched)).withColumn("bucket", number)
            write_table(rows, f"{self.path('visitor_buckets')}/{made}", "bucket")
            for b in touched:
                where[b] = made

        def unless_overtaken() -> dict:
            newest = self._base()
            if (newest and newest["version"]) != (base and base["version"]):
                raise LostRace("compacted by somebody else")
            return {}

        return self.log.append(
            "base", unless_overtaken, covers=published[-1]["version"], state=made, buckets=where
        )

    def tidy(self) -> list[str]:
        """Delete folders of compactions that the newest one does not name; returns their names.

        For times when nobody reads an older state.
        """
        base, dropped = self._base(), []
        named = {"file_state": {base["state"]}, "visitor_buckets": set(base["buckets"])} if base else {}
        for table, names in named.items():
            top = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(table))
            store = top.getFileSystem(self.spark._jsc.hadoopConfiguration())
            for part in store.listStatus(top) if store.exists(top) else []:
                if part.getPath().getName() not in names:
                    dropped.append(f"{table}/{part.getPath().getName()}")
                    store.delete(part.getPath(), True)
        return dropped

    def missing_outputs(self, *tables: str) -> list[str]:
        """Those of the output tables that hold no published row."""
        wanted = tables or ("estadistica", "errores", "visitante")
        found = {name: self.visitors() if name == "visitante" else self.table(name) for name in wanted}
        return [name for name, rows in found.items() if rows is None or rows.isEmpty()]


def _unpartitioned(events: DataFrame) -> DataFrame:
    return events.select(
        *[F.col(part.strip().split(" ")[0]) for part in control.FILE_EVENT_SCHEMA.split(",")]
    )


def constraint_report(warehouse: Warehouse) -> DataFrame | None:
    """Width and NOT NULL violations of all published tables in one list."""
    from ..operators.checks import table_violations

    reports = []
    for name in ("estadistica", "errores", "visitante"):
        rows = warehouse.visitors() if name == "visitante" else warehouse.table(name)
        if rows is not None:
            key = F.concat_ws(":", *[F.col(c).cast("string") for c in layout.UNIQUE_KEYS[name]])
            reports.append(
                table_violations(rows, name).select(
                    F.lit(name).alias("table_name"), key.alias("row_key"), "column_name", "rule",
                    "length",
                )
            )
    if not reports:
        return None
    merged = reports[0]
    for report in reports[1:]:
        merged = merged.unionByName(report)
    return merged
