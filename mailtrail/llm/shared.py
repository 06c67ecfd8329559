"""What the operators share: reading tables, cutting lineage, Arrow batches cut to size."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_folder

#: Bytes of text that a task turns into numpy arrays at once; a longer text is a piece alone.
PIECE_BYTES = 2 << 20
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kept(frame: DataFrame, purpose: str) -> DataFrame:
    """The rows, written once below the shared folder: lost executors lose nothing.

    The shuffle files behind them are dropped as soon as the table is written.
    """
    spark = frame.sparkSession
    folder = scratch_folder(spark, purpose)
    if _open:
        _written.setdefault(_open[-1], []).append(folder)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        frame.write.option("compression", "zstd").parquet(folder)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(frame.schema).parquet(folder)


#: Folders that ``kept`` has written in a scope, and the scope that is open.
_written: dict[str, list[str]] = {}
_open: list[str] = []


@contextmanager
def scratch_scope(spark: SparkSession, name: str) -> Iterator[None]:
    """Tables that ``kept`` writes inside go when the scope of this name is next entered.

    For a caller who has by then written all that was made of them, as between stages.
    """
    scope = f"{spark.sparkContext.applicationId} {name}"
    for folder in _written.pop(scope, []):
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    _open.append(scope)
    try:
        yield
    finally:
        _open.pop()


def with_rest(documents: DataFrame) -> DataFrame:
    """doc_id, text, and all columns but the text in the struct ``rest``: no name can clash."""
    others = [F.col(f"`{c}`") for c in documents.columns if c != "text"]
    return documents.select("doc_id", "text", F.struct(*others).alias("rest"))


def restored(frame: DataFrame, documents: DataFrame) -> DataFrame:
    """The columns of ``documents`` from a frame with text and rest."""
    return frame.select(
        *[F.col("text") if c == "text" else F.col("rest")[c].alias(c) for c in documents.columns]
    )


def schema_with_rest(ddl: str, frame: DataFrame) -> T.StructType:
    """The schema of ``ddl``, and the frame's ``rest`` if it has one."""
    schema = T.StructType.fromDDL(ddl)
    return T.StructType([*schema.fields, *[f for f in frame.schema.fields if f.name == "rest"]])


def with_columns(columns: dict[str, pa.Array], batch: pa.RecordBatch) -> pa.RecordBatch:
    """A batch of the columns, and the ``rest`` of ``batch`` if it has one."""
    if "rest" in batch.schema.names:
        columns = {**columns, "rest": batch.column("rest")}
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string or binary column and its n+1 offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.large_binary() if pa.types.is_large_string(column.type) or pa.types.is_large_binary(
        column.type) else pa.binary()
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    column = column.cast(wide)
    kind = np.int64 if wide == pa.large_binary() else np.int32
    _, ends, data = column.buffers()
    if ends is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(ends, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def pieces(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = PIECE_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of rows with about ``limit`` bytes of text, their bytes and offsets."""
    for batch in batches:
        data, ends = text_bytes(batch.column(column))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(ends, ends[first] + limit, "right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            yield (
                batch.slice(first, last - first),
                data[ends[first] : ends[last]],
                ends[first : last + 1] - ends[first],
            )
            first = last


class RowNumbers:
    """Numbers for the rows of a task, different from those of every other task.

    They hold for what is written to a table; a repeated task deals the same numbers.
    """

    def __init__(self):
        self.next = TaskContext.get().partitionId() << 40

    def take(self, n: int) -> np.ndarray:
        self.next += n
        return np.arange(self.next - n, self.next, dtype=np.int64)


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    """Consecutive values as one list per count."""
    ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, kind))


def whole_groups(
    batches: Iterator[pa.RecordBatch], keys: list[str], rows: int
) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of about ``rows`` rows, sorted by ``keys``, that cut no group, and the groups' starts."""
    waiting, count = [], 0

    def cuts(whole: pa.Table) -> np.ndarray:
        new = np.zeros(whole.num_rows, bool)
        new[:1] = True
        for key in keys:
            values = whole.column(key).to_numpy()
            new[1:] |= values[1:] != values[:-1]
        return np.flatnonzero(new)

    for batch in batches:
        if not batch.num_rows:
            continue
        waiting.append(batch)
        count += batch.num_rows
        if count < rows:
            continue
        whole = pa.Table.from_batches(waiting)
        starts = cuts(whole)
        if len(starts) > 1:
            yield whole.slice(0, starts[-1]).combine_chunks(), starts[:-1]
            whole = whole.slice(starts[-1]).combine_chunks()
        waiting, count = whole.to_batches(), whole.num_rows
    if waiting:
        whole = pa.Table.from_batches(waiting).combine_chunks()
        yield whole, cuts(whole)
