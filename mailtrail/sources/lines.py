"""Report lines with their physical line numbers, at any file size.

A line's number is its position inside its file split plus the lines of the splits before
it. Positions come from one pass over the text, which is written to the scratch folder, so
that numbers never depend on two scans being split alike. What is joined back is one row
per split: up to ``MAX_SPLITS`` of them, 100 TB or more of text, go to all tasks, so that no
line is moved; beyond that lines are joined on (file, split), whose groups are no larger than
a split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import layout
from ..session import scratch_folder

SPLIT_KEYS = ["file_name", "split_start"]
#: Splits whose offsets, some 50 bytes each, are sent to all tasks.
MAX_SPLITS = 1_000_000


def positioned_lines(
    spark: SparkSession, folder: str | list[str], glob: str = layout.REPORT_GLOB
) -> DataFrame:
    """(file_name, split_start, position, raw_record); position grows along a split.

    Nothing may be filtered before the position is taken.
    """
    text = spark.read.option("pathGlobFilter", glob).text(folder)
    return text.select(
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("split_start"),
        F.monotonically_increasing_id().alias("position"),
        F.col("value").alias("raw_record"),
    )


def split_offsets(positioned: DataFrame) -> DataFrame:
    """One row per split: its first position and the number of lines before it in the file."""
    splits = positioned.groupBy(*SPLIT_KEYS).agg(
        F.count(F.lit(1)).alias("lines"), F.min("position").alias("first_position")
    )
    before = Window.partitionBy("file_name").orderBy("split_start").rowsBetween(
        Window.unboundedPreceding, -1
    )
    return splits.select(
        *SPLIT_KEYS, "first_position",
        F.coalesce(F.sum("lines").over(before), F.lit(0)).alias("lines_before"),
    )


def with_line_numbers(positioned: DataFrame, offsets: DataFrame) -> DataFrame:
    """Replace split and position by the 1-based physical line number; ``offsets`` is a written table."""
    if offsets.count() <= MAX_SPLITS:
        offsets = F.broadcast(offsets)
    return positioned.join(offsets, SPLIT_KEYS).select(
        (F.col("lines_before") + F.col("position") - F.col("first_position") + 1)
        .cast("bigint").alias("line_number"),
        *[c for c in positioned.columns if c not in ("split_start", "position")],
    )


def written(frame: DataFrame, path: str) -> DataFrame:
    """Write as Parquet and read back: lineage ends, sizes are known."""
    frame.write.mode("overwrite").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def numbered_lines(
    spark: SparkSession, folder: str, glob: str = layout.REPORT_GLOB, scratch: str | None = None
) -> DataFrame:
    """All physical lines (header = line 1): file_name, line_number, raw_record."""
    scratch = scratch or scratch_folder(spark, "lines")
    staged = written(positioned_lines(spark, folder, glob), f"{scratch}/lines")
    offsets = written(split_offsets(staged), f"{scratch}/offsets")
    return with_line_numbers(staged, offsets).select("file_name", "line_number", "raw_record")


def record_lines(numbered: DataFrame) -> DataFrame:
    """Records only: the header line is left out, numbering starts at 2."""
    return numbered.filter("line_number > 1").select(
        F.col("file_name").alias("source_file"),
        F.col("line_number").alias("source_line"),
        "raw_record",
    )


def header_lines(numbered: DataFrame) -> DataFrame:
    return numbered.filter("line_number = 1").select(
        "file_name", F.col("raw_record").alias("header_line")
    )
