"""The permissive CSV scan: fixed all-string schema, header skipped, no line numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import layout

SOURCE_SCHEMA = ", ".join(f"`{name}` STRING" for name in layout.REPORT_COLUMNS)
CSV_OPTIONS = {"sep": ",", "quote": '"', "escape": '"', "mode": "PERMISSIVE"}


def scan_csv(spark: SparkSession, folder: str, glob: str = layout.REPORT_GLOB) -> DataFrame:
    """The 15 source columns under their engine names plus source_file."""
    raw = (
        spark.read.schema(SOURCE_SCHEMA)
        .options(header=True, pathGlobFilter=glob, **CSV_OPTIONS)
        .csv(folder)
    )
    return raw.select(
        F.col("_metadata.file_name").alias("source_file"),
        *[
            F.col(f"`{source}`").alias(name)
            for source, name in zip(layout.REPORT_COLUMNS, layout.FIELD_NAMES)
        ],
    )
