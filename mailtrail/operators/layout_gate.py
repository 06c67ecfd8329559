"""File layout rules: name, emptiness, header width, header text; the first failure wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import layout
from ..functions.text import split_fields


def header_differences(header: Column) -> Column:
    """Messages for the columns that differ from the expected header, in column order."""
    expected = F.array(*[F.lit(name) for name in layout.REPORT_COLUMNS])
    positions = F.sequence(F.lit(1), F.lit(layout.REPORT_WIDTH))
    pairs = F.arrays_zip(positions.alias("n"), expected.alias("e"), header.alias("a"))
    differing = F.filter(pairs, lambda p: ~p["e"].eqNullSafe(p["a"]))
    return F.transform(
        differing,
        lambda p: F.concat(
            F.lit("column "), p["n"].cast("string"), F.lit(": expected '"), p["e"],
            F.lit("', found '"), F.coalesce(p["a"], F.lit("")), F.lit("'"),
        ),
    )


def validate_layout(files: DataFrame) -> DataFrame:
    """Add layout_ok, layout_code and layout_message to file rows.

    Needs file_name, file_path, file_size (null: no such file) and header_line (null: none).
    """
    width = layout.REPORT_WIDTH
    name = F.col("file_name")
    parsed = files.select(*files.columns, split_fields(F.col("header_line")).alias("_header"))
    header = F.col("_header")
    expected = F.array(*[F.lit(c) for c in layout.REPORT_COLUMNS])
    rules = [
        (
            ~name.rlike(layout.REPORT_NAME_PATTERN),
            "INVALID_FILENAME",
            F.concat(
                F.lit("Invalid file name '"), name,
                F.lit("'. Expected pattern report_<number>.txt"),
            ),
        ),
        (
            F.col("file_size").isNull(),
            "EMPTY_FILE",
            F.concat(F.lit("File does not exist: "), F.col("file_path")),
        ),
        (F.col("file_size") == 0, "EMPTY_FILE", F.concat(F.lit("File is empty: "), name)),
        (F.col("header_line").isNull(), "EMPTY_FILE", F.concat(F.lit("File has no header: "), name)),
        (
            F.size(header) != width,
            "INVALID_COLUMN_COUNT",
            F.concat(
                F.lit(f"Expected {width} columns, found "), F.size(header).cast("string"),
                F.lit(" in file "), name,
            ),
        ),
        (
            header != expected,
            "INVALID_HEADER",
            F.concat(
                F.lit("Invalid header in file "), name, F.lit('. Differences: ["'),
                F.array_join(header_differences(header), '", "'), F.lit('"]'),
            ),
        ),
    ]
    code = message = F
    for broken, error_code, text in rules:
        code = code.when(broken, F.lit(error_code))
        message = message.when(broken, text)
    return parsed.select(
        *files.columns,
        code.isNull().alias("layout_ok"),
        code.alias("layout_code"),
        message.alias("layout_message"),
    )


def list_header_differences(files: DataFrame) -> DataFrame:
    """One row per differing header column of files whose header has the right width."""
    parsed = files.select("file_name", split_fields(F.col("header_line")).alias("header"))
    return parsed.filter(F.size("header") == layout.REPORT_WIDTH).select(
        "file_name", F.explode(header_differences(F.col("header"))).alias("difference")
    )
