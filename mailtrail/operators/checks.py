"""Integrity checks that return the offending rows; an empty result means all is well."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import layout


def duplicate_keys(frame: DataFrame, *keys: str) -> DataFrame:
    """Key values that occur more than once, with their number of rows."""
    return frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def appendable(target: DataFrame, incoming: DataFrame, *keys: str) -> DataFrame:
    """Incoming rows a unique key accepts: not in the target, not repeated in the batch.

    The refused ones are ``duplicate_keys(incoming)`` and the rows already in the target.
    """
    taken = target.select(*keys).unionByName(duplicate_keys(incoming, *keys).select(*keys))
    return incoming.join(taken, list(keys), "left_anti")


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Foreign-key values without a parent, with their number of child rows."""
    referenced = child.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias("child_rows")
    )
    return referenced.join(parent.select(key), key, "left_anti")


def _violations(frame: DataFrame, widths: dict[str, int] | None, not_null: list[str] | None) -> Column:
    """The violated width and NOT NULL rules of a row, as an array."""
    found = [
        F.when(
            F.char_length(F.col(c)) > limit,
            F.struct(
                F.lit(c).alias("column_name"), F.lit(f"width {limit}").alias("rule"),
                F.char_length(F.col(c)).alias("length"),
            ),
        )
        for c, limit in (widths or {}).items() if c in frame.columns
    ] + [
        F.when(
            F.col(c).isNull(),
            F.struct(
                F.lit(c).alias("column_name"), F.lit("not null").alias("rule"),
                F.lit(None).cast("int").alias("length"),
            ),
        )
        for c in not_null or [] if c in frame.columns
    ]
    return F.array_compact(F.array(*found))


def constraint_violations(
    frame: DataFrame,
    key: list[str],
    widths: dict[str, int] | None = None,
    not_null: list[str] | None = None,
) -> DataFrame:
    """One row per violated width or NOT NULL rule, in one pass over the rows."""
    return frame.select(*key, F.inline(_violations(frame, widths, not_null)))


def table_violations(frame: DataFrame, name: str) -> DataFrame:
    """The fixed width and NOT NULL rules of one of the engine's tables."""
    return constraint_violations(
        frame, layout.UNIQUE_KEYS[name], layout.WIDTHS[name], layout.NOT_NULL[name]
    )


def load_reconciliation(
    expected: DataFrame, statistics: DataFrame, errors: DataFrame, key: str = "file_id"
) -> DataFrame:
    """Per file the counted records against the rows in the two tables, counted in one grouping."""
    rows = statistics.select(key, F.lit(True).alias("is_visit")).unionByName(
        errors.select(key, F.lit(False).alias("is_visit"))
    )
    counted = rows.groupBy(key).agg(
        F.count_if("is_visit").alias("statistics_rows"), F.count_if(~F.col("is_visit")).alias("errors_rows")
    )
    return _reconciled(expected, counted, key)


def _reconciled(expected: DataFrame, counted: DataFrame, key: str) -> DataFrame:
    """Expected counts and those of the tables, none being zero, with the code of a difference."""
    joined = expected.join(counted, key, "left").withColumns(
        {c: F.coalesce(c, F.lit(0)) for c in ("statistics_rows", "errors_rows")}
    )
    balanced = (
        (F.col("statistics_rows") == F.col("records_valid"))
        & (F.col("errors_rows") == F.col("records_invalid"))
        & (F.col("records_read") == F.col("statistics_rows") + F.col("errors_rows"))
    )
    return joined.select(
        *expected.columns, *[c for c in joined.columns if c not in expected.columns],
        F.when(~balanced, F.lit("RECONCILIATION_ERROR")).alias("error_code"),
    )


def load_verdicts(expected: DataFrame, tables: dict[str, DataFrame], key: str = "file_id") -> DataFrame:
    """What is wrong with each file's rows, from the rows that are to be written.

    ``tables`` are ``estadistica`` and ``errores`` to be. Besides the counts of
    ``load_reconciliation``: ``duplicate_lines``, keys that repeat, and ``refused_values``, those
    that break a width or NOT NULL rule; null where there are none. Only keys and numbers are
    shuffled, by the whole key, so a file of any size is spread.
    """
    def narrow(name: str) -> DataFrame:
        frame = tables[name]
        refused = F.size(_violations(frame, layout.WIDTHS[name], layout.NOT_NULL[name]))
        line = next(c for c in layout.UNIQUE_KEYS[name] if c != key)
        return frame.select(
            key, F.lit(name == "estadistica").alias("is_visit"), F.col(line).alias("line"), refused.alias("refused")
        )

    rows = reduce(DataFrame.unionByName, [narrow(name) for name in tables])
    each = rows.groupBy(key, "is_visit", "line").agg(
        F.count(F.lit(1)).alias("copies"), F.sum("refused").alias("refused")
    )
    copies = F.col("copies")
    counted = each.groupBy(key).agg(
        F.sum(F.when(F.col("is_visit"), copies).otherwise(0)).alias("statistics_rows"),
        F.sum(F.when(F.col("is_visit"), 0).otherwise(copies)).alias("errors_rows"),
        F.nullif(F.count_if(copies > 1), F.lit(0)).alias("duplicate_lines"),
        F.nullif(F.sum("refused"), F.lit(0)).alias("refused_values"),
    )
    return _reconciled(expected, counted, key)


def unreconciled_files(files: DataFrame) -> DataFrame:
    """Files where read is not valid + invalid."""
    return files.filter("records_read <> records_valid + records_invalid").select(
        "file_id", "file_name", "records_read", "records_valid", "records_invalid"
    )


def unreconciled_loads(files: DataFrame) -> DataFrame:
    """Loaded files where not every valid record was loaded."""
    return files.filter(
        F.col("status").isin(layout.LOADED_STATUSES)
        & (F.col("records_valid") != F.col("records_loaded"))
    ).select("file_id", "file_name", "status", "records_valid", "records_loaded")


def success_without_backup(files: DataFrame) -> DataFrame:
    return files.filter(
        "status = 'SUCCESS' AND (backup_uri IS NULL OR backup_at IS NULL)"
    ).select("file_id", "file_name", "backup_uri", "backup_at")


def unsafe_deletions(files: DataFrame) -> DataFrame:
    """Files whose source was deleted before the backup."""
    return files.filter("source_deleted_at < backup_at").select(
        "file_id", "file_name", "backup_at", "source_deleted_at"
    )


def broken_success(files: DataFrame) -> DataFrame:
    """SUCCESS files that miss a backup, a deletion time, or have them in the wrong order."""
    kept = (
        "backup_at IS NOT NULL AND backup_uri IS NOT NULL AND source_deleted_at IS NOT NULL "
        "AND source_deleted_at >= backup_at"
    )
    return files.filter(f"status = 'SUCCESS' AND NOT ({kept})").select(
        "file_id", "file_name", "backup_at", "backup_uri", "source_deleted_at"
    )
