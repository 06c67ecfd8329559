"""One metrics row per e-mail: rebuild, incremental recompute, upsert.

Every step aggregates before it joins, so a very frequent e-mail is collapsed on the map
side and never travels as rows.
"""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VISITOR_COLUMNS = [
    "email", "fecha_primera_visita", "fecha_ultima_visita", "visitas_totales",
    "visitas_anio_actual", "visitas_mes_actual",
]

#: Monthly activity with the version of the last run that met the e-mail, and its reference day.
ACTIVITY_SCHEMA = (
    "email string, year int, month int, first_day date, last_day date, visits bigint, "
    "version bigint, reference date"
)
ACTIVITY_COLUMNS = [part.strip().split(" ")[0] for part in ACTIVITY_SCHEMA.split(",")]


def _in_period(year: Column, month: Column, reference: date) -> tuple[Column, Column]:
    same_year = year == reference.year
    return same_year, same_year & (month == reference.month)


def visitors(visits: DataFrame, reference: date) -> DataFrame:
    """First and last visit day, total, reference-year and reference-month counts."""
    day = F.to_date("fecha_envio")
    same_year, same_month = _in_period(F.year("fecha_envio"), F.month("fecha_envio"), reference)
    return visits.groupBy("email").agg(
        F.min(day).alias("fecha_primera_visita"),
        F.max(day).alias("fecha_ultima_visita"),
        F.count(F.lit(1)).alias("visitas_totales"),
        F.count_if(same_year).alias("visitas_anio_actual"),
        F.count_if(same_month).alias("visitas_mes_actual"),
    )


def monthly_activity(visits: DataFrame) -> DataFrame:
    """Visits per e-mail, year and month: all a later recompute needs of these visits."""
    day = F.to_date("fecha_envio")
    return visits.groupBy(
        "email", F.year("fecha_envio").alias("year"), F.month("fecha_envio").alias("month")
    ).agg(
        F.min(day).alias("first_day"), F.max(day).alias("last_day"),
        F.count(F.lit(1)).alias("visits"),
    )


def visitors_from_activity(activity: DataFrame, reference: date) -> DataFrame:
    """The metrics of ``visitors`` from monthly activity rows of any number of batches."""
    same_year, same_month = _in_period(F.col("year"), F.col("month"), reference)
    return activity.groupBy("email").agg(
        F.min("first_day").alias("fecha_primera_visita"),
        F.max("last_day").alias("fecha_ultima_visita"),
        F.sum("visits").alias("visitas_totales"),
        F.sum(F.when(same_year, F.col("visits")).otherwise(0)).alias("visitas_anio_actual"),
        F.sum(F.when(same_month, F.col("visits")).otherwise(0)).alias("visitas_mes_actual"),
    )


def merged_activity(activity: DataFrame) -> DataFrame:
    """One row per e-mail, year and month from those of any number of runs, in any order."""
    newest = F.max(F.struct("version", "reference"))
    return activity.groupBy("email", "year", "month").agg(
        F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"),
        F.sum("visits").alias("visits"), newest.alias("newest"),
    ).select(*ACTIVITY_COLUMNS[:-2], "newest.version", "newest.reference")


def visitors_of_runs(activity: DataFrame) -> DataFrame:
    """The metrics of ``visitors`` from activity of runs, each run with its own reference day.

    An e-mail's year and month are those of the run that met it last, by version. Its months,
    a handful a run, are looked at once that is known: one shuffle.
    """
    each = activity.groupBy("email").agg(
        F.min("first_day").alias("fecha_primera_visita"),
        F.max("last_day").alias("fecha_ultima_visita"),
        F.sum("visits").alias("visitas_totales"),
        F.max(F.struct("version", "reference")).alias("newest"),
        F.collect_list(F.struct("year", "month", "visits")).alias("months"),
    )
    reference = F.col("newest.reference")

    def visits(*parts) -> Column:
        within = F.filter("months", lambda m: reduce(Column.__and__, [m[n] == f(reference) for n, f in parts]))
        return F.aggregate(within, F.lit(0).cast("bigint"), lambda total, m: total + m["visits"])

    return each.select(
        *VISITOR_COLUMNS[:4], visits(("year", F.year)).alias("visitas_anio_actual"),
        visits(("year", F.year), ("month", F.month)).alias("visitas_mes_actual"),
    )


def affected_emails(visits: DataFrame, *by: str) -> DataFrame:
    """The distinct e-mails of a batch, or of each group named in ``by``."""
    return visits.select(*by, "email").distinct()


def visitors_of(affected: DataFrame, history: DataFrame, reference: date) -> DataFrame:
    """Metrics over all history for the affected e-mails only; the others are cut first."""
    touched = affected.select("email").distinct()
    return visitors(history.join(touched, "email", "left_semi"), reference)


def merge_visitors(snapshot: DataFrame, recomputed: DataFrame) -> DataFrame:
    """New snapshot: recomputed rows replace old ones, all others stay as they are.

    Visitors without new visits keep the year and month counts of their last recompute;
    ``visitors`` over all history refreshes them.
    """
    untouched = snapshot.join(recomputed.select("email"), "email", "left_anti")
    return untouched.select(*VISITOR_COLUMNS).unionByName(recomputed.select(*VISITOR_COLUMNS))


def visitor_changes(visits: DataFrame, snapshot: DataFrame, file_key: str = "file_id") -> DataFrame:
    """Per file: visitors inserted and updated, files loaded in the order of their key.

    An e-mail is inserted by the first file that brings it, unless the snapshot has it; every
    later file with it is an update. Two aggregates joined per file: no join on e-mail rows.
    """
    pairs = visits.select(file_key, "email").distinct()
    affected = pairs.groupBy(file_key).agg(F.count(F.lit(1)).alias("visitors_affected"))
    inserted = (
        visits.groupBy("email").agg(F.min(file_key).alias(file_key))
        .join(snapshot.select("email"), "email", "left_anti")
        .groupBy(file_key).agg(F.count(F.lit(1)).alias("visitors_inserted"))
    )
    return affected.join(inserted, file_key, "left").select(
        file_key,
        "visitors_affected",
        F.coalesce("visitors_inserted", F.lit(0)).alias("visitors_inserted"),
        (F.col("visitors_affected") - F.coalesce("visitors_inserted", F.lit(0))).alias(
            "visitors_updated"
        ),
    )


def load_results(
    metrics: DataFrame, visits: DataFrame, rejected: DataFrame, snapshot: DataFrame,
    file_key: str = "file_id",
) -> DataFrame:
    """One row per file with the numbers a load reports; files without visits have zeros."""
    loaded = visits.groupBy(file_key).agg(F.count(F.lit(1)).alias("statistics_inserted"))
    refused = rejected.groupBy(file_key).agg(F.count(F.lit(1)).alias("errors_inserted"))
    joined = (
        metrics.select(file_key)
        .join(loaded, file_key, "left")
        .join(refused, file_key, "left")
        .join(visitor_changes(visits, snapshot, file_key), file_key, "left")
    )
    counts = ["statistics_inserted", "errors_inserted", "visitors_inserted", "visitors_updated"]
    return joined.select(
        file_key,
        *[F.coalesce(c, F.lit(0)).alias(c) for c in counts],
        F.coalesce("statistics_inserted", F.lit(0)).alias("records_loaded"),
    )
