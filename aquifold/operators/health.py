"""Operational health queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aquifold.functions import AsOf, as_date, as_double, by_bore, days_before


def staleness(readings: DataFrame, as_of: AsOf) -> DataFrame:
    latest = F.max("reading_date")
    return readings.agg(
        latest.alias("latest_reading"),
        F.datediff(as_date(as_of), latest).alias("days_behind"),
        F.countDistinct("well_id").alias("bores_reporting"),
    )


def detector_heartbeat(events: DataFrame, as_of: str | Column) -> DataFrame:
    """Last detection and number of events in the 24 hours up to ``as_of`` (a timestamp)."""
    now = F.to_timestamp(F.lit(as_of)) if isinstance(as_of, str) else as_of
    return events.filter(F.col("detected_at") >= now - F.expr("INTERVAL 1 DAY")).agg(
        F.max("detected_at").alias("last_detector_run"), F.count(F.lit(1)).alias("events_last_24h")
    )


def rows_loaded_by_day(readings: DataFrame, as_of: AsOf, days: int = 7) -> DataFrame:
    return (
        readings.filter(F.col("reading_date") >= days_before(as_of, days))
        .groupBy("reading_date").agg(F.count(F.lit(1)).alias("rows_loaded"))
        .orderBy(F.col("reading_date").desc())
    )


def duplicate_readings(readings: DataFrame) -> DataFrame:
    return (
        readings.groupBy("well_id", "reading_date").agg(F.count(F.lit(1)).alias("duplicate_rows"))
        .filter(F.col("duplicate_rows") > 1)
    )


def completeness_by_bore(wells: DataFrame, readings: DataFrame, as_of: AsOf, days: int = 30) -> DataFrame:
    """Readings per bore since ``days`` days ago, suspect ones included and uncapped."""
    counts = (
        readings.filter(F.col("reading_date") >= days_before(as_of, days))
        .groupBy("well_id").agg(F.count("reading_date").alias("n"))
    )
    n = F.coalesce("n", F.lit(0))
    return (
        wells.select("well_id").join(counts, "well_id", "left")
        .select("well_id", n.alias("readings"), (100.0 * n / days).alias("pct_complete"))
        .orderBy("pct_complete", "well_id")
    )


def day_on_day_movement(readings: DataFrame, as_of: AsOf, days: int = 30) -> DataFrame:
    """Level change against the previous row of the last ``days`` days, largest first."""
    level = as_double("water_level_mbgl")
    delta = F.round(level - F.lag(level).over(by_bore()), 6)
    return (
        readings.filter(F.col("reading_date") >= days_before(as_of, days))
        .select("well_id", "reading_date", level.alias("water_level_mbgl"), delta.alias("delta_m"))
        .orderBy(F.abs("delta_m").desc(), "well_id", "reading_date")
    )


def critical_last_7d(events: DataFrame, as_of: str | Column) -> DataFrame:
    now = F.to_timestamp(F.lit(as_of)) if isinstance(as_of, str) else as_of
    return events.filter(
        (F.col("severity") == "CRITICAL") & (F.col("detected_at") >= now - F.expr("INTERVAL 7 DAYS"))
    ).agg(F.count(F.lit(1)).alias("critical_events"))


def load_status(loads: DataFrame) -> DataFrame:
    """Status of each source's load; success with no rows shows as Empty.

    ``loads`` holds source, rows and error (NULL when the load succeeded).
    """
    status = (
        F.when(F.col("error").isNotNull(), "Failed").when(F.col("rows") == 0, "Empty").otherwise("Succeeded")
    )
    return loads.select("source", "rows", status.alias("status"))
