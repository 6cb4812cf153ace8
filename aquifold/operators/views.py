"""Reporting views and the alert workflow's rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aquifold import schemas
from aquifold.functions import AsOf, as_double, days_before, newest_first


def well_status(wells: DataFrame, readings: DataFrame, events: DataFrame, as_of: AsOf) -> DataFrame:
    """Every bore with its newest reading and a status from its recent events."""
    newest = readings.groupBy("well_id").agg(
        F.max("reading_date").alias("last_reading_date"),
        F.max_by("water_level_mbgl", "reading_date").alias("last_water_level_mbgl"),
        F.max_by("tds_mg_per_l", "reading_date").alias("last_tds_mg_per_l"),
    )
    worst = (
        events.filter(F.col("event_date") >= days_before(as_of, 30))
        .groupBy("well_id")
        .agg(
            F.max(F.col("severity") == "CRITICAL").alias("any_critical"),
            F.max(F.col("severity") == "WARNING").alias("any_warning"),
        )
    )
    return (
        wells.join(newest, "well_id", "left")
        .join(worst, "well_id", "left")
        .select(
            "well_id", "location_name", "latitude", "longitude", "aquifer_name",
            "management_area", "coastal_flag", "last_reading_date",
            "last_water_level_mbgl", "last_tds_mg_per_l",
            F.when(F.col("any_critical"), "Critical")
            .when(F.col("any_warning"), "Watch")
            .otherwise("Normal").alias("status"),
        )
    )


def rainfall_recharge(readings: DataFrame, wells: DataFrame, rainfall: DataFrame) -> DataFrame:
    """Mean level per area and day beside each distinct rainfall value of that day.

    Readings shrink to one row per area and day before rainfall joins. The mean
    does not depend on how many stations report a value, so stations are reduced
    to distinct values and never multiply readings.
    """
    level = F.col("water_level_mbgl").cast("decimal(8,3)")
    daily = (
        readings.join(wells.select("well_id", "management_area"), "well_id")
        .groupBy("management_area", F.col("reading_date").alias("obs_date"))
        .agg((F.sum(level).cast("double") / F.count(level)).alias("avg_water_level_mbgl"))
    )
    values = rainfall.select("management_area", "obs_date", "rainfall_mm").distinct()
    return daily.join(values, ["management_area", "obs_date"], "left").select(
        "management_area", "obs_date", "avg_water_level_mbgl", "rainfall_mm"
    )


def latest_risk_snapshot(snapshots: DataFrame) -> DataFrame:
    """Newest snapshot of each bore."""
    return (
        snapshots.withColumn("place", F.row_number().over(newest_first("risk_snapshot_date")))
        .filter(F.col("place") == 1)
        .select(*schemas.names(schemas.SNAPSHOTS))
    )


def licence_compliance_view(licences: DataFrame, wells: DataFrame, extraction: DataFrame) -> DataFrame:
    """Extraction within each licence's own period, for all licences."""
    monthly = (
        extraction.filter(F.col("data_quality_flag") != "suspect")
        .join(wells.select("well_id", "management_area"), "well_id")
        .groupBy("management_area", "reading_month")
        .agg(F.sum(F.col("extraction_ml").cast("decimal(18,2)")).alias("month_ml"))
    )
    period = ["management_area", "licence_start_date", "licence_end_date"]
    used = (
        licences.select(*period).distinct()
        .join(monthly, "management_area")
        .filter(F.col("reading_month").between(F.col("licence_start_date"), F.col("licence_end_date")))
        .groupBy(*period)
        .agg(F.sum("month_ml").alias("used_ml"))
    )
    used_ml = F.coalesce(F.col("used_ml"), F.lit(0).cast("decimal(28,2)"))
    allocation = F.col("annual_allocation_ml").cast("decimal(12,2)")
    pct = F.lit(100) * used_ml.cast("decimal(20,2)") / F.nullif(allocation, F.lit(0).cast("decimal(12,2)"))
    return licences.join(used, period, "left").select(
        "licence_id", *period, "annual_allocation_ml", "compliance_limit_pct",
        used_ml.cast("decimal(28,2)").alias("extraction_to_date_ml"),
        pct.cast("decimal(7,2)").alias("allocation_used_pct"),
    )


def unsent_critical_events(events: DataFrame, wells: DataFrame) -> DataFrame:
    """CRITICAL events nobody was alerted to yet, newest first."""
    return critical_events_to_send(events, wells).orderBy(F.col("event_date").desc())


def critical_events_to_send(events: DataFrame, wells: DataFrame) -> DataFrame:
    """The same events in no order, as a sink takes them."""
    return (
        events.filter((F.col("severity") == "CRITICAL") & (F.col("alert_sent") == 0))
        .join(wells.select("well_id", "location_name", "management_area").hint("merge"), "well_id")
        .select(
            "event_id", "well_id", "location_name", "management_area", "event_date",
            "anomaly_type", "severity", "actual_value", "detail",
        )
    )


def mark_alerted(events: DataFrame, sent: DataFrame) -> DataFrame:
    """``events`` with alert_sent set for the event ids in ``sent``."""
    ids = sent.select("event_id").distinct().withColumn("now_sent", F.lit(1)).hint("merge")
    return (
        events.join(ids, "event_id", "left")
        .withColumn("alert_sent", F.coalesce("now_sent", "alert_sent"))
        .select(*events.columns)
    )


def alert_messages(unsent: DataFrame) -> DataFrame:
    """Mail subject, mail body and chat text of each unsent event.

    A missing field renders as empty text.
    """
    def text(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    # The texts are fixed values.
    return unsent.select(
        "event_id",
        F.format_string(
            "CRITICAL groundwater alert: %s at %s", text("anomaly_type"), text("location_name")
        ).alias("subject"),
        F.format_string(
            "<p><b>Management area:</b> %s</p><p><b>Event date:</b> %s</p><p><b>Detail:</b> %s</p>",
            text("management_area"), text("event_date"), text("detail"),
        ).alias("body"),
        F.format_string(
            "CRITICAL: %s detected at %s (%s). %s",
            text("anomaly_type"), text("location_name"), text("management_area"), text("detail"),
        ).alias("chat_text"),
    )


def level_moving_average(readings: DataFrame, wells: DataFrame, rainfall: DataFrame, rows: int = 7) -> DataFrame:
    """Area level with its moving average, beside daily and cumulative rainfall.

    Works on the daily area series, whose windows are bounded by the calendar.
    """
    level = F.col("water_level_mbgl").cast("decimal(8,3)")
    mm = F.col("rainfall_mm").cast("decimal(7,2)")
    daily = (
        readings.join(wells.select("well_id", "management_area"), "well_id")
        .groupBy("management_area", F.col("reading_date").alias("obs_date"))
        .agg((F.sum(level).cast("double") / F.count(level)).alias("level_mbgl"))
    )
    rain = rainfall.groupBy("management_area", "obs_date").agg(
        (F.sum(mm).cast("double") / F.count(mm)).alias("rainfall_mm")
    )
    window = Window.partitionBy("management_area").orderBy("obs_date").rowsBetween(-(rows - 1), 0)
    return daily.join(rain, ["management_area", "obs_date"], "left").select(
        "management_area", "obs_date", "level_mbgl",
        F.avg("level_mbgl").over(window).alias("level_moving_avg"),
        as_double("rainfall_mm").alias("rainfall_mm"),
        F.sum("rainfall_mm").over(window).alias("rainfall_cumulative_mm"),
    )
