"""Live fleet queries; ``latest`` is the newest reading date, taken as now."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aquifold.functions import AsOf, as_date, as_double, days_before, newest_first, rounded


def bore_status_now(wells: DataFrame, events: DataFrame, latest: AsOf) -> DataFrame:
    """Status from events since the day before: any event is at least Watch."""
    recent = (
        events.filter(F.col("event_date") >= days_before(latest, 1))
        .groupBy("well_id").agg(F.max(F.col("severity") == "CRITICAL").alias("any_critical"))
    )
    return wells.select("well_id").join(recent, "well_id", "left").select(
        "well_id",
        F.when(F.col("any_critical").isNull(), "Normal")
        .when(F.col("any_critical"), "Critical").otherwise("Watch").alias("status"),
    )


def latest_reading(readings: DataFrame) -> DataFrame:
    return readings.groupBy("well_id").agg(
        F.max("reading_date").alias("reading_date"),
        rounded(F.max_by(as_double("water_level_mbgl"), "reading_date"), 3).alias("level_mbgl"),
        rounded(F.max_by(as_double("tds_mg_per_l"), "reading_date"), 1).alias("tds_mg_per_l"),
    )


def _last_issue(forecasts: DataFrame) -> DataFrame:
    return (
        forecasts.withColumn("place", F.rank().over(newest_first()))
        .filter(F.col("place") == 1)
        .select(
            "well_id", "target_date",
            rounded(as_double("predicted"), 3).alias("predicted"),
            rounded(as_double("actual"), 3).alias("actual"),
        )
    )


def last_issued_forecast(forecasts: DataFrame) -> DataFrame:
    """Points of each bore's newest issue, by target date."""
    return _last_issue(forecasts).orderBy("well_id", "target_date")


def _recent_scores(scores: DataFrame, latest: AsOf, days: int) -> DataFrame:
    return scores.filter(F.col("reading_date") >= days_before(latest, days)).select(
        "well_id", "reading_date", rounded(F.col("anomaly_score"), 4).alias("anomaly_score"), "is_anomaly"
    )


def anomaly_trend(scores: DataFrame, latest: AsOf, days: int = 30) -> DataFrame:
    return _recent_scores(scores, latest, days).orderBy("well_id", "reading_date")


def _recent_events(events: DataFrame, latest: AsOf, days: int) -> DataFrame:
    return events.filter(F.col("event_date") >= days_before(latest, days)).select(
        "well_id", "event_date", "anomaly_type", "severity", "detail"
    )


def active_alerts(events: DataFrame, latest: AsOf, days: int = 3) -> DataFrame:
    """Recent events of the whole fleet, newest first."""
    return _recent_events(events, latest, days).orderBy(F.col("event_date").desc(), "well_id", "anomaly_type")


def fleet_snapshot(
    wells: DataFrame, readings: DataFrame, events: DataFrame, forecasts: DataFrame, latest: AsOf
) -> DataFrame:
    """All bores with status, newest reading and forecast change."""
    forecast = forecasts.groupBy("well_id").agg(
        rounded(
            F.max_by(as_double("predicted"), F.struct("reading_date", "target_date")), 3
        ).alias("forecast_30d")
    )
    return (
        wells.join(bore_status_now(wells, events, latest), "well_id")
        .join(latest_reading(readings), "well_id", "left")
        .join(forecast, "well_id", "left")
        .select(
            "well_id", "location_name", "aquifer_name", "management_area",
            (F.coalesce(F.col("coastal_flag").cast("int"), F.lit(0)) != 0).alias("coastal_flag"),
            as_double("latitude").alias("lat"), as_double("longitude").alias("lon"),
            "status", "reading_date", "level_mbgl", "tds_mg_per_l", "forecast_30d",
            rounded(F.col("forecast_30d") - F.col("level_mbgl"), 3).alias("forecast_delta"),
        )
    )


def _listed(df: DataFrame, name: str, order: list[Column], fields: list[str]) -> DataFrame:
    """Rows of each bore as one array, in the order of ``order``; rows per bore must be few."""
    keyed = F.struct(*[o.alias(f"k{i}") for i, o in enumerate(order)], F.struct(*fields).alias("item"))
    rows = F.sort_array(F.collect_list(keyed))
    return df.groupBy("well_id").agg(F.transform(rows, lambda r: r["item"]).alias(name))


def bore_detail(
    wells: DataFrame,
    readings: DataFrame,
    events: DataFrame,
    forecasts: DataFrame,
    scores: DataFrame,
    latest: AsOf,
    history_rows: int = 90,
    trend_days: int = 30,
    alert_days: int = 3,
) -> DataFrame:
    """Nested detail of every bore: attributes, status, last rows, forecast, trend, alerts.

    Each list is limited by rows or days before it is gathered.
    """
    history = (
        readings.withColumn("place", F.row_number().over(newest_first()))
        .filter(F.col("place") <= history_rows)
        .select(
            "well_id", "reading_date",
            rounded(as_double("water_level_mbgl"), 3).alias("level_mbgl"),
            rounded(as_double("tds_mg_per_l"), 1).alias("tds_mg_per_l"),
        )
    )
    date_then = F.col("reading_date")
    lists = [
        _listed(history, "history", [date_then], ["reading_date", "level_mbgl", "tds_mg_per_l"]),
        _listed(
            _last_issue(forecasts), "forecast_series", [F.col("target_date")],
            ["target_date", "predicted", "actual"],
        ),
        _listed(
            _recent_scores(scores, latest, trend_days), "anomaly_trend", [date_then],
            ["reading_date", "anomaly_score", "is_anomaly"],
        ),
        _listed(
            _recent_events(events, latest, alert_days), "active_alerts",
            [F.datediff(F.lit("1970-01-01").cast("date"), "event_date"), F.col("anomaly_type")],
            ["event_date", "anomaly_type", "severity", "detail"],
        ),
    ]
    detail = fleet_snapshot(wells, readings, events, forecasts, latest).select(
        "well_id",
        F.struct("location_name", "aquifer_name", "management_area", "coastal_flag", "lat", "lon").alias("meta"),
        "status",
        F.struct("reading_date", "level_mbgl", "tds_mg_per_l").alias("latest_reading"),
    )
    for part in lists:
        detail = detail.join(part, "well_id", "left")
    for part in ("history", "forecast_series", "anomaly_trend", "active_alerts"):
        detail = detail.withColumn(part, F.coalesce(part, F.array()))
    return detail


def fleet_summary(snapshot: DataFrame, latest: AsOf) -> DataFrame:
    level = F.col("level_mbgl").cast("decimal(18,3)")
    per_status = [
        F.count_if(F.col("status") == name).alias(name.lower()) for name in ("Critical", "Watch", "Normal")
    ]
    return snapshot.agg(
        F.count(F.lit(1)).alias("total_bores"), *per_status,
        rounded(F.sum(level).cast("double") / F.count(level), 2).alias("avg_level_mbgl"),
    ).select(as_date(latest).alias("as_of"), "*")
