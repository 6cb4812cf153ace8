"""Rule-based anomaly detectors.

Each takes the trusted readings (and rainfall) and returns one row per flagged
bore in the column order of ``schemas.DETECTED_EVENTS``. All three judge only a
bore's newest readings, so the newest rows are cut out per bore first: the rank
limit is applied before the exchange as well as after it, and the whole history
contributes just a per-bore count.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aquifold import schemas
from aquifold.functions import as_double, fixed, newest_first, rounded, snap

RAPID_CHANGE = "RapidLevelChange"
LOW_RECHARGE = "LowRechargeResponse"
SALINITY = "SalinityIntrusionRisk"

Detector = Callable[[DataFrame, DataFrame], DataFrame]


def rapid_level_change(
    readings: DataFrame,
    baseline_rows: int = 7,
    min_baseline: int = 3,
    warning_sigma: float = 2.0,
    critical_sigma: float = 3.0,
    min_observations: int = 10,
    observations: DataFrame | None = None,
) -> DataFrame:
    """Newest level far off the mean of the rows before it.

    ``observations`` (well_id, observations) counts each bore's levels where ``readings`` holds only the newest rows.
    """
    level = as_double("water_level_mbgl")
    series = readings.select("well_id", "reading_date", level.alias("level"))
    if observations is None:
        observations = series.groupBy("well_id").agg(F.count("level").alias("observations"))
    history = observations.filter(F.col("observations") >= min_observations)
    newest = (
        series.withColumn("age", F.row_number().over(newest_first()))
        .filter(F.col("age") <= baseline_rows + 1)
    )
    is_last = F.col("age") == 1
    earlier = F.when(~is_last, F.col("level"))
    stats = (
        newest.groupBy("well_id")
        .agg(
            F.max(F.when(is_last, F.col("reading_date"))).alias("event_date"),
            F.max(F.when(is_last, F.col("level"))).alias("actual"),
            F.count(earlier).alias("n"),
            F.avg(earlier).alias("mean"),
            F.stddev_samp(earlier).alias("std"),
        )
        .filter((F.col("n") >= min_baseline) & (snap(F.col("std")) > 0) & F.col("actual").isNotNull())
        .join(history.hint("merge"), "well_id")
        .withColumn("z", snap(F.abs(F.col("actual") - F.col("mean")) / F.col("std")))
        .filter(F.col("z") >= warning_sigma)
    )
    side = F.signum(F.col("actual") - F.col("mean"))
    return stats.select(
        "well_id",
        "event_date",
        F.lit(RAPID_CHANGE).alias("anomaly_type"),
        F.when(F.col("z") >= critical_sigma, "CRITICAL").otherwise("WARNING").alias("severity"),
        rounded(F.col("mean") + side * warning_sigma * F.col("std"), 3).alias("threshold_value"),
        rounded(F.col("actual"), 3).alias("actual_value"),
        F.format_string(  # fixed text
            f"Water level %s mBGL is %sσ %s than the {baseline_rows}-day baseline (%s mBGL).",
            fixed(F.col("actual"), 2), fixed(F.col("z"), 1),
            F.when(side > 0, "deeper").otherwise("shallower"), fixed(F.col("mean"), 2),
        ).alias("detail"),
    )


def latest_rain_event(
    bores: DataFrame, rainfall: DataFrame, window_rows: int = 7, threshold_mm: float = 20.0
) -> DataFrame:
    """Newest heavy-rain day of each bore's area up to the bore's ``cutoff`` date.

    ``bores`` holds well_id, area, cutoff. Each area's calendar is laid out with
    the event in force on every day, and bores look their cutoff up by equality:
    the work per area is bounded by its number of days, not by bores times events.
    """
    per_area = Window.partitionBy("area").orderBy("day")
    last_day = rainfall.agg(F.max("day").alias("day")).scalar()
    event_days = (
        rainfall.withColumn("mm", as_double("rainfall_mm"))
        .withColumn("total", F.sum("mm").over(per_area.rowsBetween(-(window_rows - 1), 0)))
        .filter(snap(F.col("total")) > threshold_mm)
    )
    in_force = (
        event_days.select("area", "day").distinct()
        .select(
            "area", F.col("day").alias("event_date"),
            F.coalesce(F.date_sub(F.lead("day").over(per_area), 1), last_day).alias("until"),
        )
        .select("area", "event_date", F.explode(F.sequence("event_date", "until")).alias("day"))
    )
    return (
        bores.withColumn("day", F.least(F.col("cutoff"), last_day)).join(in_force, ["area", "day"])
        .select("well_id", "event_date")
    )


def low_recharge_response(
    readings: DataFrame,
    rainfall: DataFrame,
    rain_rows: int = 7,
    rain_threshold_mm: float = 20.0,
    response_days: int = 14,
    min_rise_m: float = 0.10,
) -> DataFrame:
    """Level fails to rise after the newest heavy rain with a complete response window.

    Rain counts for the area of the bore's last reading; when either side has no
    area column, all rain counts for every bore.
    """
    local = "management_area" in rainfall.columns and "management_area" in readings.columns
    area: Column = F.max_by("management_area", "reading_date") if local else F.lit("all")
    bores = (
        readings.groupBy("well_id")
        .agg(F.date_sub(F.max("reading_date"), response_days).alias("cutoff"), area.alias("area"))
    )
    rain = rainfall.select(
        (F.col("management_area") if local else F.lit("all")).alias("area"),
        F.col("obs_date").alias("day"),
        "rainfall_mm",
    )
    events = latest_rain_event(bores, rain, rain_rows, rain_threshold_mm)
    responses = recharge_responses(readings, events, response_days)
    return recharge_events(responses, rain_rows, rain_threshold_mm, response_days, min_rise_m)


def recharge_responses(readings: DataFrame, events: DataFrame, response_days: int = 14) -> DataFrame:
    """Per bore and rain event the level ``before`` it (the last up to its day) and the ``shallowest`` after it."""
    date, level = F.col("reading_date"), F.col("level")
    in_window = (date > F.col("event_date")) & (date <= F.date_add(F.col("event_date"), response_days))
    earlier = F.when(date <= F.col("event_date"), date)
    return (
        readings.select("well_id", "reading_date", as_double("water_level_mbgl").alias("level"))
        .join(events, "well_id")
        .filter(date <= F.date_add(F.col("event_date"), response_days))
        .groupBy("well_id", "event_date")
        .agg(
            F.max(earlier).alias("before_date"),
            F.max_by(level, earlier).alias("before"),
            F.min(F.when(in_window, level)).alias("shallowest"),
        )
    )


def recharge_events(
    responses: DataFrame,
    rain_rows: int = 7,
    rain_threshold_mm: float = 20.0,
    response_days: int = 14,
    min_rise_m: float = 0.10,
) -> DataFrame:
    """Events of the responses that rise too little; a missing side is too little data to judge."""
    weak = responses.withColumn("rise", snap(F.col("before") - F.col("shallowest"))).filter(F.col("rise") < min_rise_m)
    return weak.select(
        "well_id",
        "event_date",
        F.lit(LOW_RECHARGE).alias("anomaly_type"),
        F.lit("WARNING").alias("severity"),
        F.lit(float(min_rise_m)).alias("threshold_value"),
        rounded(F.col("rise"), 3).alias("actual_value"),
        F.format_string(  # fixed text
            f"After a rainfall event ({rain_rows}-day total > {rain_threshold_mm:.0f} mm) the water table rose "
            f"only %s m within {response_days} days (expected >= {min_rise_m:.2f} m).",
            fixed(F.col("rise"), 2),
        ).alias("detail"),
    )


def salinity_intrusion(
    readings: DataFrame,
    window_days: int = 30,
    min_slope: float = 1.0,
    min_r2: float = 0.5,
    min_observations: int = 10,
    observations: DataFrame | None = None,
) -> DataFrame:
    """Sustained linear rise of dissolved solids over a bore's newest days.

    ``observations`` (well_id, observations) counts each bore's values where ``readings`` holds only the newest rows.
    """
    series = readings.select(
        "well_id", "reading_date", as_double("tds_mg_per_l").alias("tds"), "coastal_flag"
    )
    history = series.groupBy("well_id").agg(
        F.count("tds").alias("observations"), F.max_by("coastal_flag", "reading_date").alias("coastal_flag")
    )
    if observations is not None:
        history = history.drop("observations").join(observations.hint("merge"), "well_id")
    history = history.filter(F.col("observations") >= min_observations)
    # The window spans window_days + 1 calendar days, so it lies within that many
    # distinct dates; dense_rank keeps every row of those dates.
    newest = (
        series.drop("coastal_flag")
        .withColumn("age", F.dense_rank().over(newest_first()))
        .filter(F.col("age") <= window_days + 1)
        .withColumn("last_date", F.max("reading_date").over(Window.partitionBy("well_id")))
        .filter((F.col("reading_date") >= F.date_sub("last_date", window_days)) & F.col("tds").isNotNull())
        .withColumn("x", F.datediff("reading_date", "last_date").cast("double"))
    )
    trends = (
        newest.groupBy("well_id")
        .agg(
            F.max("reading_date").alias("event_date"),
            F.count("tds").alias("n"),
            (F.max("x") - F.min("x")).alias("span"),
            snap(F.regr_slope("tds", "x")).alias("slope"),
            snap(F.regr_r2("tds", "x")).alias("r2"),
        )
        .filter(
            (F.col("n") >= 3) & (F.col("span") > 0)
            & (F.col("slope") >= min_slope) & (F.col("r2") >= min_r2)
        )
        .join(history.hint("merge"), "well_id")
    )
    coastal = F.coalesce(F.col("coastal_flag").cast("int"), F.lit(0)) != 0
    return trends.select(
        "well_id",
        "event_date",
        F.lit(SALINITY).alias("anomaly_type"),
        F.when(coastal, "CRITICAL").otherwise("WARNING").alias("severity"),
        F.lit(float(min_slope)).alias("threshold_value"),
        rounded(F.col("slope"), 3).alias("actual_value"),
        F.concat(  # fixed text
            F.format_string(
                f"TDS rising %s mg/L per day over {window_days} days (R²=%s)",
                fixed(F.col("slope"), 1), fixed(F.col("r2"), 2),
            ),
            F.when(coastal, " in a coastal aquifer.").otherwise("."),
        ).alias("detail"),
    )


DEFAULT_DETECTORS: tuple[Detector, ...] = (
    lambda readings, rainfall: rapid_level_change(readings),
    low_recharge_response,
    lambda readings, rainfall: salinity_intrusion(readings),
)


def run_all_detectors(
    readings: DataFrame, rainfall: DataFrame, detectors: Iterable[Detector] = DEFAULT_DETECTORS
) -> DataFrame:
    """Union of all detectors' events.

    A detector is any callable ``(readings, rainfall) -> events``; its output must
    have the event columns.
    """
    expected = schemas.names(schemas.DETECTED_EVENTS)
    outputs = []
    for detector in detectors:
        events = detector(readings, rainfall)
        if events.columns != expected:
            raise ValueError(f"detector returned {events.columns}, expected {expected}")
        outputs.append(events)
    return reduce(DataFrame.unionByName, outputs)
