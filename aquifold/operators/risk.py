"""Licence use, trend projection, completeness and the bore-level risk score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aquifold import schemas
from aquifold.functions import AsOf, as_date, as_double, days_before, drop_suspect, latest_date, newest_first, rounded

# Two-sided 80 % normal quantile used for the projection interval (fixed value).
INTERVAL_Z_80 = 1.281552

# Fixed texts of the risk report.
ACTION_BY_ANOMALY = {
    "SalinityIntrusionRisk": "Confirm the salinity result and review coastal bore monitoring.",
    "RapidLevelChange": "Confirm the latest level reading and review recent pumping conditions.",
    "LowRechargeResponse": "Review the recent rainfall response and check for continued low recharge.",
}
ACTION_OVER_ALLOCATION = "Review extraction against the licence allocation and prepare a compliance response."
ACTION_NEAR_ALLOCATION = "Review the seasonal pumping plan and monitor allocation use monthly."
ACTION_DRAWDOWN = "Review the 60-day drawdown outlook and increase monitoring frequency if required."
ACTION_DATA_GAPS = "Resolve recent data gaps before the next water-security review."
ACTION_ROUTINE = "Continue routine monitoring."


def licence_compliance(
    licences: DataFrame, extraction: DataFrame, wells: DataFrame, as_of: AsOf
) -> DataFrame:
    """Allocation used so far and projected to the licence end, for active licences.

    Metered volumes shrink to one row per area and month before licences meet
    them, and licences meet them once per distinct period, so neither a busy area
    nor many licences on it multiply rows.
    """
    today = as_date(as_of)
    start, end = F.col("licence_start_date"), F.col("licence_end_date")
    active = licences.filter((start <= today) & (end >= today))

    monthly = (
        drop_suspect(extraction)
        .filter(F.col("reading_month") <= today)
        .join(wells.select("well_id", "management_area"), "well_id")
        .groupBy("management_area", "reading_month")
        .agg(F.sum(F.col("extraction_ml").cast("decimal(18,2)")).alias("month_ml"))
    )
    periods = active.select("management_area", "licence_start_date").distinct()
    used = (
        periods.join(monthly, "management_area")
        .filter(F.col("reading_month") >= start)
        .groupBy("management_area", "licence_start_date")
        .agg(F.sum("month_ml").cast("double").alias("used_ml"))
    )
    elapsed_days = F.datediff(today, start) + 1
    licence_days = F.datediff(end, start) + 1
    extracted, allocation = F.col("extracted"), F.col("allocation")
    return (
        active.join(used, ["management_area", "licence_start_date"], "left")
        .select(
            "licence_id",
            "management_area",
            as_double("annual_allocation_ml").alias("allocation"),
            F.coalesce("used_ml", F.lit(0.0)).alias("extracted"),
            F.greatest(F.least(elapsed_days / licence_days, F.lit(1.0)), F.lit(0.0)).alias("fraction"),
        )
        .withColumn("projected", extracted / F.nullif(F.col("fraction"), F.lit(0.0)))
        .select(
            "licence_id",
            "management_area",
            allocation.alias("annual_allocation_ml"),
            rounded(extracted, 2).alias("extraction_ytd_ml"),
            rounded(100 * extracted / allocation, 1).alias("allocation_used_pct"),
            rounded(F.col("projected"), 2).alias("projected_year_end_extraction_ml"),
            rounded(100 * F.col("projected") / allocation, 1).alias("projected_allocation_pct"),
        )
    )


def trend_projection(
    readings: DataFrame,
    horizon_days: int = 60,
    window_days: int = 90,
    min_rows: int = 10,
    z: float = INTERVAL_Z_80,
) -> DataFrame:
    """Linear level trend of each bore's newest days, projected with an interval."""
    recent = (
        drop_suspect(readings)
        .select("well_id", "reading_date", as_double("water_level_mbgl").alias("level"))
        # window_days calendar days hold at most that many distinct dates.
        .withColumn("age", F.dense_rank().over(newest_first()))
        .filter(F.col("age") <= window_days)
        .withColumn("last_date", F.max("reading_date").over(Window.partitionBy("well_id")))
        .filter(
            (F.col("reading_date") >= F.date_sub("last_date", window_days - 1))
            & F.col("level").isNotNull()
        )
        .withColumn("x", F.datediff("reading_date", "last_date").cast("double"))
    )
    fits = (
        recent.groupBy("well_id")
        .agg(
            F.count("level").alias("n"),
            F.avg("level").alias("mean_level"),
            F.avg("x").alias("mean_x"),
            (F.max("x") + horizon_days).alias("x_future"),
            F.max_by("level", "reading_date").alias("latest"),
            F.coalesce(F.regr_slope("level", "x"), F.lit(0.0)).alias("slope"),
            F.regr_sxx("level", "x").alias("sxx"),
            F.regr_sxy("level", "x").alias("sxy"),
            F.regr_syy("level", "x").alias("syy"),
        )
        .filter(F.col("n") >= min_rows)
    )
    reach = F.col("x_future") - F.col("mean_x")
    squared_error = F.greatest(F.col("syy") - F.col("slope") * F.col("sxy"), F.lit(0.0))
    leverage = 1 + 1 / F.col("n") + F.coalesce(
        reach * reach / F.nullif(F.col("sxx"), F.lit(0.0)), F.lit(0.0)
    )
    forecast, half, latest = F.col("forecast"), F.col("half"), F.col("latest")
    return (
        fits.withColumn("forecast", F.col("mean_level") + F.col("slope") * reach)
        .withColumn("half", z * F.sqrt(squared_error / (F.col("n") - 2)) * F.sqrt(leverage))
        .select(
            "well_id",
            rounded(latest, 3).alias("latest_level_mbgl"),
            rounded(forecast, 3).alias("forecast_60d_mbgl"),
            rounded(forecast - half, 3).alias("forecast_lower_80_mbgl"),
            rounded(forecast + half, 3).alias("forecast_upper_80_mbgl"),
            rounded(forecast - latest, 3).alias("forecast_change_mbgl"),
        )
    )


def data_completeness(readings: DataFrame, as_of: AsOf, days: int = 30) -> DataFrame:
    """Share of the last ``days`` days with a trusted reading, for bores that have any."""
    recent = drop_suspect(readings).filter(
        F.col("reading_date").between(days_before(as_of, days - 1), as_date(as_of))
    )
    covered = F.countDistinct("reading_date")
    return recent.groupBy("well_id").agg(
        rounded(F.least(100.0 * covered / days, F.lit(100.0)), 1).alias("data_completeness_30d_pct")
    )


def most_severe_recent_event(events: DataFrame, as_of: AsOf, days: int = 30) -> DataFrame:
    """Worst, then newest event of each bore; remaining ties go by type name."""
    rank = (
        F.when(F.col("severity") == "CRITICAL", 3)
        .when(F.col("severity") == "WARNING", 2)
        .when(F.col("severity") == "INFO", 1)
        .otherwise(0)
    )
    worst_first = Window.partitionBy("well_id").orderBy(
        F.col("rank").desc(), F.col("event_date").desc(), F.col("anomaly_type")
    )
    return (
        events.filter(F.col("event_date") >= days_before(as_of, days - 1))
        .select("well_id", "event_date", "anomaly_type", "severity", rank.alias("rank"))
        .withColumn("place", F.row_number().over(worst_first))
        .filter(F.col("place") == 1)
        .select(
            "well_id",
            F.col("anomaly_type").alias("latest_anomaly_type"),
            F.col("severity").alias("latest_anomaly_severity"),
        )
    )


def risk_classify(df: DataFrame, reference_nulls: bool = False) -> DataFrame:
    """Add risk_score, risk_status, risk_drivers and recommended_action.

    A bore with no reading in the window counts as 0 % complete. With
    ``reference_nulls`` unknown completeness carries no penalty instead.
    """
    severity, anomaly = F.col("latest_anomaly_severity"), F.col("latest_anomaly_type")
    use = F.coalesce(as_double("projected_allocation_pct"), F.lit(0.0))
    change = F.coalesce(as_double("forecast_change_mbgl"), F.lit(0.0))
    complete = F.coalesce(
        as_double("data_completeness_30d_pct"), F.lit(100.0 if reference_nulls else 0.0)
    )

    # (condition, points, driver text); within a group the first match counts. The texts are fixed values.
    groups: list[list[tuple[Column, int, Column]]] = [
        [
            (severity == "CRITICAL", 60, F.concat_ws(" ", F.lit("critical"), anomaly, F.lit("event"))),
            (severity == "WARNING", 25, F.concat_ws(" ", F.lit("warning"), anomaly, F.lit("event"))),
        ],
        [
            (use > 100, 50, F.lit("projected extraction above allocation")),
            (use >= 85, 25, F.lit("projected extraction at or above 85% of allocation")),
        ],
        [
            (change >= 0.30, 20, F.lit("60-day projection indicates further drawdown")),
            (change >= 0.15, 10, F.lit("60-day projection indicates moderate drawdown")),
        ],
        [(complete < 95, 20, F.lit("recent data completeness below 95%"))],
    ]

    def first_match(rules: list[tuple[Column, Column]]) -> Column:
        chain = F.when(*rules[0])
        for rule in rules[1:]:
            chain = chain.when(*rule)
        return chain

    points: Column = F.lit(0)
    texts: list[Column] = []
    for group in groups:
        points = points + F.coalesce(
            first_match([(test, F.lit(weight)) for test, weight, _ in group]), F.lit(0)
        )
        texts.append(first_match([(test, text) for test, _, text in group]))
    drivers = F.concat_ws("; ", *texts)
    action = first_match(
        [(anomaly == name, F.lit(text)) for name, text in ACTION_BY_ANOMALY.items()]
        + [
            (use > 100, F.lit(ACTION_OVER_ALLOCATION)),
            (use >= 85, F.lit(ACTION_NEAR_ALLOCATION)),
            (change >= 0.30, F.lit(ACTION_DRAWDOWN)),
            (complete < 95, F.lit(ACTION_DATA_GAPS)),
        ]
    ).otherwise(ACTION_ROUTINE)
    score = F.col("risk_score")
    return (
        df.withColumn("risk_score", F.least(points, F.lit(100)))
        .withColumn(
            "risk_status",
            F.when(score >= 60, "Critical").when(score >= 25, "Watch").otherwise("Normal"),
        )
        .withColumn("risk_drivers", F.when(drivers == "", "no current risk trigger").otherwise(drivers))
        .withColumn("recommended_action", action)
    )


def risk_snapshot(
    wells: DataFrame,
    readings: DataFrame,
    events: DataFrame,
    licences: DataFrame,
    extraction: DataFrame,
    as_of: AsOf | None = None,
    reference_nulls: bool = False,
) -> DataFrame:
    """One row per bore with condition, outlook, licence use and risk.

    Every input is reduced to at most one row per bore (or licence) before it is
    joined. Two licences active in one area would repeat the area's bores; check
    the result with ``constraints.unique_violations`` before storing it.
    """
    today = latest_date(readings) if as_of is None else as_date(as_of)
    combined = (
        wells.join(licence_compliance(licences, extraction, wells, today), "management_area", "left")
        .join(trend_projection(readings), "well_id", "left")
        .join(data_completeness(readings, today), "well_id", "left")
        .join(most_severe_recent_event(events, today), "well_id", "left")
        .withColumn("risk_snapshot_date", today)
    )
    return risk_classify(combined, reference_nulls).select(*schemas.names(schemas.SNAPSHOTS))


def ordered_snapshot(snapshot: DataFrame) -> DataFrame:
    """Report order: worst first, then area and bore."""
    return snapshot.orderBy(F.col("risk_score").desc(), "management_area", "well_id")

