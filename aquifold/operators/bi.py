"""Report measures over the risk snapshot.

A slicer is a filter on the input, a category axis is ``by``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aquifold.functions import as_double

DEFAULT_ACTION = "Select one bore to review the recommended action."

# Fixed colours of the two report palettes and their shared fallback.
STATUS_COLOURS = {"Critical": "#D64550", "Watch": "#B98600", "Normal": "#107C10"}
BAR_COLOURS = {"Critical": "#D64550", "Watch": "#E8A33D", "Normal": "#107C10"}
FALLBACK_COLOUR = "#605E5C"


def _mean(name: str, scale: int = 3) -> Column:
    """Mean of a decimal measure, summed exactly so partial order cannot matter."""
    value = F.col(name).cast(f"decimal(18,{scale})")
    return F.sum(value).cast("double") / F.count(value)


def risk_kpis(snapshot: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """The report's card measures, in total or per category."""
    above = as_double("projected_allocation_pct") > 100
    return snapshot.groupBy(*by).agg(
        F.count_if(F.col("risk_status") == "Critical").alias("critical_bores"),
        F.count_if(F.col("risk_status") == "Watch").alias("watch_bores"),
        _mean("risk_score").alias("avg_risk_score"),
        F.max(as_double("projected_allocation_pct")).alias("max_projected_allocation_pct"),
        F.countDistinct(F.when(above, F.col("well_id"))).alias("bores_above_allocation"),
        _mean("forecast_change_mbgl").alias("avg_level_change_60d"),
        _mean("data_completeness_30d_pct").alias("avg_completeness_30d"),
    )


def kpis_by_area(snapshot: DataFrame) -> DataFrame:
    return risk_kpis(snapshot, ("management_area",))


def _single_value(name: str) -> Column:
    """The value if there is exactly one distinct value, blank included; else NULL."""
    blanks = F.max(F.col(name).isNull().cast("int"))
    distinct = F.countDistinct(name) + F.coalesce(blanks, F.lit(0))
    return F.when(distinct == 1, F.max(name))


def selected_action(snapshot: DataFrame, default: str = DEFAULT_ACTION, by: tuple[str, ...] = ()) -> DataFrame:
    return snapshot.groupBy(*by).agg(
        F.coalesce(_single_value("recommended_action"), F.lit(default)).alias("selected_action")
    )


def risk_by_location(snapshot: DataFrame) -> DataFrame:
    return (
        snapshot.groupBy("location_name").agg(F.sum("risk_score").alias("risk_score"))
        .orderBy(F.col("risk_score").desc(), "location_name")
    )


def allocation_by_licence(snapshot: DataFrame) -> DataFrame:
    return snapshot.groupBy("licence_id").agg(
        _mean("allocation_used_pct").alias("avg_allocation_used_pct"),
        _mean("projected_allocation_pct").alias("avg_projected_allocation_pct"),
    )


def level_vs_forecast(snapshot: DataFrame) -> DataFrame:
    return snapshot.groupBy("location_name").agg(
        _mean("latest_level_mbgl").alias("avg_latest_level_mbgl"),
        _mean("forecast_60d_mbgl").alias("avg_forecast_60d_mbgl"),
    )


def risk_table(snapshot: DataFrame) -> DataFrame:
    return snapshot.select(
        "location_name", "management_area", "risk_status", "risk_score", "latest_level_mbgl",
        "forecast_60d_mbgl", "forecast_change_mbgl", "projected_allocation_pct",
        "data_completeness_30d_pct", "recommended_action",
    ).orderBy(F.col("risk_score").desc(), "location_name")


def licences_in_filter(licences: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Licences left visible by a filter on the snapshot."""
    return licences.join(snapshot, "licence_id", "left_semi")


def colour_of(status: str | Column, palette: dict[str, str]) -> Column:
    column = F.col(status) if isinstance(status, str) else status
    chain = F.lit(FALLBACK_COLOUR)
    for name, colour in palette.items():
        chain = F.when(column == name, colour).otherwise(chain)
    return chain


def status_colour(snapshot: DataFrame, by: tuple[str, ...] = ("well_id",)) -> DataFrame:
    """Colour of the single status in each group; mixed or no status is grey."""
    status = F.col("status")
    return (
        snapshot.groupBy(*by).agg(_single_value("risk_status").alias("status"))
        .select(
            *by,
            colour_of(status, STATUS_COLOURS).alias("status_colour"),
            colour_of(status, BAR_COLOURS).alias("bar_colour"),
        )
    )


def date_dimension(readings: DataFrame, rainfall: DataFrame) -> DataFrame:
    """Every day between the first and last observation of either table."""
    bounds = (
        readings.select(F.col("reading_date").alias("day"))
        .unionByName(rainfall.select(F.col("obs_date").alias("day")))
        .agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"))
    )
    day = F.col("date")
    return (
        bounds.filter(F.col("first_day").isNotNull())
        .select(F.explode(F.sequence("first_day", "last_day")).alias("date"))
        .select(
            "date", F.year(day).alias("year"), F.month(day).alias("month"),
            F.dayofmonth(day).alias("day"), F.date_format(day, "yyyy-MM").alias("year_month"),
        )
    )


def calendar_activity(dates: DataFrame, readings: DataFrame, rainfall: DataFrame, events: DataFrame) -> DataFrame:
    """Readings, rain and events counted per calendar day.

    Events relate to the calendar only where asked for, by event_date.
    """
    def daily(df: DataFrame, column: str, name: str) -> DataFrame:
        return df.groupBy(F.col(column).alias("date")).agg(F.count(F.lit(1)).alias(name))

    joined = dates.select("date")
    for df, column, name in (
        (readings, "reading_date", "readings"), (rainfall, "obs_date", "rain_rows"), (events, "event_date", "events"),
    ):
        joined = joined.join(daily(df, column, name), "date", "left")
    return joined.select("date", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("readings", "rain_rows", "events")])


def status_by_area(status: DataFrame) -> DataFrame:
    """Bores, status counts and mean level per area."""
    per_status = [
        F.count_if(F.col("status") == name).alias(name.lower()) for name in ("Critical", "Watch", "Normal")
    ]
    return status.groupBy("management_area").agg(
        F.count(F.lit(1)).alias("bores"), *per_status, _mean("last_water_level_mbgl").alias("avg_level_mbgl")
    )


def licence_year(licences: DataFrame) -> DataFrame:
    """Licence period as text such as 2025-26."""
    return licences.select(
        "licence_id",
        F.concat(
            F.year("licence_start_date").cast("string"), F.lit("-"),
            F.date_format("licence_end_date", "yy"),
        ).alias("licence_year"),
    )
