"""Leakage-safe features for forecasting and anomaly scoring.

All per-bore features share one window specification, so a bore's rows are
sorted once for every lag, rolling statistic and lead.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aquifold.functions import as_double, by_bore, snap, trailing, with_moments

LAGS = (1, 7, 14, 30)
ROLLS = (7, 30)
RAIN_ROWS = (7, 14, 30)
ANOMALY_FEATURES = ["level_z", "tds_z", "level_diff", "tds_diff", "rain_sum_7"]

_NOT_FEATURES = {
    "well_id", "reading_date", "target", "target_date",
    "water_level_mbgl", "data_quality_flag", "pumping_event",
}


def area_names(wells: DataFrame) -> list[str]:
    """The areas that become indicator columns: one column, and one collected name, per area."""
    return sorted(row[0] for row in wells.select("management_area").na.drop().distinct().collect())


def with_rain(readings: DataFrame, wells: DataFrame, rainfall: DataFrame) -> DataFrame:
    """Readings with bore attributes and the day's rain, 0 where none is recorded.

    ``rainfall`` holds one row per (area and) day.
    """
    keys = ["reading_date"] + (["management_area"] if "management_area" in rainfall.columns else [])
    rain = rainfall.withColumnRenamed("obs_date", "reading_date").select(
        *keys, as_double("rainfall_mm").alias("rainfall_mm")
    )
    return (
        readings.withColumn("water_level_mbgl", as_double("water_level_mbgl"))
        .withColumn("tds_mg_per_l", as_double("tds_mg_per_l"))
        .join(wells.select("well_id", "coastal_flag", "management_area"), "well_id", "left")
        .join(rain, keys, "left")
        .na.fill(0.0, ["rainfall_mm"])
    )


def history_features(
    wells: DataFrame,
    readings: DataFrame,
    rainfall: DataFrame,
    horizons: tuple[int, ...],
    areas: list[str] | None = None,
    only: list[str] | None = None,
) -> DataFrame:
    """Features known at each reading, and the level each of ``horizons`` rows later as target_<rows>.

    ``only`` names rolling means and deviations of the level: the rows are the same, but no other feature is computed
    and neither bores nor rain are joined.
    """
    if only is not None:
        return _rolled_levels(readings, horizons, only)
    bore = by_bore()
    level, mm = F.col("water_level_mbgl"), F.col("rainfall_mm")
    angle = 2 * math.pi * F.dayofyear("reading_date") / 365.25

    columns: dict[str, Column] = {f"level_lag_{n}": F.lag(level, n).over(bore) for n in LAGS}
    rolls = _level_rolls()
    columns |= {f"rain_sum_{n}": F.sum(mm).over(trailing(bore, n)) for n in RAIN_ROWS}
    columns |= {
        "tds_mg_per_l": F.last("tds_mg_per_l", ignorenulls=True).over(bore),
        "season_sin": F.sin(angle),
        "season_cos": F.cos(angle),
        "level_now": level,
    }
    columns |= {f"target_{h}": F.lead(level, h).over(bore) for h in horizons}
    for area in area_names(wells) if areas is None else areas:
        columns[f"area_{area}"] = F.coalesce(F.col("management_area") == area, F.lit(False)).cast("int")
    frame = with_rain(readings, wells, rainfall)
    known = with_moments(frame.withColumns(columns), rolls)
    lagged = [f"level_lag_{n}" for n in LAGS]
    later = [c for c in columns if c not in frame.columns and c not in lagged]
    return (
        known.select(*[
            F.col(f"`{c}`") for c in [*frame.columns, *lagged, *[name for pair in rolls for name in pair], *later]
        ])
        .drop("management_area")
        .filter(F.col(f"level_lag_{max(LAGS)}").isNotNull())
    )


def _rolled_levels(readings: DataFrame, horizons: tuple[int, ...], names: list[str]) -> DataFrame:
    bore, level, oldest = by_bore(), F.col("water_level_mbgl"), f"level_lag_{max(LAGS)}"
    rolls = {pair: spec for pair, spec in _level_rolls().items() if set(pair) & set(names)}
    levels = readings.select("well_id", "reading_date", as_double("water_level_mbgl").alias("water_level_mbgl"))
    columns = {oldest: F.lag(level, max(LAGS)).over(bore), "level_now": level}
    columns |= {f"target_{h}": F.lead(level, h).over(bore) for h in horizons}
    known = with_moments(levels.withColumns(columns), rolls).filter(F.col(oldest).isNotNull())
    return known.select("well_id", "reading_date", "water_level_mbgl", *names, "level_now", *[f"target_{h}" for h in horizons])


def _level_rolls() -> dict[tuple[str, str], tuple[str, int, int, int]]:
    return {(f"level_roll_mean_{n}", f"level_roll_std_{n}"): ("water_level_mbgl", n - 1, 0, max(2, n // 2)) for n in ROLLS}


def at_horizon(frame: DataFrame, horizon: int) -> DataFrame:
    """Rows of ``history_features`` that have a target at ``horizon``, with that target alone."""
    target = F.col(f"target_{horizon}")
    others = [c for c in frame.columns if c.startswith("target_")]
    return (
        frame.filter(target.isNotNull())
        .withColumns({"target": target, "target_date": F.date_add("reading_date", horizon)})
        .drop(*[c for c in others if c != "target_date"])
    )


def forecast_features(
    wells: DataFrame,
    readings: DataFrame,
    rainfall: DataFrame,
    horizon: int = 30,
    areas: list[str] | None = None,
    only: list[str] | None = None,
) -> DataFrame:
    """Features known at each reading and the level ``horizon`` rows later."""
    return at_horizon(history_features(wells, readings, rainfall, (horizon,), areas, only), horizon)


def feature_columns(df: DataFrame) -> list[str]:
    """Model inputs: everything but identifiers, the raw level and the target."""
    return [c for c in df.columns if c not in _NOT_FEATURES]


def split_cutoff(df: DataFrame, test_fraction: float = 0.2) -> Column:
    """First test date, as a scalar subquery over the distinct dates (bounded by the calendar)."""
    dates = F.sort_array(F.collect_set("reading_date"))
    position = F.floor(F.size(dates) * F.lit(1 - test_fraction)).cast("int") + 1
    return df.select("reading_date").agg(F.element_at(dates, position).alias("cutoff")).scalar()


def purged_time_split(df: DataFrame, test_fraction: float = 0.2) -> tuple[DataFrame, DataFrame, Column]:
    """Train rows whose target lies before the cutoff, test rows dated from it on."""
    cutoff = split_cutoff(df, test_fraction)
    return df.filter(F.col("target_date") < cutoff), df.filter(F.col("reading_date") >= cutoff), cutoff


def anomaly_features(wells: DataFrame, readings: DataFrame, rainfall: DataFrame) -> DataFrame:
    """Each reading against its bore's own recent history; incomplete rows are dropped."""
    bore = by_bore()
    level, tds = F.col("water_level_mbgl"), F.col("tds_mg_per_l")
    frame = with_rain(readings, wells, rainfall)
    history = {(f"_mean_{c}", f"_std_{c}"): (c, 30, 1, 5) for c in ("water_level_mbgl", "tds_mg_per_l")}

    def z_score(name: str) -> Column:
        std = F.col(f"_std_{name}")
        return F.when(snap(std) > 0, (F.col(name) - F.col(f"_mean_{name}")) / std)

    changes = frame.withColumns({
        "level_diff": level - F.lag(level).over(bore),
        "tds_diff": tds - F.lag(tds).over(bore),
        "rain_sum_7": F.sum("rainfall_mm").over(trailing(bore, 7)),
    })
    return (
        with_moments(changes, history)
        .withColumns({"level_z": z_score("water_level_mbgl"), "tds_z": z_score("tds_mg_per_l")})
        .select(*frame.columns, *ANOMALY_FEATURES)
        .na.drop(subset=ANOMALY_FEATURES)
    )
