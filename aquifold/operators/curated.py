"""Curated inputs of the detectors and models.

Joins carry no broadcast hints: dimension sides broadcast when their size is
below the session threshold, known from files or measured by AQE, and fall back
to a shuffle join when the fleet outgrows it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aquifold.functions import as_double


def trusted_readings(readings: DataFrame, wells: DataFrame) -> DataFrame:
    """Readings not flagged suspect, with coastal flag and area of their bore."""
    return (
        readings.filter(F.col("data_quality_flag") != "suspect")
        .select("well_id", "reading_date", as_double("water_level_mbgl").alias("water_level_mbgl"),
                as_double("tds_mg_per_l").alias("tds_mg_per_l"))
        .join(wells.select("well_id", "coastal_flag", "management_area"), "well_id")
    )


def area_rainfall(rainfall: DataFrame) -> DataFrame:
    """Mean trusted rainfall per area and day."""
    return (
        rainfall.filter(F.col("data_quality_flag") != "suspect")
        .groupBy("management_area", "obs_date")
        .agg(_mean_rain())
    )


def area_rain_summary(rainfall: DataFrame) -> DataFrame:
    """Mean trusted rainfall per area and day and how many trusted rows it comes from, days with none included."""
    trusted = F.col("data_quality_flag") != "suspect"
    return rainfall.groupBy("management_area", "obs_date").agg(
        _mean_rain(F.when(trusted, F.col("rainfall_mm"))), F.count_if(trusted).alias("stations")
    )


def area_rainfall_unfiltered(rainfall: DataFrame) -> DataFrame:
    """Mean rainfall per area and day, suspect rows included.

    A table without areas is averaged per day.
    """
    keys = [k for k in ("management_area", "obs_date") if k in rainfall.columns]
    return rainfall.groupBy(*keys).agg(_mean_rain())


def regional_rainfall(rainfall: DataFrame) -> DataFrame:
    """Mean rainfall over all stations per day."""
    return rainfall.groupBy("obs_date").agg(_mean_rain())


def readings_with_well(readings: DataFrame, wells: DataFrame) -> DataFrame:
    """Every reading with its bore's attributes, NULL for an unknown bore."""
    return readings.join(wells.select("well_id", "coastal_flag", "management_area"), "well_id", "left")


def _mean_rain(amount: Column | None = None) -> Column:
    # Decimal sums do not depend on the order in which partial results merge, and a
    # sum of the stored type still fits a long, which keeps it fast.
    amount = (F.col("rainfall_mm") if amount is None else amount).cast("decimal(7,2)")
    return (F.sum(amount).cast("double") / F.count(amount)).alias("rainfall_mm")
