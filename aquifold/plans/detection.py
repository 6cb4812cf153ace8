"""Daily detection: bore summaries, all detectors, idempotent store."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aquifold.operators import curated, detectors, summaries
from aquifold.session import Staging
from aquifold.sources.store import KeyedTable, insert_new_events
from aquifold.sources.summaries import SummarisedStore


@dataclass(frozen=True)
class DetectionCounts:
    detected: int
    inserted: int


def _events(bores: DataFrame, wells: DataFrame, responses: DataFrame) -> DataFrame:
    """Events of all detectors from bore summaries and the responses to rain."""
    newest = summaries.as_readings(bores, wells)

    def seen(count: str) -> DataFrame:
        return bores.select("well_id", F.col(count).alias("observations"))

    return (
        detectors.rapid_level_change(newest, observations=seen("levels"))
        .unionByName(detectors.recharge_events(responses))
        .unionByName(detectors.salinity_intrusion(newest, observations=seen("salts")))
    )


def _rain_events(bores: DataFrame, wells: DataFrame, rain: DataFrame) -> DataFrame:
    days = rain.select(F.col("management_area").alias("area"), F.col("obs_date").alias("day"), "rainfall_mm")
    return detectors.latest_rain_event(summaries.last_days(bores, wells), days)


def detect(
    readings: DataFrame, wells: DataFrame, rainfall: DataFrame, staging: Staging | None = None
) -> DataFrame:
    """Events of all detectors over trusted readings and area rainfall.

    The readings, one per bore and day, are not copied: one pass counts them, one keeps each bore's newest
    rows, and one looks up the levels around its last rain event. Only these summaries are staged.
    """
    staging = staging or Staging(readings.sparkSession)
    bores = staging.write(summaries.summarise(readings), "summaries")
    rain = staging.write(curated.area_rainfall(rainfall), "area_rain")
    events = staging.write(_rain_events(bores, wells, rain), "rain_events")
    responses = detectors.recharge_responses(summaries.trusted_rows(readings), events)
    return _events(bores, wells, responses)


def detect_stored(stored: SummarisedStore, wells: DataFrame, staging: Staging) -> DataFrame:
    """``detect`` over everything stored, from the stored summaries and the months of rain events not judged yet."""
    responses = stored.judge_events(_rain_events(stored.bores.read(), wells, stored.area_rain()), staging)
    return _events(stored.bores.read(), wells, responses)


def detect_and_store(
    stored: SummarisedStore, wells: DataFrame, events: KeyedTable, detected_at: Column | None = None
) -> DetectionCounts:
    with Staging(stored.spark) as staging:
        found = staging.write(detect_stored(stored, wells, staging), "detected")
        return DetectionCounts(found.count(), insert_new_events(events, found, detected_at))
