"""Live tags from landed change notifications.

The functions work on batch and streaming frames alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aquifold.functions import rounded
from aquifold.operators.fleet import latest_reading

# Tag names of the field server and the field each one feeds (fixed values).
FIELD_BY_TAG = {
    "WaterLevel_mBGL": "level",
    "TDS_mg_per_L": "tds",
    "PumpSpeed_RPM": "pump",
    "ValvePosition_pct": "valve",
    "SignalQuality": "quality",
}
FIELDS = list(FIELD_BY_TAG.values())


def parse_tags(events: DataFrame) -> DataFrame:
    """Bore, location and field of each notification; other objects and tags are ignored."""
    parts = F.split("browse_name", "_", 3)
    well_id = F.try_element_at(parts, F.lit(2)).try_cast("int")
    location = F.coalesce(
        F.replace(F.try_element_at(parts, F.lit(3)), F.lit("_"), F.lit(" ")),
        F.concat(F.lit("Bore "), well_id.cast("string")),
    )
    field = F.create_map(*[F.lit(x) for pair in FIELD_BY_TAG.items() for x in pair])[F.col("tag_name")]
    return (
        events.filter(F.startswith("browse_name", F.lit("Bore_")))
        .select(
            "event_id", F.col("ts").cast("timestamp").alias("ts"), well_id.alias("well_id"),
            location.alias("location"), field.alias("field"), F.col("value").cast("string").alias("value"),
        )
        .filter(F.col("well_id").isNotNull() & F.col("field").isNotNull())
    )


def tag_last_value(tags: DataFrame) -> DataFrame:
    """Newest value of every field per bore, by event time, then by event id.

    Partial results merge before the exchange, so a chatty bore sends one row per task.
    """
    when = F.struct("ts", "event_id")

    def newest(field: str, kind: str) -> Column:
        mine = F.col("field") == field
        return F.max_by(F.when(mine, F.col("value")), F.when(mine, when)).try_cast(kind).alias(field)

    return tags.groupBy("well_id").agg(
        F.max_by("location", when).alias("location"),
        newest("level", "double"), newest("tds", "double"), newest("pump", "double"),
        newest("valve", "double"), newest("quality", "string"),
        F.max("ts").alias("last_update"),
    )


def tags_with_fallback(wells: DataFrame, state: DataFrame, readings: DataFrame, connected: bool = True) -> DataFrame:
    """Tag row of every bore; one without a live level shows its last stored reading as Uncertain."""
    stored = latest_reading(readings).select(
        "well_id", F.col("level_mbgl").alias("stored_level"), F.col("tds_mg_per_l").alias("stored_tds")
    )
    live = F.col("level").isNotNull()

    def pick(column: str, fallback: Column, default: float = 0) -> Column:
        return F.when(live, F.coalesce(F.col(column), F.lit(default))).otherwise(fallback)

    return (
        wells.select("well_id", "location_name")
        .join(state.drop("location"), "well_id", "left")
        .join(stored, "well_id", "left")
        .select(
            "well_id",
            F.col("location_name").alias("location"),
            rounded(pick("level", F.col("stored_level")), 3).alias("tag_level"),
            rounded(pick("tds", F.col("stored_tds")), 1).alias("tag_tds"),
            pick("pump", F.lit(0.0)).cast("int").alias("tag_pump_rpm"),
            pick("valve", F.lit(0.0)).cast("int").alias("tag_valve_pct"),
            F.when(live, F.coalesce("quality", F.lit("Good"))).otherwise("Uncertain").alias("quality"),
            F.lit("OPC-UA" if connected else "fallback").alias("source"),
        )
    )


def tag_health(state: DataFrame) -> DataFrame:
    return state.agg(
        (F.count(F.lit(1)) > 0).alias("connected"),
        F.max("last_update").alias("last_update"),
        F.count("level").alias("tag_count"),
    )


def telemetry_window(tags: DataFrame, window: str = "5 minutes", delay: str = "10 minutes") -> DataFrame:
    """Mean numeric value per bore, field and time window; late data is accepted up to ``delay``."""
    return (
        tags.withWatermark("ts", delay)
        .withColumn("number", F.col("value").try_cast("double"))
        .filter(F.col("number").isNotNull())
        .groupBy(F.window("ts", window).alias("slot"), "well_id", "field")
        .agg(F.count("number").alias("n"), F.avg("number").alias("mean_value"))
        .select(
            F.col("slot.start").alias("window_start"), F.col("slot.end").alias("window_end"),
            "well_id", "field", "n", "mean_value",
        )
    )
