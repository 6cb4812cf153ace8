"""Stored readings and rain with the summaries detection works on, kept up to date load by load.

Besides the readings and rainfall tables a folder holds

    reading_months   per bore and month: counts, and the last trusted day and level
    area_rain        per area and day: mean trusted rain
    bore_summaries   per bore: counts, newest rows, and the response to its last judged rain event

A load recomputes the first two for the months it touches, from those months' rows, and merges the
third; every step overwrites, so a load that was cut off is put right by repeating it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from aquifold import schemas
from aquifold.functions import as_double
from aquifold.operators import curated
from aquifold.operators import summaries as bores
from aquifold.operators.detectors import recharge_responses
from aquifold.session import Staging
from aquifold.sources.store import KeyedTable

class SummarisedStore:
    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.readings = KeyedTable.named(spark, folder, "readings")
        self.rainfall = KeyedTable.named(spark, folder, "rainfall")
        self.months = KeyedTable(spark, f"{folder}/reading_months", schemas.READING_MONTHS, ["well_id", "month"], "month")
        self.rain = KeyedTable(spark, f"{folder}/area_rain", schemas.AREA_RAIN, ["management_area", "obs_date"], "obs_date")
        self.bores = KeyedTable(spark, f"{folder}/bore_summaries", schemas.BORE_SUMMARIES, ["well_id"])

    # loading ---------------------------------------------------------------------

    def load_readings(self, rows: DataFrame) -> int:
        """Upsert readings (of several deliveries of a key the last counts) and refresh their months' summaries."""
        with Staging(self.spark) as staging:
            staged = staging.write(rows, "arrived")
            loaded = self.readings.load(staged, is_staged=True)
            self.refresh_readings(self.readings.months_of(staged))
            return loaded

    def load_rainfall(self, rows: DataFrame) -> int:
        with Staging(self.spark) as staging:
            staged = staging.write(rows, "arrived")
            loaded = self.rainfall.load(staged, is_staged=True)
            self.refresh_rain(self.rainfall.months_of(staged))
            return loaded

    def refresh_rain(self, months: set[str]) -> None:
        # Days without a trusted station stay as rows, so that a month never disappears.
        self.rain.replace_months(curated.area_rain_summary(self.rainfall.read(months)))

    def area_rain(self) -> DataFrame:
        return self.rain.read().filter("stations > 0").drop("stations")

    def refresh_readings(self, months: set[str]) -> None:
        """Bring the summaries up to the stored rows of these months."""
        if not months:
            return
        stored, sound = self.readings.read(months), bores.is_trusted()
        level, day = as_double("water_level_mbgl"), F.col("reading_date")
        per_month = stored.groupBy("well_id", F.trunc("reading_date", "month").alias("month")).agg(
            F.count_if(sound).alias("rows"), F.count(F.when(sound, level)).alias("levels"),
            F.count(F.when(sound, as_double("tds_mg_per_l"))).alias("salts"),
            F.max(F.when(sound, day)).alias("last_date"), F.max_by(level, F.when(sound, day)).alias("last_level"),
        )
        with Staging(self.spark) as staging:
            per_month = staging.write(per_month, "months")
            self.months.replace_months(per_month, is_staged=True)
            touched = per_month.groupBy("well_id").agg(F.min("month").alias("first_touched"))
            totals = self.months.read().groupBy("well_id").agg(*[F.sum(c).alias(c) for c in ("rows", "levels", "salts")])
            fresh = bores.newest_rows(bores.trusted_rows(stored)).withColumnRenamed("newest", "fresh")
            known = self.bores.read().drop("rows", "levels", "salts")
            elsewhere = F.filter("newest", lambda r: ~F.date_format(r["reading_date"], "yyyy-MM").isin(sorted(months)))
            # A response stands unless readings up to the end of its window may have changed.
            stands = F.col("first_touched") > F.date_add("event_date", 14)
            merged = (
                touched.join(totals, "well_id").join(known, "well_id", "left").join(fresh, "well_id", "left")
                .withColumn("newest", bores.merged_newest(elsewhere, F.col("fresh")))
                .withColumns({c: F.when(stands, F.col(c)) for c in ("event_date", "before", "shallowest")})
                .select(*schemas.BORE_SUMMARIES.names)
            )
            merged = staging.write(merged, "merged")
            short = merged.filter(F.size("newest") < F.least(F.lit(bores.NEWEST_ROWS), "rows"))
            complete = short.isEmpty()
            if not complete:
                merged = merged.join(short.select("well_id"), "well_id", "left_anti").unionByName(self._refilled(short))
            self.bores.upsert(merged, is_staged=complete)

    def _refilled(self, short: DataFrame) -> DataFrame:
        """Summaries that lost rows take older ones, read from just the months that hold them."""
        later = W.partitionBy("well_id").orderBy(F.desc("month")).rowsBetween(W.unboundedPreceding, -1)
        wanted = (
            self.months.read().filter("rows > 0").join(short.select("well_id"), "well_id", "left_semi")
            .withColumn("later", F.coalesce(F.sum("rows").over(later), F.lit(0)))
            .filter(F.col("later") < bores.NEWEST_ROWS)
        )
        months = {r[0] for r in wanted.select(F.date_format("month", "yyyy-MM")).distinct().collect()}
        rows = bores.trusted_rows(self.readings.read(months)).join(short.select("well_id"), "well_id", "left_semi")
        return short.drop("newest").join(bores.newest_rows(rows), "well_id").select(*schemas.BORE_SUMMARIES.names)

    # recharge -----------------------------------------------------------------------

    def judge_events(self, events: DataFrame, staging: Staging) -> DataFrame:
        """Responses to the bores' rain ``events`` (well_id, event_date); those not judged yet are, and remembered.

        Only the months from an open event to the end of its window are read; where they hold no
        reading up to the event, the level before it is the last one of the months before.
        """
        keys = ["well_id", "event_date"]
        events = staging.write(events, "rain_events")
        fresh = staging.write(events.join(self.bores.read().select(*keys), keys, "left_anti"), "open_events")
        spans = fresh.select(F.explode(F.array("event_date", F.date_add("event_date", 14))).alias("day"))
        months = {r[0] for r in spans.select(F.date_format("day", "yyyy-MM")).distinct().collect()}
        if months:
            here = recharge_responses(bores.trusted_rows(self.readings.read(months)), fresh)
            earlier = (
                self.months.read().filter(F.col("last_date").isNotNull()).join(fresh, "well_id")
                .filter(F.col("month") < F.trunc("event_date", "month"))
                .groupBy("well_id").agg(F.max_by("last_level", "month").alias("level_earlier"))
            )
            before = F.when(F.col("before_date").isNull(), F.col("level_earlier")).otherwise(F.col("before"))
            found = fresh.join(here, keys, "left").join(earlier, "well_id", "left").select(
                *keys, before.alias("before"), "shallowest"
            )
            rest = self.bores.read().drop("event_date", "before", "shallowest")
            self.bores.upsert(found.join(rest, "well_id").select(*schemas.BORE_SUMMARIES.names))
        return self.bores.read().select(*keys, "before", "shallowest").join(events, keys, "left_semi")
