"""Bore summaries: all that the detectors need of a bore's history, in one row.

A summary holds how many trusted rows, levels and salinities a bore has and its newest rows,
newest first. Summaries of parts of a history merge into that of the whole.

Joins of tables that grow with the bores are merge joins: the newest rows are stored as small
lists, so Spark takes the unfolded rows for far smaller than they are and would broadcast them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aquifold import schemas
from aquifold.functions import as_double, newest_first

#: Rows kept: the salinity trend looks at 30 days before the last one, a bore has at most one reading a day.
NEWEST_ROWS = 31


def is_trusted() -> Column:
    return F.col("data_quality_flag") != "suspect"


def trusted_rows(readings: DataFrame) -> DataFrame:
    return readings.filter(is_trusted()).select(
        "well_id", "reading_date", as_double("water_level_mbgl").alias("water_level_mbgl"),
        as_double("tds_mg_per_l").alias("tds_mg_per_l"),
    )


def newest_rows(rows: DataFrame) -> DataFrame:
    """(well_id, newest): each bore's newest rows; the rank limit is applied before the exchange as well."""
    row = F.struct("reading_date", "water_level_mbgl", "tds_mg_per_l")
    return (
        rows.withColumn("age", F.row_number().over(newest_first())).filter(F.col("age") <= NEWEST_ROWS)
        .groupBy("well_id").agg(F.sort_array(F.collect_list(row), asc=False).cast(schemas.NEWEST_ROWS).alias("newest"))
    )


def merged_newest(older: Column, newer: Column) -> Column:
    """Newest rows of both lists, which share no day."""
    empty = F.array().cast(schemas.NEWEST_ROWS)
    both = F.concat(F.coalesce(older, empty), F.coalesce(newer, empty))
    return F.slice(F.sort_array(both, asc=False), 1, NEWEST_ROWS)


def summarise(readings: DataFrame) -> DataFrame:
    """Summaries of whole readings: well_id, rows, levels, salts, newest."""
    rows = trusted_rows(readings)
    counts = rows.groupBy("well_id").agg(
        F.count(F.lit(1)).alias("rows"), F.count("water_level_mbgl").alias("levels"), F.count("tds_mg_per_l").alias("salts")
    )
    return counts.join(newest_rows(rows).hint("merge"), "well_id")


def as_readings(summaries: DataFrame, wells: DataFrame) -> DataFrame:
    """The summaries' newest rows as trusted readings of known bores."""
    return (
        summaries.select("well_id", F.explode("newest").alias("row")).select("well_id", "row.*")
        .join(wells.select("well_id", "coastal_flag", "management_area").hint("merge"), "well_id")
    )


def last_days(summaries: DataFrame, wells: DataFrame, response_days: int = 14) -> DataFrame:
    """(well_id, area, cutoff): the last day whose rain has a complete response window."""
    areas = wells.select("well_id", "management_area").hint("merge")
    return summaries.filter(F.size("newest") > 0).join(areas, "well_id").select(
        "well_id", F.col("management_area").alias("area"),
        F.date_sub(F.col("newest")[0]["reading_date"], response_days).alias("cutoff"),
    )
