"""Loads of the landed sources into the stored tables.

Landed layout, one folder per request the collector makes::

    wells/area=<area>/*.json             bores of an area, one JSON record per line
    readings/dh_no=<drillhole>/*.json    its readings, one JSON record per line
    rainfall/station_id=<id>/*.csv       a station's days
    surface/site_id=<id>/metric=<m>/*.csv   a site's values of one metric
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from aquifold.functions import AsOf
from aquifold.session import Staging, stage
from aquifold.sources import landed, store
from aquifold.sources.store import KeyedTable, LoadResult, assign_surrogate_keys, resolve_keys

# Station or site settings: (id, name, area) and (id, name, metric).
Station = tuple[str, str, str]
Site = tuple[str, str, str]


def load(table: KeyedTable, rows: DataFrame) -> int:
    return table.load(rows)


def load_wells(table: KeyedTable, wells: DataFrame) -> int:
    """Upsert bores under stable ids; a drillhole reported by two areas is stored once."""
    return table.upsert(assign_surrogate_keys(landed.first_per_drillhole(wells), table.read()))


def load_readings(table: KeyedTable, readings: DataFrame, wells: DataFrame) -> int:
    return load(table, resolve_keys(readings, wells))


def load_rainfall(table: KeyedTable, rainfall: DataFrame) -> int:
    return load(table, rainfall)


def load_surface(table: KeyedTable, surface: DataFrame) -> int:
    return load(table, surface)


def load_csv_units(
    spark: SparkSession, table: KeyedTable, path: str, settings: DataFrame, wanted: landed.Wanted,
    normalise: Callable[[DataFrame], DataFrame], day: str, as_of: AsOf, years: int,
) -> LoadResult:
    """Load the landed CSV folders of all units (stations or sites) that ``settings`` lists, in one read.

    The first columns of ``settings`` that are folders of the path identify a unit. A unit without
    rows is reported as such; files that lack a wanted column are left out and reported.
    """
    keys = [c for c in settings.columns if c in landed.UNIT_FOLDERS]
    with Staging(spark) as staging:
        settings = staging.write(settings, "settings")
        try:
            lines = landed.csv_lines(spark.read, path, tuple(keys))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            lines = landed.no_lines(spark, tuple(keys))
        delivered = staging.write(landed.by_header(lines, wanted).join(settings, keys), "delivered")
        rows = staging.write(normalise(delivered.filter(F.size("missing") == 0)), "normalised")
        recent = landed.history_window(rows, day, as_of, years)
        loaded = table.load(recent)

        reason = F.concat(F.lit("no column "), F.array_join(F.max("missing"), ", "))
        seen = delivered.groupBy(*keys).agg(
            F.count_if(F.size("missing") == 0).alias("usable"), F.when(F.size(F.max("missing")) > 0, reason).alias("error")
        )
        counts = rows.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("dated"), F.count_if(landed.in_window(day, as_of, years)).alias("rows")
        )
        none = F.lit(0).cast("long")
        outcomes = settings.select(*keys).join(seen, keys, "left").join(counts, keys, "left").select(
            F.concat_ws("/", *keys).alias("unit"), F.coalesce("rows", none).alias("rows"),
            (F.coalesce("usable", none) - F.coalesce("dated", none)).alias("dropped"), "error",
        )
        # One row per configured unit outlives the staging.
        outcomes = stage(outcomes, "outcomes")
    return LoadResult(loaded, outcomes.agg(F.coalesce(F.sum("dropped"), none)).first()[0], 0, outcomes)


def run_ingestion(
    spark: SparkSession,
    source: str,
    target: str,
    stations: list[Station],
    sites: list[Site],
    as_of: AsOf,
    years: int = 5,
    skip_surface: bool = False,
    run_id: str = "manual",
) -> tuple[DataFrame, int]:
    """Load everything landed under ``source`` into the tables under ``target``.

    Sources are independent: the outcome of each, and of every station and site, is reported,
    failures are recorded in the audit table, and the exit code says whether a source failed.
    """
    tables = {name: KeyedTable.named(spark, target, name) for name in ("wells", "readings", "rainfall", "surface")}

    def groundwater() -> LoadResult:
        raw = landed.read_json_records(spark, f"{source}/wells", landed.WELL_FIELDS, folders=("area",))
        load_wells(tables["wells"], landed.normalise_wells(raw, F.col("area")))
        raw = landed.read_json_records(spark, f"{source}/readings", landed.READING_FIELDS, folders=("dh_no",))
        dates, ids = Observation("dates"), Observation("ids")
        recent = landed.history_window(landed.normalise_readings(raw, F.col("dh_no"), dates), "reading_date", as_of, years)
        loaded = load(tables["readings"], resolve_keys(recent, tables["wells"].read(), ids))
        return LoadResult(loaded, dates.get["dropped"], ids.get["unresolved"])

    def rainfall() -> LoadResult:
        settings = spark.createDataFrame(stations, "station_id string, station_name string, management_area string")
        return load_csv_units(
            spark, tables["rainfall"], f"{source}/rainfall", settings, landed.RAIN_COLUMNS,
            lambda rows: landed.normalise_rainfall(rows, *map(F.col, settings.columns)), "obs_date", as_of, years,
        )

    def surface() -> LoadResult:
        settings = spark.createDataFrame([(i, m, n) for i, n, m in sites], "site_id string, metric string, site_name string")
        return load_csv_units(
            spark, tables["surface"], f"{source}/surface", settings, landed.SURFACE_COLUMNS,
            lambda rows: landed.normalise_surface(rows, F.col("site_id"), F.col("site_name"), F.col("metric"))
            .withColumn("metric", F.col("metric_name")),
            "reading_datetime", as_of, years,
        )

    loaders = {"groundwater": groundwater, "rainfall": rainfall}
    if not skip_surface:
        loaders["surface"] = surface
    return store.run_sources(spark, loaders, f"{target}/audit", run_id)
