"""One runnable query per operator over the given star-schema tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aquifold import schemas
from aquifold.functions import drop_suspect
from aquifold.operators import (
    bi, constraints, curated, detectors, features, fleet, forecast, forest, health, risk, views,
)
from aquifold.plans import detection, ingest
from aquifold.session import new_folder
from aquifold.sources import landed, store
from aquifold.sources.alerts import AlertQueue
from aquifold.sources.store import KeyedTable
from aquifold.sources.summaries import SummarisedStore
from aquifold.streaming import jobs, tag_state, tags
from checks.star_tables import StarTables, star_tables, tag_events_of

_QUERIES: dict[str, Callable[[StarTables], DataFrame]] = {}


def query(fn: Callable[[StarTables], DataFrame]) -> Callable[[StarTables], DataFrame]:
    _QUERIES[fn.__name__] = fn
    return fn


def portable(df: DataFrame) -> DataFrame:
    """Plain types for comparison between engines: text dates, long integers, doubles."""
    columns = []
    for field in df.schema.fields:
        column, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, T.DateType):
            column = column.cast("string")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(kind, T.DecimalType):
            column = column.cast("double")
        elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.BooleanType)):
            column = column.cast("long")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn):
        return lambda spark, folder: portable(fn(star_tables(spark, folder)))

    return {name: bind(fn) for name, fn in _QUERIES.items()}


def _six(df: DataFrame, *columns: str) -> DataFrame:
    """Round derived doubles to six digits."""
    return df.withColumns({c: F.round(F.round(c, 9), 6) for c in columns})


def _coastal(t: StarTables) -> DataFrame:
    return t.wells.filter(F.col("coastal_flag") == 1)


def _bores(t: StarTables) -> DataFrame:
    """Readings as delivered, keyed by drillhole number."""
    return t.readings.join(t.wells.select("well_id", "source_dh_no"), "well_id").drop("well_id")


# sources and sinks -----------------------------------------------------------


#: Columns of each table in the common layout of whole-table comparisons: key, day, two numbers, texts.
_LAYOUT = {
    "wells": ("well_id", None, "latitude", "longitude", ["source_dh_no", "location_name", "aquifer_name", "management_area", "coastal_flag"]),
    "licences": ("licence_id", "licence_start_date", "annual_allocation_ml", "compliance_limit_pct", ["management_area", "licence_end_date"]),
    "readings": ("well_id", "reading_date", "water_level_mbgl", "tds_mg_per_l", ["pumping_event", "data_quality_flag"]),
    "rainfall": ("station_id", "obs_date", "rainfall_mm", None, ["station_name", "management_area", "data_quality_flag"]),
    "extraction": ("well_id", "reading_month", "extraction_ml", None, ["coverage_days", "data_quality_flag"]),
    "events": ("event_id", "event_date", "threshold_value", "actual_value", ["well_id", "anomaly_type", "severity", "detail", "alert_sent"]),
    "snapshots": ("well_id", "risk_snapshot_date", "risk_score", None, ["risk_status", "risk_drivers", "recommended_action"]),
}


def _all_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """Every row of the tables in one layout."""
    none = F.lit(None)

    def rows(name: str, df: DataFrame) -> DataFrame:
        key, day, x, y, texts = _LAYOUT[name]
        return df.select(
            F.lit(name).alias("table_name"), F.col(key).cast("string").alias("row_key"),
            (F.col(day).cast("date").cast("string") if day else none.cast("string")).alias("day"),
            F.round(F.col(x).cast("double"), 6).alias("x"),
            (F.round(F.col(y).cast("double"), 6) if y else none.cast("double")).alias("y"),
            F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in texts]).alias("texts"),
        )

    return constraints._union([rows(name, df) for name, df in tables.items()])


@query
def read_tables(t: StarTables) -> DataFrame:
    """Five tables written as CSV with their columns in reverse and a column nobody asked for, read back by name."""
    folder = new_folder(t.spark, "csv")
    frames = {"wells": t.wells, "readings": t.readings, "rainfall": t.rainfall, "licences": t.licences, "extraction": t.extraction}
    for name, df in frames.items():
        store.write_output(df.select(F.lit("x").alias("note"), *reversed(df.columns)), f"{folder}/{name}")
    return _all_rows(landed.read_tables(t.spark, {name: f"{folder}/{name}" for name in frames}))


@query
def read_optional(t: StarTables) -> DataFrame:
    """Predictions that were never written count as none for every bore."""
    missing = landed.read_optional(t.spark, new_folder(t.spark, "never-written"), schemas.FORECASTS)
    return t.wells.join(missing, "well_id", "left").groupBy("well_id").agg(
        F.count("predicted").alias("predictions")
    )


@query
def normalise_wells(t: StarTables) -> DataFrame:
    raw = t.wells.select(
        F.col("source_dh_no").alias("DHNO"), F.col("location_name").alias("NAME"),
        F.col("latitude").cast("string").alias("LAT"), F.col("longitude").cast("string").alias("LON"),
        F.concat("aquifer_name", F.when(F.col("coastal_flag") == 1, " CoastAL sand").otherwise("")).alias("AQUIFER"),
        "management_area",
    )
    return landed.normalise_wells(raw, F.col("management_area"))


@query
def normalise_readings(t: StarTables) -> DataFrame:
    line, qty = F.col("l_linenumber"), F.col("l_quantity")
    raw = t.raw("lineitem").select(
        F.col("l_suppkey").cast("string").alias("dh"),
        F.when(line == 7, "not a date").otherwise(F.to_date("l_shipdate").cast("string")).alias("OBS_DATE"),
        (qty * 8 - 20).cast("long").cast("string").alias("DTW"),
        F.when(line == 6, "n/a").otherwise((qty + 100).cast("long").cast("string")).alias("TDS"),
        F.when(line < 4, (line % 2).cast("string")).alias("PUMPING"),
    )
    return landed.normalise_readings(raw, F.col("dh"))


@query
def normalise_rainfall(t: StarTables) -> DataFrame:
    """Orders as rain rows: urgent ones carry a bad date, low-priority ones a word instead of an amount."""
    priority, mm = F.col("o_orderpriority"), F.floor(F.col("o_totalprice") / 10000) - 3
    raw = t.raw("orders").select(
        F.when(priority == "1-URGENT", "?").otherwise(F.date_format("o_orderdate", "yyyyMMdd")).alias(" Date "),
        F.when(priority == "5-LOW", "trace").otherwise(mm.cast("string")).alias("Daily_Rain"),
        F.col("o_orderstatus").alias("station"),
    )
    station = F.col("station")
    return landed.normalise_rainfall(raw, station, F.concat(F.lit("Station "), station), F.concat(F.lit("Area "), station))


@query
def normalise_surface(t: StarTables) -> DataFrame:
    raw = t.raw("events").select(
        F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ss").alias("TimeStamp"),
        F.when(F.col("event_type") == "error", "bad").otherwise(F.col("value").cast("string")).alias("Value"),
        F.col("user_id").alias("site"), F.col("event_type").alias("metric"),
    )
    site = F.col("site").cast("string")
    return landed.normalise_surface(raw, site, F.concat(F.lit("Site "), site), F.col("metric"))


@query
def flag_quality(t: StarTables) -> DataFrame:
    """Rows per flag when levels are moved out of the physical range on both sides."""
    level = F.col("water_level_mbgl") * 8 - 20
    flagged = t.readings.select(landed.flag_level_quality(level).alias("data_quality_flag"))
    return flagged.groupBy("data_quality_flag").agg(F.count(F.lit(1)).alias("readings"))


@query
def collect_all(t: StarTables) -> DataFrame:
    """Rainfall landed as CSV, a folder a station, under two headers; collected in one read with the stations' settings."""
    folder = new_folder(t.spark, "stations")
    day, mm = F.date_format("obs_date", "d/M/yyyy"), F.col("rainfall_mm").cast("string")
    odd = F.col("station_id").endswith("-1")
    plain = t.rainfall.filter(~odd).select("station_id", day.alias("Date"), mm.alias("Rain"))
    other = t.rainfall.filter(odd).select("station_id", F.lit("a, b").alias("Note"), mm.alias("Daily_Rain"), day.alias("Date2"))
    for df in (plain, other):
        df.write.mode("append").option("header", True).partitionBy("station_id").csv(folder)
    settings = t.rainfall.select("station_id", "station_name", "management_area").distinct()
    lines = landed.csv_lines(t.spark.read, folder, ("station_id",))
    raw = landed.by_header(lines, landed.RAIN_COLUMNS).join(settings, "station_id")
    rows = landed.normalise_rainfall(raw, *[F.col(c) for c in settings.columns])
    return rows.select(
        *settings.columns, "obs_date", F.col("rainfall_mm").cast("double").alias("rainfall_mm"), "data_quality_flag"
    )


@query
def history_window(t: StarTables) -> DataFrame:
    return landed.history_window(t.readings, "reading_date", t.as_of, years=1).select(
        "well_id", "reading_date", "water_level_mbgl"
    )


@query
def upsert(t: StarTables) -> DataFrame:
    """Readings up to 2000 stored, then newer ones with changed values merged over a half-year overlap, twice."""
    table = KeyedTable.named(t.spark, new_folder(t.spark, "tables"), "readings")
    table.upsert(t.readings.filter(F.col("reading_date") <= "2000-12-31"))
    newer = t.readings.filter(F.col("reading_date") >= "2000-07-01").withColumn(
        "tds_mg_per_l", F.when(F.col("pumping_event") == 1, F.col("tds_mg_per_l") + 1)
    )
    table.upsert(newer)
    table.upsert(newer)
    return table.read()


@query
def assign_surrogate_keys(t: StarTables) -> DataFrame:
    """Coastal bores are known; the others get the next ids."""
    known = _coastal(t)
    assigned = store.assign_surrogate_keys(t.wells.drop("well_id"), known)
    before = known.select("source_dh_no", F.col("well_id").alias("old_id"))
    return assigned.join(before, "source_dh_no", "left").agg(
        F.count(F.lit(1)).alias("bores"), F.countDistinct("well_id").alias("ids"),
        F.max("well_id").alias("highest_id"),
        F.count_if(F.col("well_id") == F.col("old_id")).alias("kept_ids"),
    )


@query
def resolve_keys(t: StarTables) -> DataFrame:
    return store.resolve_keys(_bores(t), t.wells).select("well_id", "reading_date", "water_level_mbgl")


@query
def unresolved_keys(t: StarTables) -> DataFrame:
    """Readings of inland bores when only coastal bores are stored."""
    return store.unresolved_count(_bores(t), _coastal(t))


@query
def insert_new_events(t: StarTables) -> DataFrame:
    """Critical events are stored already with another severity; detection adds the others."""
    table = KeyedTable.named(t.spark, new_folder(t.spark, "tables"), "events")
    old = t.detected.filter(F.col("severity") == "CRITICAL").withColumn("severity", F.lit("INFO"))
    store.insert_new_events(table, old, t.now)
    store.insert_new_events(table, t.detected, t.now)
    store.insert_new_events(table, t.detected, t.now)
    return table.read().select(*schemas.names(schemas.DETECTED_EVENTS), "alert_sent")


@query
def reload_all(t: StarTables) -> DataFrame:
    frames = {
        "wells": t.wells, "licences": t.licences, "readings": t.readings, "rainfall": t.rainfall,
        "events": t.events, "extraction": t.extraction, "snapshots": t.snapshots,
    }
    folder = new_folder(t.spark, "tables")
    tables = {name: KeyedTable.named(t.spark, folder, name) for name in frames}
    broken = store.reload_all(tables, frames).agg(F.count(F.lit(1)).cast("double").alias("x"))
    rows = _all_rows({name: table.read() for name, table in tables.items()})
    return rows.unionByName(broken.withColumn("table_name", F.lit("broken references")), allowMissingColumns=True)


def _load_outcomes(t: StarTables) -> tuple[DataFrame, str]:
    """Three loads of which one fails and one finds nothing."""
    folder = new_folder(t.spark, "tables")
    rain = KeyedTable.named(t.spark, folder, "rainfall")
    readings = KeyedTable.named(t.spark, folder, "readings")
    audit = f"{folder}/audit"
    outcomes, _ = store.run_sources(t.spark, {
        "rainfall": lambda: ingest.load_rainfall(rain, t.rainfall),
        "surface": lambda: ingest.load_rainfall(rain, t.rainfall.filter(F.col("rainfall_mm") < 0)),
        "readings": lambda: readings.upsert(t.readings.unionByName(t.readings)),
    }, audit, "run-1")
    return outcomes, audit


@query
def audit_append(t: StarTables) -> DataFrame:
    _, audit = _load_outcomes(t)
    return t.spark.read.schema(schemas.AUDIT).parquet(audit).select("pipeline_name", "run_id", "status")


@query
def zero_row_load_check(t: StarTables) -> DataFrame:
    return health.load_status(_load_outcomes(t)[0]).select(
        "source", F.coalesce("rows", F.lit(0)).alias("rows"), "status"
    )


@query
def write_outputs(t: StarTables) -> DataFrame:
    folder = new_folder(t.spark, "snapshot-csv")
    store.write_output(t.snapshot, folder)
    return landed.read_table(t.spark, folder, "snapshots")


# curated inputs ----------------------------------------------------------------


@query
def trusted_readings(t: StarTables) -> DataFrame:
    return curated.trusted_readings(t.readings, t.wells)


@query
def area_rainfall(t: StarTables) -> DataFrame:
    return _six(curated.area_rainfall(t.rainfall), "rainfall_mm")


@query
def area_rainfall_unfiltered(t: StarTables) -> DataFrame:
    return _six(curated.area_rainfall_unfiltered(t.rainfall), "rainfall_mm")


@query
def regional_rainfall(t: StarTables) -> DataFrame:
    return _six(curated.regional_rainfall(t.rainfall), "rainfall_mm")


@query
def readings_with_well(t: StarTables) -> DataFrame:
    """Inland bores are unknown here, so their readings keep no attributes."""
    return curated.readings_with_well(t.readings, _coastal(t)).select(
        "well_id", "reading_date", "water_level_mbgl", F.col("coastal_flag").cast("double").alias("coastal_flag"),
        "management_area",
    )


# detectors ----------------------------------------------------------------------


@query
def rapid_level_change(t: StarTables) -> DataFrame:
    return detectors.rapid_level_change(t.trusted)


@query
def low_recharge_response(t: StarTables) -> DataFrame:
    return detectors.low_recharge_response(t.trusted, curated.area_rainfall(t.rainfall))


@query
def low_recharge_regional(t: StarTables) -> DataFrame:
    """With one regional rain signal instead of the area's."""
    return detectors.low_recharge_response(t.trusted, curated.regional_rainfall(t.rainfall))


@query
def salinity_intrusion(t: StarTables) -> DataFrame:
    return detectors.salinity_intrusion(t.trusted)


@query
def run_all_detectors(t: StarTables) -> DataFrame:
    return detection.detect(t.readings, t.wells, t.rainfall)


@query
def detect_and_store(t: StarTables) -> DataFrame:
    """Readings loaded in two parts, detection run twice: what each run found and stored."""
    folder = new_folder(t.spark, "detection")
    table, stored = KeyedTable.named(t.spark, folder, "events"), SummarisedStore(t.spark, folder)
    stored.load_rainfall(t.rainfall)
    early = F.col("reading_date") < F.date_sub(t.as_of, 200)
    stored.load_readings(t.readings.filter(early))
    stored.load_readings(t.readings.filter(~early))
    runs = [detection.detect_and_store(stored, t.wells, table, t.now) for _ in range(2)]
    found = table.read().agg(F.count(F.lit(1)).alias("stored"), F.countDistinct("event_id").alias("ids"))
    return found.select(
        F.lit(runs[0].detected).alias("detected"), F.lit(runs[0].inserted).alias("first_inserted"),
        F.lit(runs[1].inserted).alias("second_inserted"), "stored", "ids",
    )


# risk ------------------------------------------------------------------------------


@query
def licence_compliance(t: StarTables) -> DataFrame:
    return risk.licence_compliance(t.licences, t.extraction, t.wells, t.as_of)


@query
def trend_projection(t: StarTables) -> DataFrame:
    return risk.trend_projection(t.readings)


@query
def data_completeness_30d(t: StarTables) -> DataFrame:
    return risk.data_completeness(t.readings, t.as_of)


@query
def most_severe_recent_event(t: StarTables) -> DataFrame:
    return risk.most_severe_recent_event(t.events, t.as_of)


@query
def risk_classify(t: StarTables) -> DataFrame:
    """Scores of every (bore, day) with inputs spread over all bands, not only today's."""
    day = F.col("well_id") + F.dayofmonth("reading_date")
    spread = t.readings.select(
        "well_id", "reading_date",
        F.when(day % 4 == 0, "CRITICAL").when(day % 4 == 1, "WARNING").alias("latest_anomaly_severity"),
        F.when(day % 8 == 0, "SalinityIntrusionRisk").when(day % 8 == 1, "RapidLevelChange")
        .when(day % 8 == 4, "LowRechargeResponse").when(day % 8 == 5, "Other").alias("latest_anomaly_type"),
        (F.col("water_level_mbgl") + 62).alias("projected_allocation_pct"),
        (F.floor(F.col("tds_mg_per_l")) % 50 / 100.0 - 0.1).alias("forecast_change_mbgl"),
        F.when(day % 5 > 0, 90.0 + day % 11).alias("data_completeness_30d_pct"),
    )
    return risk.risk_classify(spread).select(
        "well_id", "reading_date", "risk_score", "risk_status", "risk_drivers", "recommended_action"
    )


@query
def risk_snapshot(t: StarTables) -> DataFrame:
    """The whole chain: detection over the readings, then the snapshot."""
    return risk.risk_snapshot(
        t.wells, t.readings, detection.detect(t.readings, t.wells, t.rainfall), t.licences, t.extraction
    )


# views -----------------------------------------------------------------------------


@query
def well_status(t: StarTables) -> DataFrame:
    return views.well_status(t.wells, t.readings, t.events, t.as_of)


@query
def rainfall_recharge(t: StarTables) -> DataFrame:
    return _six(views.rainfall_recharge(t.readings, t.wells, t.rainfall), "avg_water_level_mbgl")


@query
def latest_risk_snapshot(t: StarTables) -> DataFrame:
    return views.latest_risk_snapshot(t.snapshots)


@query
def licence_compliance_view(t: StarTables) -> DataFrame:
    return views.licence_compliance_view(t.licences, t.wells, t.extraction)


@query
def unsent_critical_events(t: StarTables) -> DataFrame:
    return views.unsent_critical_events(t.events, t.wells)


@query
def mark_alerted(t: StarTables) -> DataFrame:
    sent = views.unsent_critical_events(t.events, t.wells)
    return views.mark_alerted(t.events, sent).select("event_id", "severity", "alert_sent")


@query
def alert_messages(t: StarTables) -> DataFrame:
    return views.alert_messages(views.unsent_critical_events(t.events, t.wells))


# report measures -----------------------------------------------------------------------


@query
def risk_kpis(t: StarTables) -> DataFrame:
    return _six(
        bi.risk_kpis(t.snapshot), "avg_risk_score", "avg_level_change_60d", "avg_completeness_30d"
    )


@query
def kpis_by_area(t: StarTables) -> DataFrame:
    return _six(
        bi.kpis_by_area(t.snapshot), "avg_risk_score", "avg_level_change_60d", "avg_completeness_30d"
    )


@query
def selected_action(t: StarTables) -> DataFrame:
    return bi.selected_action(t.snapshot, by=("management_area", "risk_score"))


@query
def risk_by_location(t: StarTables) -> DataFrame:
    return bi.risk_by_location(t.snapshot)


@query
def allocation_by_licence(t: StarTables) -> DataFrame:
    return _six(bi.allocation_by_licence(t.snapshot), "avg_allocation_used_pct", "avg_projected_allocation_pct")


@query
def level_vs_forecast(t: StarTables) -> DataFrame:
    return _six(bi.level_vs_forecast(t.snapshot), "avg_latest_level_mbgl", "avg_forecast_60d_mbgl")


@query
def risk_table(t: StarTables) -> DataFrame:
    return bi.risk_table(t.snapshot)


@query
def licences_in_filter(t: StarTables) -> DataFrame:
    return bi.licences_in_filter(t.licences, t.snapshot.filter(F.col("projected_allocation_pct") > 100))


@query
def status_colour(t: StarTables) -> DataFrame:
    return bi.status_colour(t.snapshot, by=("management_area", "risk_score"))


@query
def date_dimension(t: StarTables) -> DataFrame:
    """Every calendar day with the readings, rain rows and events on it."""
    dates = bi.date_dimension(t.readings, t.rainfall)
    return dates.join(bi.calendar_activity(dates, t.readings, t.rainfall, t.events), "date")


@query
def level_moving_avg(t: StarTables) -> DataFrame:
    return _six(
        views.level_moving_average(t.readings, t.wells, t.rainfall),
        "level_mbgl", "level_moving_avg", "rainfall_mm", "rainfall_cumulative_mm",
    )


@query
def status_by_area(t: StarTables) -> DataFrame:
    return _six(bi.status_by_area(views.well_status(t.wells, t.readings, t.events, t.as_of)), "avg_level_mbgl")


@query
def licence_year(t: StarTables) -> DataFrame:
    return bi.licence_year(t.licences)


# health --------------------------------------------------------------------------------


@query
def staleness(t: StarTables) -> DataFrame:
    return health.staleness(t.readings, F.date_add(t.as_of, 2))


@query
def detector_heartbeat(t: StarTables) -> DataFrame:
    return health.detector_heartbeat(t.events, t.now)


@query
def rows_loaded_by_day(t: StarTables) -> DataFrame:
    return health.rows_loaded_by_day(t.readings, t.as_of)


@query
def duplicate_readings(t: StarTables) -> DataFrame:
    """Line items as if each were a reading: several a day break the key."""
    lines = t.raw("lineitem").select(
        F.col("l_suppkey").cast("int").alias("well_id"), F.to_date("l_shipdate").alias("reading_date")
    )
    return health.duplicate_readings(lines)


@query
def completeness_by_bore(t: StarTables) -> DataFrame:
    return _six(health.completeness_by_bore(t.wells, t.readings, t.as_of), "pct_complete")


@query
def day_on_day_movement(t: StarTables) -> DataFrame:
    return health.day_on_day_movement(t.readings, t.as_of)


@query
def critical_last_7d(t: StarTables) -> DataFrame:
    return health.critical_last_7d(t.events, t.now)


# constraints ---------------------------------------------------------------------------


def _all_tables(t: StarTables) -> dict[str, DataFrame]:
    return {
        "wells": t.wells, "readings": t.readings, "rainfall": t.rainfall, "surface": t.surface,
        "events": t.events, "licences": t.licences, "extraction": t.extraction, "snapshots": t.snapshots,
    }


@query
def unique_violations(t: StarTables) -> DataFrame:
    """Violations after the months with large volumes arrive twice."""
    tables = _all_tables(t)
    again = t.extraction.filter(F.col("extraction_ml") > 200)
    return constraints.unique_violation_counts(tables | {"extraction": t.extraction.unionByName(again)})


@query
def fk_violations(t: StarTables) -> DataFrame:
    """Orphan keys once the inland bores are missing from the bore table."""
    return constraints.fk_violation_counts(_all_tables(t) | {"wells": _coastal(t)})


@query
def check_violations(t: StarTables) -> DataFrame:
    """Violations once small volumes turn negative and coverage is off by three days."""
    bad = t.extraction.withColumn("extraction_ml", F.col("extraction_ml") - 50).withColumn(
        "coverage_days", F.col("coverage_days") - 3
    )
    return constraints.check_violation_counts(_all_tables(t) | {"extraction": bad})


@query
def domain_violations(t: StarTables) -> DataFrame:
    """Violations with missing dates, long flags and oversized levels planted."""
    level = F.col("water_level_mbgl")
    bad = t.readings.select(
        "well_id",
        F.when(level > 2, F.col("reading_date")).alias("reading_date"),
        F.when(F.col("pumping_event") == 1, level * 10000).otherwise(level).alias("water_level_mbgl"),
        "tds_mg_per_l", "pumping_event",
        F.when(F.col("data_quality_flag") == "suspect", F.repeat("data_quality_flag", 3))
        .otherwise(F.col("data_quality_flag")).alias("data_quality_flag"),
    )
    return constraints.domain_violation_counts({"readings": bad, "wells": t.wells, "rainfall": t.rainfall})


@query
def station_area_mapping(t: StarTables) -> DataFrame:
    return constraints.station_area_mapping(t.rainfall)


# features and models ----------------------------------------------------------------------


@query
def forecast_features(t: StarTables) -> DataFrame:
    frame = t.forecast_frame
    doubles = [f.name for f in frame.schema.fields if isinstance(f.dataType, T.DoubleType)]
    renamed = {c: c.lower().replace(" ", "_") for c in frame.columns if c.startswith("area_")}
    return _six(frame, *doubles).withColumnsRenamed(renamed)


@query
def feature_columns(t: StarTables) -> DataFrame:
    """Inputs of the model with their number of present values."""
    frame = t.forecast_frame
    names = features.feature_columns(frame)
    counts = frame.agg(F.map_from_arrays(
        F.array(*[F.lit(n) for n in names]), F.array(*[F.count(f"`{n}`") for n in names])
    ).alias("counts"))
    return counts.select(F.explode("counts").alias("feature", "present"))


@query
def purged_time_split(t: StarTables) -> DataFrame:
    train, test, cutoff = features.purged_time_split(t.forecast_frame)
    parts = train.select(F.lit("train").alias("part"), "reading_date", "target_date").unionByName(
        test.select(F.lit("test").alias("part"), "reading_date", "target_date")
    )
    return parts.groupBy("part").agg(
        F.count(F.lit(1)).alias("rows"), F.min("reading_date").alias("first_reading"),
        F.max("target_date").alias("last_target"), F.max(cutoff).alias("cutoff"),
    )


@query
def gbt_forecast(t: StarTables) -> DataFrame:
    _, test, _ = features.purged_time_split(t.forecast_frame)
    return forecast.predict(t.forecast_model, test)


@query
def forecast_metrics(t: StarTables) -> DataFrame:
    return forecast.forecast_metrics(t.forecasts)


@query
def horizon_sweep(t: StarTables) -> DataFrame:
    return forecast.horizon_sweep(
        t.wells, t.trusted.drop("coastal_flag", "management_area"),
        t.daily_rain,
    )


@query
def persistence_baseline(t: StarTables) -> DataFrame:
    return forecast.persistence_baseline(drop_suspect(t.readings))


@query
def anomaly_features(t: StarTables) -> DataFrame:
    names = features.ANOMALY_FEATURES
    return _six(t.anomaly_frame.select("well_id", "reading_date", *names), *names)


@query
def isolation_forest_score(t: StarTables) -> DataFrame:
    return t.scores


@query
def top_anomalies(t: StarTables) -> DataFrame:
    return forest.top_anomalies(t.scores).select("well_id", "reading_date", "anomaly_score")


@query
def rediscovered_bores(t: StarTables) -> DataFrame:
    """Coastal bores with a flagged row."""
    return forest.rediscovered_bores(t.scores, _coastal(t))


@query
def feature_importance(t: StarTables) -> DataFrame:
    return forecast.feature_importance(t.forecast_model)


# fleet -----------------------------------------------------------------------------------


@query
def bore_status_now(t: StarTables) -> DataFrame:
    return fleet.bore_status_now(t.wells, t.events, t.as_of)


@query
def latest_reading(t: StarTables) -> DataFrame:
    return fleet.latest_reading(t.readings)


@query
def last_issued_forecast(t: StarTables) -> DataFrame:
    return fleet.last_issued_forecast(t.forecasts)


@query
def anomaly_trend(t: StarTables) -> DataFrame:
    return fleet.anomaly_trend(t.scores, t.as_of)


@query
def active_alerts(t: StarTables) -> DataFrame:
    return fleet.active_alerts(t.events, t.as_of)


@query
def fleet_snapshot(t: StarTables) -> DataFrame:
    return fleet.fleet_snapshot(t.wells, t.readings, t.events, t.forecasts, t.as_of)


@query
def bore_detail(t: StarTables) -> DataFrame:
    """Nested detail, flattened to one row per history entry with the other lists' sizes."""
    detail = fleet.bore_detail(t.wells, t.readings, t.events, t.forecasts, t.scores, t.as_of)
    return detail.select(
        "well_id", "status", F.col("meta.location_name").alias("location_name"),
        F.col("latest_reading.level_mbgl").alias("latest_level"),
        F.size("forecast_series").alias("forecast_points"),
        F.size("anomaly_trend").alias("trend_points"), F.size("active_alerts").alias("alerts"),
        F.posexplode("history").alias("position", "entry"),
    ).select("*", "entry.*").drop("entry")


@query
def fleet_summary(t: StarTables) -> DataFrame:
    snapshot = fleet.fleet_snapshot(t.wells, t.readings, t.events, t.forecasts, t.as_of)
    return fleet.fleet_summary(snapshot, t.as_of)


# streaming ---------------------------------------------------------------------------------


def _tag_stream(t: StarTables) -> DataFrame:
    """The event table as a stream of notifications."""
    schema = t.raw("events").schema
    # A pattern matches the table whether it is one file or a folder of files.
    return tag_events_of(jobs.file_stream(t.spark, f"{t.folder}/event[s].parquet", schema))


@query
def tag_last_value(t: StarTables) -> DataFrame:
    folder = new_folder(t.spark, "tags")
    log = tag_state.ChangeLog(t.spark, f"{folder}/changes")
    tag_state.start_tag_state(_tag_stream(t), log, f"{folder}/checkpoint", {"availableNow": True}).awaitTermination()
    return log.read()


@query
def tag_browse_parse(t: StarTables) -> DataFrame:
    return tags.parse_tags(t.tag_events).select(
        "event_id", "well_id", "location", "field", F.col("value").cast("double").alias("value")
    )


@query
def tags_with_fallback(t: StarTables) -> DataFrame:
    state = tags.tag_last_value(tags.parse_tags(t.tag_events))
    return tags.tags_with_fallback(t.wells, state, t.readings)


@query
def tag_health(t: StarTables) -> DataFrame:
    return tags.tag_health(tags.tag_last_value(tags.parse_tags(t.tag_events)))


@query
def alert_stream(t: StarTables) -> DataFrame:
    """Stored events streamed through the alert job; the messages written and the events' state after it."""
    folder = new_folder(t.spark, "alerts")
    source = f"{folder}/source"
    t.events.write.parquet(source)
    alerts = AlertQueue(t.spark, folder)
    stream = jobs.file_stream(t.spark, source, t.events.schema)
    jobs.start_alerts(stream, alerts, t.wells, f"{folder}/checkpoint", {"availableNow": True}).awaitTermination()
    return (
        alerts.events.read().select("event_id", "severity", "alert_sent").join(alerts.outbox.read(), "event_id", "left")
    )


@query
def daily_detection_stream(t: StarTables) -> DataFrame:
    """Readings arriving as files, detected and stored in one available-now run."""
    folder = new_folder(t.spark, "detection")
    source = f"{folder}/source"
    t.readings.write.parquet(source)
    stored, events = SummarisedStore(t.spark, folder), KeyedTable.named(t.spark, folder, "events")
    stored.load_rainfall(t.rainfall)
    stream = jobs.file_stream(t.spark, source, t.readings.schema)
    jobs.start_detection(stream, stored, t.wells, events, f"{folder}/checkpoint").awaitTermination()
    return events.read().select(*schemas.names(schemas.DETECTED_EVENTS))


@query
def ingest_stream(t: StarTables) -> DataFrame:
    """Surface readings landed under two headers, normalised and upserted by a stream."""
    folder = new_folder(t.spark, "ingest")
    moment = F.date_format("reading_datetime", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    value, odd = F.col("metric_value").cast("string"), F.crc32("metric_name") % 2 == 1
    plain = t.surface.filter(~odd).select(moment.alias("Timestamp"), value.alias("Value"), "site_id", "metric_name")
    other = t.surface.filter(odd).select("metric_name", F.lit("n").alias("Note"), "site_id", value.alias("VALUE"), moment.alias("Date"))
    for i, df in enumerate((plain, other)):
        df.write.option("header", True).csv(f"{folder}/source/part={i}")
    target = KeyedTable.named(t.spark, folder, "surface")
    wanted = landed.SURFACE_COLUMNS | {"site_id": (("site_id",), None), "metric_name": (("metric_name",), None)}
    site = F.col("site_id")
    jobs.start_ingest(
        landed.csv_lines(t.spark.readStream, f"{folder}/source"),
        lambda lines: landed.normalise_surface(landed.by_header(lines, wanted), site, site, F.col("metric_name")),
        target, f"{folder}/checkpoint",
    ).awaitTermination()
    return target.read().withColumn("metric_value", F.col("metric_value").cast("double"))


@query
def telemetry_window(t: StarTables) -> DataFrame:
    windows = tags.telemetry_window(tags.parse_tags(t.tag_events))
    return _six(windows, "mean_value")
