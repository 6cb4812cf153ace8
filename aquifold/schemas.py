"""Table schemas, keys and constraints of the groundwater data model.

Missing values are NULL everywhere. NaN is never stored: Spark orders NaN above
every number, so a NaN would satisfy ``>=`` thresholds.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_INT, _LONG, _SHORT = T.IntegerType(), T.LongType(), T.ShortType()
_STR, _DATE, _TS, _DBL, _BOOL = T.StringType(), T.DateType(), T.TimestampType(), T.DoubleType(), T.BooleanType()


def _dec(precision: int, scale: int) -> T.DecimalType:
    return T.DecimalType(precision, scale)


WELLS = _struct(
    ("well_id", _INT), ("source_dh_no", _STR), ("location_name", _STR),
    ("latitude", _dec(9, 6)), ("longitude", _dec(9, 6)), ("aquifer_name", _STR),
    ("management_area", _STR), ("coastal_flag", _INT),
)

READINGS = _struct(
    ("well_id", _INT), ("reading_date", _DATE), ("water_level_mbgl", _dec(8, 3)),
    ("tds_mg_per_l", _dec(10, 2)), ("pumping_event", _INT), ("data_quality_flag", _STR),
)

RAINFALL = _struct(
    ("station_id", _STR), ("station_name", _STR), ("management_area", _STR),
    ("obs_date", _DATE), ("rainfall_mm", _dec(7, 2)), ("data_quality_flag", _STR),
)

SURFACE = _struct(
    ("site_id", _STR), ("site_name", _STR), ("reading_datetime", _TS),
    ("metric_name", _STR), ("metric_value", _dec(12, 3)), ("data_quality_flag", _STR),
)

# What a detector returns; a stored event adds id, detection time and alert state.
DETECTED_EVENTS = _struct(
    ("well_id", _INT), ("event_date", _DATE), ("anomaly_type", _STR), ("severity", _STR),
    ("threshold_value", _DBL), ("actual_value", _DBL), ("detail", _STR),
)

EVENTS = _struct(
    ("event_id", _LONG), ("well_id", _INT), ("detected_at", _TS), ("event_date", _DATE),
    ("anomaly_type", _STR), ("severity", _STR), ("threshold_value", _dec(12, 3)),
    ("actual_value", _dec(12, 3)), ("detail", _STR), ("alert_sent", _INT),
)

LICENCES = _struct(
    ("licence_id", _STR), ("management_area", _STR), ("licence_start_date", _DATE),
    ("licence_end_date", _DATE), ("annual_allocation_ml", _dec(12, 2)),
    ("compliance_limit_pct", _dec(6, 2)),
)

EXTRACTION = _struct(
    ("well_id", _INT), ("reading_month", _DATE), ("coverage_days", _SHORT),
    ("extraction_ml", _dec(12, 2)), ("data_quality_flag", _STR),
)

SNAPSHOTS = _struct(
    ("risk_snapshot_date", _DATE), ("well_id", _INT), ("source_dh_no", _STR),
    ("location_name", _STR), ("management_area", _STR), ("aquifer_name", _STR),
    ("licence_id", _STR), ("annual_allocation_ml", _dec(12, 2)),
    ("extraction_ytd_ml", _dec(12, 2)), ("allocation_used_pct", _dec(7, 2)),
    ("projected_year_end_extraction_ml", _dec(12, 2)), ("projected_allocation_pct", _dec(7, 2)),
    ("latest_level_mbgl", _dec(8, 3)), ("forecast_60d_mbgl", _dec(8, 3)),
    ("forecast_lower_80_mbgl", _dec(8, 3)), ("forecast_upper_80_mbgl", _dec(8, 3)),
    ("forecast_change_mbgl", _dec(8, 3)), ("data_completeness_30d_pct", _dec(6, 2)),
    ("latest_anomaly_type", _STR), ("latest_anomaly_severity", _STR), ("risk_score", _SHORT),
    ("risk_status", _STR), ("risk_drivers", _STR), ("recommended_action", _STR),
)

AUDIT = _struct(("pipeline_name", _STR), ("run_id", _STR), ("status", _STR), ("logged_at", _TS))

FORECASTS = _struct(
    ("well_id", _INT), ("reading_date", _DATE), ("target_date", _DATE),
    ("level_now", _DBL), ("actual", _DBL), ("predicted", _DBL),
)

SCORES = _struct(
    ("well_id", _INT), ("reading_date", _DATE), ("water_level_mbgl", _DBL),
    ("tds_mg_per_l", _DBL), ("level_z", _DBL), ("tds_z", _DBL),
    ("anomaly_score", _DBL), ("is_anomaly", _BOOL),
)

TAG_EVENTS = _struct(
    ("event_id", _LONG), ("ts", _TS), ("browse_name", _STR), ("tag_name", _STR), ("value", _STR),
)

# Summaries kept beside the readings and the rain, for detection.
READING_MONTHS = _struct(
    ("well_id", _INT), ("month", _DATE), ("rows", _LONG), ("levels", _LONG), ("salts", _LONG),
    ("last_date", _DATE), ("last_level", _DBL),
)

AREA_RAIN = _struct(("management_area", _STR), ("obs_date", _DATE), ("rainfall_mm", _DBL), ("stations", _LONG))

NEWEST_ROWS = T.ArrayType(_struct(("reading_date", _DATE), ("water_level_mbgl", _DBL), ("tds_mg_per_l", _DBL)))

BORE_SUMMARIES = _struct(
    ("well_id", _INT), ("rows", _LONG), ("levels", _LONG), ("salts", _LONG), ("newest", NEWEST_ROWS),
    ("event_date", _DATE), ("before", _DBL), ("shallowest", _DBL),
)

MESSAGES = _struct(("event_id", _LONG), ("subject", _STR), ("body", _STR), ("chat_text", _STR))

# Last value of every tag of a bore.
TAG_STATE = _struct(
    ("well_id", _INT), ("location", _STR), ("level", _DBL), ("tds", _DBL), ("pump", _DBL), ("valve", _DBL),
    ("quality", _STR), ("last_update", _TS),
)

TABLES: dict[str, T.StructType] = {
    "wells": WELLS, "readings": READINGS, "rainfall": RAINFALL, "surface": SURFACE,
    "events": EVENTS, "licences": LICENCES, "extraction": EXTRACTION, "snapshots": SNAPSHOTS,
}

# Keys of the tables; upserts match on these.
MERGE_KEYS: dict[str, list[str]] = {
    "wells": ["well_id"],
    "readings": ["well_id", "reading_date"],
    "rainfall": ["station_id", "obs_date"],
    "surface": ["site_id", "reading_datetime", "metric_name"],
    "events": ["well_id", "event_date", "anomaly_type"],
    "licences": ["licence_id"],
    "extraction": ["well_id", "reading_month"],
    "snapshots": ["risk_snapshot_date", "well_id"],
}

UNIQUE_KEYS: dict[str, list[list[str]]] = {
    "wells": [["well_id"], ["source_dh_no"]],
    "readings": [["well_id", "reading_date"]],
    "rainfall": [["station_id", "obs_date"]],
    "surface": [["site_id", "reading_datetime", "metric_name"]],
    "events": [["event_id"]],
    "licences": [["licence_id"]],
    "extraction": [["well_id", "reading_month"]],
    "snapshots": [["risk_snapshot_date", "well_id"]],
}

# child table -> (column, parent table, parent column); a NULL child key is allowed.
FOREIGN_KEYS: list[tuple[str, str, str, str]] = [
    ("readings", "well_id", "wells", "well_id"),
    ("events", "well_id", "wells", "well_id"),
    ("extraction", "well_id", "wells", "well_id"),
    ("snapshots", "well_id", "wells", "well_id"),
    ("snapshots", "licence_id", "licences", "licence_id"),
]

# Named SQL conditions that must not be false (NULL passes, as in SQL CHECK).
CHECKS: dict[str, dict[str, str]] = {
    "licences": {
        "licence_dates": "licence_end_date >= licence_start_date",
        "licence_allocation": "annual_allocation_ml > 0",
    },
    "extraction": {
        "extraction_nonnegative": "extraction_ml >= 0",
        "extraction_coverage": "coverage_days BETWEEN 1 AND 31",
    },
    "snapshots": {
        "risk_score": "risk_score BETWEEN 0 AND 100",
        "risk_status": "risk_status IN ('Normal', 'Watch', 'Critical')",
    },
}

REQUIRED: dict[str, list[str]] = {
    "wells": ["well_id", "source_dh_no", "coastal_flag"],
    "readings": ["well_id", "reading_date", "pumping_event", "data_quality_flag"],
    "rainfall": ["station_id", "management_area", "obs_date", "data_quality_flag"],
    "surface": ["site_id", "reading_datetime", "metric_name", "data_quality_flag"],
    "events": ["event_id", "detected_at", "event_date", "anomaly_type", "severity", "alert_sent"],
    "licences": [
        "licence_id", "management_area", "licence_start_date", "licence_end_date",
        "annual_allocation_ml", "compliance_limit_pct",
    ],
    "extraction": ["well_id", "reading_month", "coverage_days", "extraction_ml", "data_quality_flag"],
    "snapshots": [
        "risk_snapshot_date", "well_id", "source_dh_no", "management_area",
        "risk_score", "risk_status", "risk_drivers", "recommended_action",
    ],
}

TEXT_LENGTHS: dict[str, dict[str, int]] = {
    "wells": {"source_dh_no": 30, "location_name": 120, "aquifer_name": 120, "management_area": 120},
    "readings": {"data_quality_flag": 20},
    "rainfall": {"station_id": 20, "station_name": 120, "management_area": 120, "data_quality_flag": 20},
    "surface": {"site_id": 30, "site_name": 120, "metric_name": 40, "data_quality_flag": 20},
    "events": {"anomaly_type": 40, "severity": 10, "detail": 400},
    "licences": {"licence_id": 40, "management_area": 120},
    "extraction": {"data_quality_flag": 20},
    "snapshots": {
        "source_dh_no": 30, "location_name": 120, "management_area": 120, "aquifer_name": 120,
        "licence_id": 40, "latest_anomaly_type": 40, "latest_anomaly_severity": 10,
        "risk_status": 10, "risk_drivers": 500, "recommended_action": 500,
    },
}

# table -> column -> digits left of the decimal point that the stored type can hold.
DECIMAL_DIGITS: dict[str, dict[str, int]] = {
    name: {
        f.name: f.dataType.precision - f.dataType.scale
        for f in schema.fields
        if isinstance(f.dataType, T.DecimalType)
    }
    for name, schema in TABLES.items()
}


def names(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields]
