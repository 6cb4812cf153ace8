from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from conftest import day
from pyspark.sql import functions as F

from aquifold import schemas
from aquifold.operators import constraints, risk
from aquifold.plans import risk as risk_plan
from aquifold.sources.store import KeyedTable

AS_OF = dt.date(2026, 6, 7)

def volume(month: int, bore: int) -> float:
    """An invented metered volume of one bore and month: a base by bore, a wave by month."""
    return 31.0 + 11 * bore + 4 * ((3 * month + bore) % 5) + 0.25 * month


EXTRACTION = [tuple(volume(month, bore) for bore in range(6)) for month in range(12)]
AREAS = ["north", "north", "valley", "valley", "coast", "coast"]


@pytest.fixture(scope="module")
def wells(spark):
    return spark.createDataFrame(
        [(i + 1, f"DH{i + 1}", f"Site {i + 1}", "Sand", area, int(area == "coast")) for i, area in enumerate(AREAS)],
        "well_id int, source_dh_no string, location_name string, aquifer_name string, management_area string, "
        "coastal_flag int",
    )


@pytest.fixture(scope="module")
def extraction(spark):
    rows = []
    for m, volumes in enumerate(EXTRACTION):
        month = dt.date(2025 + (m + 6) // 12, (m + 6) % 12 + 1, 1)
        rows += [(i + 1, month, 30, volume, "measured") for i, volume in enumerate(volumes)]
    return spark.createDataFrame(
        rows, "well_id int, reading_month date, coverage_days int, extraction_ml double, data_quality_flag string"
    )


def licences_of(spark, *rows):
    return spark.createDataFrame(
        [(i, a, dt.date.fromisoformat(s), dt.date.fromisoformat(e), ml, 100.0) for i, a, s, e, ml in rows],
        "licence_id string, management_area string, licence_start_date date, licence_end_date date, "
        "annual_allocation_ml double, compliance_limit_pct double",
    )


@pytest.fixture(scope="module")
def licences(spark):
    year = ("2025-07-01", "2026-06-30")
    return licences_of(
        spark, ("L-north", "north", *year, 1140.0), ("L-coast", "coast", *year, 2500.0), ("L-valley", "valley", *year, 2300.0)
    )


def used_by(area: str) -> float:
    """Volumes of an area's bores over all months, which lie in the licence year and before AS_OF."""
    return sum(volume(month, bore) for month in range(12) for bore in range(6) if AREAS[bore] == area)


def test_licences_against_plain_sums(licences, extraction, wells):
    got = {r.licence_id: tuple(r) for r in risk.licence_compliance(licences, extraction, wells, AS_OF).collect()}
    # 342 of the year's 365 days have passed, the first and the last included.
    for area, allocation in (("north", 1140.0), ("coast", 2500.0), ("valley", 2300.0)):
        used = used_by(area)
        projected = used / 342 * 365
        want = (used, 100 * used / allocation, projected, 100 * projected / allocation)
        assert got[f"L-{area}"][:3] == (f"L-{area}", area, allocation)
        assert got[f"L-{area}"][3:] == tuple(pytest.approx(x, abs=d) for x, d in zip(want, (0.006, 0.06, 0.006, 0.06)))


def test_suspect_and_future_volumes_do_not_count(spark, licences, extraction, wells):
    extra = spark.createDataFrame(
        [(1, dt.date(2026, 1, 1), 30, 999.0, "suspect"), (1, dt.date(2026, 6, 8), 30, 999.0, "measured"),
         (1, dt.date(2025, 6, 30), 30, 999.0, "measured"), (77, dt.date(2026, 1, 1), 30, 999.0, "measured")],
        extraction.schema,
    )
    got = risk.licence_compliance(licences, extraction.unionByName(extra), wells, AS_OF)
    assert got.filter("licence_id = 'L-north'").first().extraction_ytd_ml == used_by("north")


def test_inactive_licences_and_areas_without_volumes(spark, extraction, wells):
    rows = licences_of(
        spark, ("old", "north", "2024-07-01", "2025-06-30", 10.0), ("later", "north", "2026-06-08", "2026-12-31", 10.0),
        ("first-day", "north", "2026-06-07", "2026-06-07", 10.0), ("desert", "desert", "2025-07-01", "2026-06-30", 10.0),
    )
    got = {r.licence_id: r for r in risk.licence_compliance(rows, extraction, wells, AS_OF).collect()}
    assert set(got) == {"first-day", "desert"}
    assert got["desert"].extraction_ytd_ml == 0.0 and got["desert"].projected_allocation_pct == 0.0


def test_licence_range_join_against_brute_force(spark, wells, extraction):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(40):
        start = dt.date(2025, 1, 1) + dt.timedelta(days=int(rng.integers(0, 600)))
        end = start + dt.timedelta(days=int(rng.integers(0, 500)))
        rows.append((f"L{i}", str(rng.choice(AREAS)), start.isoformat(), end.isoformat(), 100.0))
    got = {
        r.licence_id: r.extraction_ytd_ml
        for r in risk.licence_compliance(licences_of(spark, *rows), extraction, wells, AS_OF).collect()
    }
    want = {}
    for licence_id, area, start, end, _ in rows:
        if start <= AS_OF.isoformat() <= end:
            want[licence_id] = round(sum(
                volume
                for m, volumes in enumerate(EXTRACTION) for bore, volume in enumerate(volumes)
                if AREAS[bore] == area
                and start <= dt.date(2025 + (m + 6) // 12, (m + 6) % 12 + 1, 1).isoformat() <= AS_OF.isoformat()
            ), 2)
    assert got == want


# trend projection ----------------------------------------------------------------


def test_projection_against_numpy(spark):
    rng = np.random.default_rng(11)
    rows, want = [], {}
    for well_id in range(12):
        n = int(rng.integers(8, 140))
        series = [
            (i, None if rng.random() < 0.1 else round(6 + 0.01 * well_id * i + rng.normal(0, 0.2), 3))
            for i in range(n) if rng.random() > 0.2
        ]
        rows += [(well_id, day(i), v, "measured") for i, v in series]
        last = series[-1][0]
        kept = [(i, v) for i, v in series if i >= last - 89 and v is not None]
        if len(kept) < 10:
            continue
        x, y = np.array([k[0] for k in kept], float), np.array([k[1] for k in kept])
        b, a = np.polyfit(x, y, 1)
        future = x[-1] + 60
        s = np.std(y - b * x - a, ddof=2)
        half = 1.281552 * s * np.sqrt(1 + 1 / len(x) + (future - x.mean()) ** 2 / ((x - x.mean()) ** 2).sum())
        yhat = b * future + a
        want[well_id] = (y[-1], yhat, yhat - half, yhat + half, yhat - y[-1])
    readings = spark.createDataFrame(
        rows, "well_id int, reading_date date, water_level_mbgl double, data_quality_flag string"
    )
    got = {r.well_id: tuple(r)[1:] for r in risk.trend_projection(readings).collect()}
    assert got.keys() == want.keys()
    for well_id, values in want.items():
        assert got[well_id] == pytest.approx(values, abs=6e-4)


def test_projection_is_typed_and_empty_without_enough_rows(spark):
    readings = spark.createDataFrame(
        [(1, day(i), 5.0, "measured") for i in range(9)],
        "well_id int, reading_date date, water_level_mbgl double, data_quality_flag string",
    )
    out = risk.trend_projection(readings)
    assert out.isEmpty() and "forecast_change_mbgl" in out.columns


def test_perfect_line_has_no_interval(spark):
    readings = spark.createDataFrame(
        [(1, day(i), 5.0 + 0.01 * i, "measured") for i in range(60)],
        "well_id int, reading_date date, water_level_mbgl double, data_quality_flag string",
    )
    row = risk.trend_projection(readings).first()
    assert (row.forecast_60d_mbgl, row.forecast_lower_80_mbgl, row.forecast_upper_80_mbgl) == (6.19, 6.19, 6.19)


# completeness and events -------------------------------------------------------------


def test_completeness_counts_distinct_trusted_days(spark):
    rows = [(1, day(i), "measured") for i in range(1, 31)] + [(1, day(30), "measured")]
    rows += [(2, day(i), "suspect" if i % 2 else None) for i in range(1, 31)]
    rows += [(3, day(0), "measured")]
    readings = spark.createDataFrame(rows, "well_id int, reading_date date, data_quality_flag string")
    got = {r.well_id: r.data_completeness_30d_pct for r in risk.data_completeness(readings, day(30)).collect()}
    assert got == {1: 100.0, 2: 50.0}


def test_worst_event_and_ties(spark):
    rows = [
        (1, AS_OF, "B", "WARNING"), (1, AS_OF - dt.timedelta(days=29), "A", "CRITICAL"),
        (2, AS_OF, "Z", "WARNING"), (2, AS_OF, "A", "WARNING"),
        (3, AS_OF - dt.timedelta(days=30), "A", "CRITICAL"),
        (4, AS_OF, "A", "odd"), (4, AS_OF - dt.timedelta(days=3), "B", "INFO"),
    ]
    events = spark.createDataFrame(rows, "well_id int, event_date date, anomaly_type string, severity string")
    got = {tuple(r) for r in risk.most_severe_recent_event(events, AS_OF).collect()}
    assert got == {(1, "A", "CRITICAL"), (2, "A", "WARNING"), (4, "B", "INFO")}


# classification --------------------------------------------------------------------------


def classify(spark, *rows, **options):
    df = spark.createDataFrame(
        [(i, *row) for i, row in enumerate(rows)],
        "n int, latest_anomaly_severity string, latest_anomaly_type string, projected_allocation_pct double, "
        "forecast_change_mbgl double, data_completeness_30d_pct double",
    )
    return risk.risk_classify(df, **options).orderBy("n").collect()


def test_classification_golden(spark):
    got = classify(
        spark,
        ("CRITICAL", "RapidLevelChange", 102.9, -2.712, 100.0), ("CRITICAL", "SalinityIntrusionRisk", 91.9, -0.44, 100.0),
        (None, None, 102.9, -0.44, 100.0), ("WARNING", "LowRechargeResponse", 75.9, 0.012, 100.0),
        (None, None, 91.9, -0.439, 100.0), (None, None, 75.9, -0.453, 100.0),
    )
    assert [(r.risk_score, r.risk_status) for r in got] == [
        (100, "Critical"), (85, "Critical"), (50, "Watch"), (25, "Watch"), (25, "Watch"), (0, "Normal")
    ]
    assert got[0].risk_drivers == "critical RapidLevelChange event; projected extraction above allocation"
    assert got[5].risk_drivers == "no current risk trigger"
    assert got[5].recommended_action == "Continue routine monitoring."
    assert all(r.recommended_action.endswith(".") for r in got)


@pytest.mark.parametrize(
    ("use", "change", "complete", "score"),
    [
        (100.0, 0.0, 100.0, 25), (100.1, 0.0, 100.0, 50), (85.0, 0.0, 100.0, 25), (84.9, 0.0, 100.0, 0),
        (0.0, 0.15, 100.0, 10), (0.0, 0.149, 100.0, 0), (0.0, 0.3, 100.0, 20), (0.0, 0.299, 100.0, 10),
        (0.0, 0.0, 95.0, 0), (0.0, 0.0, 94.9, 20), (None, None, None, 20),
    ],
)
def test_classification_boundaries(spark, use, change, complete, score):
    assert classify(spark, (None, None, use, change, complete))[0].risk_score == score


def test_unknown_completeness_can_follow_the_reference(spark):
    assert classify(spark, (None, None, None, None, None), reference_nulls=True)[0].risk_score == 0


# snapshot ------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def readings(spark):
    rows = [
        (bore, AS_OF - dt.timedelta(days=i), 5.0 + 0.001 * i, 500.0, "measured")
        for bore in range(1, 7) for i in range(100) if not (bore == 6 and i < 35)
    ]
    return spark.createDataFrame(
        rows, "well_id int, reading_date date, water_level_mbgl double, tds_mg_per_l double, data_quality_flag string"
    )


@pytest.fixture(scope="module")
def events(spark):
    return spark.createDataFrame(
        [(1, AS_OF, "RapidLevelChange", "CRITICAL"), (4, AS_OF, "LowRechargeResponse", "WARNING")],
        "well_id int, event_date date, anomaly_type string, severity string",
    )


def test_snapshot_end_to_end(wells, readings, events, licences, extraction):
    snapshot = risk.risk_snapshot(wells, readings, events, licences, extraction)
    assert snapshot.columns == schemas.names(schemas.SNAPSHOTS)
    rows = risk.ordered_snapshot(snapshot).collect()
    assert [r.well_id for r in rows] == [1, 2, 6, 5, 4, 3]
    assert {r.risk_status for r in rows} == {"Critical", "Watch", "Normal"}
    assert {str(r.risk_snapshot_date) for r in rows} == {"2026-06-07"}
    gap = next(r for r in rows if r.well_id == 6)
    assert gap.data_completeness_30d_pct is None and "completeness below 95%" in gap.risk_drivers


def test_snapshot_without_active_licence_or_trend(spark, wells, readings, events, extraction):
    none = licences_of(spark, ("old", "north", "2024-07-01", "2025-06-30", 10.0))
    short = readings.filter(F.col("reading_date") >= AS_OF - dt.timedelta(days=5))
    rows = risk.risk_snapshot(wells, short, events, none, extraction).collect()
    assert len(rows) == 6 and all(r.licence_id is None and r.forecast_60d_mbgl is None for r in rows)


def test_two_active_licences_in_an_area_are_refused(spark, tmp_path, wells, readings, events, licences, extraction):
    second = licences_of(spark, ("L-second", "north", "2026-01-01", "2026-12-31", 500.0))
    snapshot = risk.risk_snapshot(wells, readings, events, licences.unionByName(second), extraction)
    assert constraints.unique_violations(snapshot, ["risk_snapshot_date", "well_id"]).count() == 2
    table = KeyedTable.named(spark, str(tmp_path), "snapshots")
    with pytest.raises(risk_plan.AmbiguousLicence):
        risk_plan.store_snapshot(table, snapshot)


def test_snapshot_is_stored_once_per_day(spark, tmp_path, wells, readings, events, licences, extraction):
    table = KeyedTable.named(spark, str(tmp_path), "snapshots")
    for _ in range(2):
        assert risk_plan.build_and_store(wells, readings, events, licences, extraction, table) == 6
    assert table.read().count() == 6
    assert pd.Series([r.risk_score for r in table.read().collect()]).between(0, 100).all()
