from __future__ import annotations

import datetime as dt

import pytest

from aquifold import schemas
from aquifold.operators import bi, constraints, fleet, health, views

TODAY = dt.date(2024, 6, 30)


def ago(days: int) -> dt.date:
    return TODAY - dt.timedelta(days=days)


@pytest.fixture(scope="module")
def wells(spark):
    return spark.createDataFrame(
        [(i, f"D{i}", f"Site {i}", 1.0, 2.0, "Sand", "A" if i < 3 else "B", i % 2) for i in range(1, 5)],
        "well_id int, source_dh_no string, location_name string, latitude double, longitude double, "
        "aquifer_name string, management_area string, coastal_flag int",
    )


@pytest.fixture(scope="module")
def readings(spark):
    rows = [(w, ago(i), 5.0 + w + 0.1 * i, 500.0 + w, "measured") for w in (1, 2, 3) for i in range(100)]
    return spark.createDataFrame(
        rows, "well_id int, reading_date date, water_level_mbgl double, tds_mg_per_l double, data_quality_flag string"
    )


@pytest.fixture(scope="module")
def events(spark):
    rows = [
        (1, 1, ago(0), "A", "CRITICAL", 0), (2, 2, ago(1), "B", "INFO", 0), (3, 3, ago(30), "C", "WARNING", 0),
        (4, 3, ago(31), "C", "CRITICAL", 1), (5, 2, ago(3), "A", "WARNING", 0), (6, 9, ago(0), "A", "CRITICAL", 0),
    ]
    return spark.createDataFrame(
        [(i, w, dt.datetime(2024, 6, 30, 6), d, t, s, 1.0, 2.0, f"detail {i}", a) for i, w, d, t, s, a in rows],
        "event_id long, well_id int, detected_at timestamp, event_date date, anomaly_type string, severity string, "
        "threshold_value double, actual_value double, detail string, alert_sent int",
    )


def test_view_and_fleet_status_windows_differ(wells, readings, events):
    view = {r.well_id: r.status for r in views.well_status(wells, readings, events, TODAY).collect()}
    assert view == {1: "Critical", 2: "Watch", 3: "Watch", 4: "Normal"}
    live = {r.well_id: r.status for r in fleet.bore_status_now(wells, events, TODAY).collect()}
    assert live == {1: "Critical", 2: "Watch", 3: "Normal", 4: "Normal"}


def test_rainfall_values_of_stations_split_or_merge(spark, wells):
    readings = spark.createDataFrame(
        [(1, TODAY, 4.0), (2, TODAY, 6.0), (3, TODAY, 9.0)], "well_id int, reading_date date, water_level_mbgl double"
    )
    rain = spark.createDataFrame(
        [("s1", "A", TODAY, 2.0), ("s2", "A", TODAY, 2.0), ("s3", "A", TODAY, 3.0)],
        "station_id string, management_area string, obs_date date, rainfall_mm double",
    )
    got = {tuple(r) for r in views.rainfall_recharge(readings, wells, rain).collect()}
    assert got == {("A", TODAY, 5.0, 2.0), ("A", TODAY, 5.0, 3.0), ("B", TODAY, 9.0, None)}


def test_licence_view_keeps_expired_and_empty_licences(spark, wells):
    licences = spark.createDataFrame(
        [("old", "A", ago(700), ago(400), 100.0, 100.0), ("now", "A", ago(100), ago(-100), 200.0, 100.0),
         ("none", "Z", ago(100), ago(-100), 10.0, 100.0)],
        "licence_id string, management_area string, licence_start_date date, licence_end_date date, "
        "annual_allocation_ml double, compliance_limit_pct double",
    )
    extraction = spark.createDataFrame(
        [(1, ago(500), 30.0, "measured"), (1, ago(50), 40.0, "measured"), (2, ago(-90), 10.0, "measured"),
         (2, ago(40), 99.0, "suspect"), (3, ago(50), 7.0, "measured")],
        "well_id int, reading_month date, extraction_ml double, data_quality_flag string",
    )
    got = {
        r.licence_id: (float(r.extraction_to_date_ml), float(r.allocation_used_pct))
        for r in views.licence_compliance_view(licences, wells, extraction).collect()
    }
    assert got == {"old": (30.0, 30.0), "now": (50.0, 25.0), "none": (0.0, 0.0)}


def test_alert_rows_and_marking(wells, events):
    unsent = views.unsent_critical_events(events, wells)
    assert [r.event_id for r in unsent.collect()] == [1]
    message = views.alert_messages(unsent).first()
    assert message.subject == "CRITICAL groundwater alert: A at Site 1"
    assert message.chat_text == "CRITICAL: A detected at Site 1 (A). detail 1"
    assert message.body.startswith("<p><b>Management area:</b> A</p><p><b>Event date:</b> 2024-06-30</p>")
    marked = views.mark_alerted(events, unsent)
    assert marked.columns == events.columns
    assert {r.event_id for r in marked.filter("alert_sent = 1").collect()} == {1, 4}
    assert views.unsent_critical_events(marked, wells).isEmpty()


@pytest.fixture(scope="module")
def snapshot(spark):
    rows = [
        (1, "Site 1", "A", "Critical", 80, 120.0, 0.5, 90.0, "act one", "L1"),
        (2, "Site 2", "A", "Watch", 30, 120.0, None, 100.0, "act one", "L1"),
        (3, "Site 3", "B", "Normal", 0, 90.0, -0.1, None, None, None),
        (4, "Site 4", "B", "Normal", 10, None, 0.2, 80.0, "act two", "L2"),
    ]
    return spark.createDataFrame(
        rows, "well_id int, location_name string, management_area string, risk_status string, risk_score int, "
        "projected_allocation_pct double, forecast_change_mbgl double, data_completeness_30d_pct double, "
        "recommended_action string, licence_id string",
    )


def test_report_measures(snapshot):
    row = bi.risk_kpis(snapshot).first()
    assert (row.critical_bores, row.watch_bores, row.avg_risk_score, row.bores_above_allocation) == (1, 1, 30.0, 2)
    assert (row.avg_level_change_60d, row.avg_completeness_30d) == (pytest.approx(0.2), 90.0)
    by_area = {r.management_area: r.critical_bores for r in bi.kpis_by_area(snapshot).collect()}
    assert by_area == {"A": 1, "B": 0}
    actions = {r.management_area: r.selected_action for r in bi.selected_action(snapshot, by=("management_area",)).collect()}
    assert actions == {"A": "act one", "B": bi.DEFAULT_ACTION}
    assert [r.location_name for r in bi.risk_by_location(snapshot).collect()] == ["Site 1", "Site 2", "Site 4", "Site 3"]


def test_selected_action_blank_counts_as_a_value(snapshot):
    only_blank = snapshot.filter("well_id = 3")
    assert bi.selected_action(only_blank).first().selected_action == bi.DEFAULT_ACTION


def test_colours(snapshot):
    got = {r.management_area: (r.status_colour, r.bar_colour) for r in bi.status_colour(snapshot, ("management_area",)).collect()}
    assert got == {"A": ("#605E5C", "#605E5C"), "B": ("#107C10", "#107C10")}


def test_licences_follow_the_risk_filter(spark, snapshot):
    licences = spark.createDataFrame([("L1",), ("L2",), ("L3",)], "licence_id string")
    assert [r[0] for r in bi.licences_in_filter(licences, snapshot.filter("risk_score > 20")).collect()] == ["L1"]


def test_calendar_has_no_gaps(spark, readings):
    rain = spark.createDataFrame([(ago(-3), 1.0), (ago(120), 1.0)], "obs_date date, rainfall_mm double")
    dates = bi.date_dimension(readings, rain)
    assert dates.count() == 124
    assert bi.date_dimension(readings.limit(0), rain.limit(0)).isEmpty()


def test_health(spark, wells, readings, events):
    assert tuple(health.staleness(readings, ago(-2)).first()) == (TODAY, 2, 3)
    assert health.detector_heartbeat(events, "2024-06-30 12:00:00").first().events_last_24h == 6
    assert health.critical_last_7d(events, "2024-07-10 00:00:00").first()[0] == 0
    assert [r.rows_loaded for r in health.rows_loaded_by_day(readings, TODAY).collect()] == [3] * 8
    assert health.duplicate_readings(readings).isEmpty()
    assert health.duplicate_readings(readings.unionByName(readings.limit(2))).count() == 2
    complete = {r.well_id: r.readings for r in health.completeness_by_bore(wells, readings, TODAY).collect()}
    assert complete == {1: 31, 2: 31, 3: 31, 4: 0}
    moves = health.day_on_day_movement(readings, TODAY).collect()
    assert len(moves) == 93 and moves[-1].delta_m is None and moves[0].delta_m == -0.1


def test_constraints(spark, wells, readings):
    extraction = spark.createDataFrame(
        [(1, TODAY, 0, -1.0), (2, TODAY, 31, 5.0), (3, TODAY, None, 5.0)],
        "well_id int, reading_month date, coverage_days int, extraction_ml double",
    )
    rules = [r.rule for r in constraints.check_violations(extraction, "extraction").collect()]
    assert sorted(rules) == ["extraction_coverage", "extraction_nonnegative"]
    orphans = constraints.fk_violations(readings, "well_id", wells.filter("well_id > 1"), "well_id")
    assert orphans.select("well_id").distinct().count() == 1
    counts = {
        (r.table_name, r.rule): r.violations
        for r in constraints.domain_violation_counts({"readings": readings.withColumn("data_quality_flag", views.F.lit("x" * 21))}).collect()
    }
    assert counts[("readings", "data_quality_flag length")] == 300
    rain = spark.createDataFrame([("s1", "A"), ("s1", "B"), ("s2", "B")], "station_id string, management_area string")
    assert tuple(constraints.station_area_mapping(rain).first()) == (3, 2, 2)


def test_bore_detail_is_nested_and_bounded(spark, wells, readings, events):
    forecasts = spark.createDataFrame(
        [(1, ago(40), ago(10), 5.0, 5.1, 5.2), (1, ago(30), TODAY, 5.0, None, 6.5)], schemas.FORECASTS
    )
    scores = spark.createDataFrame(
        [(1, ago(i), 5.0, 1.0, 0.1, 0.1, 0.01 * i, i > 3) for i in range(50)], schemas.SCORES
    )
    rows = {r.well_id: r for r in fleet.bore_detail(wells, readings, events, forecasts, scores, TODAY).collect()}
    one = rows[1]
    assert len(one.history) == 90 and one.history[-1].reading_date == TODAY and one.history[0].reading_date == ago(89)
    assert [(p.target_date, p.predicted, p.actual) for p in one.forecast_series] == [(TODAY, 6.5, None)]
    assert len(one.anomaly_trend) == 31 and [a.anomaly_type for a in one.active_alerts] == ["A"]
    assert [a.severity for a in rows[2].active_alerts] == ["INFO", "WARNING"]
    assert rows[4].history == [] and rows[4].latest_reading.level_mbgl is None
    snap = fleet.fleet_snapshot(wells, readings, events, forecasts, TODAY)
    first = snap.filter("well_id = 1").first()
    assert (first.forecast_30d, first.forecast_delta, first.coastal_flag) == (6.5, 0.5, True)
    summary = fleet.fleet_summary(snap, TODAY).first()
    assert (summary.total_bores, summary.critical, summary.watch, summary.normal, summary.avg_level_mbgl) == (4, 1, 1, 2, 7.0)
