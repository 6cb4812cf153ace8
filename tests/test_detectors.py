from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from conftest import day, ripple

from aquifold.operators import curated, detectors

AREA = "Valley"


def showers(days: int, *spells: tuple[int, float]) -> list[float]:
    """Rain of a run of days: each spell puts its millimetres on one day."""
    fallen = dict(spells)
    return [fallen.get(i, 0.0) for i in range(days)]


# rapid level change -------------------------------------------------------------


def test_a_sudden_drop_of_the_table_is_critical(readings_of):
    # Seven rows before the last: 12.2, 12.0, 11.8 in turn, mean 12.03, deviation 0.18; the last lies 21 of them deeper.
    levels = ripple(26, 12.0, 0.2) + [15.8]
    rows = detectors.rapid_level_change(readings_of((4, levels, 820.0, 0, AREA))).collect()
    assert [(r.well_id, r.anomaly_type, r.severity, r.event_date) for r in rows] == [
        (4, "RapidLevelChange", "CRITICAL", day(26))
    ]
    assert rows[0].actual_value == 15.8
    mean = np.mean(levels[-8:-1])
    assert f"deeper than the 7-day baseline ({mean:.2f} mBGL)" in rows[0].detail


def test_only_the_bore_that_jumps_is_reported(readings_of):
    quiet, jumping = ripple(24, 9.0, 0.05), ripple(23, 9.0, 0.05) + [8.0]
    rows = detectors.rapid_level_change(readings_of((1, quiet, 300.0, 0, AREA), (2, jumping, 300.0, 1, AREA))).collect()
    assert [r.well_id for r in rows] == [2]


@pytest.mark.parametrize(
    ("last", "severity"), [(7.0, "WARNING"), (6.999, None), (8.0, "CRITICAL"), (7.999, "WARNING"), (3.0, "WARNING")]
)
def test_sigma_boundaries(readings_of, last, severity):
    # The seven rows before the last have mean 5 and sample deviation 1.
    baseline = [5.0, 4.0, 6.0, 4.0, 6.0, 4.0, 6.0]
    assert np.std(baseline, ddof=1) == pytest.approx(1.0)
    events = detectors.rapid_level_change(readings_of((1, [5.0] * 5 + baseline + [last], 500.0, 0, AREA))).collect()
    assert [e.severity for e in events] == ([severity] if severity else [])


def test_constant_baseline_is_skipped(readings_of):
    assert detectors.rapid_level_change(readings_of((1, [5.0] * 19 + [9.0], 500.0, 0, AREA))).isEmpty()


def test_needs_ten_levels_over_the_whole_history(readings_of):
    nine = ripple(8, 3.0, 0.2) + [7.0]
    assert detectors.rapid_level_change(readings_of((1, nine, 500.0, 0, AREA))).isEmpty()
    ten = ripple(9, 3.0, 0.2) + [7.0]
    assert detectors.rapid_level_change(readings_of((1, ten, 500.0, 0, AREA))).count() == 1


def test_missing_last_level_or_thin_baseline_is_skipped(readings_of):
    assert detectors.rapid_level_change(readings_of((1, ripple(16, 3.0, 0.2) + [None], 500.0, 0, AREA))).isEmpty()
    thin = ripple(14, 3.0, 0.2) + [None] * 5 + [3.2, 2.8, 7.0]
    assert detectors.rapid_level_change(readings_of((1, thin, 500.0, 0, AREA))).isEmpty()


# low recharge --------------------------------------------------------------------


def test_level_that_stays_after_one_storm_is_flagged(readings_of, rain_of):
    # 34 mm on one day keep the seven-row total above 20 mm through six days after it.
    storm = showers(52, (21, 34.0))
    events = detectors.low_recharge_response(readings_of((3, [11.5] * 52, 640.0, 0, AREA)), rain_of(storm))
    row = events.first()
    assert events.count() == 1
    assert (row.anomaly_type, row.severity, row.threshold_value, row.actual_value) == (
        "LowRechargeResponse", "WARNING", 0.1, 0.0
    )
    assert row.event_date == day(27)


def test_level_that_climbs_within_two_weeks_is_healthy(readings_of, rain_of):
    # The last wet total falls on day 27; half a metre comes up ten days later.
    levels = [11.5] * 37 + [11.0] * 15
    events = detectors.low_recharge_response(readings_of((3, levels, 640.0, 0, AREA)), rain_of(showers(52, (21, 34.0))))
    assert events.isEmpty()


def test_each_area_answers_to_its_own_rain(readings_of, rain_of):
    series = [(w, [11.5] * 52, 640.0, 0, area) for w, area in ((1, "hill"), (2, "plain"), (3, "hill"))]
    rain = rain_of({"hill": showers(52, (5, 3.0)), "plain": showers(52, (18, 15.0), (20, 15.0))})
    assert [r.well_id for r in detectors.low_recharge_response(readings_of(*series), rain).collect()] == [2]


def test_exactly_twenty_millimetres_is_no_event(readings_of, rain_of):
    readings = readings_of((1, [11.5] * 52, 640.0, 0, AREA))
    assert detectors.low_recharge_response(readings, rain_of(showers(52, (12, 8.0), (15, 12.0)))).isEmpty()
    assert detectors.low_recharge_response(readings, rain_of(showers(52, (12, 8.0), (15, 12.01)))).count() == 1


@pytest.mark.parametrize(("after", "flagged"), [(5.9, False), (5.901, True)])
def test_rise_boundary(readings_of, rain_of, after, flagged):
    levels = [6.0] * 19 + [after] * 21
    events = detectors.low_recharge_response(readings_of((1, levels, 500.0, 0, AREA)), rain_of(showers(40, (12, 11.0), (14, 11.0))))
    assert events.isEmpty() is not flagged


def test_missing_side_gives_no_event(readings_of, rain_of):
    rain = rain_of(showers(40, (12, 11.0), (14, 11.0)))
    no_before = [None] * 19 + [6.0] * 21
    no_after = [6.0] * 19 + [None] * 14 + [6.0] * 7
    for levels in (no_before, no_after):
        assert detectors.low_recharge_response(readings_of((1, levels, 500.0, 0, AREA)), rain).isEmpty()


def test_no_rain_rows_give_no_event(readings_of, rain_of, spark):
    empty = spark.createDataFrame([], "obs_date date, rainfall_mm double")
    assert detectors.low_recharge_response(readings_of((1, [6.0] * 40, 500.0, 0, AREA)), empty).isEmpty()


# salinity -------------------------------------------------------------------------


@pytest.mark.parametrize(("coastal", "severity"), [(1, "CRITICAL"), (0, "WARNING"), (None, "WARNING")])
def test_rising_salinity(readings_of, coastal, severity):
    rising = [940.0 + 2.5 * i for i in range(44)]
    rows = detectors.salinity_intrusion(readings_of((8, [14.0] * 44, rising, coastal, AREA))).collect()
    assert [(r.anomaly_type, r.severity, r.actual_value) for r in rows] == [("SalinityIntrusionRisk", severity, 2.5)]
    assert rows[0].detail.endswith(" in a coastal aquifer." if coastal else "(R²=1.00).")


def test_salinity_without_a_trend_is_quiet(readings_of):
    for series in (ripple(44, 940.0, 6.0), [940.0] * 44, [940.0 - 3 * i for i in range(44)]):
        assert detectors.salinity_intrusion(readings_of((8, [14.0] * 44, series, 1, AREA))).isEmpty()


@pytest.mark.parametrize(("slope", "flagged"), [(1.0, True), (0.999, False)])
def test_slope_boundary(readings_of, slope, flagged):
    tds = [500.0 + slope * i for i in range(30)]
    assert detectors.salinity_intrusion(readings_of((1, [6.0] * 30, tds, 1, AREA))).isEmpty() is not flagged


def test_window_is_31_calendar_days(readings_of):
    # The jump lies 31 days before the last row, just outside the window.
    tds = [100.0] * 10 + [500.0 + 2 * i for i in range(31)]
    row = detectors.salinity_intrusion(readings_of((1, [6.0] * 41, tds, 0, AREA))).first()
    assert row.actual_value == 2.0


def test_repeated_dates_do_not_push_days_out_of_the_window(readings_of):
    once = readings_of((1, [6.0] * 31, [500.0 + 2 * i for i in range(31)], 0, AREA))
    twice = once.unionByName(once)
    assert detectors.salinity_intrusion(twice).first().actual_value == 2.0


# all detectors -----------------------------------------------------------------------


def test_run_all_on_empty_readings(readings_of, rain_of):
    empty = readings_of((1, [6.0], 1.0, 0, AREA)).limit(0)
    assert detectors.run_all_detectors(empty, rain_of([0.0])).isEmpty()


def test_custom_detector_must_return_event_columns(readings_of, rain_of):
    readings = readings_of((1, [6.0], 1.0, 0, AREA))
    with pytest.raises(ValueError, match="expected"):
        detectors.run_all_detectors(readings, rain_of([0.0]), [lambda r, _: r])


def test_null_flag_differs_between_stored_and_frame_inputs(spark):
    from aquifold.functions import drop_suspect

    rows = spark.createDataFrame(
        [(1, dt.date(2024, 1, 1), 5.0, 1.0, None), (1, dt.date(2024, 1, 2), 5.0, 1.0, "measured")],
        "well_id int, reading_date date, water_level_mbgl double, tds_mg_per_l double, data_quality_flag string",
    )
    wells = spark.createDataFrame([(1, 0, AREA)], "well_id int, coastal_flag int, management_area string")
    assert curated.trusted_readings(rows, wells).count() == 1
    assert drop_suspect(rows).count() == 2


# brute force ---------------------------------------------------------------------------


def expected_events(frame: pd.DataFrame, rain: pd.DataFrame) -> set[tuple]:
    """Plain per-bore evaluation of the three rules."""
    found = set()
    for well_id, g in frame.groupby("well_id"):
        g = g.sort_values("reading_date").reset_index(drop=True)
        level = g.water_level_mbgl
        before = level.iloc[-8:-1].dropna()
        if level.notna().sum() >= 10 and len(before) >= 3 and pd.notna(level.iloc[-1]) and before.std() > 0:
            z = abs(level.iloc[-1] - before.mean()) / before.std()
            if z >= 2:
                found.add((well_id, "RapidLevelChange", "CRITICAL" if z >= 3 else "WARNING"))
        last = g.reading_date.iloc[-1]
        mine = rain[rain.management_area == g.management_area.iloc[-1]].sort_values("obs_date").reset_index(drop=True)
        heavy = [
            mine.obs_date[i] for i in range(len(mine))
            if mine.rainfall_mm[max(0, i - 6): i + 1].sum() > 20 and mine.obs_date[i] <= last - dt.timedelta(days=14)
        ]
        if heavy:
            start = max(heavy)
            prior = g[g.reading_date <= start]
            after = g[(g.reading_date > start) & (g.reading_date <= start + dt.timedelta(days=14))]
            if len(prior) and len(after):
                rise = prior.water_level_mbgl.iloc[-1] - after.water_level_mbgl.min()
                if rise < 0.10:
                    found.add((well_id, "LowRechargeResponse", "WARNING"))
        w = g[(g.reading_date >= last - dt.timedelta(days=30)) & g.tds_mg_per_l.notna()]
        if g.tds_mg_per_l.notna().sum() >= 10 and len(w) >= 3:
            x = np.array([(d - w.reading_date.iloc[0]).days for d in w.reading_date], dtype=float)
            if x.max() > 0:
                slope, base = np.polyfit(x, w.tds_mg_per_l, 1)
                spread = ((w.tds_mg_per_l - w.tds_mg_per_l.mean()) ** 2).sum()
                fit = 1 - ((w.tds_mg_per_l - slope * x - base) ** 2).sum() / spread if spread else 0
                if slope >= 1 and fit >= 0.5:
                    found.add((well_id, "SalinityIntrusionRisk", "CRITICAL" if g.coastal_flag.iloc[-1] else "WARNING"))
    return found


def test_against_brute_force_with_gaps_and_missing_values(spark):
    rng = np.random.default_rng(7)
    rows = []
    for well_id in range(60):
        slope = rng.choice([0.0, 0.6, 1.5, 4.0])
        for i in range(int(rng.integers(5, 70))):
            if rng.random() < 0.25:
                continue
            level = None if rng.random() < 0.08 else float(round(5 + rng.normal(0, 0.05), 3))
            tds = None if rng.random() < 0.1 else float(round(500 + slope * i + rng.normal(0, 6), 2))
            rows.append((well_id, day(i), level, tds, well_id % 2, f"area {well_id % 3}"))
        well, date, level, tds, flag, area = rows[-1]
        if well_id % 4 == 0:
            rows[-1] = (well, date, 5.0 + float(rng.choice([-1, 1])) * 0.2, tds, flag, area)
    rain = [(f"area {a}", day(i), float(rng.choice([0, 0, 0, 2, 9]))) for a in range(3) for i in range(75)]
    readings = spark.createDataFrame(
        rows,
        "well_id int, reading_date date, water_level_mbgl double, tds_mg_per_l double, "
        "coastal_flag int, management_area string",
    )
    rainfall = spark.createDataFrame(rain, "management_area string, obs_date date, rainfall_mm double")
    frame = pd.DataFrame(rows, columns=readings.columns)
    wet = pd.DataFrame(rain, columns=rainfall.columns)
    got = {
        (r.well_id, r.anomaly_type, r.severity)
        for r in detectors.run_all_detectors(readings, rainfall).collect()
    }
    want = expected_events(frame, wet)
    assert got == want
    assert len({kind for _, kind, _ in want}) == 3
