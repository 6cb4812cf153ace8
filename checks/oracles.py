"""The registered queries as SQL for DuckDB over the same parquet tables.

Shared tables are named CTEs; each oracle takes the ones it mentions. The SQL is
written from the rules, not from the Spark plans: plain joins, correlated
subqueries and direct formulas.
"""

from __future__ import annotations

import re


def r(value: str, digits: int) -> str:
    """Round half up after dropping floating-point noise, as the operators do."""
    return f"CAST(round(CAST(round({value}, 9) AS DECIMAL(38,9)), {digits}) AS DOUBLE)"


def fixed(value: str, digits: int) -> str:
    """Text with a fixed number of decimals."""
    return f"CAST(CAST(round(CAST(round({value}, 9) AS DECIMAL(38,9)), {digits}) AS DECIMAL(28,{digits})) AS VARCHAR)"


def ts(value: str) -> str:
    return f"strftime({value}, '%Y-%m-%d %H:%M:%S')"


_SHARES = "CASE r_regionkey WHEN 0 THEN 1.08e0 WHEN 1 THEN 0.88e0 WHEN 2 THEN 0.64e0 WHEN 3 THEN 1.02e0 ELSE 0.95e0 END"

CTES: dict[str, str] = {
    "areas": "SELECT n_nationkey, n_name, r_regionkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey",
    "wells": """
        SELECT s_suppkey AS well_id, s_name AS source_dh_no, s_name AS location_name,
               CAST(s_suppkey % 180 - 90 AS DOUBLE) AS latitude, CAST(s_suppkey % 360 - 180 AS DOUBLE) AS longitude,
               n_name AS aquifer_name, r_name AS management_area, CAST(s_nationkey % 2 AS BIGINT) AS coastal_flag
        FROM supplier JOIN areas ON s_nationkey = n_nationkey""",
    "readings": """
        SELECT *, CASE WHEN water_level_mbgl > 48 THEN 'suspect' ELSE 'measured' END AS data_quality_flag
        FROM (SELECT l_suppkey AS well_id, CAST(l_shipdate AS DATE) AS reading_date,
                     floor(sum(l_quantity) / count(*) * 1000 + 0.5e0) / 1000e0 AS water_level_mbgl,
                     floor(CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / (count(*) * 100e0) + 0.5e0)
                         / 100e0 AS tds_mg_per_l,
                     CAST(count(*) > 1 AS BIGINT) AS pumping_event
              FROM lineitem GROUP BY 1, 2)""",
    "rainfall": """
        SELECT station_id, station_id AS station_name, management_area, obs_date, rainfall_mm,
               CASE WHEN rainfall_mm > 9 THEN 'suspect' ELSE 'measured' END AS data_quality_flag
        FROM (SELECT r_name || '-' || CAST(o_orderkey % 2 AS VARCHAR) AS station_id, r_name AS management_area,
                     CAST(o_orderdate AS DATE) AS obs_date,
                     floor(CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / (count(*) * 50000e0) + 0.5e0)
                         / 100e0 AS rainfall_mm
              FROM orders JOIN customer ON o_custkey = c_custkey JOIN areas ON c_nationkey = n_nationkey
              GROUP BY 1, 2, 3)""",
    "extraction": """
        SELECT *, CASE WHEN coverage_days <= 1 THEN 'suspect' ELSE 'measured' END AS data_quality_flag
        FROM (SELECT l_suppkey AS well_id, CAST(date_trunc('month', l_shipdate) AS DATE) AS reading_month,
                     count(DISTINCT day(l_shipdate)) AS coverage_days, sum(l_quantity) AS extraction_ml
              FROM lineitem GROUP BY 1, 2)""",
    "licences": f"""
        SELECT 'LIC-' || r_name || '-' || y AS licence_id, r_name AS management_area,
               CAST(s AS DATE) AS licence_start_date, CAST(e AS DATE) AS licence_end_date,
               floor(used / (127 / 365e0) / ({_SHARES}) * 100 + 0.5e0) / 100e0 AS annual_allocation_ml,
               100e0 AS compliance_limit_pct
        FROM region
        JOIN (SELECT management_area, sum(extraction_ml) AS used FROM extraction JOIN wells USING (well_id)
              WHERE reading_month BETWEEN DATE '2001-07-01' AND DATE '2001-11-30' GROUP BY 1) u
          ON r_name = management_area
        CROSS JOIN (VALUES ('2001', '2001-07-01', '2002-06-30'), ('2000', '2000-07-01', '2001-06-30')) AS p(y, s, e)""",
    "as_of": "SELECT max(reading_date) AS d, CAST(max(reading_date) + 1 AS TIMESTAMP) + INTERVAL 6 HOUR AS t FROM readings",
    "trusted": """
        SELECT well_id, reading_date, water_level_mbgl, tds_mg_per_l, coastal_flag, management_area
        FROM readings JOIN wells USING (well_id) WHERE data_quality_flag <> 'suspect'""",
    "area_rain": """
        SELECT management_area, obs_date, avg(rainfall_mm) AS rainfall_mm FROM rainfall
        WHERE data_quality_flag <> 'suspect' GROUP BY 1, 2""",
    "area_rain_all": "SELECT management_area, obs_date, avg(rainfall_mm) AS rainfall_mm FROM rainfall GROUP BY 1, 2",
    "region_rain": "SELECT obs_date, avg(rainfall_mm) AS rainfall_mm FROM rainfall GROUP BY 1",
    "rapid": f"""
        SELECT well_id, reading_date AS event_date, 'RapidLevelChange' AS anomaly_type,
               CASE WHEN z >= 3 THEN 'CRITICAL' ELSE 'WARNING' END AS severity,
               {r("m + sign(water_level_mbgl - m) * 2 * s", 3)} AS threshold_value,
               {r("water_level_mbgl", 3)} AS actual_value,
               'Water level ' || {fixed("water_level_mbgl", 2)} || ' mBGL is ' || {fixed("z", 1)} || 'σ '
                 || CASE WHEN water_level_mbgl > m THEN 'deeper' ELSE 'shallower' END
                 || ' than the 7-day baseline (' || {fixed("m", 2)} || ' mBGL).' AS detail
        FROM (SELECT *, round(abs(water_level_mbgl - m) / s, 9) AS z
              FROM (SELECT well_id, reading_date, water_level_mbgl,
                           count(water_level_mbgl) OVER w AS n, avg(water_level_mbgl) OVER w AS m,
                           stddev_samp(water_level_mbgl) OVER w AS s,
                           count(water_level_mbgl) OVER (PARTITION BY well_id) AS total,
                           row_number() OVER (PARTITION BY well_id ORDER BY reading_date DESC) AS k
                    FROM trusted
                    WINDOW w AS (PARTITION BY well_id ORDER BY reading_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
              WHERE k = 1 AND total >= 10 AND n >= 3 AND round(s, 9) > 0)
        WHERE z >= 2""",
    "salinity": f"""
        SELECT well_id, event_date, 'SalinityIntrusionRisk' AS anomaly_type,
               CASE WHEN coastal = 1 THEN 'CRITICAL' ELSE 'WARNING' END AS severity, 1e0 AS threshold_value,
               {r("slope", 3)} AS actual_value,
               'TDS rising ' || {fixed("slope", 1)} || ' mg/L per day over 30 days (R²=' || {fixed("r2", 2)} || ')'
                 || CASE WHEN coastal = 1 THEN ' in a coastal aquifer.' ELSE '.' END AS detail
        FROM (SELECT t.well_id, max(reading_date) AS event_date, count(*) AS n, max(coastal) AS coastal,
                     date_diff('day', min(reading_date), max(reading_date)) AS span,
                     round(regr_slope(tds_mg_per_l, CAST(date_diff('day', DATE '1990-01-01', reading_date) AS DOUBLE)), 9) AS slope,
                     round(regr_r2(tds_mg_per_l, CAST(date_diff('day', DATE '1990-01-01', reading_date) AS DOUBLE)), 9) AS r2
              FROM trusted t
              JOIN (SELECT well_id, max(reading_date) AS last, count(tds_mg_per_l) AS total,
                           arg_max(coastal_flag, reading_date) AS coastal FROM trusted GROUP BY 1) b
                ON t.well_id = b.well_id AND reading_date >= last - 30 AND total >= 10
              WHERE tds_mg_per_l IS NOT NULL GROUP BY 1)
        WHERE n >= 3 AND span > 0 AND slope >= 1 AND r2 >= 0.5e0""",
    "bores": """
        SELECT well_id, max(reading_date) AS last, arg_max(management_area, reading_date) AS area FROM trusted GROUP BY 1""",
    "event_of_bore": """
        SELECT well_id, max(obs_date) AS event_date
        FROM bores JOIN (SELECT *, sum(rainfall_mm) OVER (PARTITION BY management_area ORDER BY obs_date
                                ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS total FROM area_rain)
          ON management_area = area AND round(total, 9) > 20 AND obs_date <= last - 14 GROUP BY 1""",
    "event_of_bore_regional": """
        SELECT well_id, max(obs_date) AS event_date
        FROM bores, (SELECT *, sum(rainfall_mm) OVER (ORDER BY obs_date
                            ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS total FROM region_rain)
        WHERE round(total, 9) > 20 AND obs_date <= last - 14 GROUP BY 1""",
}


def _recharge(events: str) -> str:
    return f"""
        SELECT well_id, event_date, 'LowRechargeResponse' AS anomaly_type, 'WARNING' AS severity,
               0.1e0 AS threshold_value, {r("rise", 3)} AS actual_value,
               'After a rainfall event (7-day total > 20 mm) the water table rose only ' || {fixed("rise", 2)}
                 || ' m within 14 days (expected >= 0.10 m).' AS detail
        FROM (SELECT e.well_id, e.event_date, round(
                       (SELECT arg_max(water_level_mbgl, reading_date) FROM trusted t
                        WHERE t.well_id = e.well_id AND t.reading_date <= e.event_date)
                       - (SELECT min(water_level_mbgl) FROM trusted t WHERE t.well_id = e.well_id
                          AND t.reading_date > e.event_date AND t.reading_date <= e.event_date + 14), 9) AS rise
              FROM {events} e)
        WHERE rise < 0.1e0"""


CTES |= {
    "recharge": _recharge("event_of_bore"),
    "recharge_regional": _recharge("event_of_bore_regional"),
    "detected": "SELECT * FROM rapid UNION ALL SELECT * FROM recharge UNION ALL SELECT * FROM salinity",
    "anomalies": """
        SELECT id AS event_id, well_id, CAST(event_date + 1 AS TIMESTAMP) + INTERVAL 6 HOUR AS detected_at,
               event_date, anomaly_type, severity, threshold_value, actual_value, detail, id % 2 AS alert_sent
        FROM (SELECT *, well_id * 3 + CASE anomaly_type WHEN 'RapidLevelChange' THEN 0
                          WHEN 'LowRechargeResponse' THEN 1 ELSE 2 END AS id FROM detected)""",
    "compliance": f"""
        SELECT licence_id, management_area, annual_allocation_ml,
               {r("x", 2)} AS extraction_ytd_ml, {r("100 * x / annual_allocation_ml", 1)} AS allocation_used_pct,
               {r("x / f", 2)} AS projected_year_end_extraction_ml,
               {r("100 * (x / f) / annual_allocation_ml", 1)} AS projected_allocation_pct
        FROM (SELECT l.*, (SELECT coalesce(sum(extraction_ml), 0) FROM extraction JOIN wells w USING (well_id)
                           WHERE w.management_area = l.management_area AND data_quality_flag <> 'suspect'
                             AND reading_month >= l.licence_start_date AND reading_month <= as_of.d) AS x,
                     nullif(greatest(least((date_diff('day', licence_start_date, as_of.d) + 1)
                       / CAST(date_diff('day', licence_start_date, licence_end_date) + 1 AS DOUBLE), 1e0), 0e0), 0e0) AS f
              FROM licences l, as_of WHERE licence_start_date <= as_of.d AND licence_end_date >= as_of.d)""",
    "projection": f"""
        SELECT well_id, {r("latest", 3)} AS latest_level_mbgl, {r("yhat", 3)} AS forecast_60d_mbgl,
               {r("yhat - half", 3)} AS forecast_lower_80_mbgl, {r("yhat + half", 3)} AS forecast_upper_80_mbgl,
               {r("yhat - latest", 3)} AS forecast_change_mbgl
        FROM (SELECT *, b0 + b1 * xf AS yhat,
                     1.281552e0 * sqrt(greatest(syy - b1 * sxy, 0) / (n - 2))
                       * sqrt(1 + 1e0 / n + coalesce((xf - mx) * (xf - mx) / nullif(sxx, 0), 0)) AS half
              FROM (SELECT well_id, count(*) AS n, arg_max(y, x) AS latest, max(x) + 60 AS xf, avg(x) AS mx,
                           regr_slope(y, x) AS b1, regr_intercept(y, x) AS b0, regr_sxx(y, x) AS sxx,
                           regr_syy(y, x) AS syy, regr_sxy(y, x) AS sxy
                    FROM (SELECT a.well_id, water_level_mbgl AS y,
                                 CAST(date_diff('day', last, reading_date) AS DOUBLE) AS x
                          FROM readings a JOIN (SELECT well_id, max(reading_date) AS last FROM readings
                                                WHERE data_quality_flag <> 'suspect' GROUP BY 1) b
                            ON a.well_id = b.well_id AND reading_date >= last - 89
                          WHERE data_quality_flag <> 'suspect' AND water_level_mbgl IS NOT NULL)
                    GROUP BY 1) WHERE n >= 10)""",
    "completeness": f"""
        SELECT well_id, {r("least(100e0 * count(DISTINCT reading_date) / 30, 100)", 1)} AS data_completeness_30d_pct
        FROM readings, as_of WHERE reading_date BETWEEN d - 29 AND d AND data_quality_flag <> 'suspect' GROUP BY 1""",
    "worst_event": """
        SELECT well_id, anomaly_type AS latest_anomaly_type, severity AS latest_anomaly_severity
        FROM (SELECT *, row_number() OVER (PARTITION BY well_id ORDER BY
                       CASE severity WHEN 'CRITICAL' THEN 3 WHEN 'WARNING' THEN 2 WHEN 'INFO' THEN 1 ELSE 0 END DESC,
                       event_date DESC, anomaly_type) AS k
              FROM anomalies, as_of WHERE event_date >= d - 29) WHERE k = 1""",
    "snapshot": "",  # filled below
    "snapshots": """
        SELECT * FROM snapshot WHERE risk_status <> 'Normal'
        UNION ALL SELECT * REPLACE (risk_snapshot_date - 30 AS risk_snapshot_date, CAST(0 AS BIGINT) AS risk_score) FROM snapshot""",
    "status": """
        SELECT w.*, last_reading_date, last_water_level_mbgl, last_tds_mg_per_l,
               CASE coalesce(sev, 0) WHEN 3 THEN 'Critical' WHEN 2 THEN 'Watch' ELSE 'Normal' END AS status
        FROM wells w
        LEFT JOIN (SELECT well_id, max(reading_date) AS last_reading_date,
                          arg_max(water_level_mbgl, reading_date) AS last_water_level_mbgl,
                          arg_max(tds_mg_per_l, reading_date) AS last_tds_mg_per_l FROM readings GROUP BY 1) USING (well_id)
        LEFT JOIN (SELECT well_id, max(CASE severity WHEN 'CRITICAL' THEN 3 WHEN 'WARNING' THEN 2
                          WHEN 'INFO' THEN 1 ELSE 0 END) AS sev
                   FROM anomalies, as_of WHERE event_date >= d - 30 GROUP BY 1) USING (well_id)""",
    "base_features": """
        SELECT t.*, coalesce(r.rainfall_mm, 0) AS rainfall_mm
        FROM trusted t LEFT JOIN area_rain_all r
          ON r.management_area = t.management_area AND r.obs_date = t.reading_date""",
    "features": """
        SELECT * FROM (
          SELECT well_id, reading_date, water_level_mbgl, coastal_flag, rainfall_mm, management_area,
                 last_value(tds_mg_per_l IGNORE NULLS) OVER (w ROWS UNBOUNDED PRECEDING) AS tds_mg_per_l,
                 lag(water_level_mbgl, 1) OVER w AS level_lag_1, lag(water_level_mbgl, 7) OVER w AS level_lag_7,
                 lag(water_level_mbgl, 14) OVER w AS level_lag_14, lag(water_level_mbgl, 30) OVER w AS level_lag_30,
                 CASE WHEN count(water_level_mbgl) OVER w7 >= 3 THEN avg(water_level_mbgl) OVER w7 END AS level_roll_mean_7,
                 CASE WHEN count(water_level_mbgl) OVER w7 >= 3 THEN stddev_samp(water_level_mbgl) OVER w7 END AS level_roll_std_7,
                 CASE WHEN count(water_level_mbgl) OVER w30 >= 15 THEN avg(water_level_mbgl) OVER w30 END AS level_roll_mean_30,
                 CASE WHEN count(water_level_mbgl) OVER w30 >= 15 THEN stddev_samp(water_level_mbgl) OVER w30 END AS level_roll_std_30,
                 sum(rainfall_mm) OVER w7 AS rain_sum_7, sum(rainfall_mm) OVER w14 AS rain_sum_14,
                 sum(rainfall_mm) OVER w30 AS rain_sum_30,
                 sin(2 * pi() * dayofyear(reading_date) / 365.25e0) AS season_sin,
                 cos(2 * pi() * dayofyear(reading_date) / 365.25e0) AS season_cos,
                 water_level_mbgl AS level_now, lead(water_level_mbgl, 30) OVER w AS target, reading_date + 30 AS target_date
          FROM base_features
          WINDOW w AS (PARTITION BY well_id ORDER BY reading_date),
                 w7 AS (PARTITION BY well_id ORDER BY reading_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
                 w14 AS (PARTITION BY well_id ORDER BY reading_date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW),
                 w30 AS (PARTITION BY well_id ORDER BY reading_date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW))
        WHERE target IS NOT NULL AND level_lag_30 IS NOT NULL""",
    "cutoff": """
        SELECT d AS cutoff FROM (SELECT d, row_number() OVER (ORDER BY d) AS k, count(*) OVER () AS n
                                 FROM (SELECT DISTINCT reading_date AS d FROM features)) WHERE k = floor(n * 0.8e0) + 1""",
    "anomaly_rows": """
        SELECT * FROM (
          SELECT well_id, reading_date, water_level_mbgl, tds_mg_per_l,
                 CASE WHEN count(water_level_mbgl) OVER p >= 5 AND round(stddev_samp(water_level_mbgl) OVER p, 9) > 0
                   THEN (water_level_mbgl - avg(water_level_mbgl) OVER p) / stddev_samp(water_level_mbgl) OVER p END AS level_z,
                 CASE WHEN count(tds_mg_per_l) OVER p >= 5 AND round(stddev_samp(tds_mg_per_l) OVER p, 9) > 0
                   THEN (tds_mg_per_l - avg(tds_mg_per_l) OVER p) / stddev_samp(tds_mg_per_l) OVER p END AS tds_z,
                 water_level_mbgl - lag(water_level_mbgl) OVER w AS level_diff,
                 tds_mg_per_l - lag(tds_mg_per_l) OVER w AS tds_diff,
                 sum(rainfall_mm) OVER w7 AS rain_sum_7
          FROM base_features
          WINDOW w AS (PARTITION BY well_id ORDER BY reading_date),
                 w7 AS (PARTITION BY well_id ORDER BY reading_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
                 p AS (PARTITION BY well_id ORDER BY reading_date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING))
        WHERE level_z IS NOT NULL AND tds_z IS NOT NULL AND level_diff IS NOT NULL AND tds_diff IS NOT NULL
          AND rain_sum_7 IS NOT NULL""",
    "forecasts": """
        SELECT well_id, reading_date, target_date, level_now, target AS actual,
               round(level_roll_mean_7, 6) AS predicted FROM features""",
    "scores": """
        SELECT * EXCLUDE (raw, cut), round(raw - cut, 9) AS anomaly_score, raw > cut AS is_anomaly FROM forest_raw, forest_cut""",
    "status_now": """
        SELECT w.well_id, CASE WHEN c IS NULL THEN 'Normal' WHEN c THEN 'Critical' ELSE 'Watch' END AS status
        FROM wells w LEFT JOIN (SELECT well_id, bool_or(severity = 'CRITICAL') AS c FROM anomalies, as_of
                                WHERE event_date >= d - 1 GROUP BY 1) USING (well_id)""",
    "latest": f"""
        SELECT well_id, reading_date, {r("water_level_mbgl", 3)} AS level_mbgl, {r("tds_mg_per_l", 1)} AS tds_mg_per_l
        FROM (SELECT *, row_number() OVER (PARTITION BY well_id ORDER BY reading_date DESC) AS k FROM readings) WHERE k = 1""",
    "last_forecast": f"""
        SELECT well_id, target_date, {r("predicted", 3)} AS predicted, {r("actual", 3)} AS actual
        FROM (SELECT *, max(reading_date) OVER (PARTITION BY well_id) AS last FROM forecasts) WHERE reading_date = last""",
    "fleet": f"""
        SELECT w.well_id, location_name, aquifer_name, management_area, coastal_flag, latitude AS lat, longitude AS lon,
               status, reading_date, level_mbgl, tds_mg_per_l, predicted AS forecast_30d,
               {r("predicted - level_mbgl", 3)} AS forecast_delta
        FROM wells w JOIN status_now USING (well_id) LEFT JOIN latest USING (well_id)
        LEFT JOIN last_forecast USING (well_id)""",
    "tags": """
        SELECT event_id, ts, user_id AS well_id, 'Site ' || CAST(user_id % 7 AS VARCHAR) AS location,
               CASE event_type WHEN 'click' THEN 'level' WHEN 'view' THEN 'tds' WHEN 'purchase' THEN 'pump'
                 ELSE 'valve' END AS field, value
        FROM events WHERE event_type IN ('click', 'view', 'purchase', 'signup')""",
    "tag_state": """
        SELECT well_id, max(location) AS location,
               max(value) FILTER (field = 'level') AS level, max(value) FILTER (field = 'tds') AS tds,
               max(value) FILTER (field = 'pump') AS pump, max(value) FILTER (field = 'valve') AS valve,
               max(last) AS last_update
        FROM (SELECT *, row_number() OVER (PARTITION BY well_id, field ORDER BY ts DESC, event_id DESC) AS k,
                     max(ts) OVER (PARTITION BY well_id) AS last FROM tags) WHERE k = 1 GROUP BY 1""",
    "alerts": "SELECT e.*, location_name, management_area FROM anomalies e JOIN wells USING (well_id) WHERE severity = 'CRITICAL' AND alert_sent = 0",
}


def _classified(source: str) -> str:
    """Score, status, drivers and action of rows with the five inputs."""
    return f"""
        SELECT *, CASE WHEN risk_score >= 60 THEN 'Critical' WHEN risk_score >= 25 THEN 'Watch' ELSE 'Normal' END AS risk_status
        FROM (SELECT *,
            CAST(least(CASE sev WHEN 'CRITICAL' THEN 60 WHEN 'WARNING' THEN 25 ELSE 0 END
                + CASE WHEN use_pct > 100 THEN 50 WHEN use_pct >= 85 THEN 25 ELSE 0 END
                + CASE WHEN change >= 0.3e0 THEN 20 WHEN change >= 0.15e0 THEN 10 ELSE 0 END
                + CASE WHEN complete < 95 THEN 20 ELSE 0 END, 100) AS BIGINT) AS risk_score,
            coalesce(nullif(concat_ws('; ',
                CASE sev WHEN 'CRITICAL' THEN concat_ws(' ', 'critical', anomaly, 'event')
                         WHEN 'WARNING' THEN concat_ws(' ', 'warning', anomaly, 'event') END,
                CASE WHEN use_pct > 100 THEN 'projected extraction above allocation'
                     WHEN use_pct >= 85 THEN 'projected extraction at or above 85% of allocation' END,
                CASE WHEN change >= 0.3e0 THEN '60-day projection indicates further drawdown'
                     WHEN change >= 0.15e0 THEN '60-day projection indicates moderate drawdown' END,
                CASE WHEN complete < 95 THEN 'recent data completeness below 95%' END), ''),
              'no current risk trigger') AS risk_drivers,
            CASE WHEN anomaly = 'SalinityIntrusionRisk' THEN 'Confirm the salinity result and review coastal bore monitoring.'
                 WHEN anomaly = 'RapidLevelChange' THEN 'Confirm the latest level reading and review recent pumping conditions.'
                 WHEN anomaly = 'LowRechargeResponse' THEN 'Review the recent rainfall response and check for continued low recharge.'
                 WHEN use_pct > 100 THEN 'Review extraction against the licence allocation and prepare a compliance response.'
                 WHEN use_pct >= 85 THEN 'Review the seasonal pumping plan and monitor allocation use monthly.'
                 WHEN change >= 0.3e0 THEN 'Review the 60-day drawdown outlook and increase monitoring frequency if required.'
                 WHEN complete < 95 THEN 'Resolve recent data gaps before the next water-security review.'
                 ELSE 'Continue routine monitoring.' END AS recommended_action
          FROM (SELECT *, latest_anomaly_severity AS sev, latest_anomaly_type AS anomaly,
                       coalesce(projected_allocation_pct, 0) AS use_pct, coalesce(forecast_change_mbgl, 0) AS change,
                       coalesce(data_completeness_30d_pct, 0) AS complete FROM ({source})))"""


_SNAPSHOT_COLUMNS = """risk_snapshot_date, well_id, source_dh_no, location_name, management_area, aquifer_name,
        licence_id, annual_allocation_ml, extraction_ytd_ml, allocation_used_pct, projected_year_end_extraction_ml,
        projected_allocation_pct, latest_level_mbgl, forecast_60d_mbgl, forecast_lower_80_mbgl,
        forecast_upper_80_mbgl, forecast_change_mbgl, data_completeness_30d_pct, latest_anomaly_type,
        latest_anomaly_severity, risk_score, risk_status, risk_drivers, recommended_action"""
CTES["snapshot"] = f"""
        SELECT {_SNAPSHOT_COLUMNS} FROM ({_classified('''
            SELECT d AS risk_snapshot_date, w.*, c.* EXCLUDE (management_area), p.* EXCLUDE (well_id),
                   m.* EXCLUDE (well_id), e.* EXCLUDE (well_id)
            FROM as_of, wells w LEFT JOIN compliance c ON c.management_area = w.management_area
            LEFT JOIN projection p ON p.well_id = w.well_id LEFT JOIN completeness m ON m.well_id = w.well_id
            LEFT JOIN worst_event e ON e.well_id = w.well_id''')})"""

_SNAPSHOT_OUT = f"SELECT * REPLACE (CAST(risk_snapshot_date AS VARCHAR) AS risk_snapshot_date) FROM"
# The isolation forest: 300 trees of 256 rows, whose draws are md5 numbers.


def _drawn(text: str) -> str:
    return f"(('0x' || substr(md5({text}), 1, 13))::BIGINT::DOUBLE / 4503599627370496e0)"


_MEAN_PATH = "CASE WHEN n <= 1 THEN 0e0 WHEN n = 2 THEN 1e0 ELSE 2e0 * (ln(n - 1e0) + 0.5772156649015329e0) - 2e0 * (n - 1e0) / n END"

CTES["forest_rows"] = """
    SELECT well_id, reading_date, water_level_mbgl, tds_mg_per_l, x[1] AS level_z, x[2] AS tds_z,
           x, well_id || '|' || reading_date AS k
    FROM (SELECT *, [""" + ", ".join(r(c, 6) for c in ("level_z", "tds_z", "level_diff", "tds_diff", "rain_sum_7")) + """] AS x
          FROM anomaly_rows)"""
CTES["forest_size"] = """
    SELECT least(1e0, wanted * 300) AS keep, wanted / least(1e0, wanted * 300) AS per_tree
    FROM (SELECT least(1e0, 1.5e0 * 256 / count(*)) AS wanted FROM forest_rows)"""
CTES["forest_samples"] = f"""
    SELECT tree, x FROM (
      SELECT tree, x, row_number() OVER (PARTITION BY tree ORDER BY draw, k) AS place FROM (
        SELECT t.tree, x, k, per_tree, {_drawn("'0|' || t.tree || '|' || k")} AS draw
        FROM forest_rows, forest_size, range(300) AS t(tree) WHERE {_drawn("'0|' || k")} < keep)
      WHERE draw < per_tree) WHERE place <= 256"""
_CHOSEN = f"""
    SELECT *, lo[f] + {_drawn("'0|' || tree || '|' || node || '|cut'")} * (hi[f] - lo[f]) AS cut FROM (
      SELECT *, varying[1 + floor({_drawn("'0|' || tree || '|' || node || '|feature'")} * len(varying))::INT] AS f FROM (
        SELECT *, list_filter([1, 2, 3, 4, 5], lambda i: hi[i] > lo[i]) AS varying FROM ({{source}})))"""
_ENDS = [f"{end}(x[{i}])" for end in ("min", "max") for i in range(1, 6)]
_LOW, _HIGH = (", ".join(e + "{over}" for e in _ENDS[:5]), ", ".join(e + "{over}" for e in _ENDS[5:]))
CTES["forest_nodes"] = """
    SELECT tree, 0 AS node, 0 AS depth, x FROM forest_samples
    UNION ALL
    SELECT tree, 2 * node + 1 + (x[f] > cut)::INT, depth + 1, x FROM (""" + _CHOSEN.format(source=f"""
        SELECT *, [{_LOW.format(over=" OVER w")}] AS lo, [{_HIGH.format(over=" OVER w")}] AS hi FROM forest_nodes
        WINDOW w AS (PARTITION BY tree, node)""") + ") WHERE depth < 8 AND len(varying) > 0"
CTES["forest_splits"] = _CHOSEN.format(source=f"""
    SELECT tree, node, depth, count(*) AS n, [{_LOW.format(over="")}] AS lo, [{_HIGH.format(over="")}] AS hi
    FROM forest_nodes GROUP BY tree, node, depth""")
CTES["forest_trees"] = f"""
    SELECT tree, fs, cuts, paths FROM (
      SELECT t.tree, list(coalesce(f, 1) ORDER BY i) AS fs, list(coalesce(cut, 'infinity'::DOUBLE) ORDER BY i) AS cuts
      FROM range(300) AS t(tree) CROSS JOIN range(255) AS n(i)
      LEFT JOIN (SELECT * FROM forest_splits WHERE depth < 8 AND len(varying) > 0) s ON s.tree = t.tree AND s.node = n.i GROUP BY t.tree)
    JOIN (
      SELECT t.tree, list(coalesce(path, 0) ORDER BY i) AS paths FROM range(300) AS t(tree) CROSS JOIN range(256) AS n(i)
      LEFT JOIN (SELECT tree, (node + 1) * (1 << (8 - depth)) - 256 AS slot, round((depth + {_MEAN_PATH}) * 1e9)::BIGINT AS path
                 FROM forest_splits WHERE depth = 8 OR len(varying) = 0) s ON s.tree = t.tree AND s.slot = n.i GROUP BY t.tree) USING (tree)"""
_WALK = "SELECT k, x, fs, cuts, paths, 0 AS node FROM forest_rows, forest_trees"
for _ in range(8):
    _WALK = f"SELECT k, x, fs, cuts, paths, 2 * node + 1 + (x[fs[node + 1]] > cuts[node + 1])::INT AS node FROM ({_WALK})"
CTES["forest_raw"] = f"""
    SELECT r.* EXCLUDE (x, k), raw FROM forest_rows r JOIN (
      SELECT k, round(pow(2e0, -(sum(paths[node - 254])::DOUBLE / 1e9) / 300 / (2e0 * (ln(255e0) + 0.5772156649015329e0) - 2e0 * 255 / 256)), 9) AS raw
      FROM ({_WALK}) GROUP BY k) USING (k)"""
CTES["forest_cut"] = """
    SELECT low + (high - low) * (p - floor(p)) AS cut FROM (
      SELECT 0.99e0 * (n - 1) AS p, max(raw) FILTER (place = floor(0.99e0 * (n - 1))) AS low,
             max(raw) FILTER (place = least(floor(0.99e0 * (n - 1)) + 1, n - 1)) AS high
      FROM (SELECT raw, row_number() OVER (ORDER BY raw) - 1 AS place, count(*) OVER () AS n FROM forest_raw) GROUP BY n)"""

#: Key, day, two numbers and texts of each table, as in the registry's common layout.
_LAYOUT = {
    "wells": ("wells", "well_id", "NULL", "latitude", "longitude", "source_dh_no location_name aquifer_name management_area coastal_flag"),
    "licences": ("licences", "licence_id", "licence_start_date", "annual_allocation_ml", "compliance_limit_pct", "management_area licence_end_date"),
    "readings": ("readings", "well_id", "reading_date", "water_level_mbgl", "tds_mg_per_l", "pumping_event data_quality_flag"),
    "rainfall": ("rainfall", "station_id", "obs_date", "rainfall_mm", "NULL", "station_name management_area data_quality_flag"),
    "extraction": ("extraction", "well_id", "reading_month", "extraction_ml", "NULL", "coverage_days data_quality_flag"),
    "anomalies": ("events", "event_id", "event_date", "threshold_value", "actual_value", "well_id anomaly_type severity detail alert_sent"),
    "snapshots": ("snapshots", "well_id", "risk_snapshot_date", "risk_score", "NULL", "risk_status risk_drivers recommended_action"),
}


def _all_rows(name: str) -> str:
    table, key, day, x, y, texts = _LAYOUT[name]
    joined = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '-')" for c in texts.split())
    return (
        f"SELECT '{table}' AS table_name, CAST({key} AS VARCHAR) AS row_key, CAST(CAST({day} AS DATE) AS VARCHAR) AS day, "
        f"round(CAST({x} AS DOUBLE), 6) AS x, round(CAST({y} AS DOUBLE), 6) AS y, {joined} AS texts FROM {name}"
    )


_EVENT_OUT = "SELECT * REPLACE (CAST(event_date AS VARCHAR) AS event_date) FROM"


def _kpis(by: str = "") -> str:
    key, tail = (f"{by}, ", f" GROUP BY {by}") if by else ("", "")
    return f"""SELECT {key}count(*) FILTER (risk_status = 'Critical') AS critical_bores,
        count(*) FILTER (risk_status = 'Watch') AS watch_bores, {r("avg(risk_score)", 6)} AS avg_risk_score,
        max(projected_allocation_pct) AS max_projected_allocation_pct,
        count(DISTINCT CASE WHEN projected_allocation_pct > 100 THEN well_id END) AS bores_above_allocation,
        {r("avg(forecast_change_mbgl)", 6)} AS avg_level_change_60d,
        {r("avg(data_completeness_30d_pct)", 6)} AS avg_completeness_30d FROM snapshot{tail}"""


def _horizons() -> str:
    parts = []
    for h in (7, 14, 30, 45, 60):
        parts.append(f"""
        SELECT CAST({h} AS BIGINT) AS horizon_days, count(*) AS n_test, {r("avg(abs(a - now))", 4)} AS baseline_mae_m,
               {r("sqrt(avg((a - now) * (a - now)))", 4)} AS baseline_rmse_m
        FROM (SELECT *, dense_rank() OVER (ORDER BY reading_date) AS k FROM h{h}),
             (SELECT count(DISTINCT reading_date) AS n FROM h{h}) WHERE k >= floor(n * 0.8e0) + 1""")
    return " UNION ALL ".join(parts)


for _h in (7, 14, 30, 45, 60):
    CTES[f"h{_h}"] = f"""
        SELECT * FROM (SELECT reading_date, water_level_mbgl AS now,
            lead(water_level_mbgl, {_h}) OVER (PARTITION BY well_id ORDER BY reading_date) AS a,
            lag(water_level_mbgl, 30) OVER (PARTITION BY well_id ORDER BY reading_date) AS g
            FROM readings WHERE data_quality_flag <> 'suspect') WHERE a IS NOT NULL AND g IS NOT NULL"""

_FEATURE_DOUBLES = [
    "water_level_mbgl", "rainfall_mm", "tds_mg_per_l", "level_lag_1", "level_lag_7", "level_lag_14", "level_lag_30",
    "level_roll_mean_7", "level_roll_std_7", "level_roll_mean_30", "level_roll_std_30", "rain_sum_7", "rain_sum_14",
    "rain_sum_30", "season_sin", "season_cos", "level_now", "target",
]
_AREAS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
_FEATURES = [c for c in _FEATURE_DOUBLES if c not in ("water_level_mbgl", "target")] + ["coastal_flag"]


def _per_area(sql: str, joiner: str = ", ") -> str:
    return joiner.join(sql.format(area=a, name="area_" + a.lower().replace(" ", "_")) for a in _AREAS)


def _domain() -> str:
    rules = {
        "readings": (
            "bad",
            {"well_id required": "well_id IS NULL", "reading_date required": "reading_date IS NULL",
             "pumping_event required": "pumping_event IS NULL", "data_quality_flag required": "data_quality_flag IS NULL",
             "data_quality_flag length": "length(data_quality_flag) > 20",
             "water_level_mbgl overflow": "abs(water_level_mbgl) >= 100000",
             "tds_mg_per_l overflow": "abs(tds_mg_per_l) >= 100000000"},
        ),
        "wells": (
            "wells",
            {"well_id required": "well_id IS NULL", "source_dh_no required": "source_dh_no IS NULL",
             "coastal_flag required": "coastal_flag IS NULL", "source_dh_no length": "length(source_dh_no) > 30",
             "location_name length": "length(location_name) > 120", "aquifer_name length": "length(aquifer_name) > 120",
             "management_area length": "length(management_area) > 120", "latitude overflow": "abs(latitude) >= 1000",
             "longitude overflow": "abs(longitude) >= 1000"},
        ),
        "rainfall": (
            "rainfall",
            {"station_id required": "station_id IS NULL", "management_area required": "management_area IS NULL",
             "obs_date required": "obs_date IS NULL", "data_quality_flag required": "data_quality_flag IS NULL",
             "station_id length": "length(station_id) > 20", "station_name length": "length(station_name) > 120",
             "management_area length": "length(management_area) > 120",
             "data_quality_flag length": "length(data_quality_flag) > 20",
             "rainfall_mm overflow": "abs(rainfall_mm) >= 100000"},
        ),
    }
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{rule}' AS rule, count(*) FILTER ({test}) AS violations FROM {source}"
        for name, (source, tests) in rules.items() for rule, test in tests.items()
    )


CTES["bad"] = """
        SELECT well_id, CASE WHEN water_level_mbgl > 2 THEN reading_date END AS reading_date,
               CASE WHEN pumping_event = 1 THEN water_level_mbgl * 10000 ELSE water_level_mbgl END AS water_level_mbgl,
               tds_mg_per_l, pumping_event,
               CASE WHEN data_quality_flag = 'suspect' THEN repeat(data_quality_flag, 3) ELSE data_quality_flag END AS data_quality_flag
        FROM readings"""

# The stored anomaly events; the plain name belongs to the given event table.
_SOURCE = {"events": "anomalies"}

_UNIQUES = [
    ("wells", "well_id"), ("wells", "source_dh_no"), ("readings", "well_id,reading_date"),
    ("rainfall", "station_id,obs_date"), ("surface", "site_id,reading_datetime,metric_name"), ("events", "event_id"),
    ("licences", "licence_id"), ("extraction", "well_id,reading_month"), ("snapshots", "risk_snapshot_date,well_id"),
]


def _uniques() -> str:
    parts = []
    for name, keys in _UNIQUES:
        source = (
            "(SELECT * FROM extraction UNION ALL SELECT * FROM extraction WHERE extraction_ml > 200)"
            if name == "extraction" else _SOURCE.get(name, name)
        )
        parts.append(
            f"SELECT '{name}' AS table_name, '{keys}' AS rule, count(*) AS violations "
            f"FROM (SELECT {keys} FROM {source} GROUP BY {keys} HAVING count(*) > 1)"
        )
    return " UNION ALL ".join(parts)


def _orphans() -> str:
    parents = {"wells": "(SELECT * FROM wells WHERE coastal_flag = 1)", "licences": "licences"}
    refs = [
        ("readings", "well_id", "wells"), ("events", "well_id", "wells"), ("extraction", "well_id", "wells"),
        ("snapshots", "well_id", "wells"), ("snapshots", "licence_id", "licences"),
    ]
    return " UNION ALL ".join(
        f"SELECT '{child}' AS table_name, '{key}->{parent}' AS rule, count(DISTINCT {key}) AS violations FROM {_SOURCE.get(child, child)} "
        f"WHERE {key} IS NOT NULL AND {key} NOT IN (SELECT {key} FROM {parents[parent]})"
        for child, key, parent in refs
    )


CTES["surface"] = """
        SELECT CAST(user_id AS VARCHAR) AS site_id, ts AS reading_datetime, event_type AS metric_name,
               max(value) AS metric_value FROM events GROUP BY 1, 2, 3"""

ORACLES: dict[str, str] = {
    # sources and sinks
    "read_tables": " UNION ALL ".join(_all_rows(n) for n in ("wells", "readings", "rainfall", "licences", "extraction")),
    "read_optional": "SELECT well_id, CAST(0 AS BIGINT) AS predictions FROM wells",
    "normalise_wells": """
        SELECT source_dh_no, location_name, latitude, longitude,
               aquifer_name || CASE WHEN coastal_flag = 1 THEN ' CoastAL sand' ELSE '' END AS aquifer_name,
               management_area, coastal_flag FROM wells""",
    "normalise_readings": """
        SELECT CAST(l_suppkey AS VARCHAR) AS source_dh_no, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS reading_date,
               l_quantity * 8 - 20 AS water_level_mbgl, CASE WHEN l_linenumber <> 6 THEN l_quantity + 100 END AS tds_mg_per_l,
               CAST(CASE WHEN l_linenumber < 4 THEN l_linenumber % 2 ELSE 0 END AS BIGINT) AS pumping_event,
               CASE WHEN l_quantity * 8 - 20 < 0 OR l_quantity * 8 - 20 > 300 THEN 'suspect' ELSE 'measured' END AS data_quality_flag
        FROM lineitem WHERE l_linenumber <> 7""",
    "normalise_rainfall": """
        SELECT o_orderstatus AS station_id, 'Station ' || o_orderstatus AS station_name,
               'Area ' || o_orderstatus AS management_area, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS obs_date,
               mm AS rainfall_mm, CASE WHEN mm < 0 THEN 'suspect' ELSE 'measured' END AS data_quality_flag
        FROM (SELECT *, CASE WHEN o_orderpriority <> '5-LOW' THEN floor(o_totalprice / 10000) - 3 END AS mm FROM orders)
        WHERE o_orderpriority <> '1-URGENT'""",
    "normalise_surface": f"""
        SELECT CAST(user_id AS VARCHAR) AS site_id, 'Site ' || CAST(user_id AS VARCHAR) AS site_name,
               {ts("ts")} AS reading_datetime, event_type AS metric_name,
               CASE WHEN event_type <> 'error' THEN value END AS metric_value, 'measured' AS data_quality_flag
        FROM events""",
    "flag_quality": """
        SELECT CASE WHEN x < 0 OR x > 300 THEN 'suspect' ELSE 'measured' END AS data_quality_flag, count(*) AS readings
        FROM (SELECT water_level_mbgl * 8 - 20 AS x FROM readings) GROUP BY 1""",
    "collect_all": """
        SELECT station_id, station_name, management_area, CAST(obs_date AS VARCHAR) AS obs_date, rainfall_mm,
               CASE WHEN rainfall_mm < 0 THEN 'suspect' ELSE 'measured' END AS data_quality_flag FROM rainfall""",
    "history_window": """
        SELECT well_id, CAST(reading_date AS VARCHAR) AS reading_date, water_level_mbgl
        FROM readings, as_of WHERE reading_date BETWEEN d - 365 AND d""",
    "upsert": """
        SELECT well_id, CAST(reading_date AS VARCHAR) AS reading_date, water_level_mbgl,
               CASE WHEN reading_date < DATE '2000-07-01' THEN tds_mg_per_l
                    WHEN pumping_event = 1 THEN CAST(tds_mg_per_l + 1 AS DECIMAL(10,2))::DOUBLE END AS tds_mg_per_l,
               pumping_event, data_quality_flag FROM readings""",
    "assign_surrogate_keys": """
        SELECT count(*) AS bores, count(*) AS ids, coalesce(max(well_id) FILTER (coastal_flag = 1), 0)
               + count(*) FILTER (coastal_flag = 0) AS highest_id, count(*) FILTER (coastal_flag = 1) AS kept_ids FROM wells""",
    "resolve_keys": """
        SELECT well_id, CAST(reading_date AS VARCHAR) AS reading_date, water_level_mbgl
        FROM readings WHERE well_id IN (SELECT well_id FROM wells)""",
    "unresolved_keys": """
        SELECT source_dh_no, count(*) AS "rows" FROM readings JOIN wells USING (well_id) WHERE coastal_flag = 0 GROUP BY 1""",
    "insert_new_events": """
        SELECT * REPLACE (CAST(event_date AS VARCHAR) AS event_date,
                          CASE severity WHEN 'CRITICAL' THEN 'INFO' ELSE severity END AS severity),
               CAST(0 AS BIGINT) AS alert_sent FROM detected""",
    "reload_all": " UNION ALL ".join(map(_all_rows, ("wells", "licences", "readings", "rainfall", "anomalies", "extraction", "snapshots")))
    + " UNION ALL SELECT 'broken references', NULL, NULL, 0e0, NULL, NULL",
    "audit_append": "SELECT 'readings' AS pipeline_name, 'run-1' AS run_id, 'Failed' AS status FROM (SELECT count(*) FROM lineitem)",
    "zero_row_load_check": """
        SELECT 'rainfall' AS source, count(*) AS "rows", 'Succeeded' AS status FROM rainfall
        UNION ALL SELECT 'surface', count(*) FILTER (rainfall_mm < 0), 'Empty' FROM rainfall
        UNION ALL SELECT 'readings', CAST(0 AS BIGINT), 'Failed'""",
    "write_outputs": f"{_SNAPSHOT_OUT} snapshot",
    # curated inputs
    "trusted_readings": "SELECT * REPLACE (CAST(reading_date AS VARCHAR) AS reading_date) FROM trusted",
    "area_rainfall": f"SELECT management_area, CAST(obs_date AS VARCHAR) AS obs_date, {r('rainfall_mm', 6)} AS rainfall_mm FROM area_rain",
    "area_rainfall_unfiltered": f"SELECT management_area, CAST(obs_date AS VARCHAR) AS obs_date, {r('rainfall_mm', 6)} AS rainfall_mm FROM area_rain_all",
    "regional_rainfall": f"SELECT CAST(obs_date AS VARCHAR) AS obs_date, {r('rainfall_mm', 6)} AS rainfall_mm FROM region_rain",
    "readings_with_well": """
        SELECT a.well_id, CAST(reading_date AS VARCHAR) AS reading_date, water_level_mbgl,
               CAST(coastal_flag AS DOUBLE) AS coastal_flag, management_area
        FROM readings a LEFT JOIN (SELECT * FROM wells WHERE coastal_flag = 1) w ON a.well_id = w.well_id""",
    # detectors
    "rapid_level_change": f"{_EVENT_OUT} rapid",
    "low_recharge_response": f"{_EVENT_OUT} recharge",
    "low_recharge_regional": f"{_EVENT_OUT} recharge_regional",
    "salinity_intrusion": f"{_EVENT_OUT} salinity",
    "run_all_detectors": f"{_EVENT_OUT} detected",
    "detect_and_store": """
        SELECT count(*) AS detected, count(*) AS first_inserted, CAST(0 AS BIGINT) AS second_inserted,
               count(*) AS stored, count(*) AS ids FROM detected""",
    # risk
    "licence_compliance": "SELECT * FROM compliance",
    "trend_projection": "SELECT * FROM projection",
    "data_completeness_30d": "SELECT * FROM completeness",
    "most_severe_recent_event": "SELECT * FROM worst_event",
    "risk_classify": f"""
        SELECT well_id, CAST(reading_date AS VARCHAR) AS reading_date, risk_score, risk_status, risk_drivers, recommended_action
        FROM ({_classified('''
            SELECT well_id, reading_date,
                   CASE day % 4 WHEN 0 THEN 'CRITICAL' WHEN 1 THEN 'WARNING' END AS latest_anomaly_severity,
                   CASE day % 8 WHEN 0 THEN 'SalinityIntrusionRisk' WHEN 1 THEN 'RapidLevelChange'
                     WHEN 4 THEN 'LowRechargeResponse' WHEN 5 THEN 'Other' END AS latest_anomaly_type,
                   water_level_mbgl + 62 AS projected_allocation_pct,
                   CAST(floor(tds_mg_per_l) AS BIGINT) % 50 / 100e0 - 0.1e0 AS forecast_change_mbgl,
                   CASE WHEN day % 5 > 0 THEN 90e0 + day % 11 END AS data_completeness_30d_pct
            FROM (SELECT *, well_id + day(reading_date) AS day FROM readings)''')})""",
    "risk_snapshot": f"{_SNAPSHOT_OUT} snapshot",
    # views
    "well_status": """
        SELECT well_id, location_name, latitude, longitude, aquifer_name, management_area, coastal_flag,
               CAST(last_reading_date AS VARCHAR) AS last_reading_date, last_water_level_mbgl, last_tds_mg_per_l, status
        FROM status""",
    "rainfall_recharge": f"""
        SELECT * FROM (WITH daily AS (
            SELECT reading_date AS day, management_area, avg(water_level_mbgl) AS level
            FROM (SELECT well_id, management_area FROM wells) JOIN readings USING (well_id)
            GROUP BY ALL),
        wet AS (SELECT DISTINCT obs_date AS day, management_area, rainfall_mm FROM rainfall)
        SELECT management_area, CAST(day AS VARCHAR) AS obs_date, {r("level", 6)} AS avg_water_level_mbgl, rainfall_mm
        FROM daily LEFT JOIN wet USING (day, management_area))""",
    "latest_risk_snapshot": f"""
        {_SNAPSHOT_OUT} (SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY well_id
            ORDER BY risk_snapshot_date DESC) AS k FROM snapshots) WHERE k = 1)""",
    "licence_compliance_view": """
        SELECT * FROM (WITH pumped AS (
            SELECT management_area, reading_month, sum(extraction_ml) AS ml
            FROM extraction JOIN (SELECT well_id, management_area FROM wells) USING (well_id)
            WHERE data_quality_flag <> 'suspect' GROUP BY ALL),
        spent AS (
            SELECT licence_id, sum(ml) AS ml FROM licences JOIN pumped USING (management_area)
            WHERE reading_month >= licence_start_date AND reading_month <= licence_end_date GROUP BY ALL),
        used AS (
            SELECT licences.*, coalesce(spent.ml, 0) AS extraction_to_date_ml
            FROM licences LEFT JOIN spent USING (licence_id))
        SELECT licence_id, management_area, annual_allocation_ml, compliance_limit_pct, extraction_to_date_ml,
               CAST(licence_start_date AS VARCHAR) AS licence_start_date, CAST(licence_end_date AS VARCHAR) AS licence_end_date,
               CASE WHEN annual_allocation_ml <> 0
                 THEN CAST(round(CAST(100 * extraction_to_date_ml / annual_allocation_ml AS DECIMAL(38,9)), 2) AS DOUBLE) END
                 AS allocation_used_pct
        FROM used)""",
    "unsent_critical_events": """
        SELECT event_id, well_id, location_name, management_area, CAST(event_date AS VARCHAR) AS event_date,
               anomaly_type, severity, actual_value, detail FROM alerts""",
    "mark_alerted": """
        SELECT event_id, severity, CASE WHEN severity = 'CRITICAL' THEN 1 ELSE alert_sent END AS alert_sent FROM anomalies""",
    "alert_messages": """
        SELECT event_id, 'CRITICAL groundwater alert: ' || anomaly_type || ' at ' || location_name AS subject,
               '<p><b>Management area:</b> ' || management_area || '</p><p><b>Event date:</b> '
                 || CAST(event_date AS VARCHAR) || '</p><p><b>Detail:</b> ' || detail || '</p>' AS body,
               'CRITICAL: ' || anomaly_type || ' detected at ' || location_name || ' (' || management_area || '). '
                 || detail AS chat_text FROM alerts""",
    # report measures
    "risk_kpis": _kpis(),
    "kpis_by_area": _kpis("management_area"),
    "selected_action": """
        SELECT management_area, risk_score, CASE WHEN count(DISTINCT recommended_action) = 1 THEN max(recommended_action)
               ELSE 'Select one bore to review the recommended action.' END AS selected_action
        FROM snapshot GROUP BY 1, 2""",
    "risk_by_location": "SELECT location_name, CAST(sum(risk_score) AS BIGINT) AS risk_score FROM snapshot GROUP BY 1",
    "allocation_by_licence": f"""
        SELECT licence_id, {r("avg(allocation_used_pct)", 6)} AS avg_allocation_used_pct,
               {r("avg(projected_allocation_pct)", 6)} AS avg_projected_allocation_pct FROM snapshot GROUP BY 1""",
    "level_vs_forecast": f"""
        SELECT location_name, {r("avg(latest_level_mbgl)", 6)} AS avg_latest_level_mbgl,
               {r("avg(forecast_60d_mbgl)", 6)} AS avg_forecast_60d_mbgl FROM snapshot GROUP BY 1""",
    "risk_table": """
        SELECT location_name, management_area, risk_status, risk_score, latest_level_mbgl, forecast_60d_mbgl,
               forecast_change_mbgl, projected_allocation_pct, data_completeness_30d_pct, recommended_action FROM snapshot""",
    "licences_in_filter": """
        SELECT * REPLACE (CAST(licence_start_date AS VARCHAR) AS licence_start_date,
                          CAST(licence_end_date AS VARCHAR) AS licence_end_date)
        FROM licences WHERE licence_id IN (SELECT licence_id FROM snapshot WHERE projected_allocation_pct > 100)""",
    "status_colour": """
        SELECT management_area, risk_score,
               CASE s WHEN 'Critical' THEN '#D64550' WHEN 'Watch' THEN '#B98600' WHEN 'Normal' THEN '#107C10' ELSE '#605E5C' END AS status_colour,
               CASE s WHEN 'Critical' THEN '#D64550' WHEN 'Watch' THEN '#E8A33D' WHEN 'Normal' THEN '#107C10' ELSE '#605E5C' END AS bar_colour
        FROM (SELECT management_area, risk_score, CASE WHEN count(DISTINCT risk_status) = 1 THEN max(risk_status) END AS s
              FROM snapshot GROUP BY 1, 2)""",
    "date_dimension": """
        SELECT CAST(d AS VARCHAR) AS date, year(d) AS year, month(d) AS month, day(d) AS day, strftime(d, '%Y-%m') AS year_month,
               (SELECT count(*) FROM readings WHERE reading_date = d) AS readings,
               (SELECT count(*) FROM rainfall WHERE obs_date = d) AS rain_rows,
               (SELECT count(*) FROM anomalies WHERE event_date = d) AS events
        FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d
              FROM (SELECT least((SELECT min(reading_date) FROM readings), (SELECT min(obs_date) FROM rainfall)) AS lo,
                           greatest((SELECT max(reading_date) FROM readings), (SELECT max(obs_date) FROM rainfall)) AS hi))""",
    "level_moving_avg": f"""
        SELECT management_area, CAST(obs_date AS VARCHAR) AS obs_date, {r("level_mbgl", 6)} AS level_mbgl,
               {r("avg(level_mbgl) OVER w", 6)} AS level_moving_avg, {r("rainfall_mm", 6)} AS rainfall_mm,
               {r("sum(rainfall_mm) OVER w", 6)} AS rainfall_cumulative_mm
        FROM (SELECT l.*, rainfall_mm FROM (SELECT management_area, reading_date AS obs_date, avg(water_level_mbgl) AS level_mbgl
                FROM readings JOIN wells USING (well_id) GROUP BY 1, 2) l
              LEFT JOIN area_rain_all USING (management_area, obs_date))
        WINDOW w AS (PARTITION BY management_area ORDER BY obs_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
    "status_by_area": f"""
        SELECT management_area, count(*) AS bores, count(*) FILTER (status = 'Critical') AS critical,
               count(*) FILTER (status = 'Watch') AS watch, count(*) FILTER (status = 'Normal') AS normal,
               {r("avg(last_water_level_mbgl)", 6)} AS avg_level_mbgl FROM status GROUP BY 1""",
    "licence_year": """
        SELECT licence_id, CAST(year(licence_start_date) AS VARCHAR) || '-' || strftime(licence_end_date, '%y') AS licence_year
        FROM licences""",
    # health
    "staleness": """
        SELECT CAST(max(reading_date) AS VARCHAR) AS latest_reading, CAST(2 AS BIGINT) AS days_behind,
               count(DISTINCT well_id) AS bores_reporting FROM readings""",
    "detector_heartbeat": f"""
        SELECT {ts("max(detected_at)")} AS last_detector_run, count(*) AS events_last_24h
        FROM anomalies, as_of WHERE detected_at >= t - INTERVAL 1 DAY""",
    "rows_loaded_by_day": """
        SELECT CAST(reading_date AS VARCHAR) AS reading_date, count(*) AS rows_loaded
        FROM readings, as_of WHERE reading_date >= d - 7 GROUP BY 1""",
    "duplicate_readings": """
        SELECT l_suppkey AS well_id, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS reading_date, count(*) AS duplicate_rows
        FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
    "completeness_by_bore": f"""
        SELECT w.well_id, count(reading_date) AS readings, {r("100e0 * count(reading_date) / 30", 6)} AS pct_complete
        FROM as_of, wells w LEFT JOIN readings x ON x.well_id = w.well_id
          AND x.reading_date >= (SELECT d FROM as_of) - 30 GROUP BY 1""",
    "day_on_day_movement": """
        SELECT well_id, CAST(reading_date AS VARCHAR) AS reading_date, water_level_mbgl, round(water_level_mbgl
               - lag(water_level_mbgl) OVER (PARTITION BY well_id ORDER BY reading_date), 6) AS delta_m
        FROM readings, as_of WHERE reading_date >= d - 30""",
    "critical_last_7d": """
        SELECT count(*) AS critical_events FROM anomalies, as_of
        WHERE severity = 'CRITICAL' AND detected_at >= t - INTERVAL 7 DAY""",
    # constraints
    "unique_violations": _uniques(),
    "fk_violations": _orphans(),
    "check_violations": """
        SELECT 'licences' AS table_name, 'licence_dates' AS rule, count(*) FILTER (licence_end_date < licence_start_date) AS violations FROM licences
        UNION ALL SELECT 'licences', 'licence_allocation', count(*) FILTER (annual_allocation_ml <= 0) FROM licences
        UNION ALL SELECT 'extraction', 'extraction_nonnegative', count(*) FILTER (extraction_ml < 50) FROM extraction
        UNION ALL SELECT 'extraction', 'extraction_coverage', count(*) FILTER (coverage_days < 4 OR coverage_days > 34) FROM extraction
        UNION ALL SELECT 'snapshots', 'risk_score', count(*) FILTER (risk_score < 0 OR risk_score > 100) FROM snapshots
        UNION ALL SELECT 'snapshots', 'risk_status', count(*) FILTER (risk_status NOT IN ('Normal', 'Watch', 'Critical')) FROM snapshots""",
    "domain_violations": _domain(),
    "station_area_mapping": """
        SELECT count(*) AS pairs, count(DISTINCT station_id) AS stations, count(DISTINCT management_area) AS areas
        FROM (SELECT DISTINCT station_id, management_area FROM rainfall)""",
    # features and models
    "forecast_features": f"""
        SELECT well_id, CAST(reading_date AS VARCHAR) AS reading_date, coastal_flag,
               CAST(target_date AS VARCHAR) AS target_date, {", ".join(f"{r(c, 6)} AS {c}" for c in _FEATURE_DOUBLES)},
               {_per_area("CAST(management_area = '{area}' AS BIGINT) AS {name}")} FROM features""",
    "feature_columns": " UNION ALL ".join(
        [f"SELECT '{c}' AS feature, count({c}) AS present FROM features" for c in _FEATURES]
        + [f"SELECT 'area_{a}' AS feature, count(management_area) AS present FROM features" for a in _AREAS]
    ),
    "purged_time_split": """
        SELECT part, count(*) AS "rows", CAST(min(reading_date) AS VARCHAR) AS first_reading,
               CAST(max(target_date) AS VARCHAR) AS last_target, CAST(max(cutoff) AS VARCHAR) AS cutoff
        FROM (SELECT *, CASE WHEN target_date < cutoff THEN 'train' WHEN reading_date >= cutoff THEN 'test' END AS part
              FROM features, cutoff) WHERE part IS NOT NULL GROUP BY 1""",
    "forecast_metrics": f"""
        SELECT n AS n_test, {r("m", 4)} AS model_mae_m, {r("s", 4)} AS model_rmse_m, {r("bm", 4)} AS baseline_mae_m,
               {r("bs", 4)} AS baseline_rmse_m, {r("100 * (bm - m) / bm", 1)} AS mae_improvement_pct
        FROM (SELECT count(*) AS n, avg(abs(actual - predicted)) AS m, sqrt(avg((actual - predicted) ** 2)) AS s,
                     avg(abs(actual - level_now)) AS bm, sqrt(avg((actual - level_now) ** 2)) AS bs FROM forecasts)""",
    "persistence_baseline": _horizons(),
    "anomaly_features": f"""
        SELECT well_id, CAST(reading_date AS VARCHAR) AS reading_date,
               {", ".join(f"{r(c, 6)} AS {c}" for c in ("level_z", "tds_z", "level_diff", "tds_diff", "rain_sum_7"))}
        FROM anomaly_rows""",
    "isolation_forest_score": "SELECT * REPLACE (CAST(reading_date AS VARCHAR) AS reading_date, CAST(is_anomaly AS BIGINT) AS is_anomaly) FROM scores",
    "top_anomalies": """
        SELECT well_id, CAST(reading_date AS VARCHAR) AS reading_date, anomaly_score FROM (
          SELECT * FROM scores WHERE is_anomaly ORDER BY anomaly_score DESC, well_id, reading_date LIMIT 10)""",
    "rediscovered_bores": "SELECT DISTINCT well_id FROM scores WHERE is_anomaly AND well_id IN (SELECT well_id FROM wells WHERE coastal_flag = 1)",
    # fleet
    "bore_status_now": "SELECT * FROM status_now",
    "latest_reading": "SELECT * REPLACE (CAST(reading_date AS VARCHAR) AS reading_date) FROM latest",
    "last_issued_forecast": "SELECT * REPLACE (CAST(target_date AS VARCHAR) AS target_date) FROM last_forecast",
    "anomaly_trend": f"""
        SELECT well_id, CAST(reading_date AS VARCHAR) AS reading_date, {r("anomaly_score", 4)} AS anomaly_score,
               CAST(is_anomaly AS BIGINT) AS is_anomaly FROM scores, as_of WHERE reading_date >= d - 30""",
    "active_alerts": """
        SELECT well_id, CAST(event_date AS VARCHAR) AS event_date, anomaly_type, severity, detail
        FROM anomalies, as_of WHERE event_date >= d - 3""",
    "fleet_snapshot": "SELECT * REPLACE (CAST(reading_date AS VARCHAR) AS reading_date) FROM fleet",
    "bore_detail": f"""
        SELECT well_id, status, location_name, f.level_mbgl AS latest_level,
               (SELECT count(*) FROM last_forecast x WHERE x.well_id = f.well_id) AS forecast_points,
               (SELECT count(*) FROM scores x WHERE x.well_id = f.well_id AND x.reading_date >= (SELECT d FROM as_of) - 30) AS trend_points,
               (SELECT count(*) FROM anomalies x WHERE x.well_id = f.well_id AND x.event_date >= (SELECT d FROM as_of) - 3) AS alerts,
               row_number() OVER (PARTITION BY well_id ORDER BY h.reading_date) - 1 AS position,
               CAST(h.reading_date AS VARCHAR) AS reading_date, {r("h.water_level_mbgl", 3)} AS level_mbgl,
               {r("h.tds_mg_per_l", 1)} AS tds_mg_per_l
        FROM fleet f JOIN (SELECT *, row_number() OVER (PARTITION BY well_id ORDER BY reading_date DESC) AS k FROM readings) h
          USING (well_id) WHERE k <= 90""",
    "fleet_summary": f"""
        SELECT CAST((SELECT d FROM as_of) AS VARCHAR) AS as_of, count(*) AS total_bores,
               count(*) FILTER (status = 'Critical') AS critical, count(*) FILTER (status = 'Watch') AS watch,
               count(*) FILTER (status = 'Normal') AS normal, {r("avg(level_mbgl)", 2)} AS avg_level_mbgl FROM fleet""",
    # streaming
    "tag_last_value": f"SELECT well_id, location, level, tds, pump, valve, CAST(NULL AS VARCHAR) AS quality, {ts('last_update')} AS last_update FROM tag_state",
    "tag_browse_parse": "SELECT event_id, well_id, location, field, value FROM tags",
    "tags_with_fallback": f"""
        SELECT w.well_id, location_name AS location,
               {r("CASE WHEN level IS NOT NULL THEN level ELSE level_mbgl END", 3)} AS tag_level,
               {r("CASE WHEN level IS NOT NULL THEN coalesce(tds, 0) ELSE tds_mg_per_l END", 1)} AS tag_tds,
               CAST(CASE WHEN level IS NOT NULL THEN trunc(coalesce(pump, 0)) ELSE 0 END AS BIGINT) AS tag_pump_rpm,
               CAST(CASE WHEN level IS NOT NULL THEN trunc(coalesce(valve, 0)) ELSE 0 END AS BIGINT) AS tag_valve_pct,
               CASE WHEN level IS NOT NULL THEN 'Good' ELSE 'Uncertain' END AS quality, 'OPC-UA' AS source
        FROM wells w LEFT JOIN tag_state s USING (well_id)
        LEFT JOIN latest USING (well_id)""",
    "tag_health": f"SELECT CAST(count(*) > 0 AS BIGINT) AS connected, {ts('max(last_update)')} AS last_update, count(level) AS tag_count FROM tag_state",
    "alert_stream": """
        SELECT e.event_id, e.severity, CASE WHEN e.severity = 'CRITICAL' THEN 1 ELSE e.alert_sent END AS alert_sent,
               'CRITICAL groundwater alert: ' || a.anomaly_type || ' at ' || a.location_name AS subject,
               '<p><b>Management area:</b> ' || a.management_area || '</p><p><b>Event date:</b> '
                 || CAST(a.event_date AS VARCHAR) || '</p><p><b>Detail:</b> ' || a.detail || '</p>' AS body,
               'CRITICAL: ' || a.anomaly_type || ' detected at ' || a.location_name || ' (' || a.management_area || '). '
                 || a.detail AS chat_text
        FROM anomalies e LEFT JOIN alerts a ON a.event_id = e.event_id""",
    "daily_detection_stream": f"{_EVENT_OUT} detected",
    "ingest_stream": f"""
        SELECT site_id, site_id AS site_name, {ts("reading_datetime")} AS reading_datetime, metric_name,
               CAST(metric_value AS DECIMAL(12, 3))::DOUBLE AS metric_value, 'measured' AS data_quality_flag FROM surface""",
    "telemetry_window": f"""
        SELECT {ts("w")} AS window_start, {ts("w + INTERVAL 5 MINUTE")} AS window_end, well_id, field, count(*) AS n,
               {r("avg(value)", 6)} AS mean_value
        FROM (SELECT *, time_bucket(INTERVAL 5 MINUTE, ts) AS w FROM tags) GROUP BY w, well_id, field""",
}

#: Tables that cost too much to be computed at each mention.
_ONCE = {"anomaly_rows", "forest_rows", "forest_samples", "forest_splits", "forest_trees", "forest_raw"}
_WORD = re.compile(r"[a-z_0-9]+")


def _collect(sql: str, seen: set[str], order: list[str]) -> None:
    """Append the tables mentioned in ``sql`` after the ones they mention themselves."""
    for word in _WORD.findall(sql):
        if word in CTES and word not in seen:
            seen.add(word)
            _collect(CTES[word], seen, order)
            order.append(word)


def _complete(sql: str) -> str:
    order: list[str] = []
    _collect(sql, set(), order)
    tables = ",\n".join(f"{name} AS {'MATERIALIZED ' if name in _ONCE else ''}({CTES[name]})" for name in order)
    return f"WITH RECURSIVE {tables}\n{sql}" if order else sql


def oracle_sql() -> dict[str, str]:
    return {name: _complete(sql) for name, sql in ORACLES.items()}
