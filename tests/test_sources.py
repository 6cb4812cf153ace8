from __future__ import annotations

import datetime as dt
import json
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from aquifold import schemas
from aquifold.operators import health
from aquifold.plans import ingest
from aquifold.sources import landed, store
from aquifold.sources.store import DuplicateKeyError, KeyedTable, merge


def json_lines(path, records):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(json.dumps(r) for r in records))
    return str(path)


# landed files -----------------------------------------------------------------


def test_wells_from_json(spark, tmp_path):
    path = json_lines(tmp_path / "wells.json", [
        {"DHNO": 6621, "NAME": "One", "LAT": -34.6, "LON": 138.5, "AQUIFER": "Coastal sand"},
        {"DHNO": 6622, "NAME": "Two", "LAT": "n/a", "LON": 138.6},
        {"DHNO": 6621, "NAME": "Zwei", "LAT": -34.7, "LON": 138.5, "AQUIFER": "Sand"},
    ])
    raw = landed.read_json_records(spark, path, landed.WELL_FIELDS)
    inland = {r.source_dh_no: r for r in landed.normalise_wells(raw, "Plains").collect()}
    assert inland.keys() == {"6621", "6622"}
    assert inland["6621"].location_name == "One"
    assert (inland["6621"].coastal_flag, inland["6622"].coastal_flag) == (1, 0)
    assert inland["6622"].latitude is None and inland["6622"].aquifer_name is None
    named = landed.normalise_wells(raw, "mclaren vale")
    assert named.columns == landed.WELL_COLUMNS
    assert named.filter("coastal_flag = 0").isEmpty()


def test_readings_from_json_array(spark, tmp_path):
    path = tmp_path / "readings.json"
    path.write_text(json.dumps([
        {"OBS_DATE": "2024-01-02", "DTW": "5.5", "TDS": "510", "PUMPING": "1"},
        {"obs_date": "2024-01-03T06:00:00", "water_level": -0.1, "tds": "x"},
        {"OBS_DATE": "soon", "DTW": "5", "TDS": "5"},
        {"OBS_DATE": "2024-01-04", "DTW": "300.01", "TDS": "NaN"},
        {"OBS_DATE": "2024-01-05", "DTW": None, "TDS": " 7 "},
    ]))
    raw = landed.read_json_records(spark, str(path), landed.READING_FIELDS, array_files=True)
    rows = landed.normalise_readings(raw, "6621").orderBy("reading_date").collect()
    assert [(r.source_dh_no, r.reading_date.day, r.water_level_mbgl, r.tds_mg_per_l, r.pumping_event, r.data_quality_flag)
            for r in rows] == [
        ("6621", 2, 5.5, 510.0, 1, "measured"), ("6621", 3, -0.1, None, 0, "suspect"),
        ("6621", 4, 300.01, None, 0, "suspect"), ("6621", 5, None, 7.0, 0, "measured"),
    ]


def test_readings_in_lower_case_fields_without_pumping(spark):
    raw = spark.createDataFrame([("2024-01-02", "300", "1")], "obs_date string, water_level string, tds string")
    row = landed.normalise_readings(raw, F.lit("A")).first()
    assert (row.water_level_mbgl, row.pumping_event, row.data_quality_flag) == (300.0, 0, "measured")


def test_rainfall_headers_in_any_case(spark, tmp_path):
    frames = []
    for station, header in (("1", "Date,RAIN"), ("2", "date2, Daily_Rain "), ("3", "when,Rainfall")):
        path = tmp_path / f"{station}.csv"
        path.write_text(f"{header}\n2024-01-01,4.5\n20240102,-1\nbad,3\n2024-01-03,trace\n")
        raw = spark.read.option("header", True).csv(str(path))
        frames.append(landed.normalise_rainfall(raw, station, f"Station {station}", "Plains"))
    rows = landed.collect_all(spark, frames, schemas.RAINFALL).orderBy("station_id", "obs_date").collect()
    assert [(r.station_id, r.obs_date.day, r.rainfall_mm, r.data_quality_flag) for r in rows] == [
        (s, *rest) for s in "123"
        for rest in ((1, 4.5, "measured"), (2, -1.0, "suspect"), (3, None, "measured"))
    ]
    with pytest.raises(ValueError, match="rain"):
        landed.normalise_rainfall(spark.createDataFrame([("a", "b")], "date string, mm string"), "1", "x", "y")


def test_surface_falls_back_to_column_positions(spark):
    raw = spark.createDataFrame([("2024-01-01 10:00:00", "1.25"), ("?", "2"), ("2024-01-02", "-")], "when string, metres string")
    rows = landed.normalise_surface(raw, "A1", "River", "level_m").orderBy("reading_datetime").collect()
    assert [(str(r.reading_datetime), r.metric_value, r.data_quality_flag) for r in rows] == [
        ("2024-01-01 10:00:00", 1.25, "measured"), ("2024-01-02 00:00:00", None, "measured")
    ]


def test_no_frames_give_a_typed_empty_table(spark):
    assert landed.collect_all(spark, [], schemas.RAINFALL).schema == schemas.RAINFALL


def test_missing_optional_file_keeps_the_columns(spark, tmp_path):
    frame = landed.read_optional(spark, str(tmp_path / "never.csv"), schemas.FORECASTS)
    assert frame.isEmpty() and frame.columns == schemas.names(schemas.FORECASTS)


def test_history_window_is_inclusive(spark):
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=i),) for i in range(800)]
    df = spark.createDataFrame(rows, "d date")
    kept = landed.history_window(df, "d", "2025-06-30", years=1).agg(F.min("d"), F.max("d"), F.count("d")).first()
    assert tuple(kept) == (dt.date(2024, 6, 30), dt.date(2025, 6, 30), 366)


# store --------------------------------------------------------------------------


def readings(spark, *rows):
    return spark.createDataFrame(
        [(w, dt.date.fromisoformat(d), level, 1.0, 0, "measured") for w, d, level in rows],
        "well_id int, reading_date date, water_level_mbgl double, tds_mg_per_l double, pumping_event int, "
        "data_quality_flag string",
    )


def content(table):
    return sorted((r.well_id, str(r.reading_date), r.water_level_mbgl and float(r.water_level_mbgl)) for r in table.read().collect())


def test_upsert_updates_inserts_and_repeats(spark, tmp_path):
    table = KeyedTable.named(spark, str(tmp_path), "readings")
    assert table.read().isEmpty()
    assert table.upsert(readings(spark, (1, "2024-01-01", 5.0), (1, "2024-02-01", 6.0), (2, "2024-01-01", 7.0))) == 3
    newer = readings(spark, (1, "2024-01-01", None), (3, "2024-03-01", 8.0))
    for _ in range(2):
        assert table.upsert(newer) == 2
        assert content(table) == [
            (1, "2024-01-01", None), (1, "2024-02-01", 6.0), (2, "2024-01-01", 7.0), (3, "2024-03-01", 8.0)
        ]
    assert table.upsert(newer.limit(0)) == 0
    assert table.read({"2024-03"}).count() == 1
    assert table.read(since=dt.date(2024, 2, 15)).count() == 2


def test_duplicate_source_keys_are_refused(spark, tmp_path):
    table = KeyedTable.named(spark, str(tmp_path), "readings")
    twice = readings(spark, (1, "2024-01-01", 5.0), (1, "2024-01-01", 6.0))
    with pytest.raises(DuplicateKeyError):
        table.upsert(twice)
    assert table.read().isEmpty()
    table.upsert_latest(twice.withColumn("arrived_at", F.col("water_level_mbgl")), "arrived_at")
    assert content(table) == [(1, "2024-01-01", 6.0)]


def files_of(table):
    return sorted(Path(table.root).rglob("part-*.parquet"))


def test_repeated_loads_keep_the_number_of_files_and_untouched_months(spark, tmp_path):
    table = KeyedTable.named(spark, str(tmp_path), "readings")
    table.upsert(readings(spark, (1, "2024-01-01", 5.0), (1, "2024-02-01", 6.0)))
    february = [f for f in files_of(table) if "2024-02" in str(f)]
    for i in range(6):
        table.upsert(readings(spark, (2, "2024-01-01", float(i))))
        assert len(files_of(table)) == 2
    assert [f for f in files_of(table) if "2024-02" in str(f)] == february
    assert content(table) == [(1, "2024-01-01", 5.0), (1, "2024-02-01", 6.0), (2, "2024-01-01", 5.0)]


def test_merge_counts_copies_and_keeps_old_rows_on_request(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d"), (3, "d")], "k int, v string")
    rows = sorted(tuple(r) for r in merge(old, new, ["k"]).collect())
    assert rows == [(1, "a", 0, 0), (2, "c", 1, 0), (3, "d", 2, 1)]
    assert {r.k: r.v for r in merge(old, new, ["k"], keep_old=True).collect()} == {1: "a", 2: "b", 3: "d"}


def test_csv_columns_are_taken_by_name(spark, tmp_path):
    (tmp_path / "e.csv").write_text("well_id,note,anomaly_type,event_date\n7,x,Kind,2024-01-05\n8,y,Kind,never\n")
    rows = landed.read_table(spark, str(tmp_path / "e.csv"), "events").collect()
    assert [(r.event_id, r.well_id, str(r.event_date), r.anomaly_type) for r in rows] == [
        (None, 7, "2024-01-05", "Kind"), (None, 8, "None", "Kind")
    ]


def test_days_in_other_formats_and_numbers_with_suffixes(spark):
    given = ["15/01/2024", "15-01-2024", "2024/01/15", "15 Jan 2024", "20240115", "2024-01-15", "2024-01-15T10:00:00", "soon"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(given)], "i int, t string")
    got = [str(r.d) for r in rows.select("i", landed.to_day(F.col("t")).alias("d")).orderBy("i").collect()]
    assert got == ["2024-01-15"] * 7 + ["None"]
    assert tuple(landed.unreadable_days(rows, "t").first()) == (1, 8)
    numbers = spark.createDataFrame([("5d",), ("3f",), (" 1e3 ",), ("NaN",), ("-.5",)], "t string")
    assert [r[0] for r in numbers.select(landed.to_number(F.col("t"))).collect()] == [None, None, 1000.0, None, -0.5]
    raw = spark.createDataFrame([("2024-01-01", "1", "1e12")], "OBS_DATE string, DTW string, PUMPING string")
    assert landed.normalise_readings(raw, "DH1").first().pumping_event is None


def test_overwrite_and_clear(spark, tmp_path):
    table = KeyedTable.named(spark, str(tmp_path), "readings")
    table.upsert(readings(spark, (1, "2024-01-01", 5.0), (1, "2024-02-01", 6.0)))
    assert table.overwrite(readings(spark, (4, "2024-05-01", 1.0))) == 1
    assert content(table) == [(4, "2024-05-01", 1.0)]
    table.clear()
    assert table.read().isEmpty()
    table.upsert(readings(spark, (5, "2024-05-01", 2.0)))
    assert content(table) == [(5, "2024-05-01", 2.0)]


def test_surrogate_keys_are_stable_and_dense(spark):
    existing = spark.createDataFrame([(7, "D7"), (3, "D3")], "well_id int, source_dh_no string")
    wells = spark.createDataFrame([(f"D{i}", f"n{i}") for i in range(40)], "source_dh_no string, location_name string")
    first = {r.source_dh_no: r.well_id for r in store.assign_surrogate_keys(wells, existing).collect()}
    assert (first["D7"], first["D3"]) == (7, 3)
    assert sorted(v for k, v in first.items() if k not in ("D3", "D7")) == list(range(8, 46))
    again = store.assign_surrogate_keys(wells.repartition(7), existing)
    assert {r.source_dh_no: r.well_id for r in again.collect()} == first
    fresh = store.assign_surrogate_keys(wells, existing.limit(0))
    assert sorted(r.well_id for r in fresh.collect()) == list(range(1, 41))


def test_drillhole_in_two_areas_is_stored_once(spark, tmp_path):
    table = KeyedTable.named(spark, str(tmp_path), "wells")
    raw = spark.createDataFrame([("D1", "x"), ("D2", "y")], "DHNO string, NAME string")
    both = landed.collect_all(
        spark, [landed.normalise_wells(raw, "B"), landed.normalise_wells(raw.filter("DHNO = 'D1'"), "A")], schemas.WELLS
    )
    for _ in range(2):
        assert ingest.load_wells(table, both) == 2
    rows = {r.source_dh_no: (r.well_id, r.management_area) for r in table.read().collect()}
    assert rows["D1"][1] == "A" and {v[0] for v in rows.values()} == {1, 2}


def test_readings_of_unknown_drillholes_are_dropped_and_counted(spark):
    wells = spark.createDataFrame([(1, "D1")], "well_id int, source_dh_no string")
    rows = spark.createDataFrame([("D1", 1.0), ("D9", 2.0), ("D9", 3.0)], "source_dh_no string, water_level_mbgl double")
    assert store.resolve_keys(rows, wells).collect() == [(1, 1.0)]
    assert [tuple(r) for r in store.unresolved_count(rows, wells).collect()] == [("D9", 2)]


def test_events_are_inserted_once(spark, tmp_path):
    table = KeyedTable.named(spark, str(tmp_path), "events")
    events = spark.createDataFrame(
        [(1, dt.date(2024, 1, 1), "A", "WARNING", 1.0, float("nan"), "x"),
         (1, dt.date(2024, 1, 1), "A", "WARNING", 1.0, float("nan"), "x"),
         (2, dt.date(2024, 1, 1), "A", "CRITICAL", 1.0, 2.0, "y")],
        schemas.DETECTED_EVENTS,
    )
    assert store.insert_new_events(table, events) == 2
    assert store.insert_new_events(table, events) == 0
    more = events.withColumn("anomaly_type", F.lit("B")).withColumn("severity", F.lit("INFO"))
    assert store.insert_new_events(table, more) == 2
    rows = table.read().collect()
    assert sorted(r.event_id for r in rows) == [1, 2, 3, 4]
    assert next(r for r in rows if r.well_id == 1).actual_value is None
    assert {r.alert_sent for r in rows} == {0}


def test_reload_all_reports_broken_references(spark, tmp_path):
    tables = {n: KeyedTable.named(spark, str(tmp_path), n) for n in ("wells", "readings")}
    wells = spark.createDataFrame([(1, "D1", "n", 1.0, 1.0, "a", "b", 0)], schemas.names(schemas.WELLS))
    frames = {"wells": wells, "readings": readings(spark, (1, "2024-01-01", 5.0))}
    assert store.reload_all(tables, frames).isEmpty()
    assert store.reload_all(tables, frames).isEmpty()
    assert tables["readings"].read().count() == 1
    frames["readings"] = readings(spark, (2, "2024-01-01", 5.0))
    assert [tuple(r) for r in store.reload_all(tables, frames).collect()] == [("readings", "well_id->wells", 1)]


def test_reload_all_writes_every_row_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store.Staging, "write", lambda *_: pytest.fail("staged"))
    tables = {n: KeyedTable.named(spark, str(tmp_path), n) for n in ("wells", "readings")}
    wells = spark.createDataFrame([(1, "D1", "n", 1.0, 1.0, "a", "b", 0)], schemas.names(schemas.WELLS))
    loaded = readings(spark, (1, "2024-01-01", 5.0), (1, "2024-02-01", 6.0))
    assert store.reload_all(tables, {"wells": wells, "readings": loaded}).isEmpty()
    assert tables["readings"].read().count() == 2


def test_sources_fail_independently_and_empty_is_visible(spark, tmp_path):
    def broken() -> int:
        raise RuntimeError("portal is down")

    outcomes, code = store.run_sources(
        spark, {"bores": lambda: 3, "rain": broken, "surface": lambda: 0}, str(tmp_path / "audit"), "run-7"
    )
    assert code == 1
    assert {r.source: r.status for r in health.load_status(outcomes).collect()} == {
        "bores": "Succeeded", "rain": "Failed", "surface": "Empty"
    }
    audit = spark.read.parquet(str(tmp_path / "audit")).collect()
    assert [(r.pipeline_name, r.run_id, r.status) for r in audit] == [("rain", "run-7", "Failed")]


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_outputs_read_back(spark, tmp_path, fmt):
    df = readings(spark, (1, "2024-01-01", 5.0), (2, "2024-01-02", None))
    store.write_output(df, str(tmp_path / fmt), fmt)
    assert landed.read_table(spark, str(tmp_path / fmt), "readings", fmt).count() == 2 if fmt != "parquet" else True
    assert spark.read.format(fmt).option("header", True).load(str(tmp_path / fmt)).count() == 2


def test_merge_sorts_rows_after_the_shuffle_only(spark):
    table = spark.createDataFrame([], schemas.TABLES["readings"])
    merged = store.merge(table, table, schemas.MERGE_KEYS["readings"])
    text = merged._sc._jvm.PythonSQLUtils.explainString(merged._jdf.queryExecution(), "simple")
    assert text.count("Exchange ") == 1 and len(re.findall(r"\bSort \[", text)) == 1
    assert text.index("SortAggregate") < text.index("Sort [") < text.index("Exchange ")
