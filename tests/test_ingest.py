from __future__ import annotations

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from aquifold.operators import health
from aquifold.plans import ingest
from aquifold.sources import landed
from aquifold.sources.store import KeyedTable


def put(root, name, text, age=0):
    path = root / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    when = dt.datetime(2024, 6, 1).timestamp() - age
    os.utime(path, (when, when))


def lines(*records):
    return "\n".join(json.dumps(r) for r in records)


def landing(root):
    put(root, "wells/area=Plains/a.json", lines({"DHNO": "0001", "NAME": "One", "AQUIFER": "Sand"}, {"DHNO": "0002", "NAME": "Two"}))
    put(root, "wells/area=Old Coast/b.json", lines({"dh_no": "0003", "dh_name": "Three", "aquifer": "coastal"}))
    put(root, "readings/dh_no=0001/a.json", lines(
        {"OBS_DATE": "2024-05-01", "DTW": 5.5, "TDS": 500}, {"OBS_DATE": "2012-05-01", "DTW": 9}), age=50)
    put(root, "readings/dh_no=0001/b.json", lines({"obs_date": "2024-05-01", "water_level": 6.5}))
    put(root, "readings/dh_no=0003/a.json", lines({"OBS_DATE": "2024-05-02", "DTW": -1, "PUMPING": 1}))
    put(root, "readings/dh_no=9999/a.json", lines({"OBS_DATE": "2024-05-02", "DTW": 1}))
    put(root, "rainfall/station_id=23/a.csv", "Date,Rain\n2024-05-01,3.5\n2024-05-02,-1\n")
    put(root, "rainfall/station_id=24/a.csv", "Date,Wind\n2024-05-01,3.5\n")
    put(root, "rainfall/station_id=26/a.csv", 'Quality,"Daily_Rain",Note, Date2 \nY,0.5,"a, b",20240503\nY,9.9,x,someday\n')
    put(root, "rainfall/station_id=99/a.csv", "Date,Rain\n2024-05-01,3.5\n")
    put(root, "readings/dh_no=0001/c.json", lines({"OBS_DATE": "no day", "DTW": 1}))
    put(root, "surface/site_id=A1/metric=level_m/a.csv", "Timestamp,Value\n2024-05-01 01:00:00,1.5\n")


STATIONS = [("23", "North", "Plains"), ("24", "No rain column", "Plains"), ("25", "Never landed", "Old Coast"), ("26", "Other header", "Old Coast")]
SITES = [("A1", "River", "level_m"), ("A2", "Creek", "flow")]


def test_whole_run_is_repeatable(spark, tmp_path):
    source, target = tmp_path / "landed", str(tmp_path / "tables")
    landing(source)
    for _ in range(2):
        outcomes, code = ingest.run_ingestion(spark, str(source), target, STATIONS, SITES, "2024-06-01")
        assert code == 0
        assert {r.source: (r.rows, r.status) for r in health.load_status(outcomes).collect()} == {
            "groundwater": (2, "Succeeded"), "rainfall": (3, "Succeeded"), "surface": (1, "Succeeded"),
            "rainfall/23": (2, "Succeeded"), "rainfall/24": (0, "Failed"), "rainfall/25": (0, "Empty"),
            "rainfall/26": (1, "Succeeded"), "surface/A1/level_m": (1, "Succeeded"), "surface/A2/flow": (0, "Empty"),
        }
        details = {r.source: (r.dropped, r.unresolved, r.error) for r in outcomes.collect()}
        assert details["groundwater"] == (1, 1, None)
        assert details["rainfall"] == details["rainfall/26"] == (1, 0, None)
        assert details["rainfall/24"] == (0, 0, "no column rain")
        failed = {(r.pipeline_name, r.status) for r in spark.read.parquet(f"{target}/audit").collect()}
        assert failed == {("rainfall/24", "Failed")}
        wells = {r.source_dh_no: r for r in KeyedTable.named(spark, target, "wells").read().collect()}
        assert sorted(wells) == ["0001", "0002", "0003"] and {w.well_id for w in wells.values()} == {1, 2, 3}
        assert (wells["0003"].management_area, wells["0003"].coastal_flag) == ("Old Coast", 1)
        readings = {
            (r.well_id, str(r.reading_date)): (float(r.water_level_mbgl), r.tds_mg_per_l, r.pumping_event, r.data_quality_flag)
            for r in KeyedTable.named(spark, target, "readings").read().collect()
        }
        # The later delivery replaced the whole row; the old reading is outside the history window.
        assert readings == {
            (wells["0001"].well_id, "2024-05-01"): (6.5, None, 0, "measured"),
            (wells["0003"].well_id, "2024-05-02"): (-1.0, None, 1, "suspect"),
        }
        rain = KeyedTable.named(spark, target, "rainfall").read().collect()
        assert {(r.station_name, float(r.rainfall_mm), r.data_quality_flag) for r in rain} == {
            ("North", 3.5, "measured"), ("North", -1.0, "suspect"), ("Other header", 0.5, "measured")
        }


def test_a_failing_source_does_not_stop_the_others(spark, tmp_path):
    source, target = tmp_path / "landed", str(tmp_path / "tables")
    put(source, "rainfall/station_id=23/a.csv", "Date,Rain\n2024-05-01,3.5\n")
    outcomes, code = ingest.run_ingestion(
        spark, str(source), target, STATIONS, SITES, "2024-06-01", skip_surface=True, run_id="r1"
    )
    assert code == 1
    status = {r.source: r.status for r in health.load_status(outcomes).collect() if "/" not in r.source}
    assert status == {"groundwater": "Failed", "rainfall": "Succeeded"}
    assert [r.pipeline_name for r in spark.read.parquet(f"{target}/audit").collect()] == ["groundwater"]


def test_nothing_landed_shows_as_empty(spark, tmp_path):
    outcomes, _ = ingest.run_ingestion(spark, str(tmp_path / "none"), str(tmp_path / "t"), [], SITES, "2024-06-01")
    status = {r.source: r.status for r in health.load_status(outcomes).collect()}
    assert (status["rainfall"], status["surface"]) == ("Empty", "Empty")


def test_the_plan_of_a_read_does_not_grow_with_stations(spark, tmp_path):
    sizes = []
    for stations in (3, 60):
        root = tmp_path / str(stations)
        for i in range(stations):
            header = ["Date,Rain", "Daily_Rain,Date2", "X,Rainfall,Date"][i % 3]
            row = {"Date,Rain": "2024-05-01,1", "Daily_Rain,Date2": "1,2024-05-01", "X,Rainfall,Date": "9,1,1/5/2024"}[header]
            put(root, f"station_id={i}/a.csv", f"{header}\n{row}\n")
        rows = landed.by_header(landed.csv_lines(spark.read, str(root), ("station_id",)), landed.RAIN_COLUMNS)
        got = landed.normalise_rainfall(rows, F.col("station_id"), "n", "a")
        assert {(r.station_id, str(r.obs_date), r.rainfall_mm) for r in got.collect()} == {
            (str(i), "2024-05-01", 1.0) for i in range(stations)
        }
        sizes.append(len(got._sc._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "simple")))
    assert abs(sizes[1] - sizes[0]) < 0.1 * sizes[0]


def test_lines_of_files_read_in_pieces(spark, tmp_path):
    """A file split over many tasks still gets its header, also with a byte order mark and a repeated header line."""
    days = [dt.date(2000, 1, 1) + dt.timedelta(days=i) for i in range(3000)]
    put(tmp_path, "station_id=1/a.csv", "\ufeffRain,Date\n" + "\n".join(f"{i},{d}" for i, d in enumerate(days)) + "\nRain,Date\n")
    put(tmp_path, "station_id=2/a.csv", "")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        lines_read = landed.csv_lines(spark.read, str(tmp_path), ("station_id",))
        assert lines_read.rdd.getNumPartitions() > 5
        rows = landed.by_header(lines_read, landed.RAIN_COLUMNS)
        assert {(r.date, r.rain) for r in rows.collect()} == {(str(d), str(i)) for i, d in enumerate(days)}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
