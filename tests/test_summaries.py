"""Detection from stored summaries equals detection over the whole history, load after load."""

from __future__ import annotations

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F
from test_plans import plan

from aquifold import schemas
from aquifold.operators import detectors, summaries, views
from aquifold.plans import detection
from aquifold.session import Staging
from aquifold.sources.store import KeyedTable
from aquifold.sources.summaries import SummarisedStore

READINGS = "well_id int, reading_date date, water_level_mbgl double, tds_mg_per_l double, pumping_event int, data_quality_flag string"
RAIN = "station_id string, station_name string, management_area string, obs_date date, rainfall_mm double, data_quality_flag string"
FIRST = dt.date(2023, 1, 1)


def on(i: int) -> dt.date:
    return FIRST + dt.timedelta(days=i)


def reading(rng: random.Random, well: int, i: int) -> tuple:
    level = None if rng.random() < 0.05 else round(rng.gauss(20, 0.05) + (3 if rng.random() < 0.05 else 0), 3)
    tds = None if rng.random() < 0.05 else round(500 + (i * 2.5 if well % 3 == 0 else 0) + rng.random(), 1)
    return (well, on(i), level, tds, 0, rng.choice(["measured"] * 9 + ["suspect"]))


def batches(rng: random.Random):
    """Readings and rain by load: history, days one by one, late rows, and replacements that turn suspect."""
    yield [reading(rng, w, i) for w in range(1, 8) for i in range(0, 200) if rng.random() < (0.15 if w == 2 else 0.8) and not (w == 3 and i > 90)], range(0, 200)
    yield [reading(rng, w, i) for w in range(1, 6) for i in (200, 201, 202)], range(200, 203)
    yield [reading(rng, 2, i) for i in range(20, 40)] + [reading(rng, 9, 205)], []
    yield [(*reading(rng, 4, i)[:5], "suspect") for i in range(150, 203)], [100, 101, 102]
    yield [reading(rng, w, i) for w in (1, 3, 5) for i in range(203, 260)], range(203, 260)
    yield [], range(60, 70)


def test_incremental_detection_equals_full(spark, tmp_path):
    rng = random.Random(3)
    wells = spark.createDataFrame(
        [(w, w % 2, f"area {w % 2}") for w in range(1, 9)], "well_id int, coastal_flag int, management_area string"
    )
    stored = SummarisedStore(spark, str(tmp_path))
    found = set()
    for rows, rain_days in batches(rng):
        rain = [
            (f"s{a}{k}", "n", f"area {a}", on(i), round(rng.random() * 6 if rng.random() < 0.6 else 0.0, 1), rng.choice(["measured"] * 8 + ["suspect"]))
            for a in (0, 1) for k in (0, 1) for i in rain_days
        ]
        stored.load_rainfall(spark.createDataFrame(rain, RAIN))
        stored.load_readings(spark.createDataFrame(rows, READINGS))
        for name, table in (("readings", stored.readings), ("rainfall", stored.rainfall)):
            assert table.read().count() > 0, name
        whole = {r.well_id: r for r in summaries.summarise(stored.readings.read()).collect()}
        kept = {r.well_id: r for r in stored.bores.read().collect() if r.rows}
        assert {w: (r.rows, r.levels, r.salts, r.newest) for w, r in kept.items()} == {
            w: (r.rows, r.levels, r.salts, r.newest) for w, r in whole.items()
        }
        with Staging(spark) as staging:
            got = sorted(map(tuple, detection.detect_stored(stored, wells, staging).collect()), key=repr)
            want = sorted(map(tuple, detection.detect(stored.readings.read(), wells, stored.rainfall.read(), staging).collect()), key=repr)
        assert got == want
        found |= {r[2] for r in got}
    assert found == {"RapidLevelChange", "LowRechargeResponse", "SalinityIntrusionRisk"}


def test_a_repeated_load_changes_nothing(spark, tmp_path):
    rng = random.Random(1)
    stored = SummarisedStore(spark, str(tmp_path))
    first = spark.createDataFrame([reading(rng, 1, i) for i in range(60)], READINGS)
    last = spark.createDataFrame([reading(rng, 1, i) for i in range(55, 70)], READINGS)
    for rows in (first, last):
        stored.load_readings(rows)
    before = stored.bores.read().collect()
    stored.load_readings(last)
    assert stored.bores.read().collect() == before


def test_a_load_stages_its_rows_once(spark, tmp_path, monkeypatch):
    rng = random.Random(2)
    stored = SummarisedStore(spark, str(tmp_path))
    written = []
    write = Staging.write
    monkeypatch.setattr(Staging, "write", lambda self, df, label: written.append(label) or write(self, df, label))
    stored.load_readings(spark.createDataFrame([reading(rng, 1, i) for i in range(60)], READINGS))
    assert written == ["arrived", "merged", "months", "merged", "merged"]  # readings twice, their months, bores twice
    written.clear()
    # Replaced rows that turn suspect leave the summary short, so that it is refilled from the stored bores' months.
    stored.load_readings(spark.createDataFrame([(*reading(rng, 1, i)[:5], "suspect") for i in range(40, 60)], READINGS))
    assert written.count("upsert") == 1 and written.count("months") == 1


def test_daily_load_reads_only_touched_months(spark, tmp_path, monkeypatch):
    rng = random.Random(5)
    wells = spark.createDataFrame([(w, 0, "area 0") for w in range(1, 4)], "well_id int, coastal_flag int, management_area string")
    stored = SummarisedStore(spark, str(tmp_path))
    stored.load_readings(spark.createDataFrame([reading(rng, w, i) for w in range(1, 4) for i in range(400)], READINGS))
    rain = [("s", "n", "area 0", on(i), 9.0 if i % 40 == 0 else (4.0 if i % 40 < 4 else 0.0), "measured") for i in range(400)]
    stored.load_rainfall(spark.createDataFrame(rain, RAIN))
    events = KeyedTable.named(spark, str(tmp_path), "events")
    detection.detect_and_store(stored, wells, events)

    read = []
    whole = KeyedTable.read

    def watched(self, parts=None, since=None):
        rows = whole(self, parts, since)
        if self.root == stored.readings.root:
            assert parts is not None
            read.append(set(parts))
            assert re.search(r"PartitionFilters: \[.*part", plan(rows))
        return rows

    monkeypatch.setattr(KeyedTable, "read", watched)
    stored.load_readings(spark.createDataFrame([reading(rng, w, 400) for w in range(1, 4)], READINGS))
    detection.detect_and_store(stored, wells, events)
    # The new day's month, and at most the months of a rain event that became complete.
    day = on(400)
    assert set().union(*read) <= {f"{d:%Y-%m}" for d in (day, day - dt.timedelta(days=14), day - dt.timedelta(days=40))}
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("aquifold")]


@pytest.mark.parametrize("older, newer, want", [(None, None, 0), (40, None, 31), (20, 20, 31), (None, 5, 5)])
def test_newest_lists_merge(spark, older, newer, want):
    def rows(n, start):
        return None if n is None else [(on(start + i), 1.0, None) for i in range(n)]

    kind = schemas.NEWEST_ROWS.simpleString()
    df = spark.createDataFrame([(rows(older, 0), rows(newer, 100))], f"a {kind}, b {kind}")
    merged = df.select(summaries.merged_newest(df.a, df.b)).first()[0]
    days = [r["reading_date"] for r in merged]
    assert len(days) == want and days == sorted(days, reverse=True)


def test_tables_that_grow_with_the_bores_are_not_broadcast(spark, tmp_path):
    wells = spark.createDataFrame(
        [(1, "b", 1, "area 1")], "well_id int, location_name string, coastal_flag int, management_area string"
    )
    bores = summaries.summarise(spark.createDataFrame([reading(random.Random(1), 1, i) for i in range(40)], READINGS))
    newest = summaries.as_readings(bores, wells)
    seen = bores.select("well_id", F.col("levels").alias("observations"))
    events = spark.createDataFrame([], schemas.EVENTS)
    for frame in (
        bores, newest, summaries.last_days(bores, wells), detectors.rapid_level_change(newest, observations=seen),
        detectors.salinity_intrusion(newest, observations=seen), views.critical_events_to_send(events, wells),
        views.mark_alerted(events, events.select("event_id")),
    ):
        text = plan(frame)
        assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text
