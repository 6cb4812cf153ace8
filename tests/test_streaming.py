from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from aquifold import schemas
from aquifold.plans import detection
from aquifold.sources import landed
from aquifold.sources.alerts import AlertQueue
from aquifold.sources.store import KeyedTable
from aquifold.sources.summaries import SummarisedStore
from aquifold.streaming import jobs, tag_state, tags

NOW = {"availableNow": True}


def notification(i, second, bore, tag, value):
    return (i, dt.datetime(2024, 1, 1, 0, 0, second), bore, tag, str(value))


FIRST = [
    notification(1, 1, "Bore_1_North_Shore", "WaterLevel_mBGL", 5.0),
    notification(2, 2, "Bore_1_North_Shore", "WaterLevel_mBGL", 6.0),
    notification(3, 1, "Bore_2", "TDS_mg_per_L", 700),
    notification(4, 1, "Pump_1_x", "WaterLevel_mBGL", 1),
    notification(5, 1, "Bore_x_y", "WaterLevel_mBGL", 1),
    notification(6, 1, "Bore_1_North_Shore", "Heartbeat", 1),
]
SECOND = [
    notification(7, 1, "Bore_1_North_Shore", "WaterLevel_mBGL", 9.0),
    notification(8, 2, "Bore_1_North_Shore", "WaterLevel_mBGL", 6.5),
    notification(9, 3, "Bore_1_North_Shore", "SignalQuality", "Good"),
    notification(10, 3, "Bore_2", "PumpSpeed_RPM", 1450.9),
]


def as_set(df, columns=schemas.TAG_STATE.names):
    return {tuple(r) for r in df.select(*columns).collect()}


def test_tag_state_over_two_runs_equals_batch(spark, tmp_path):
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    log = tag_state.ChangeLog(spark, str(tmp_path / "state"))
    assert log.read().count() == 0
    for part in (FIRST, SECOND):
        spark.createDataFrame(part, schemas.TAG_EVENTS).coalesce(1).write.mode("append").parquet(source)
        stream = jobs.file_stream(spark, source, schemas.TAG_EVENTS)
        tag_state.start_tag_state(stream, log, checkpoint, NOW).awaitTermination()
    rows = {r.well_id: r for r in log.read().collect()}
    # Event time decides: the late notification 7 loses; at equal time the higher id wins.
    assert (rows[1].level, rows[1].quality, rows[1].location) == (6.5, "Good", "North Shore")
    assert (rows[2].level, rows[2].tds, rows[2].pump, rows[2].location) == (None, 700.0, 1450.9, "Bore 2")
    batch = tags.tag_last_value(tags.parse_tags(spark.createDataFrame(FIRST + SECOND, schemas.TAG_EVENTS)))
    assert as_set(batch) == as_set(log.read())


def test_what_tag_batches_write_follows_the_changes(spark, tmp_path, monkeypatch):
    """Batches, each with news of two of 300 bores, a late, an unreadable and a missing value."""
    rng = random.Random(4)
    start = dt.datetime(2024, 1, 1)
    tag_names = list(tags.FIELD_BY_TAG)
    source, every, number = tmp_path / "in", [], 0
    for batch in range(25):
        bores = range(300) if batch == 0 else rng.sample(range(300), 2)
        rows = []
        for bore in bores:
            for _ in range(2):
                number += 1
                at = start + dt.timedelta(seconds=rng.randint(0, 600) if batch % 7 == 3 else 60 * batch)
                value = rng.choice(["x", None]) if rng.random() < 0.1 else str(rng.random())
                rows.append((number, None if rng.random() < 0.02 else at, f"Bore_{bore}_Site", rng.choice(tag_names), value))
        every += rows
        spark.createDataFrame(rows, schemas.TAG_EVENTS).coalesce(1).write.parquet(str(source / f"b={batch:02}"))
    log = tag_state.ChangeLog(spark, str(tmp_path / "state"))
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        stream = spark.readStream.schema(schemas.TAG_EVENTS).option("maxFilesPerTrigger", 1).parquet(f"{source}/*")
        tag_state.start_tag_state(stream, log, str(tmp_path / "c"), NOW, compact_every=1000).awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    want = as_set(tags.tag_last_value(tags.parse_tags(spark.createDataFrame(every, schemas.TAG_EVENTS))))
    assert as_set(log.read()) == want
    files = sorted((tmp_path / "state").glob("batch=*/*.parquet"))
    assert len(files) <= 25 and max(spark.read.parquet(str(f)).count() for f in files[:1]) <= 300
    sizes = {f.parent.name: f.stat().st_size for f in files}
    first = max(sizes.values())
    assert sum(s for s in sizes.values() if s != first) / (len(sizes) - 1) < first / 2
    assert log._rows().filter("batch > 0").count() <= 2 * 24
    assert not log.compact()
    extra = log.read()
    for batch in (60, 61):
        log.append(extra, batch)
    assert log.compact() and as_set(log.read()) == want
    assert [f.parent.name for f in (tmp_path / "state").glob("batch=*/*.parquet")] == ["batch=61"]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


def test_fallback_rows(spark):
    wells = spark.createDataFrame([(1, "One"), (2, "Two")], "well_id int, location_name string")
    readings = spark.createDataFrame(
        [(2, dt.date(2024, 1, 1), 4.12345, 555.55)],
        "well_id int, reading_date date, water_level_mbgl double, tds_mg_per_l double",
    )
    state = tags.tag_last_value(tags.parse_tags(spark.createDataFrame(FIRST + SECOND, schemas.TAG_EVENTS)))
    rows = {r.well_id: tuple(r)[1:] for r in tags.tags_with_fallback(wells, state, readings, connected=False).collect()}
    assert rows[1] == ("One", 6.5, 0.0, 0, 0, "Good", "fallback")
    assert rows[2] == ("Two", 4.123, 555.6, 0, 0, "Uncertain", "fallback")
    health = tags.tag_health(state).first()
    assert (health.connected, health.tag_count) == (True, 1)
    assert tags.tag_health(state.limit(0)).first().connected is False


def test_telemetry_windows_close_after_the_delay(spark, tmp_path):
    start = dt.datetime(2024, 1, 1)
    rows = [
        (i, start + dt.timedelta(minutes=m), "Bore_1", "WaterLevel_mBGL", str(v))
        for i, (m, v) in enumerate([(0, 4.0), (4, 6.0), (6, 9.0), (60, 1.0)])
    ]
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame(rows, schemas.TAG_EVENTS).write.parquet(source)
    jobs.start_telemetry_windows(
        jobs.file_stream(spark, source, schemas.TAG_EVENTS), out, str(tmp_path / "c"), NOW
    ).awaitTermination()
    closed = {(r.window_start.minute, r.n, r.mean_value) for r in spark.read.parquet(out).collect()}
    assert closed == {(0, 2, 5.0), (5, 1, 9.0)}


def events_of(spark, *rows):
    """Events (id, bore, date, type, severity, sent) as stored rows."""
    at = dt.datetime(2024, 1, 2)
    full = [(i, w, at, day, kind, severity, 1.0, 2.0, "d", sent) for i, w, day, kind, severity, sent in rows]
    return spark.createDataFrame(full, "event_id long, well_id int, detected_at timestamp, event_date date, anomaly_type string, "
                                 "severity string, threshold_value double, actual_value double, detail string, alert_sent int")


WELLS = "well_id int, location_name string, management_area string"


def test_alerts_are_written_once_and_marked(spark, tmp_path):
    wells = spark.createDataFrame([(1, "One", "A")], WELLS)
    day = dt.date(2024, 1, 1)
    alerts = AlertQueue(spark, str(tmp_path))
    batch = events_of(spark, (1, 1, day, "A", "CRITICAL", 0), (2, 1, day, "B", "WARNING", 0), (3, 9, day, "A", "CRITICAL", 0), (4, 1, day, "C", "CRITICAL", 1))
    assert alerts.insert(batch) == 4
    assert alerts.send(wells) == 1 and alerts.send(wells) == 0
    # The same events delivered again are neither stored nor sent again; the unknown bore's waits until it is known.
    assert alerts.insert(batch) == 0 and alerts.send(wells) == 0
    assert [r.event_id for r in alerts.outbox.read().collect()] == [1]
    assert {(r.event_id, r.alert_sent) for r in alerts.events.read().collect()} == {(1, 1), (2, 0), (3, 0), (4, 1)}
    assert alerts.send(wells.union(spark.createDataFrame([(9, "Nine", "B")], WELLS))) == 1
    assert {r.event_id: r.subject for r in alerts.outbox.read().collect()}[3].endswith("A at Nine")
    assert alerts.unsent.read().count() == 0


@pytest.mark.parametrize("broken", ["events", "unsent"])
def test_alert_run_that_died_is_finished(spark, tmp_path, monkeypatch, broken):
    """The poll stops before it marks the events, or before it empties the queue."""
    wells = spark.createDataFrame([(1, "One", "A")], WELLS)
    alerts = AlertQueue(spark, str(tmp_path))
    alerts.insert(events_of(spark, (1, 1, dt.date(2024, 1, 1), "A", "CRITICAL", 0)))

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(getattr(alerts, broken), "upsert" if broken == "events" else "overwrite", fail)
        with pytest.raises(OSError):
            alerts.send(wells)
    alerts.send(wells)
    assert alerts.outbox.read().count() == 1 and alerts.unsent.read().count() == 0
    assert alerts.events.read().first().alert_sent == 1


def test_a_poll_reads_no_history(spark, tmp_path, monkeypatch):
    wells = spark.createDataFrame([(1, "One", "A")], WELLS)
    alerts = AlertQueue(spark, str(tmp_path))
    history = [(i, 1, dt.date(2020 + i // 12, i % 12 + 1, 1), "A", "CRITICAL", 0) for i in range(36)]
    alerts.insert(events_of(spark, *history))
    assert alerts.send(wells) == 36
    read, whole = [], KeyedTable.read

    def watched(self, parts=None, since=None):
        rows = whole(self, parts, since)
        if self.root != alerts.unsent.root:
            read.append((self.root.rsplit("/", 1)[-1], parts))
        return rows

    monkeypatch.setattr(KeyedTable, "read", watched)
    alerts.insert(events_of(spark, (100, 1, dt.date(2024, 5, 2), "A", "CRITICAL", 0)))
    assert alerts.send(wells) == 1
    assert {name for name, _ in read} == {"events", "outbox"}
    assert all(parts == ({"2024-05"} if name == "events" else {"0"}) for name, parts in read)


def test_ingest_takes_the_last_arrival_and_repeats(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.csv").write_text("Timestamp,Value\n2024-01-01 00:00:00,1.0\n2024-01-02 00:00:00,2.0\n")
    target = KeyedTable.named(spark, str(tmp_path), "surface")

    def normalise(lines):
        return landed.normalise_surface(landed.by_header(lines, landed.SURFACE_COLUMNS), "S", "Site", "level_m")

    def run():
        stream = landed.csv_lines(spark.readStream, str(source))
        jobs.start_ingest(stream, normalise, target, str(tmp_path / "c")).awaitTermination()

    run()
    import os
    import time

    for name, value in (("b.csv", "5.0"), ("c.csv", "7.0")):
        # Another order, another column, and a header of its own in every file.
        (source / name).write_text(f"Note,{name[0]},VALUE,Date\nx,y,{value},2024-01-02 00:00:00\n")
    later = time.time() + 100
    os.utime(source / "c.csv", (later, later))
    run()
    run()
    rows = sorted((str(r.reading_datetime.date()), float(r.metric_value)) for r in target.read().collect())
    assert rows == [("2024-01-01", 1.0), ("2024-01-02", 7.0)]


def test_detection_stream_equals_batch(spark, tmp_path):
    rows = [
        (1, dt.date(2024, 1, 1) + dt.timedelta(days=i), 5.0 + (0.01 if i % 2 else -0.01) + (2.5 if i == 29 else 0),
         500.0 + 5 * i, 0, "measured")
        for i in range(30)
    ]
    readings = spark.createDataFrame(
        rows, "well_id int, reading_date date, water_level_mbgl double, tds_mg_per_l double, pumping_event int, "
        "data_quality_flag string",
    )
    wells = spark.createDataFrame([(1, 1, "A")], "well_id int, coastal_flag int, management_area string")
    source = str(tmp_path / "in")
    readings.write.parquet(source)
    stored, events = SummarisedStore(spark, str(tmp_path / "tables")), KeyedTable.named(spark, str(tmp_path), "events")
    for _ in range(2):
        jobs.start_detection(
            jobs.file_stream(spark, source, readings.schema), stored, wells, events, str(tmp_path / "c")
        ).awaitTermination()
    batch = detection.detect(readings, wells, stored.rainfall.read())
    keys = ["well_id", "event_date", "anomaly_type", "severity", "detail"]
    assert {tuple(r) for r in events.read().select(*keys).collect()} == {tuple(r) for r in batch.select(*keys).collect()}
    assert events.read().agg(F.count("*")).first()[0] == 2
