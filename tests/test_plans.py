"""Physical plans the scale of the library rests on."""

from __future__ import annotations

import re

import pytest
from conftest import day, ripple
from pyspark.sql import functions as F

from aquifold.functions import latest_date
from aquifold.operators import curated, detectors, risk, summaries
from aquifold.plans import detection
from aquifold.session import Staging, freed_shuffles, shared_folder, stage


@pytest.fixture(scope="module")
def staged(spark):
    rows = [
        (well, day(i), 5.0 + 0.01 * (i % 7), 500.0 + i, well % 2, f"area {well % 3}", "measured")
        for well in range(20) for i in range(120)
    ]
    readings = spark.createDataFrame(
        rows, "well_id int, reading_date date, water_level_mbgl double, tds_mg_per_l double, coastal_flag int, "
        "management_area string, data_quality_flag string",
    )
    with Staging(spark) as staging:
        yield staging.write(readings, "plan_test")


@pytest.fixture
def no_broadcast(spark):
    """Plans as they are when every table is too big to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def nodes(text: str) -> str:
    """The operator tree, without the per-operator details."""
    return text.split("\n\n\n")[0]


def test_detection_copies_no_readings(spark, staged, no_broadcast):
    """Only summaries are staged: the readings are scanned in place, and a bore's newest rows are cut before the exchange."""
    rain = spark.createDataFrame(
        [(f"area {a}", day(i), 9.0 * (i % 9 == 0), "measured") for a in range(3) for i in range(120)],
        "management_area string, obs_date date, rainfall_mm double, data_quality_flag string",
    )
    wells = spark.createDataFrame([(w, w % 2, f"area {w % 3}") for w in range(20)], "well_id int, coastal_flag int, management_area string")
    before = {t.name for t in spark.catalog.listTables()}
    written = []

    class Watched(Staging):
        def write(self, df, label):
            written.append(label)
            return super().write(df, label)

    with Watched(spark) as staging:
        text = nodes(plan(detection.detect(staged.drop("coastal_flag", "management_area"), wells, rain, staging)))
    assert written == ["summaries", "area_rain", "rain_events"]
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert {t.name for t in spark.catalog.listTables()} == before
    text = nodes(plan(summaries.newest_rows(summaries.trusted_rows(staged))))
    final, exchange = text.index("WindowGroupLimit"), text.index("Exchange")
    assert final < exchange < text.index("WindowGroupLimit", final + 1)


def test_rank_limit_is_applied_before_the_exchange(spark, tmp_path, staged):
    staged.write.parquet(str(tmp_path / "flat"))
    text = nodes(plan(detectors.rapid_level_change(spark.read.parquet(str(tmp_path / "flat")))))
    final, exchange = text.index("WindowGroupLimit"), text.index("Exchange")
    partial = text.index("WindowGroupLimit", final + 1)
    # The tree is printed from the result down to the scan.
    assert final < exchange < partial


def test_reporting_window_reaches_the_scan(spark, tmp_path, staged):
    staged.write.parquet(str(tmp_path / "flat"))
    flat = spark.read.parquet(str(tmp_path / "flat"))
    text = plan(risk.data_completeness(flat, latest_date(flat)))
    assert re.search(r"PushedFilters: .*reading_date.*ScalarSubquery", text)
    schema = re.search(r"ReadSchema: (.*)", text).group(1)
    assert "water_level" not in schema and "tds" not in schema


def test_quality_filter_and_pruning_reach_the_scan(spark, tmp_path, staged):
    staged.write.parquet(str(tmp_path / "flat"))
    flat = spark.read.parquet(str(tmp_path / "flat"))
    wells = spark.createDataFrame([(1, 0, "a")], "well_id int, coastal_flag int, management_area string")
    trusted = curated.trusted_readings(flat.drop("coastal_flag", "management_area"), wells)
    text = plan(trusted.select("well_id", "reading_date"))
    assert re.search(r"PushedFilters: .*Not\(EqualTo\(data_quality_flag,suspect\)\)", text)
    assert "tds_mg_per_l" not in re.search(r"ReadSchema: (.*)", text).group(1)


def test_staged_tables_are_removed(spark, readings_of):
    with Staging(spark) as staging:
        table = staging.write(readings_of((1, ripple(5, 1.0, 0.1), 1.0, 0, "a")), "gone")
        assert table.count() == 5
        path = spark._jvm.org.apache.hadoop.fs.Path(staging.folder)
        files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        assert files.exists(path)
    assert not files.exists(path)
    assert staging.folder.startswith(shared_folder(spark))


def test_staged_writes_leave_no_shuffle_files(spark, tmp_path):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    with freed_shuffles(spark):
        assert spark.conf.get(key) == "true"
    with pytest.raises(ZeroDivisionError), freed_shuffles(spark):
        raise ZeroDivisionError
    assert spark.conf.get(key) == before
    counted = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    staged = stage(counted, "counted")
    assert spark.conf.get(key) == before
    assert sorted(map(tuple, staged.collect())) == sorted(map(tuple, counted.collect()))
    assert sorted(map(tuple, stage(counted, "again").collect())) == sorted(map(tuple, counted.collect()))
