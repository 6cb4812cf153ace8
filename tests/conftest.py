"""One local session for all tests, and small frame builders."""

from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from aquifold.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        master="local[8]", shuffle_partitions=4, spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="6g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


FIRST_DAY = dt.date(2024, 1, 1)


def day(offset: int) -> dt.date:
    return FIRST_DAY + dt.timedelta(days=offset)


def ripple(n: int, level: float, step: float) -> list[float]:
    """A saw of three heights around ``level``: below, at and above it in turn."""
    return [round(level + step * (i % 3 - 1), 6) for i in range(n)]


@pytest.fixture
def readings_of(spark):
    """Detector readings from (bore, levels, tds, coastal, area) on consecutive days; None skips a day."""

    def build(*series):
        rows = []
        for well_id, levels, tds, coastal, area in series:
            values = tds if isinstance(tds, list) else [tds] * len(levels)
            rows += [
                (well_id, day(i), level, values[i], coastal, area)
                for i, level in enumerate(levels)
            ]
        return spark.createDataFrame(
            rows,
            "well_id int, reading_date date, water_level_mbgl double, tds_mg_per_l double, "
            "coastal_flag int, management_area string",
        )

    return build


@pytest.fixture
def rain_of(spark):
    """Rain per day; with areas when given a dict."""

    def build(amounts):
        if isinstance(amounts, dict):
            rows = [(area, day(i), float(mm)) for area, mms in amounts.items() for i, mm in enumerate(mms)]
            return spark.createDataFrame(rows, "management_area string, obs_date date, rainfall_mm double")
        rows = [(day(i), float(mm)) for i, mm in enumerate(amounts)]
        return spark.createDataFrame(rows, "obs_date date, rainfall_mm double")

    return build
