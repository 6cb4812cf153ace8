"""Reporting dates.

An operator that depends on "today" takes ``as_of``: a date, an ISO string or a
Column. ``latest_date`` yields the newest date of a table as a scalar subquery,
so no driver round trip is needed and the bound still reaches the scan.
"""

from __future__ import annotations

import datetime as dt
from typing import Union

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AsOf = Union[dt.date, str, Column]


def as_date(as_of: AsOf) -> Column:
    if isinstance(as_of, Column):
        return as_of.cast("date")
    if isinstance(as_of, str):
        as_of = dt.date.fromisoformat(as_of[:10])
    return F.lit(as_of).cast("date")


def days_before(as_of: AsOf, days: int) -> Column:
    return F.date_sub(as_date(as_of), days)


def latest_date(df: DataFrame, column: str = "reading_date") -> Column:
    return df.agg(F.max(F.col(column)).cast("date").alias(column)).scalar()
