"""Row-framed windows over one bore's readings.

Frames count rows, not days, as the domain rules do. A partition holds one bore;
readings are unique on (well_id, reading_date), so its size is bounded by the
calendar (about 36,500 rows per century) however many readings a table has, and
a bore can never grow into a partition that needs splitting.
"""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


def by_bore(order: str = "reading_date") -> WindowSpec:
    return Window.partitionBy("well_id").orderBy(order)


def newest_first(order: str = "reading_date") -> WindowSpec:
    """Ranks under a small limit on this window are cut before the exchange as well."""
    return Window.partitionBy("well_id").orderBy(F.col(order).desc())


def trailing(window: WindowSpec, rows: int) -> WindowSpec:
    """The last ``rows`` rows, the current one included."""
    return window.rowsBetween(-(rows - 1), Window.currentRow)


def preceding(window: WindowSpec, rows: int) -> WindowSpec:
    """The ``rows`` rows before the current one."""
    return window.rowsBetween(-rows, -1)


def at_least(count: int, value: Column, aggregate: Column, window: WindowSpec) -> Column:
    """``aggregate`` over ``window``, NULL where fewer than ``count`` values are present."""
    return F.when(F.count(value).over(window) >= count, aggregate.over(window))
