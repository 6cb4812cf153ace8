"""Numeric and quality helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SNAP_DIGITS = 9


def as_double(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("double")


def snap(column: Column) -> Column:
    """Drop floating-point noise.

    Partial aggregates merge in no fixed order, so a sum can differ in its last
    bits from run to run. Thresholds and roundings work on the snapped value,
    which makes results repeatable and a value on a threshold count as on it.
    """
    return F.round(column, _SNAP_DIGITS)


def rounded(column: Column, digits: int) -> Column:
    return F.round(snap(column), digits)


def fixed(column: Column, digits: int) -> Column:
    """Text with a fixed number of decimals, rounded half up."""
    return rounded(column, digits).cast(f"decimal(28,{digits})").cast("string")


def drop_suspect(df: DataFrame) -> DataFrame:
    """Keep everything not flagged suspect; an absent column or flag is trusted."""
    if "data_quality_flag" not in df.columns:
        return df
    return df.filter(F.coalesce(F.col("data_quality_flag"), F.lit("measured")) != "suspect")
