"""Distributed prefix sums along a hierarchy of keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def null_safe(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    """Equality of all the named columns, null equal to null."""
    condition = F.lit(True)
    for name in names:
        condition &= left[name].eqNullSafe(right[name])
    return condition


def joined(left: DataFrame, right: DataFrame, names: list[str], how: str = "inner") -> DataFrame:
    """Join on equal (or both null) named columns, which are kept once."""
    marked = right.select(
        *[F.col(n).alias(f"__k{i}") for i, n in enumerate(names)], *[c for c in right.columns if c not in names]
    )
    condition = F.lit(True)
    for i, name in enumerate(names):
        condition &= F.col(name).eqNullSafe(F.col(f"__k{i}"))
    return left.join(marked, condition, how).drop(*[f"__k{i}" for i in range(len(names))])


def starts(totals: DataFrame, group: list[str], levels: list[str], value: str) -> DataFrame:
    """``totals`` with ``start``: the sum of ``value`` in all rows before it within the group.

    Rows are ordered by ``levels``, coarse to fine, and are unique in group and levels. Sums
    are added up level by level, and a running sum only ever passes over the children of one
    parent, so the largest window is the widest fan-out of the hierarchy, however many rows
    there are. Null keys sort first.
    """
    parent = [*group, *levels[:-1]]
    before = W.partitionBy(*parent).orderBy(levels[-1]).rowsBetween(W.unboundedPreceding, -1)
    placed = totals.withColumn("start", F.coalesce(F.sum(value).over(before), F.lit(0)).cast("bigint"))
    if len(levels) == 1:
        return placed
    above = starts(totals.groupBy(*parent).agg(F.sum(value).alias(value)), group, levels[:-1], value)
    above = above.select(*parent, F.col("start").alias("__above"))
    return joined(placed, above, parent).withColumn("start", F.col("start") + F.col("__above")).drop("__above")
