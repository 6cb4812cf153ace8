"""Declared constraints as queries that return the violating rows or keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aquifold import schemas

Tables = dict[str, DataFrame]


def unique_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def unique_violation_counts(tables: Tables) -> DataFrame:
    """Number of repeated keys per declared key."""
    return _union([
        unique_violations(tables[name], keys).agg(
            F.lit(name).alias("table_name"), F.lit(",".join(keys)).alias("rule"),
            F.count(F.lit(1)).alias("violations"),
        )
        for name, key_lists in schemas.UNIQUE_KEYS.items() if name in tables
        for keys in key_lists
    ])


def fk_violations(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose key has no parent; a NULL key is allowed."""
    keys = parent.select(F.col(parent_column).alias(column))
    return child.filter(F.col(column).isNotNull()).join(keys, column, "left_anti")


def fk_violation_counts(tables: Tables) -> DataFrame:
    """Number of distinct orphan keys per declared reference.

    Child keys are made distinct before the join, so a fact table contributes one
    row per key however its rows are spread.
    """
    return _union([
        fk_violations(tables[child].select(column).distinct(), column, tables[parent], parent_column)
        .agg(
            F.lit(child).alias("table_name"), F.lit(f"{column}->{parent}").alias("rule"),
            F.count(F.lit(1)).alias("violations"),
        )
        for child, column, parent, parent_column in schemas.FOREIGN_KEYS
        if child in tables and parent in tables
    ])


def check_violations(df: DataFrame, table: str) -> DataFrame:
    """Rows failing a CHECK of ``table``, once per failed rule."""
    rules = schemas.CHECKS[table]
    failed = F.array_compact(F.array(*[
        F.when(~F.expr(condition), F.lit(rule)) for rule, condition in rules.items()
    ]))
    return df.withColumn("rule", F.explode(failed))


def check_violation_counts(tables: Tables) -> DataFrame:
    return _union([
        _counts(tables[name], name, {rule: ~F.expr(condition) for rule, condition in rules.items()})
        for name, rules in schemas.CHECKS.items() if name in tables
    ])


def domain_violation_counts(tables: Tables) -> DataFrame:
    """Rows with a missing required value, an over-long text or a number too large for its type.

    One pass per table counts all of its rules.
    """
    outputs = []
    for name, df in tables.items():
        rules = {
            f"{c} required": F.col(c).isNull() for c in schemas.REQUIRED.get(name, []) if c in df.columns
        }
        rules |= {
            f"{c} length": F.length(c) > limit
            for c, limit in schemas.TEXT_LENGTHS.get(name, {}).items() if c in df.columns
        }
        rules |= {
            f"{c} overflow": F.abs(F.col(c).cast("double")) >= float(10**digits)
            for c, digits in schemas.DECIMAL_DIGITS.get(name, {}).items() if c in df.columns
        }
        if rules:
            outputs.append(_counts(df, name, rules))
    return _union(outputs)


def station_area_mapping(rainfall: DataFrame) -> DataFrame:
    """Distinct stations, areas and pairs; the mapping is one to one if all three agree."""
    pairs = rainfall.select("station_id", "management_area").distinct()
    return pairs.agg(
        F.count(F.lit(1)).alias("pairs"),
        F.countDistinct("station_id").alias("stations"),
        F.countDistinct("management_area").alias("areas"),
    )


def _counts(df: DataFrame, table: str, rules: dict) -> DataFrame:
    totals = df.agg(F.map_from_arrays(
        F.array(*[F.lit(rule) for rule in rules]),
        F.array(*[F.count_if(failed) for failed in rules.values()]),
    ).alias("counts"))
    return totals.select(F.lit(table).alias("table_name"), F.explode("counts").alias("rule", "violations"))


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
