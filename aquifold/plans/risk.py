"""Daily risk snapshot: detection, scoring and storage."""

from __future__ import annotations

from pyspark.sql import DataFrame

from aquifold.functions import AsOf
from aquifold.operators import constraints, risk
from aquifold.session import Staging
from aquifold.sources.store import KeyedTable


class AmbiguousLicence(ValueError):
    """More than one licence is active in an area, so bores would repeat."""


def store_snapshot(table: KeyedTable, snapshot: DataFrame) -> int:
    """Store a snapshot after checking that it holds every bore once."""
    with Staging(snapshot.sparkSession) as staging:
        staged = staging.write(snapshot, "snapshot")
        repeated = constraints.unique_violations(staged, ["risk_snapshot_date", "well_id"]).limit(3).collect()
        if repeated:
            raise AmbiguousLicence(f"bores with several rows, e.g. {[r['well_id'] for r in repeated]}")
        return table.upsert(staged)


def build_and_store(
    wells: DataFrame, readings: DataFrame, events: DataFrame, licences: DataFrame, extraction: DataFrame,
    table: KeyedTable, as_of: AsOf | None = None,
) -> int:
    return store_snapshot(table, risk.risk_snapshot(wells, readings, events, licences, extraction, as_of))
