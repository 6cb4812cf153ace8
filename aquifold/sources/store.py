"""Stored tables with keyed, repeatable loads on plain parquet.

A table is a parquet folder, split by month where it has a date. A load merges its rows with
the stored months they touch, stages the outcome in the shared folder and replaces just
those months by Spark's dynamic partition overwrite. Loading the same rows again changes
nothing, and the number of files follows the data, not the number of loads. One writer
per table at a time is assumed.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aquifold import schemas
from aquifold.operators import constraints
from aquifold.session import Staging, stage

# Tables in load order: parents before children.
LOAD_ORDER = ["wells", "licences", "readings", "rainfall", "events", "extraction", "snapshots"]
_MONTH_OF = {
    "readings": "reading_date", "rainfall": "obs_date", "surface": "reading_datetime",
    "events": "event_date", "extraction": "reading_month", "snapshots": "risk_snapshot_date",
}


class DuplicateKeyError(ValueError):
    """The source of a load holds a key more than once."""


def merge(target: DataFrame, source: DataFrame, keys: list[str], keep_old: bool = False) -> DataFrame:
    """Rows of both frames by key; where both hold a key, the source's row, or the target's with ``keep_old``.

    One shuffle on the key, before any aggregation: rows of mixed size are aggregated by sorting, and to sort
    whole input splits as well would cost a task far more memory than a shuffled partition does, and hardly
    shrink them, as keys rarely repeat. ``_copies`` counts the source's rows of a key, so that a
    caller can refuse repeated ones without another pass.
    """
    rest = [c for c in target.columns if c not in keys]

    def marked(df: DataFrame, new: int) -> DataFrame:
        return df.select(*keys, F.struct(*rest).alias("_rest"), F.lit(new).alias("_new"))

    both = marked(target, 0).unionByName(marked(source, 1))
    rank = -F.col("_new") if keep_old else F.col("_new")
    return both.repartition(*keys).groupBy(*keys).agg(
        F.max_by("_rest", rank).alias("_rest"), F.sum("_new").alias("_copies"), F.min("_new").alias("_inserted")
    ).select(*keys, "_rest.*", "_copies", "_inserted")


class KeyedTable:
    def __init__(
        self, spark: SparkSession, root: str, schema: T.StructType, keys: list[str], month_of: str | None = None,
        part: Column | None = None,
    ) -> None:
        """``part`` splits the table by another text than the month; like that, it must follow from the key."""
        # A key must always fall into the same month, else its old row would survive a load.
        if month_of and month_of not in keys:
            raise ValueError(f"{month_of} must be one of the keys {keys}")
        self.spark, self.root, self.schema, self.keys = spark, root.rstrip("/"), schema, keys
        self._part = F.date_format(month_of, "yyyy-MM") if month_of else F.lit("all") if part is None else part

    @classmethod
    def named(cls, spark: SparkSession, folder: str, name: str) -> KeyedTable:
        """One of the model's tables under its declared schema and key."""
        return cls(spark, f"{folder}/{name}", schemas.TABLES[name], schemas.MERGE_KEYS[name], _MONTH_OF.get(name))

    # reading -------------------------------------------------------------

    def read(self, parts: set[str] | None = None, since: dt.date | None = None) -> DataFrame:
        """The current table; only the files of the given months, or of those from ``since`` on."""
        schema = T.StructType([*self.schema.fields, T.StructField("part", T.StringType())])
        try:
            rows = self.spark.read.schema(schema).parquet(self.root)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], self.schema)
        if parts is not None:
            rows = rows.filter(F.col("part").isin(sorted(parts)))
        if since is not None:
            rows = rows.filter(F.col("part") >= f"{since:%Y-%m}")
        return rows.drop("part")

    # loading -------------------------------------------------------------

    def _typed(self, source: DataFrame) -> DataFrame:
        return source.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])

    def months_of(self, df: DataFrame) -> set[str]:
        """Months of a staged source: a bounded list, one entry per month."""
        return {r[0] for r in df.select(self._part.alias("part")).distinct().collect()}

    def _write(self, df: DataFrame, everything: bool = False) -> None:
        # Rebalancing gathers a month's rows yet splits a month that is too big for one task.
        (
            df.select(*self.schema.names).withColumn("part", self._part).hint("rebalance", "part")
            .write.mode("overwrite").option("partitionOverwriteMode", "static" if everything else "dynamic")
            .partitionBy("part").parquet(self.root)
        )

    def upsert(self, source: DataFrame, is_staged: bool = False) -> int:
        """Replace rows with equal keys, add the others; returns the source's row count.

        A source ``is_staged`` that the caller has just written: it is read as it is, not copied.
        """
        with Staging(self.spark) as staging:
            staged = self._typed(source) if is_staged else staging.write(self._typed(source), "upsert")
            merged = staging.write(merge(self.read(self.months_of(staged)), staged, self.keys), "merged")
            rows, most = merged.agg(F.coalesce(F.sum("_copies"), F.lit(0)), F.max("_copies")).first()
            if most and most > 1:
                repeated = constraints.unique_violations(staged, self.keys).limit(3).collect()
                raise DuplicateKeyError(f"{self.root}: keys held more than once, e.g. {[tuple(r) for r in repeated]}")
            if rows:
                self._write(merged)
            return rows

    def load(self, source: DataFrame, is_staged: bool = False) -> int:
        """Upsert; of several deliveries of a key the last to arrive wins."""
        if "arrived_at" in source.columns:
            return self.upsert_latest(source, "arrived_at")
        return self.upsert(source, is_staged)

    def upsert_latest(self, source: DataFrame, order: str) -> int:
        """Upsert a source that may hold a key several times: the highest ``order`` wins."""
        rest = [c for c in source.columns if c not in (*self.keys, order)]
        newest = Window.partitionBy(*self.keys).orderBy(F.col(order).desc(), *rest)
        return self.upsert(source.withColumn("place", F.row_number().over(newest)).filter("place = 1"))

    def insert_new(self, source: DataFrame) -> int:
        """Add rows whose key is absent; existing rows stay. Returns how many were added."""
        rest = [c for c in self.schema.names if c not in self.keys]
        first = Window.partitionBy(*self.keys).orderBy(*rest)
        with Staging(self.spark) as staging:
            candidates = staging.write(
                self._typed(source).withColumn("place", F.row_number().over(first)).filter("place = 1").drop("place"),
                "candidates",
            )
            merged = staging.write(
                merge(self.read(self.months_of(candidates)), candidates, self.keys, keep_old=True), "merged"
            )
            rows = merged.agg(F.coalesce(F.sum("_inserted"), F.lit(0))).first()[0]
            if rows:
                self._write(merged)
            return rows

    def replace_months(self, source: DataFrame, is_staged: bool = False) -> None:
        """Replace the months that ``source`` holds by its rows; it is copied first unless the caller staged it."""
        with Staging(self.spark) as staging:
            staged = self._typed(source) if is_staged else staging.write(self._typed(source), "months")
            if not staged.isEmpty():
                self._write(staged)

    def overwrite(self, source: DataFrame) -> int:
        """Replace the whole table."""
        with Staging(self.spark) as staging:
            staged = staging.write(self._typed(source), "overwrite")
            self._write(staged, everything=True)
            return staged.count()

    def refill(self, source: DataFrame) -> None:
        """Replace the whole table by a source that does not read it, in one write: a failure leaves it empty."""
        self._write(self._typed(source), everything=True)

    def clear(self) -> None:
        """Empty the table."""
        self._write(self.spark.createDataFrame([], self.schema), everything=True)


# surrogate keys -----------------------------------------------------------


def number_rows(df: DataFrame, key: list[str], start: Column, name: str) -> DataFrame:
    """Consecutive numbers from ``start`` in the order of the (unique) key.

    The rows are staged in ranges of the key, as many as Spark makes of the input; each
    range is offset by the sizes of those before it, so no task ever sees all rows.
    """
    ranged = stage(df.repartitionByRange(*key).withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    # One row per task that wrote the ranges.
    before = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    within = Window.partitionBy("_range").orderBy(*key)
    return (
        ranged.withColumn("_place", F.row_number().over(within))
        .join(offsets, "_range")
        .withColumn(name, start + F.col("_before") + F.col("_place") - 1)
        .drop("_range", "_before", "_place")
    )


def assign_surrogate_keys(wells: DataFrame, existing: DataFrame) -> DataFrame:
    """Give every drillhole its known well_id or the next free one.

    ``wells`` must hold each source_dh_no once; ``existing`` is the stored table.
    """
    known = existing.select("well_id", "source_dh_no")
    next_id = known.agg((F.coalesce(F.max("well_id"), F.lit(0)) + 1).alias("next_id")).scalar()
    wells = stage(wells, "wells")
    fresh = wells.select("source_dh_no").join(known, "source_dh_no", "left_anti")
    ids = number_rows(fresh, ["source_dh_no"], next_id, "well_id").select(
        F.col("well_id").cast("int").alias("well_id"), "source_dh_no"
    )
    return wells.join(known.unionByName(ids), "source_dh_no").select(
        "well_id", *[c for c in wells.columns if c != "well_id"]
    )


def resolve_keys(readings: DataFrame, wells: DataFrame, unresolved: Observation | None = None) -> DataFrame:
    """Replace the drillhole number by the well_id; readings of unknown drillholes are dropped.

    ``unresolved`` observes how many those are, in the same pass.
    """
    ids = wells.select("source_dh_no", F.col("well_id").cast("int").alias("well_id"))
    joined = readings.drop("well_id").join(ids, "source_dh_no", "left")
    if unresolved is not None:
        joined = joined.observe(unresolved, F.count_if(F.col("well_id").isNull()).alias("unresolved"))
    return joined.filter(F.col("well_id").isNotNull()).select(
        "well_id", *[c for c in readings.columns if c not in ("source_dh_no", "well_id")]
    )


def unresolved_count(readings: DataFrame, wells: DataFrame) -> DataFrame:
    """Readings per drillhole number that no stored bore has."""
    return (
        readings.groupBy("source_dh_no").agg(F.count(F.lit(1)).alias("rows"))
        .join(wells.select("source_dh_no"), "source_dh_no", "left_anti")
    )


# events and whole-model loads ---------------------------------------------


def _null_if_nan(column: str) -> Column:
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value)


def insert_new_events(table: KeyedTable, detected: DataFrame, detected_at: Column | None = None) -> int:
    """Store detected events not stored before; returns how many were new.

    Only the months of the detected events are compared; the highest number in use comes
    from the id column alone.
    """
    keys = schemas.MERGE_KEYS["events"]
    with Staging(table.spark) as staging:
        rest = ["severity", "threshold_value", "actual_value", "detail"]
        first = Window.partitionBy(*keys).orderBy(*rest)
        once = staging.write(
            detected.withColumn("place", F.row_number().over(first)).filter("place = 1").drop("place"), "events"
        )
        next_id = table.read().agg((F.coalesce(F.max("event_id"), F.lit(0)) + 1).alias("next_id")).scalar()
        # A merge join: stored events grow with the bores, and their files are much smaller than their rows.
        fresh = once.join(table.read(table.months_of(once)).select(*keys).hint("merge"), keys, "left_anti")
        return table.insert_new(
            number_rows(fresh, keys, next_id, "event_id")
            .withColumns({
                "threshold_value": _null_if_nan("threshold_value"),
                "actual_value": _null_if_nan("actual_value"),
                "detected_at": F.current_timestamp() if detected_at is None else detected_at,
                "alert_sent": F.lit(0),
            })
        )


def reload_all(tables: dict[str, KeyedTable], frames: dict[str, DataFrame]) -> DataFrame:
    """Replace every table, parents before children; returns the broken references (none is good)."""
    # An emptied child can never point at a parent that is being replaced.
    for name in reversed(LOAD_ORDER):
        if name in tables:
            tables[name].clear()
    for name in LOAD_ORDER:
        if name in tables and name in frames:
            tables[name].refill(frames[name])
    current = {name: table.read() for name, table in tables.items()}
    return constraints.fk_violation_counts(current).filter(F.col("violations") > 0)


# audit and outputs ----------------------------------------------------------


def audit_append(
    spark: SparkSession, path: str, pipeline: str, run_id: str, status: str = "Failed",
    logged_at: dt.datetime | None = None,
) -> None:
    row = (pipeline, run_id, status, logged_at or dt.datetime.now(dt.timezone.utc))
    spark.createDataFrame([row], schemas.AUDIT).write.mode("append").parquet(path)


@dataclass(frozen=True)
class LoadResult:
    """Rows loaded, rows dropped for an unreadable day or an unknown key, and the outcome of each unit of the source.

    ``units`` (unit, rows, dropped, error) has a row per station, site or other part that was asked for.
    """

    rows: int
    dropped: int = 0
    unresolved: int = 0
    units: DataFrame | None = None


def run_sources(
    spark: SparkSession, loaders: dict[str, Callable[[], int | LoadResult]], audit_path: str, run_id: str
) -> tuple[DataFrame, int]:
    """Run every source's load; one failure is recorded and does not stop the others.

    Returns source, rows, dropped, unresolved and error per load and per unit of one (source/unit),
    and a process exit code. Sources and units that failed are recorded in the audit table.
    """
    schema = "source string, rows long, dropped long, unresolved long, error string"
    outcomes, units = [], []
    for source, load in loaders.items():
        try:
            result = load()
            result = result if isinstance(result, LoadResult) else LoadResult(int(result))
            outcomes.append((source, result.rows, result.dropped, result.unresolved, None))
            if result.units is not None:
                unit = F.concat(F.lit(f"{source}/"), "unit").alias("source")
                units.append(result.units.select(unit, "rows", "dropped", F.lit(0).cast("long").alias("unresolved"), "error"))
        except Exception as error:  # noqa: BLE001 - each source stands alone
            outcomes.append((source, None, None, None, str(error)))
            audit_append(spark, audit_path, source, run_id)
    frame = reduce(DataFrame.unionByName, units, spark.createDataFrame(outcomes, schema))
    if units:
        broken = frame.filter(F.col("error").isNotNull() & F.contains("source", F.lit("/")))
        broken.select(
            F.col("source").alias("pipeline_name"), F.lit(run_id).alias("run_id"), F.lit("Failed").alias("status"),
            F.current_timestamp().alias("logged_at"),
        ).write.mode("append").parquet(audit_path)
    return frame, int(any(error for *_, error in outcomes))


def write_output(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Write a result as CSV (with header), JSON or parquet, by as many tasks as it has partitions."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
