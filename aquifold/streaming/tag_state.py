"""Live tag state: the last value of every tag of every bore, kept in a keyed state store.

Each micro-batch touches only the bores it has notifications of, and emits only those whose state
changed. The changes go to an append-only log of Parquet files, one folder a batch, so what a
batch writes follows its changes and not the fleet. Reading the log gives each bore's last row.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from aquifold import schemas
from aquifold.session import Staging, delete_folder
from aquifold.streaming.tags import FIELDS, parse_tags

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# A bore's state: its last update, and per field (and the location) the value with the time and id that set it.
# Times are microseconds.
_SLOTS = ["location", *FIELDS]
_STATE = "last_update bigint, " + ", ".join(f"{s} string, {s}_ts bigint, {s}_id bigint" for s in _SLOTS)
_CHANGES = "well_id int, " + ", ".join(f"{s} string" for s in _SLOTS) + ", last_update bigint"


def _order(*parts: int | None) -> list[tuple[bool, int]]:
    """Event time and event id as something to compare, missing ones first."""
    return [(p is not None, p or 0) for p in parts]


class LastValues(StatefulProcessor):
    """Newest value of every field of one bore, by event time, then by event id."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._state = handle.getValueState("last", _STATE)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        before = self._state.get()
        names = ["last_update", *[f"{s}{part}" for s in _SLOTS for part in ("", "_ts", "_id")]]
        state = dict(zip(names, before)) if before is not None else dict.fromkeys(names)
        known = {s for s in _SLOTS if state[f"{s}_ts"] is not None or state[f"{s}_id"] is not None}
        for row in rows:
            for slot, value in (("location", row["location"]), (row["field"], row["value"])):
                if slot not in known or _order(row["ts"], row["event_id"]) > _order(
                    state[f"{slot}_ts"], state[f"{slot}_id"]
                ):
                    known.add(slot)
                    state[slot], state[f"{slot}_ts"], state[f"{slot}_id"] = value, row["ts"], row["event_id"]
            if row["ts"] is not None and (state["last_update"] is None or row["ts"] > state["last_update"]):
                state["last_update"] = row["ts"]
        after = tuple(state[n] for n in names)
        if before is None or after != tuple(before):
            self._state.update(after)
        shown = ["last_update", *_SLOTS]
        if before is None or any(state[n] != dict(zip(names, before))[n] for n in shown):
            yield Row(well_id=key[0], **{s: state[s] for s in _SLOTS}, last_update=state["last_update"])

    def close(self) -> None:
        pass


def tag_changes(tag_events: DataFrame) -> DataFrame:
    """Stream of the bores whose state changed in a micro-batch, with all their fields."""
    tags = parse_tags(tag_events).withColumn("ts", F.unix_micros("ts"))
    changes = tags.groupBy("well_id").transformWithState(LastValues(), _CHANGES, "Update", "None")
    numbers = {f: F.col(f).try_cast("double") for f in FIELDS if f != "quality"}
    changes = changes.withColumns(numbers).withColumn("last_update", F.timestamp_micros("last_update"))
    return changes.select(*schemas.names(schemas.TAG_STATE))


@contextmanager
def _state_store(spark: SparkSession) -> Iterator[None]:
    """Queries started here keep their state in the embedded store, which processors with state need."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


class ChangeLog:
    """Changed rows by batch under ``root``; the row of the highest batch is a bore's current one.

    ``compact`` folds the log into one folder once it holds more than twice as many rows as there
    are bores, so that compaction too writes in proportion to the changes.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def append(self, changes: DataFrame, batch: int) -> None:
        """Write one batch's changes; a repeated batch replaces its own folder."""
        (
            changes.withColumn("batch", F.lit(batch).cast("bigint"))
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(self.root)
        )

    def _rows(self) -> DataFrame:
        schema = T.StructType([*schemas.TAG_STATE.fields, T.StructField("batch", T.LongType())])
        try:
            return self.spark.read.schema(schema).parquet(self.root)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def read(self) -> DataFrame:
        rest = [c for c in schemas.names(schemas.TAG_STATE) if c != "well_id"]
        newest = self._rows().groupBy("well_id").agg(F.max_by(F.struct(*rest), "batch").alias("row"))
        return newest.select("well_id", "row.*")

    def compact(self) -> bool:
        """Fold the log into the folder of its last batch if it pays; not while somebody reads it."""
        rows = self._rows()
        held, bores = rows.agg(F.count(F.lit(1)), F.countDistinct("well_id")).first()
        if held <= 2 * bores:
            return False
        batches = sorted(r[0] for r in rows.select("batch").distinct().collect())
        with Staging(self.spark) as staging:
            self.append(staging.write(self.read(), "compacted"), batches[-1])
        for batch in batches[:-1]:
            delete_folder(self.spark, f"{self.root}/batch={batch}")
        return True


def start_tag_state(
    tag_events: DataFrame, log: ChangeLog, checkpoint: str, trigger: dict | None = None, compact_every: int = 100
) -> StreamingQuery:
    """Keep the last value of every tag; changed bores go to ``log``, which is compacted now and then."""
    def apply(changes: DataFrame, batch: int) -> None:
        log.append(changes, batch)
        if batch % compact_every == compact_every - 1:
            log.compact()

    with _state_store(log.spark):
        return (
            tag_changes(tag_events).writeStream.outputMode("update").option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "1 minute"})).foreachBatch(apply).start()
        )
