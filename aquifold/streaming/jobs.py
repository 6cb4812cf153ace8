"""Streaming jobs: each micro-batch applies a batch operator to what arrived.

All sinks are keyed, so a batch repeated after a failure changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from aquifold.plans import detection
from aquifold.plans.ingest import load
from aquifold.sources import landed
from aquifold.sources.alerts import AlertQueue
from aquifold.sources.store import KeyedTable
from aquifold.sources.summaries import SummarisedStore
from aquifold.streaming import tags as tag_ops


def file_stream(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Stream of the Parquet files that land at ``path``, with their arrival time; CSV streams start at ``landed.csv_lines``."""
    return spark.readStream.schema(schema).parquet(path).select("*", landed.arrival_time())


def _start(
    stream: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str, mode: str, trigger: dict
) -> StreamingQuery:
    return (
        stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
        .trigger(**trigger).foreachBatch(apply).start()
    )


def start_telemetry_windows(
    tag_events: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Append each closed telemetry window to the files at ``path``."""
    return (
        tag_ops.telemetry_window(tag_ops.parse_tags(tag_events))
        .writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
        .option("path", path).trigger(**(trigger or {"processingTime": "1 minute"})).start()
    )


def start_alerts(
    event_stream: DataFrame, alerts: AlertQueue, wells: DataFrame, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Store arriving events and alert on unsent critical ones, every 15 minutes by default."""
    def apply(batch: DataFrame, _: int) -> None:
        alerts.insert(batch)
        alerts.send(wells)

    return _start(event_stream, apply, checkpoint, "append", trigger or {"processingTime": "15 minutes"})


def start_detection(
    reading_stream: DataFrame, stored: SummarisedStore, wells: DataFrame, events: KeyedTable, checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Load arriving readings, merge them into the bores' summaries, run the detectors and store what is new."""
    def apply(batch: DataFrame, _: int) -> None:
        stored.load_readings(batch)
        detection.detect_and_store(stored, wells, events)

    return _start(reading_stream, apply, checkpoint, "append", trigger or {"availableNow": True})


def start_ingest(
    raw_stream: DataFrame, normalise: Callable[[DataFrame], DataFrame], target: KeyedTable, checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Normalise arriving files and upsert them on the table's key.

    For CSV the stream is one of lines and ``normalise`` starts with ``landed.by_header``: a file
    arrives whole in one batch, so each batch has the headers of all its lines. A key delivered by several files of one batch takes the value that arrived last.
    """
    return _start(
        raw_stream, lambda batch, _: load(target, normalise(batch)), checkpoint, "append",
        trigger or {"availableNow": True},
    )
