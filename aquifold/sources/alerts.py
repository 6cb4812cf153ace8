"""Alerts through a queue and an outbox, so that a poll works on what is new.

Beside the events a folder holds ``unsent``, the critical events nobody was alerted to, and
``outbox``, the messages by event id. A poll reads the queue, writes its messages, marks the events
in just their months and empties the queue. Every step overwrites by key: a poll that was cut off
is finished by the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aquifold import schemas
from aquifold.operators import views
from aquifold.session import Staging
from aquifold.sources.store import KeyedTable

#: Messages of so many consecutive event ids share a part of the outbox.
_IDS_PER_PART = 100_000


class AlertQueue:
    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.events = KeyedTable.named(spark, folder, "events")
        self.unsent = KeyedTable(spark, f"{folder}/unsent", schemas.EVENTS, schemas.MERGE_KEYS["events"])
        part = F.floor(F.col("event_id") / _IDS_PER_PART).cast("string")
        self.outbox = KeyedTable(spark, f"{folder}/outbox", schemas.MESSAGES, ["event_id"], part=part)

    def insert(self, events: DataFrame) -> int:
        """Store events not stored before and queue those of them, or of a load cut off before, that need an alert."""
        with Staging(self.spark) as staging:
            staged = staging.write(events.select(*schemas.names(schemas.EVENTS)), "arrived")
            added = self.events.insert_new(staged)
            self.queue(staged)
            return added

    def queue(self, events: DataFrame) -> int:
        """Queue the stored rows of ``events`` that are critical and unsent; only the events' months are read."""
        keys = schemas.MERGE_KEYS["events"]
        stored = self.events.read(self.events.months_of(events))
        waiting = stored.filter((F.col("severity") == "CRITICAL") & (F.col("alert_sent") == 0))
        return self.unsent.upsert(waiting.join(events.select(*keys).hint("merge"), keys, "left_semi"))

    def send(self, wells: DataFrame) -> int:
        """Write the queued events' messages and mark them as sent; events of unknown bores stay queued."""
        with Staging(self.spark) as staging:
            waiting = staging.write(self.unsent.read(), "waiting")
            messages = staging.write(views.alert_messages(views.critical_events_to_send(waiting, wells)), "messages")
            sent = self.outbox.upsert(messages)
            if sent:
                done = messages.select("event_id").hint("merge")
                self.events.upsert(views.mark_alerted(waiting.join(done, "event_id", "left_semi"), done))
                self.unsent.overwrite(waiting.join(done, "event_id", "left_anti"))
            return sent
