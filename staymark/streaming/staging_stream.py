"""Staged events kept current from a stream that delivers some of them again.

The state holds the events of the last ``delay`` of event time and no older ones, so it does not
grow with the history. That bounds what the stream can know: an event that comes again, or comes
at all, more than ``delay`` after the newest one seen is dropped as late and counted in the
query's progress (numRowsDroppedByWatermark). Events without a time are outside any watermark;
they are told apart by booking and type, in a state of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from staymark.plans.staging import EVENT_KEY


def unrepeated_events(events: DataFrame, delay: str) -> DataFrame:
    """A stream of typed events, each once, as long as copies come within ``delay``."""
    timed = (
        events.where(F.col("event_ts").isNotNull())
        # A watermark needs a zoned time; the session's zone is UTC, so it is the same one.
        .withColumn("_at", F.col("event_ts").cast("timestamp"))
        .withWatermark("_at", delay)
        .dropDuplicatesWithinWatermark(list(EVENT_KEY))
        .drop("_at")
    )
    untimed = events.where(F.col("event_ts").isNull()).dropDuplicates(["booking_id", "event_type"])
    return timed.unionByName(untimed)


def start_event_stream(
    events: DataFrame, path: str, checkpoint: str, *, delay: str = "30 days", trigger: dict | None = None
) -> StreamingQuery:
    """Append the events of a stream to the Parquet table at ``path``, each exactly once."""
    return (
        unrepeated_events(events, delay)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )
