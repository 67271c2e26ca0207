"""The streamed silver table ends up equal to the batch build."""

import random

import pytest
from conftest import at, event, rows, snapshot
from pyspark.sql import types as T
from test_silver import _random_feeds

from staymark import schemas
from staymark.plans import silver, staging
from staymark.sinks.day_index import DayIndex
from staymark.sinks.tables import read_table, with_day, write_table
from staymark.streaming.silver_stream import create_empty_silver, start_silver_stream
from staymark.streaming.staging_stream import start_event_stream

AS_OF = "2025-02-01 00:00:00"
TABLE = T.StructType(
    [*schemas.SILVER_BOOKINGS.fields, T.StructField("created_date", T.DateType())]
)


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
def test_any_arrival_order(spark, frame, tmp_path, broadcast_bytes):
    snapshots, events = _random_feeds(5, bookings=60)
    rng = random.Random(0)
    path = str(tmp_path / "silver")
    create_empty_silver(spark, path, schemas.SILVER_BOOKINGS)
    assert read_table(spark, path, TABLE).isEmpty()

    def run():
        query = start_silver_stream(
            spark.readStream.schema(schemas.BOOKINGS_RAW).parquet(str(tmp_path / "in-bookings")),
            spark.readStream.schema(schemas.BOOKING_EVENTS_RAW).parquet(str(tmp_path / "in-events")),
            path,
            str(tmp_path / "checkpoint"),
            schemas.SILVER_BOOKINGS,
            as_of=AS_OF,
            broadcast_bytes=broadcast_bytes,
            trigger={"availableNow": True},
        )
        query.awaitTermination()
        assert query.exception() is None

    parts = 3
    for part in range(parts):
        for name, kind, feed in (("in-bookings", "bookings", snapshots), ("in-events", "events", events)):
            fresh = feed[part::parts]
            rng.shuffle(fresh)
            frame(kind, fresh).coalesce(1).write.mode("append").parquet(str(tmp_path / name))
        run()
    run()  # nothing new

    batch = silver.silver_bookings(
        frame("bookings", snapshots), frame("events", events), as_of=AS_OF
    )
    table = read_table(spark, path, TABLE)
    assert rows(table.drop("created_date")) == rows(batch)
    assert all(
        (c is None and d is None) or c.date() == d
        for c, d in table.select("created_at", "created_date").collect()
    )


def start(spark, tmp_path, path, **options):
    query = start_silver_stream(
        spark.readStream.schema(schemas.BOOKINGS_RAW).parquet(str(tmp_path / "in-bookings")),
        spark.readStream.schema(schemas.BOOKING_EVENTS_RAW).parquet(str(tmp_path / "in-events")),
        path,
        str(tmp_path / "checkpoint"),
        schemas.SILVER_BOOKINGS,
        as_of=AS_OF,
        trigger={"availableNow": True},
        **options,
    )
    query.awaitTermination()


def test_a_batch_reads_only_the_days_of_its_bookings(spark, frame, tmp_path):
    """A booking moves to another day; a day that no booking of the batch is on is unreadable."""
    path = str(tmp_path / "silver")
    create_empty_silver(spark, path, schemas.SILVER_BOOKINGS)
    frame("events", [event("b1", "confirmed", "2025-01-09T10:00")]).write.parquet(str(tmp_path / "in-events"))
    first = [snapshot(f"b{n}", "created", f"2025-01-0{n}T11:00", created=f"2025-01-0{n}T10:00") for n in (1, 2, 3)]
    frame("bookings", first).write.parquet(str(tmp_path / "in-bookings"))
    start(spark, tmp_path, path)
    for file in (tmp_path / "silver" / "created_date=2025-01-02").iterdir():
        file.unlink() if file.suffix == ".crc" else file.write_bytes(b"no parquet")
    moved = [snapshot("b1", "created", "2025-01-08T11:00", created="2025-01-05T10:00")]
    frame("bookings", moved).write.mode("append").parquet(str(tmp_path / "in-bookings"))
    start(spark, tmp_path, path)
    table = read_table(spark, path, TABLE).where("created_date <> DATE'2025-01-02'")
    assert rows(table, "booking_id", "created_at") == {
        ("b1", at("2025-01-05T10:00")),
        ("b3", at("2025-01-03T10:00")),
    }


def test_a_table_begun_before_the_stream_needs_its_index(spark, frame, tmp_path):
    path = str(tmp_path / "silver")
    old = silver.silver_bookings(frame("bookings", [snapshot("b1", "created", "10:00")]), frame("events", []), as_of=AS_OF)
    write_table(with_day(old, "created_at", "created_date"), path, partition_by=["created_date"])
    index = DayIndex(spark, str(tmp_path / "index"))
    index.build(read_table(spark, path, TABLE), "created_date")
    frame("events", []).write.parquet(str(tmp_path / "in-events"))
    moved = [snapshot("b1", "confirmed", "2025-01-02T10:00", created="2025-01-02T09:00")]
    frame("bookings", moved).write.parquet(str(tmp_path / "in-bookings"))
    start(spark, tmp_path, path, index=index)
    assert rows(read_table(spark, path, TABLE), "booking_id", "booking_status") == {("b1", "confirmed")}
    assert rows(index.entries(), "day") == {(at("10:00").date(),), (at("2025-01-02T09:00").date(),)}


def test_events_are_staged_once(spark, frame, tmp_path):
    """Copies within a delivery and across, restarts, and rows without time or booking."""
    first = [event("b1", "created", "10:00"), event("b1", "created", "10:00"), event(None, "created", None),
             event("b2", None, "10:30")]
    second = [event("b1", "created", "10:00"), event("b2", None, "10:30"), event(None, "created", None),
              event(None, None, None), event("b3", "created", "2025-01-02T10:00")]
    # Hours behind the watermark by then: dropped as late, not kept twice.
    late = [event("b1", "created", "10:00")]
    for delivery in (first, second, [], late):
        frame("events", delivery).write.mode("append").parquet(str(tmp_path / "in"))
        source = spark.readStream.schema(schemas.BOOKING_EVENTS_RAW).parquet(str(tmp_path / "in"))
        query = start_event_stream(
            source, str(tmp_path / "out"), str(tmp_path / "state"), delay="12 hours", trigger={"availableNow": True}
        )
        query.awaitTermination()
        assert query.exception() is None
    found = spark.read.schema(schemas.BOOKING_EVENTS_RAW).parquet(str(tmp_path / "out"))
    assert rows(found) == rows(staging.stg_booking_events(frame("events", [*first, *second])))
