"""Full and incremental refresh of stored tables."""

import datetime as dt

import pytest
from conftest import HOTELS, event, rows, snapshot

from pyspark.sql import functions as F

from staymark.plans import gold, quality
from staymark.plans.refresh import BookingTables
from staymark.sinks import locations, tables

FIRST = [
    snapshot("a", "created", "2025-01-01T10:00", created="2025-01-01T10:00"),
    snapshot("b", "confirmed", "2025-01-02T10:00", created="2025-01-02T10:00", hotel="h2"),
]
LATER = [
    snapshot("a", "cancelled", "2025-01-05T10:00", created="2025-01-03T10:00"),
    snapshot("c", "created", "2025-01-05T10:00", created="2025-01-04T10:00"),
]
EVENTS = [
    event("b", "confirmed", "2025-01-02T11:00"),
    event("c", "confirmed", "2025-01-05T11:00"),
]
MARK = "2025-01-03 00:00:00"


@pytest.fixture
def stored(spark, frame, tmp_path):
    return BookingTables(
        spark,
        str(tmp_path / "tables"),
        frame("bookings", FIRST + LATER),
        frame("events", EVENTS),
        frame("hotels", HOTELS),
        as_of="2025-02-01",
    )


def test_full_refresh(stored):
    stored.full_refresh()
    once = rows(stored.gold())
    stored.full_refresh()
    assert rows(stored.gold()) == once
    assert rows(stored.silver(), "booking_id", "booking_status") == {
        ("a", "cancelled"),
        ("b", "confirmed"),
        ("c", "confirmed"),
    }
    assert quality.gate_verdict(stored.gate()).first()["approved"]


def test_incremental_refresh(stored, frame):
    stored.full_refresh(until=MARK)
    assert rows(stored.silver(), "booking_id") == {("a",), ("b",)}
    for _ in range(2):
        stored.incremental_refresh(MARK)
        # a keeps the day of its first load.
        assert rows(stored.silver(), "booking_id", "booking_status", "created_date") == {
            ("a", "cancelled", dt.date(2025, 1, 1)),
            ("b", "confirmed", dt.date(2025, 1, 2)),
            ("c", "confirmed", dt.date(2025, 1, 4)),
        }
        full = gold.daily_city_kpis(stored.silver(), frame("hotels", HOTELS), as_of="2025-02-01")
        assert rows(stored.gold()) == rows(full)
    assert quality.gate_verdict(stored.gate()).first()["approved"]


def test_staging_tables(stored, frame):
    stored.publish_staging()
    assert rows(stored.staged("stg_bookings").drop("created_date")) == set(FIRST + LATER)
    assert rows(stored.staged("stg_booking_events"), "booking_id", "event_date") == {
        ("b", dt.date(2025, 1, 2)),
        ("c", dt.date(2025, 1, 5)),
    }
    assert rows(stored.staged("stg_hotels")) == set(HOTELS)


def test_views(spark, stored):
    stored.full_refresh()
    stored.create_views()
    found = spark.sql(
        "SELECT s.booking_id FROM silver_bookings s JOIN stg_hotels h USING (hotel_id)"
        " WHERE h.city = 'Shiraz'"
    )
    assert rows(found) == {("b",)}
    assert spark.sql("SELECT sum(total_bookings) AS n FROM gold_daily_city_kpis").first()["n"] == 3


def test_backfill(stored):
    stored.full_refresh()
    want = rows(stored.gold())
    stored.backfill("2025-01-02", "2025-01-03")
    assert rows(stored.gold()) == want


def test_backfill_touches_its_range_only(spark, stored):
    """Gold that is stale everywhere is mended inside the range and stays stale outside."""
    stored.full_refresh()
    good = rows(stored.gold())
    stale = stored.gold().withColumn("total_bookings", F.lit(99).cast("long"))
    tables.publish(locations.written(stale, "stale"), stored.gold_root, partition_by=["booking_date"])
    stored.backfill("2025-01-02", "2025-01-03")
    for row in stored.gold().collect():
        inside = dt.date(2025, 1, 2) <= row["booking_date"] <= dt.date(2025, 1, 3)
        assert (tuple(row) in good) == inside and (row["total_bookings"] == 99) != inside


def test_empty_delta_changes_nothing(spark, stored, tmp_path):
    stored.full_refresh()
    files = {p for p in (tmp_path / "tables").rglob("*.parquet")}
    stored.incremental_refresh("2030-01-01 00:00:00")
    assert {p for p in (tmp_path / "tables").rglob("*.parquet")} == files
