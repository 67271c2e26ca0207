"""Staging: explicit types and exact-duplicate removal, no business rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staymark.operators.rows import distinct_rows, first_per_key
from staymark.schemas import NTZ, PRICE

# Total order among snapshots of one booking with the same update time.
SNAPSHOT_TIES = ("user_id", "hotel_id", "status", "price", "created_at")
HOTEL_TIES = ("city", "star_rating")
EVENT_KEY = ("booking_id", "event_type", "event_ts")


def typed_bookings(raw: DataFrame) -> DataFrame:
    return raw.select(
        "booking_id",
        "user_id",
        "hotel_id",
        "status",
        F.col("price").cast(PRICE).alias("price"),
        F.col("created_at").cast(NTZ).alias("created_at"),
        F.col("updated_at").cast(NTZ).alias("updated_at"),
    )


def typed_events(raw: DataFrame) -> DataFrame:
    return raw.select("booking_id", "event_type", F.col("event_ts").cast(NTZ).alias("event_ts"))


def typed_hotels(raw: DataFrame) -> DataFrame:
    return raw.select("hotel_id", "city", F.col("star_rating").cast("int").alias("star_rating"))


def stg_bookings(raw: DataFrame) -> DataFrame:
    """One row per (booking_id, updated_at)."""
    return first_per_key(
        typed_bookings(raw), ["booking_id", "updated_at"], ties=SNAPSHOT_TIES
    )


def stg_booking_events(raw: DataFrame) -> DataFrame:
    """One row per (booking_id, event_type, event_ts)."""
    return distinct_rows(typed_events(raw), EVENT_KEY)


def stg_hotels(raw: DataFrame) -> DataFrame:
    """One row per hotel_id."""
    return first_per_key(typed_hotels(raw), ["hotel_id"], ties=HOTEL_TIES)
