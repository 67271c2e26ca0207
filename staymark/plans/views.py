"""Staging as views of the catalog, written in SQL over the tables of the raw feeds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from staymark.plans.staging import EVENT_KEY, HOTEL_TIES, SNAPSHOT_TIES


def _first_per_key(source: str, columns: Sequence[str], keys: Sequence[str], ties: Sequence[str]) -> str:
    """The first row of each key by ``ties``, NULLs last, as an aggregate."""
    named = ", ".join(f"'no_{c}', {c} IS NULL, '{c}', {c}" for c in ties)
    shown = ", ".join(c if c in keys else f"first_row.{c} AS {c}" for c in columns)
    key = ", ".join(keys)
    return (
        f"SELECT {shown} FROM (SELECT {key}, min(named_struct({named})) AS first_row"
        f" FROM {source} GROUP BY {key})"
    )


def staging_views(database: str) -> dict[str, str]:
    """View name -> its SQL, over bookings_raw, booking_events_raw and hotels_raw there."""
    bookings = f"""(SELECT booking_id, user_id, hotel_id, status, CAST(price AS DECIMAL(10,2)) AS price,
      CAST(created_at AS TIMESTAMP_NTZ) AS created_at, CAST(updated_at AS TIMESTAMP_NTZ) AS updated_at
    FROM {database}.bookings_raw)"""
    events = f"""(SELECT booking_id, event_type, CAST(event_ts AS TIMESTAMP_NTZ) AS event_ts
    FROM {database}.booking_events_raw)"""
    hotels = f"(SELECT hotel_id, city, CAST(star_rating AS INT) AS star_rating FROM {database}.hotels_raw)"
    booking_columns = ("booking_id", *SNAPSHOT_TIES, "updated_at")
    return {
        "stg_bookings": _first_per_key(bookings, booking_columns, ("booking_id", "updated_at"), SNAPSHOT_TIES),
        "stg_booking_events": f"SELECT DISTINCT {', '.join(EVENT_KEY)} FROM {events}",
        "stg_hotels": _first_per_key(hotels, ("hotel_id", *HOTEL_TIES), ("hotel_id",), HOTEL_TIES),
    }


def create_staging_views(spark: SparkSession, database: str) -> None:
    """Create or replace the views in a database that has the raw tables."""
    for name, query in staging_views(database).items():
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {query}")
