"""Declared table schemas.

Timestamps carry no zone and mean UTC, so every timestamp is TIMESTAMP_NTZ: a
cast to DATE then never depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import types as T

PRICE = T.DecimalType(10, 2)
# SUM(DECIMAL(10,2)) widens to this; it holds 10^18, where DECIMAL(14,2) would
# overflow on one very large (day, city) group.
REVENUE = T.DecimalType(20, 2)
NTZ = T.TimestampNTZType()


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


BOOKINGS_RAW = _table(
    booking_id=T.StringType(),
    user_id=T.StringType(),
    hotel_id=T.StringType(),
    status=T.StringType(),
    price=PRICE,
    created_at=NTZ,
    updated_at=NTZ,
)
BOOKING_EVENTS_RAW = _table(
    booking_id=T.StringType(),
    event_type=T.StringType(),
    event_ts=NTZ,
)
HOTELS_RAW = _table(
    hotel_id=T.StringType(),
    city=T.StringType(),
    star_rating=T.IntegerType(),
)
SILVER_BOOKINGS = _table(
    booking_id=T.StringType(),
    user_id=T.StringType(),
    hotel_id=T.StringType(),
    booking_status=T.StringType(),
    price=PRICE,
    created_at=NTZ,
    confirmed_at=NTZ,
    cancelled_at=NTZ,
    last_updated_at=NTZ,
    _raw_snapshot_status=T.StringType(),
    _raw_event_status=T.StringType(),
    _had_conflict=T.BooleanType(),
    _loaded_at=NTZ,
)
GOLD_DAILY_CITY_KPIS = _table(
    booking_date=T.DateType(),
    city=T.StringType(),
    total_bookings=T.LongType(),
    confirmed_bookings=T.LongType(),
    cancelled_bookings=T.LongType(),
    pending_bookings=T.LongType(),
    cancellation_rate=T.DoubleType(),
    total_confirmed_revenue=REVENUE,
    avg_booking_price=PRICE,
    avg_confirmed_price=PRICE,
    _computed_at=NTZ,
)

SILVER_COLUMNS = SILVER_BOOKINGS.fieldNames()
GOLD_COLUMNS = GOLD_DAILY_CITY_KPIS.fieldNames()
