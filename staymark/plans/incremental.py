"""Incremental refresh: bookings past a high-water mark, merged into silver and gold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staymark.operators.merge import merge_upsert
from staymark.operators.rows import distinct_rows, rows_with, rows_without
from staymark.operators.sizing import BROADCAST_BYTES, broadcast_if_fits, fits_broadcast
from staymark.plans.gold import daily_city_kpis
from staymark.plans.silver import reconcile_state, silver_columns, snapshot_with_events
from staymark.schemas import NTZ
from staymark.sinks.locations import written
from staymark.statuses import DEFAULT_STATUSES, StatusModel

# What a matched booking keeps from its first load.
KEPT_ON_MATCH = ("booking_id", "user_id", "hotel_id", "created_at")


def changed_bookings(bookings: DataFrame, events: DataFrame, mark: str) -> DataFrame:
    """Ids with any snapshot or event past ``mark``."""
    since = F.lit(mark).cast(NTZ)
    return distinct_rows(
        bookings.where(F.col("updated_at") > since)
        .select("booking_id")
        .unionByName(events.where(F.col("event_ts") > since).select("booking_id")),
        ["booking_id"],
    )


def silver_delta(
    bookings: DataFrame,
    events: DataFrame,
    mark: str,
    model: StatusModel = DEFAULT_STATUSES,
    *,
    as_of: str | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Silver rows of the bookings whose latest snapshot or event is past ``mark``.

    If the changed ids are measured to fit, they are broadcast and the history of
    all other bookings is dropped before the shuffle. If not, the whole history is
    reconciled and then filtered. The ids are found once, and written.
    """
    since = F.lit(mark).cast(NTZ)
    changed = changed_bookings(bookings, events, mark)
    if broadcast_bytes > 0:
        changed = written(changed, "changed")
    if fits_broadcast(changed, broadcast_bytes):
        ids = F.broadcast(changed)
        bookings = rows_with(bookings, ids, "booking_id")
        events = rows_with(events, ids, "booking_id")
    return (
        reconcile_state(snapshot_with_events(bookings, events, model), model, as_of=as_of)
        .where((F.col("snapshot_updated_at") > since) | (F.col("event_updated_at") > since))
        .select(*silver_columns(model))
    )


def merge_silver(
    target: DataFrame,
    delta: DataFrame,
    *,
    broadcast_bytes: int = BROADCAST_BYTES,
    check_source: bool = True,
) -> DataFrame:
    """Silver after merging ``delta`` into it by booking_id and last_updated_at."""
    return merge_upsert(
        target,
        delta,
        "booking_id",
        "last_updated_at",
        [c for c in target.columns if c not in KEPT_ON_MATCH],
        broadcast_bytes=broadcast_bytes,
        check_source=check_source,
    )


def affected_days(
    target: DataFrame, delta: DataFrame, *, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Reporting days, old and new, of the bookings in ``delta``: one ``day`` column."""
    ids = broadcast_if_fits(delta.select("booking_id"), broadcast_bytes)
    day = F.to_date("created_at").alias("day")
    old = rows_with(target, ids, "booking_id").select(day)
    return distinct_rows(old.unionByName(delta.select(day)), ["day"])


def refresh_gold(
    gold: DataFrame,
    silver: DataFrame,
    hotels: DataFrame,
    days: DataFrame,
    model: StatusModel = DEFAULT_STATUSES,
    *,
    as_of: str | None = None,
    hotels_bound: DataFrame | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``gold`` with the given ``days`` computed anew from ``silver``.

    Rows of other days are kept as they are. A day without bookings disappears.
    """
    days = broadcast_if_fits(days, broadcast_bytes)
    kept = rows_without(gold, days, "booking_date")
    touched = rows_with(
        silver.withColumn("_day", F.to_date("created_at")), days, "_day"
    ).drop("_day")
    renewed = daily_city_kpis(
        touched,
        hotels,
        model,
        as_of=as_of,
        hotels_bound=hotels_bound,
        broadcast_bytes=broadcast_bytes,
    )
    return kept.unionByName(renewed)
