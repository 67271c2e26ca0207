"""Silver: one reconciled row per booking, from CDC snapshots and the event log.

Both inputs are cut to one row per booking, mostly before their only shuffle, and
then joined on the partitioning they already have. The inputs may be the staged
tables or merely typed ones: staging keeps the first row of each duplicate group
in the same total order the latest snapshot is chosen by, and duplicate events
change no maximum, so both give the same result and the typed ones save a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staymark.functions.columns import (
    audit_time,
    known_to_differ,
    later_of,
    resolve_status,
    status_rank,
)
from staymark.operators.rows import first_per_key, rank_struct
from staymark.plans.staging import SNAPSHOT_TIES
from staymark.schemas import SILVER_COLUMNS
from staymark.statuses import DEFAULT_STATUSES, StatusModel


# Feed columns that silver names after the source they come from.
_SNAPSHOT_NAMES = {"status": "snapshot_status", "updated_at": "snapshot_updated_at"}


def _claim(status: str, model: StatusModel, name: str) -> Column:
    """Strongest terminal status among the rows of a group, with its strength in front."""
    # `terminal` lists the strongest claim first.
    strength = status_rank(F.col(status), model.terminal[::-1])
    claim = F.struct(strength.alias("strength"), F.col(status).alias("claim"))
    return F.max(F.when(F.col(status).isin(*model.terminal), claim)).alias(name)


def latest_snapshot(bookings: DataFrame, claims: StatusModel | None = None) -> DataFrame:
    """The current snapshot of every booking; with ``claims``, also the strongest terminal
    status of any of its snapshots, as ``_snapshot_claim``."""
    more = [] if claims is None else [_claim("status", claims, "_snapshot_claim")]
    return (
        first_per_key(bookings, ["booking_id"], newest="updated_at", ties=SNAPSHOT_TIES, also=more)
        .select("booking_id", *SNAPSHOT_TIES, "updated_at", *(["_snapshot_claim"] if more else []))
        .withColumnsRenamed(_SNAPSHOT_NAMES)
    )


def _event_rank(model: StatusModel) -> Column:
    """An event as a struct that is greatest for the latest one; a NULL time sorts lowest."""
    return F.struct(
        F.col("event_ts").alias("ts"),
        status_rank(F.col("event_type"), model.domain).alias("strength"),
        F.col("event_type").alias("type"),
    )


def _last_seen(model: StatusModel) -> list[Column]:
    return [
        F.max(F.when(F.col("event_type") == status, F.col("event_ts"))).alias(
            f"event_{status}_at"
        )
        for status in model.domain
    ]


def _event_columns(model: StatusModel) -> list[Column | str]:
    return [
        F.col("_newest.type").alias("event_status"),
        F.col("_newest.ts").alias("event_updated_at"),
        *[f"event_{status}_at" for status in model.domain],
    ]


def event_state(
    events: DataFrame, model: StatusModel = DEFAULT_STATUSES, *, claims: bool = False
) -> DataFrame:
    """Latest event and last time of every event type per booking, in one pass; with
    ``claims``, also the strongest terminal status of any event, as ``_event_claim``."""
    more = [_claim("event_type", model, "_event_claim")] if claims else []
    return (
        events.groupBy("booking_id")
        .agg(F.max(_event_rank(model)).alias("_newest"), *_last_seen(model), *more)
        .select("booking_id", *_event_columns(model), *(["_event_claim"] if claims else []))
    )


def snapshot_with_events(
    bookings: DataFrame,
    events: DataFrame,
    model: StatusModel = DEFAULT_STATUSES,
    *,
    claims: bool = False,
) -> DataFrame:
    """Every booking's snapshot beside its event state, if it has events."""
    snapshots = latest_snapshot(bookings, model if claims else None)
    return snapshots.join(event_state(events, model, claims=claims), "booking_id", "left")


def stacked_state(
    bookings: DataFrame,
    events: DataFrame,
    model: StatusModel = DEFAULT_STATUSES,
    *,
    days: bool = False,
) -> DataFrame:
    """``snapshot_with_events`` as one aggregate over both feeds stacked.

    Works on streams, where it keeps one row of state per booking and needs neither a
    window nor a join. Events without a key match no snapshot and are left out. With
    ``days``, ``_days`` are the days (NULL included) that any snapshot of the booking was created on.
    """
    day = F.when(F.col("_snapshot"), F.struct(F.to_date("created_at").alias("day")))
    seen = [F.collect_set(day).alias("_days")] if days else []
    stacked = bookings.withColumn("_snapshot", F.lit(True)).unionByName(
        events.where(F.col("booking_id").isNotNull()).withColumn("_event", F.lit(True)),
        allowMissingColumns=True,
    )
    snapshot_rank = rank_struct([*SNAPSHOT_TIES, "updated_at"], "updated_at")
    return (
        stacked.groupBy("booking_id")
        .agg(
            F.min(F.when(F.col("_snapshot"), snapshot_rank)).alias("_first"),
            F.max(F.when(F.col("_event"), _event_rank(model))).alias("_newest"),
            *_last_seen(model),
            *seen,
        )
        .where(F.col("_first").isNotNull())
        .select(
            "booking_id",
            *[F.col(f"_first.{c}").alias(c) for c in (*SNAPSHOT_TIES, "updated_at")],
            *_event_columns(model),
            *(["_days"] if days else []),
        )
        .withColumnsRenamed(_SNAPSHOT_NAMES)
    )


def reconcile_state(
    combined: DataFrame, model: StatusModel = DEFAULT_STATUSES, *, as_of: str | None = None
) -> DataFrame:
    """The silver columns of ``combined`` (see ``snapshot_with_events``), plus its own."""
    snapshot, event = F.col("snapshot_status"), F.col("event_status")
    snapshot_ts, event_ts = F.col("snapshot_updated_at"), F.col("event_updated_at")
    return combined.withColumns(
        {
            "booking_status": resolve_status(
                snapshot, event, snapshot_ts, event_ts, model.terminal
            ),
            **{
                column: F.col(f"event_{status}_at")
                for status, column in model.milestones.items()
            },
            "last_updated_at": later_of(snapshot_ts, event_ts),
            "_raw_snapshot_status": snapshot,
            "_raw_event_status": event,
            "_had_conflict": known_to_differ(snapshot, event),
            "_loaded_at": audit_time(as_of),
        }
    )


def silver_columns(model: StatusModel = DEFAULT_STATUSES) -> list[str]:
    """Silver column names; a model with more milestones adds theirs at the end."""
    extra = [c for c in model.milestones.values() if c not in SILVER_COLUMNS]
    return [*SILVER_COLUMNS, *extra]


def silver_bookings(
    bookings: DataFrame,
    events: DataFrame,
    model: StatusModel = DEFAULT_STATUSES,
    *,
    as_of: str | None = None,
    terminal: str = "latest",
) -> DataFrame:
    """One row per booking that has a snapshot.

    ``terminal="latest"`` guards a terminal status only while it is the latest
    word of one source. ``terminal="ever"`` keeps it once any snapshot or event
    has said so.
    """
    if terminal not in ("latest", "ever"):
        raise ValueError(f"terminal must be 'latest' or 'ever', not {terminal!r}")
    ever = terminal == "ever"
    combined = snapshot_with_events(bookings, events, model, claims=ever)
    silver = reconcile_state(combined, model, as_of=as_of)
    if ever:
        claim = F.greatest("_snapshot_claim", "_event_claim")
        silver = silver.withColumn("booking_status", F.coalesce(claim["claim"], "booking_status"))
    return silver.select(*silver_columns(model))
