"""Column expressions shared by the jobs. All are built-in Spark expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from staymark.schemas import NTZ, PRICE


def utc_now() -> Column:
    """The current UTC time as TIMESTAMP_NTZ, whatever the session zone is."""
    return F.convert_timezone(None, F.lit("UTC"), F.localtimestamp())


def audit_time(as_of: str | None) -> Column:
    """Load time of a job: now, or the fixed ``as_of`` for repeatable output."""
    return utc_now() if as_of is None else F.lit(as_of).cast(NTZ)


def status_rank(status: Column, domain: Sequence[str]) -> Column:
    """Strength of a status within ``domain``, 1 for the weakest; 0 if unknown."""
    rank = F.lit(0)
    for strength, name in enumerate(domain, start=1):
        rank = F.when(status == name, strength).otherwise(rank)
    return rank


def resolve_status(
    snapshot: Column,
    event: Column,
    snapshot_ts: Column,
    event_ts: Column,
    terminal: Sequence[str],
) -> Column:
    """Status of a booking from its latest snapshot and its latest event.

    A terminal status on either side wins. Otherwise, with both present, the
    event wins if it is known to be at least as new as the snapshot; a missing
    time leaves the snapshot in place. With one side present, that one wins.
    """
    agreed = F.when(
        snapshot.isNotNull() & event.isNotNull(),
        F.when(event_ts >= snapshot_ts, event).otherwise(snapshot),
    ).otherwise(F.coalesce(event, snapshot))
    for status in reversed(terminal):
        agreed = F.when((snapshot == status) | (event == status), F.lit(status)).otherwise(agreed)
    return agreed


def later_of(left: Column, right: Column) -> Column:
    """The later of two times; the other one if one is NULL."""
    return F.greatest(left, right)


def known_to_differ(left: Column, right: Column) -> Column:
    """TRUE if both are present and differ, else FALSE; never NULL."""
    return F.coalesce(left != right, F.lit(False))


def share(part: Column, whole: Column, digits: int = 4) -> Column:
    """part / whole as a rounded double, 0 if the whole is 0."""
    ratio = part.cast("double") / whole.cast("double")
    return F.when(whole > 0, F.round(ratio, digits)).otherwise(F.lit(0.0))


def exact_mean(total: Column, count: Column) -> Column:
    """Mean price rounded half up to cents, NULL if nothing was counted.

    Built from the sum and the count, so it is exact at any group size and both
    inputs can be added up across partial results.
    """
    return F.round(total / F.nullif(count, F.lit(0)), 2).cast(PRICE)
