"""The status domain as configuration.

A new status is added here, not in the jobs: its strength decides event ties,
``terminal`` whether it can be left again, ``milestones`` which columns of the
event log silver keeps, ``counters`` which counts gold reports.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from types import MappingProxyType


def _frozen(**items: str) -> Mapping[str, str]:
    return MappingProxyType(items)


@dataclass(frozen=True)
class StatusModel:
    # Weakest first. Of two events at the same instant the stronger one wins.
    domain: tuple[str, ...] = ("created", "confirmed", "cancelled")
    # Statuses a booking never leaves, strongest claim first.
    terminal: tuple[str, ...] = ("cancelled",)
    # Event type -> silver column with the time it was last seen.
    milestones: Mapping[str, str] = field(
        default_factory=lambda: _frozen(confirmed="confirmed_at", cancelled="cancelled_at")
    )
    # Status -> gold column that counts it.
    counters: Mapping[str, str] = field(
        default_factory=lambda: _frozen(
            confirmed="confirmed_bookings",
            cancelled="cancelled_bookings",
            created="pending_bookings",
        )
    )
    # Status whose prices count as revenue, and status the loss rate is about.
    earning: str = "confirmed"
    lost: str = "cancelled"


DEFAULT_STATUSES = StatusModel()
