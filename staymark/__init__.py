"""Booking reconciliation and daily KPIs as PySpark DataFrame jobs."""

from staymark.statuses import DEFAULT_STATUSES, StatusModel

__all__ = ["DEFAULT_STATUSES", "StatusModel"]
