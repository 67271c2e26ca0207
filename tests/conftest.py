from __future__ import annotations

import datetime as dt
import sys
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from staymark import schemas  # noqa: E402
from staymark.session import prepare  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("shared")
    session = (
        SparkSession.builder.master("local[*]")
        .appName("staymark-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(scratch / "checkpoints"))
        .config("spark.sql.warehouse.dir", str(scratch / "warehouse"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield prepare(session)
    session.stop()


def at(text: str | None) -> dt.datetime | None:
    """'10:30' on the day of the edge fixture, or a full ISO time."""
    if text is None:
        return None
    return dt.datetime.fromisoformat(text if "-" in text else f"2025-01-01T{text}")


def snapshot(booking, status, updated, *, hotel="h1", user="u", price="10.00", created="10:00"):
    return (
        booking,
        user,
        hotel,
        status,
        None if price is None else Decimal(price),
        at(created),
        at(updated),
    )


def event(booking, kind, ts):
    return (booking, kind, at(ts))


@pytest.fixture(scope="session")
def frame(spark):
    """Build a small feed from rows."""
    known = {
        "bookings": schemas.BOOKINGS_RAW,
        "events": schemas.BOOKING_EVENTS_RAW,
        "hotels": schemas.HOTELS_RAW,
        "silver": schemas.SILVER_BOOKINGS,
        "gold": schemas.GOLD_DAILY_CITY_KPIS,
    }
    return lambda kind, rows: spark.createDataFrame(list(rows), known[kind])


def rows(df, *columns) -> set[tuple]:
    """The rows of ``df`` (or of some columns); fails if a row repeats."""
    collected = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    assert len(collected) == len(set(collected))
    return set(collected)


HOTELS = [("h1", "Tehran", 4), ("h2", "Shiraz", 5), ("h3", "Isfahan", 3)]
