"""Staging and silver rules, case by case and against a brute-force model."""

import random

import pytest
from conftest import HOTELS, at, event, rows, snapshot
from pyspark.sql import functions as F

from staymark import StatusModel
from staymark.plans import gold, incremental, silver, staging

SNAPSHOTS = [
    snapshot("e1", "confirmed", "10:00"),
    snapshot("e2", "cancelled", "10:00"),
    snapshot("e3", "created", "10:00"),
    snapshot("e4", "confirmed", "12:00"),
    snapshot("e5", "created", "10:00"),
    snapshot("e6", "created", "10:00", hotel="h9"),
    snapshot("e7", "confirmed", "10:00"),
    snapshot("e8", None, "10:00", hotel=None),
    snapshot("e9", "created", None),
    snapshot("e10", None, "10:00"),
    snapshot("e11", "created", "10:00", created=None),
    snapshot("e12", "created", "10:00"),
]
EVENTS = [
    event("e2", "confirmed", "11:00"),
    event("e3", "cancelled", "09:00"),
    event("e4", "created", "11:00"),
    event("e5", "confirmed", "10:00"),
    event("e7", "cancelled", "10:30"),
    event("e7", "confirmed", "11:00"),
    event("e8", "confirmed", "11:00"),
    event("e9", "confirmed", "11:00"),
    event("e12", "confirmed", "11:00"),
    event("e12", "cancelled", "11:00"),
    event("e12", "cancelled", "11:00"),
    event("e99", "created", "11:00"),
]
# status, confirmed_at, cancelled_at, last_updated_at, conflict
EXPECTED = {
    "e1": ("confirmed", None, None, "10:00", False),
    "e2": ("cancelled", "11:00", None, "11:00", True),
    "e3": ("cancelled", None, "09:00", "10:00", True),
    "e4": ("confirmed", None, None, "12:00", True),
    "e5": ("confirmed", "10:00", None, "10:00", True),
    "e6": ("created", None, None, "10:00", False),
    "e7": ("confirmed", "11:00", "10:30", "11:00", False),
    "e8": ("confirmed", "11:00", None, "11:00", False),
    "e9": ("created", "11:00", None, "11:00", True),
    "e10": (None, None, None, "10:00", False),
    "e11": ("created", None, None, "10:00", False),
    "e12": ("cancelled", "11:00", "11:00", "11:00", True),
}


@pytest.fixture(scope="module")
def feeds(frame):
    return frame("bookings", SNAPSHOTS), frame("events", EVENTS)


def test_edge_cases(feeds):
    built = silver.silver_bookings(*feeds)
    got = {
        r["booking_id"]: (
            r["booking_status"],
            r["confirmed_at"],
            r["cancelled_at"],
            r["last_updated_at"],
            r["_had_conflict"],
        )
        for r in built.collect()
    }
    want = {
        booking: (status, at(confirmed), at(cancelled), at(updated), conflict)
        for booking, (status, confirmed, cancelled, updated, conflict) in EXPECTED.items()
    }
    assert got == want


def test_terminal_ever(feeds):
    built = silver.silver_bookings(*feeds, terminal="ever")
    status = {r["booking_id"]: r["booking_status"] for r in built.collect()}
    want = {booking: values[0] for booking, values in EXPECTED.items()} | {"e7": "cancelled"}
    assert status == want
    with pytest.raises(ValueError):
        silver.silver_bookings(*feeds, terminal="sometimes")


def test_gold_of_edge_cases(feeds, frame):
    kpis = gold.daily_city_kpis(silver.silver_bookings(*feeds), frame("hotels", HOTELS))
    got = {(str(r["booking_date"]), r["city"]): r for r in kpis.collect()}
    assert set(got) == {("2025-01-01", "Tehran"), ("2025-01-01", "Unknown"), ("None", "Tehran")}
    tehran = got["2025-01-01", "Tehran"]
    # e10 has no status, so it is in the total and in no count.
    assert tehran["total_bookings"] == 9
    assert (tehran["confirmed_bookings"], tehran["cancelled_bookings"]) == (4, 3)
    assert tehran["pending_bookings"] == 1
    assert got["2025-01-01", "Unknown"]["total_bookings"] == 2
    assert got["None", "Tehran"]["total_bookings"] == 1


def test_snapshot_duplicates(frame):
    """Of two snapshots with one key and time, the first in the total order stays."""
    feed = frame(
        "bookings",
        [
            snapshot("d1", "created", "10:00"),
            snapshot("d1", "cancelled", "10:00"),
            snapshot("d1", "cancelled", "10:00"),
            snapshot("d1", None, "10:00"),
            snapshot("d2", "created", "10:00", user=None),
            snapshot("d2", "created", "10:00", user="v"),
            snapshot("d3", "created", None),
            snapshot("d3", "confirmed", None),
        ],
    )
    kept = rows(staging.stg_bookings(feed), "booking_id", "user_id", "status")
    assert kept == {("d1", "u", "cancelled"), ("d2", "v", "created"), ("d3", "u", "confirmed")}


def test_event_and_hotel_duplicates(frame):
    events = frame("events", [event("a", "created", "10:00")] * 3 + [event("a", "created", None)])
    assert staging.stg_booking_events(events).count() == 2
    hotels = frame("hotels", [("h1", "Tehran", 4), ("h1", "Shiraz", 5), ("h1", None, 1)])
    assert rows(staging.stg_hotels(hotels)) == {("h1", "Shiraz", 5)}


def test_new_status_is_configuration(frame):
    model = StatusModel(
        domain=("created", "confirmed", "checked_in", "cancelled"),
        terminal=("cancelled", "checked_in"),
        milestones={
            "confirmed": "confirmed_at",
            "cancelled": "cancelled_at",
            "checked_in": "checked_in_at",
        },
        counters={
            "confirmed": "confirmed_bookings",
            "cancelled": "cancelled_bookings",
            "created": "pending_bookings",
            "checked_in": "checked_in_bookings",
        },
    )
    bookings = frame("bookings", [snapshot("n1", "checked_in", "10:00"), snapshot("n2", "created", "10:00")])
    events = frame("events", [event("n1", "confirmed", "11:00"), event("n2", "checked_in", "12:00")])
    built = silver.silver_bookings(bookings, events, model)
    assert rows(built, "booking_id", "booking_status", "checked_in_at") == {
        ("n1", "checked_in", None),
        ("n2", "checked_in", at("12:00")),
    }
    kpis = gold.daily_city_kpis(built, frame("hotels", HOTELS), model).first()
    assert (kpis["checked_in_bookings"], kpis["pending_bookings"]) == (2, 0)


def _random_feeds(seed: int, bookings: int = 300):
    """Feeds full of ties, NULLs, unknown statuses, duplicates and orphans."""
    rng = random.Random(seed)
    times = [None, *[f"{h:02d}:00" for h in range(8, 14)]]
    kinds = ["created", "confirmed", "cancelled", "refunded", None]
    snapshots, events = [], []
    for n in range(bookings):
        key = None if n == 0 else f"r{n}"
        for _ in range(rng.randint(0, 5)):
            row = snapshot(
                key,
                rng.choice(kinds),
                rng.choice(times),
                hotel=rng.choice(["h1", "h2", "h9", None]),
                user=rng.choice(["u", "v", None]),
                price=rng.choice(["10.00", "10.01", None]),
                created=rng.choice(times),
            )
            snapshots += [row] * rng.randint(1, 2)
        for _ in range(rng.randint(0, 5)):
            events += [event(key, rng.choice(kinds), rng.choice(times))] * rng.randint(1, 2)
    rng.shuffle(snapshots)
    rng.shuffle(events)
    return snapshots, events


def _last(value):
    """Sort key that puts None after everything else."""
    return (value is None, value if value is not None else 0)


def _brute_force(snapshots, events, model=StatusModel()):
    """Silver by plain rules, one booking at a time."""
    strength = {name: i for i, name in enumerate(model.domain, 1)}
    result = {}
    for key in {s[0] for s in snapshots}:
        mine = [s for s in snapshots if s[0] == key]
        dated = [s for s in mine if s[6] is not None]
        newest = max((s[6] for s in dated), default=None)
        ties = [s for s in mine if s[6] == newest]
        first = min(ties, key=lambda s: tuple(_last(v) for v in s[1:6]))
        log = [] if key is None else [e for e in events if e[0] == key]
        latest = max(
            log,
            key=lambda e: (e[2] is not None, e[2] or at("00:00"), strength.get(e[1], 0),
                           e[1] is not None, e[1] or ""),
            default=(None, None, None),
        )
        snap_status, snap_ts, kind, ts = first[3], first[6], latest[1], latest[2]
        if "cancelled" in (snap_status, kind):
            status = "cancelled"
        elif kind is not None and snap_status is not None:
            later = ts is not None and snap_ts is not None and ts >= snap_ts
            status = kind if later else snap_status
        else:
            status = kind if kind is not None else snap_status

        def seen(wanted):
            return max((e[2] for e in log if e[1] == wanted and e[2]), default=None)

        result[key] = (
            first[1],
            first[2],
            status,
            first[4],
            first[5],
            seen("confirmed"),
            seen("cancelled"),
            max((t for t in (snap_ts, ts) if t), default=None),
            snap_status,
            kind,
            snap_status is not None and kind is not None and snap_status != kind,
        )
    return result


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(frame, seed):
    snapshots, events = _random_feeds(seed)
    feeds = frame("bookings", snapshots).repartition(3), frame("events", events).repartition(3)
    want = _brute_force(snapshots, events)
    typed = silver.silver_bookings(*feeds)
    staged = silver.silver_bookings(
        staging.stg_bookings(feeds[0]), staging.stg_booking_events(feeds[1])
    )
    for built in (typed, staged):
        got = {r[0]: tuple(r)[1:12] for r in built.collect()}
        assert got == want
    joined, stacked = silver.snapshot_with_events(*feeds), silver.stacked_state(*feeds)
    assert joined.dtypes == stacked.dtypes and rows(joined) == rows(stacked)


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
def test_delta_is_the_filtered_build(frame, broadcast_bytes):
    snapshots, events = _random_feeds(9)
    feeds = frame("bookings", snapshots), frame("events", events)
    mark = "2025-01-01 11:00:00"
    combined = silver.snapshot_with_events(*feeds).where(
        (F.col("snapshot_updated_at") > F.lit(mark).cast("timestamp_ntz"))
        | (F.col("event_updated_at") > F.lit(mark).cast("timestamp_ntz"))
    )
    wanted = rows(combined, "booking_id")
    full = {r for r in rows(silver.silver_bookings(*feeds, as_of=mark)) if (r[0],) in wanted}
    delta = incremental.silver_delta(
        *feeds, mark, as_of=mark, broadcast_bytes=broadcast_bytes
    )
    assert rows(delta) == full and 0 < len(full) < len({s[0] for s in snapshots})
