"""Every check on rows that break it and rows that do not."""

import datetime as dt
from decimal import Decimal

import pytest
from conftest import HOTELS, at, rows

from staymark import schemas
from staymark.plans import quality as Q
from staymark.plans import reports as R


def silver_row(key="s", status="confirmed", price="1.00", created="10:00", raw=None, event=None):
    return (
        key, "u", "h1", status, None if price is None else Decimal(price), at(created), None, None,
        at("10:00"), raw, event, False, at("10:00"),
    )


def gold_row(city="x", total=3, counts=(1, 1, 1), rate=0.5, revenue="1.00", mean="1.00"):
    money = [Decimal(revenue), None if mean is None else Decimal(mean), Decimal("1.00")]
    return (dt.date(2025, 1, 1), city, total, *counts, rate, *money, at("10:00"))


@pytest.fixture(scope="module")
def sound(frame):
    statuses = ["created", "confirmed", "cancelled"]
    silver = frame("silver", [silver_row(f"s{n}", status) for n, status in enumerate(statuses)])
    return silver, frame("gold", [gold_row()])


@pytest.fixture(scope="module")
def broken(frame):
    silver = frame(
        "silver",
        [
            silver_row("s"),
            silver_row("s", "unheard of"),
            silver_row(None, None, "0.00"),
            silver_row("t", "cancelled", None, "2025-01-03T00:00", raw="created"),
            silver_row("v", "confirmed", event="cancelled"),
            silver_row("w", "cancelled", event="cancelled"),
        ],
    )
    gold = frame(
        "gold",
        [
            gold_row("miscounted", total=4),
            gold_row("rate", rate=1.5),
            gold_row("below", rate=-0.1),
            gold_row("revenue", revenue="-1.00"),
            gold_row("mean", mean="-0.01"),
            gold_row("no mean", mean=None),
        ],
    )
    return silver, gold


def keys(df):
    return {r[0] for r in df.select("booking_id").collect()}


def test_column_checks(broken):
    silver, _ = broken
    assert Q.not_null(silver, "booking_id").count() == 1
    assert Q.not_null(silver, "price").count() == 1
    assert rows(Q.unique(silver, ["booking_id"])) == {("s", 2)}
    assert Q.accepted_values(silver, "booking_status", ["confirmed", "cancelled"]).count() == 1
    assert Q.not_null(silver.limit(0), "price").isEmpty()


def test_unique_ignores_null_keys_but_grain_does_not(frame):
    silver = frame("silver", [silver_row(None), silver_row(None)])
    assert Q.unique(silver, ["booking_id"]).isEmpty()
    assert rows(Q.one_row_per_key(silver)) == {(None, 2)}


def test_silver_checks(broken):
    silver, _ = broken
    assert rows(Q.one_row_per_key(silver)) == {("s", 2)}
    assert rows(Q.valid_status(silver), "booking_status") == {("unheard of",)}
    assert keys(Q.no_future_dates(silver, "2025-01-02")) == {"t"}
    assert Q.no_future_dates(silver).isEmpty()
    sanity = {(r["booking_id"], r["reason"]) for r in Q.booking_sanity(silver).collect()}
    assert sanity == {
        ("s", "invalid status"),
        (None, "invalid status, invalid price"),
        ("t", "invalid price"),
    }
    assert rows(Q.status_transitions(silver), "booking_id", "reason") == {
        ("t", "cancelled but no source confirms it"),
        ("v", "confirmed but a source shows cancelled"),
    }


def test_gold_checks(broken):
    _, gold = broken
    assert rows(Q.counts_add_up(gold), "city") == {("miscounted",)}
    assert rows(Q.rate_in_bounds(gold), "city") == {("rate",), ("below",)}
    assert rows(Q.money_not_negative(gold), "city") == {("revenue",), ("mean",)}


def test_cross_layer_checks(sound, broken):
    assert Q.silver_gold_consistency(*sound).isEmpty()
    assert rows(Q.silver_gold_consistency(*broken)) == {(6, 19)}
    good = Q.revenue_consistency(*sound).first()
    assert good["counts_match"] and good["revenue_matches"]
    bad = Q.revenue_consistency(*broken).first()
    assert (bad["counts_match"], bad["revenue_matches"]) == (False, False)
    assert (bad["silver_revenue"], bad["gold_revenue"]) == (Decimal("2.00"), Decimal("4.00"))
    empty = Q.revenue_consistency(sound[0].limit(0), sound[1].limit(0)).first()
    assert empty["counts_match"] and empty["revenue_matches"]


def test_gate(sound, broken):
    assert tuple(Q.gate_verdict(Q.quality_gate(*sound)).first()) == (True, 0)
    report = {r["name"]: (r["passed"], r["detail"]) for r in Q.quality_gate(*broken).collect()}
    assert report == {
        "Silver: one row per booking": (False, "total_rows=6, unique_bookings=4"),
        "Silver: no NULL booking_ids": (False, "null_booking_ids=1"),
        "Silver: valid status values": (False, "invalid_status_count=1"),
        "Gold: counts add up": (False, "mismatched_rows=1"),
        "Gold: cancellation rate 0-1": (False, "out_of_bounds_rows=2"),
        "Gold: non-negative revenue": (False, "negative_revenue_rows=1"),
        "Cross-layer: Silver count = Gold sum": (False, "silver=6, gold_sum=19"),
    }
    assert tuple(Q.gate_verdict(Q.quality_gate(*broken)).first()) == (False, 7)


def test_gate_on_empty_tables(sound):
    empty = [df.limit(0) for df in sound]
    assert Q.gate_verdict(Q.quality_gate(*empty)).first()["approved"]


def test_messages(sound, broken):
    good = [r["test_result"] for r in Q.validation_messages(*sound).collect()]
    bad = [r["test_result"] for r in Q.validation_messages(*broken).collect()]
    assert len(good) == 6 and all(m.startswith("PASS: ") for m in good)
    assert len(bad) == 6 and all(m.startswith("FAIL: ") for m in bad)


def test_declared_tests_find_violations(frame, broken):
    hotels = frame("hotels", [*HOTELS, ("h1", "x", 1), (None, "y", 1), (None, "z", 1)])
    found = {
        (r["table"], r["column"], r["test"]): r["violations"]
        for r in Q.declared_tests({"hotels_raw": hotels, "silver_bookings": broken[0]}).collect()
        if not r["passed"]
    }
    assert found == {
        ("hotels_raw", "hotel_id", "not_null"): 2,
        ("hotels_raw", "hotel_id", "unique"): 1,
        ("silver_bookings", "booking_id", "not_null"): 1,
        ("silver_bookings", "booking_id", "unique"): 1,
        ("silver_bookings", "booking_status", "not_null"): 1,
        ("silver_bookings", "booking_status", "accepted_values"): 1,
        ("silver_bookings", "price", "not_null"): 1,
    }


def test_reports(sound, broken):
    silver, gold = sound
    assert [r["booking_id"] for r in R.booking_states(silver).collect()] == ["s0", "s1", "s2"]
    assert rows(R.status_distribution(broken[0])) == {
        (None, 1, Decimal("0.00")),
        ("cancelled", 2, Decimal("1.00")),
        ("confirmed", 2, Decimal("2.00")),
        ("unheard of", 1, Decimal("1.00")),
    }
    assert R.kpi_listing(gold).columns[-3:] == ["cancel_rate", "revenue", "avg_price"]
    assert tuple(R.overall_totals(gold).first()) == (3, 1, 1, 1, Decimal("1.00"))
    assert rows(R.input_volumes({"a": silver, "b": gold})) == {("a", 3), ("b", 1)}
    assert R.conflicts(silver).columns == [
        "booking_id", "_raw_snapshot_status", "_raw_event_status", "resolved_to",
    ]
    assert schemas.GOLD_COLUMNS[:2] == R.kpi_listing(gold).columns[:2]


def test_freshness(frame):
    log = frame("events", [("b", "created", at("10:00")), ("b", "created", at("08:00")), ("b", "created", None)])
    for as_of, stale in (("2025-01-01 12:00:00", False), ("2025-01-01 12:00:01", True), ("2025-01-01 09:00:00", False)):
        assert rows(Q.freshness(log, as_of, 2)) == {(at("10:00"), stale)}
    undated = frame("events", [("b", "created", None)])
    assert rows(Q.freshness(undated, "2025-01-01 00:00:00", 2)) == {(None, True)}
    assert rows(Q.freshness(undated.limit(0), "2025-01-01 00:00:00", 2)) == {(None, True)}
