from decimal import Decimal

import pytest
from conftest import at, rows

from staymark.operators.merge import merge_upsert
from staymark.operators.sizing import broadcast_if_fits, fits_broadcast, measured_bytes
from staymark.plans.incremental import affected_days, merge_silver


def silver_row(key, status, updated, *, price="1.00", user="u", created="10:00", loaded="10:00"):
    return (
        key, user, "h1", status, Decimal(price), at(created), None, None, at(updated),
        status, None, False, at(loaded),
    )


TARGET = [
    silver_row("older", "created", "10:00"),
    silver_row("same", "created", "10:00"),
    silver_row("newer", "confirmed", "12:00"),
    silver_row("undated", "created", None),
    silver_row("undated source", "created", "10:00"),
    silver_row("untouched", "created", "10:00"),
    silver_row(None, "created", "10:00"),
]
SOURCE = [
    silver_row("older", "cancelled", "11:00", price="2.00", user="v", created="11:00", loaded="11:00"),
    silver_row("same", "cancelled", "10:00"),
    silver_row("newer", "cancelled", "11:00"),
    silver_row("undated", "cancelled", "11:00"),
    silver_row("undated source", "cancelled", None),
    silver_row("inserted", "confirmed", "11:00", user="w"),
    silver_row(None, "confirmed", "11:00"),
]


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
def test_merge_rules(frame, broadcast_bytes):
    merged = merge_silver(
        frame("silver", TARGET), frame("silver", SOURCE), broadcast_bytes=broadcast_bytes
    )
    kept = {r for r in TARGET if r[0] != "older"}
    # Updated, but for user_id, hotel_id and created_at; NULL keys match nothing.
    updated = silver_row("older", "cancelled", "11:00", price="2.00", loaded="11:00")
    assert rows(merged) == kept | {updated, SOURCE[5], SOURCE[6]}
    assert merged.columns == frame("silver", TARGET).columns


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
def test_merge_twice_changes_nothing(frame, broadcast_bytes):
    source = frame("silver", [r for r in SOURCE if r[0] is not None])
    once = merge_silver(frame("silver", TARGET), source, broadcast_bytes=broadcast_bytes)
    twice = merge_silver(once, source, broadcast_bytes=broadcast_bytes)
    assert rows(once) == rows(twice)


def test_repeated_source_key_is_refused(frame):
    source = frame("silver", [SOURCE[0], SOURCE[0], SOURCE[6], SOURCE[6]])
    with pytest.raises(ValueError, match="booking_id"):
        merge_silver(frame("silver", TARGET), source)
    nulls = frame("silver", [SOURCE[6], SOURCE[6]])
    assert merge_silver(frame("silver", TARGET), nulls).count() == len(TARGET) + 2


def test_generic_columns(spark):
    target = spark.createDataFrame([(1, 1, "a"), (2, 5, "b")], "id int, v int, x string")
    source = spark.createDataFrame([(1, 2, "A"), (2, 4, "B"), (3, 1, "C")], "id int, v int, x string")
    for limit in (0, 1 << 20):
        merged = merge_upsert(target, source, "id", "v", ["v", "x"], broadcast_bytes=limit)
        assert rows(merged) == {(1, 2, "A"), (2, 5, "b"), (3, 1, "C")}


def test_affected_days(frame):
    target = frame(
        "silver",
        [
            silver_row("a", "created", "10:00"),
            silver_row("b", "created", "10:00", created="2025-01-05T10:00"),
            silver_row(None, "created", "10:00", created="2025-01-07T10:00"),
        ],
    )
    delta = frame(
        "silver",
        [
            silver_row("a", "created", "11:00", created="2025-01-02T10:00"),
            silver_row("c", "created", "11:00", created=None),
            silver_row(None, "created", "11:00"),
        ],
    )
    for limit in (0, 1 << 20):
        days = {str(d) for (d,) in rows(affected_days(target, delta, broadcast_bytes=limit))}
        assert days == {"2025-01-01", "2025-01-02", "2025-01-07", "None"}


def test_measured_size(spark):
    small = spark.createDataFrame([("x" * 100, 1), (None, 2)], "s string, n int")
    assert 100 < measured_bytes(small) < 1000
    assert measured_bytes(small.limit(0)) == 0
    assert fits_broadcast(small, 1000) and not fits_broadcast(small, 100)
    assert not fits_broadcast(small.limit(0), 0)
    with pytest.raises(TypeError, match="array"):
        measured_bytes(spark.createDataFrame([([1],)], "a array<int>"))
    plan = broadcast_if_fits(small, 1000)._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in plan
