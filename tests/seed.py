"""A small fixture of feeds as CSV text, and the tables that must come out of them.

Worked out by hand from the rules: k7 is confirmed a day after it was made and its
created_at changes with that; m2's snapshot was never told of the cancellation that its
event reports; q5 is cancelled by its snapshot although a later event confirms it; t9 has
no events; v3 has two events at one time, of which the stronger counts. One event of k7
comes twice.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

BOOKINGS = """booking_id,user_id,hotel_id,status,price,created_at,updated_at
k7,ann,harbor,created,80.50,2024-03-10T08:00:00,2024-03-10T08:00:00
k7,ann,harbor,confirmed,80.50,2024-03-11T09:00:00,2024-03-11T09:30:00
m2,bo,ridge,created,45.00,2024-03-10T12:00:00,2024-03-10T12:00:00
q5,cy,harbor,cancelled,60.25,2024-03-11T16:45:00,2024-03-11T17:00:00
t9,di,ridge,created,99.99,2024-03-12T06:00:00,2024-03-12T06:00:00
v3,ed,harbor,created,30.00,2024-03-12T20:00:00,2024-03-12T20:00:00
"""
EVENTS = """booking_id,event_type,event_ts
k7,created,2024-03-10T08:00:00
k7,created,2024-03-10T08:00:00
k7,confirmed,2024-03-11T09:30:00
m2,cancelled,2024-03-12T07:00:00
q5,confirmed,2024-03-12T10:00:00
v3,created,2024-03-12T21:00:00
v3,confirmed,2024-03-12T21:00:00
"""
HOTELS = """hotel_id,city,star_rating
harbor,Lisbon,4
ridge,Oslo,3
"""


def _t(day: int, hour: int, minute: int = 0) -> dt.datetime:
    return dt.datetime(2024, 3, day, hour, minute)


# booking, status, price, created, confirmed, cancelled, last updated
SILVER = {
    ("k7", "confirmed", Decimal("80.50"), _t(11, 9), _t(11, 9, 30), None, _t(11, 9, 30)),
    ("m2", "cancelled", Decimal("45.00"), _t(10, 12), None, _t(12, 7), _t(12, 7)),
    ("q5", "cancelled", Decimal("60.25"), _t(11, 16, 45), _t(12, 10), None, _t(12, 10)),
    ("t9", "created", Decimal("99.99"), _t(12, 6), None, None, _t(12, 6)),
    ("v3", "confirmed", Decimal("30.00"), _t(12, 20), _t(12, 21), None, _t(12, 21)),
}
CONFLICTS = {("m2",), ("q5",), ("v3",)}
# The last moment of the first day, and when k7 was first said to be made.
MARK = "2024-03-10 23:59:59"
K7_FIRST_CREATED = _t(10, 8)


def _g(day, city, total, confirmed, cancelled, pending, rate, revenue, mean, confirmed_mean):
    money = [Decimal(m) for m in (revenue, mean, confirmed_mean)]
    return (dt.date(2024, 3, day), city, total, confirmed, cancelled, pending, rate, *money)


GOLD = {
    _g(10, "Oslo", 1, 0, 1, 0, 1.0, "0.00", "45.00", "0.00"),
    _g(11, "Lisbon", 2, 1, 1, 0, 0.5, "80.50", "70.38", "80.50"),
    _g(12, "Lisbon", 1, 1, 0, 0, 0.0, "30.00", "30.00", "30.00"),
    _g(12, "Oslo", 1, 0, 0, 1, 0.0, "0.00", "99.99", "0.00"),
}
