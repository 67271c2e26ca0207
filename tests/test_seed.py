"""The seed feeds end to end: CSV -> staging -> silver -> gold, and the merge."""

import pytest
import seed
from conftest import rows
from pyspark.sql import functions as F

from staymark import schemas
from staymark.plans import gold, incremental, quality, silver, staging
from staymark.sources.seeds import read_seed


@pytest.fixture(scope="module")
def feeds(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("seed")
    parts = {
        "bookings": (seed.BOOKINGS, schemas.BOOKINGS_RAW),
        "events": (seed.EVENTS, schemas.BOOKING_EVENTS_RAW),
        "hotels": (seed.HOTELS, schemas.HOTELS_RAW),
    }
    out = {}
    for name, (text, schema) in parts.items():
        file = folder / f"{name}.csv"
        file.write_text(text)
        out[name] = read_seed(spark, str(file), schema)
    return out


@pytest.fixture(scope="module")
def staged(feeds):
    return (
        staging.stg_bookings(feeds["bookings"]),
        staging.stg_booking_events(feeds["events"]),
        staging.stg_hotels(feeds["hotels"]),
    )


def test_types(feeds):
    assert feeds["bookings"].schema == schemas.BOOKINGS_RAW
    assert feeds["bookings"].count() == 6 and feeds["events"].count() == 7


def test_bad_value_fails(spark, tmp_path):
    file = tmp_path / "bad.csv"
    file.write_text("hotel_id,city,star_rating\nharbor,Lisbon,many\n")
    with pytest.raises(Exception, match="(?i)malformed|star_rating|many"):
        read_seed(spark, str(file), schemas.HOTELS_RAW).collect()


def test_silver(staged):
    built = silver.silver_bookings(staged[0], staged[1])
    assert built.columns == schemas.SILVER_COLUMNS
    assert (
        rows(
            built,
            "booking_id",
            "booking_status",
            "price",
            "created_at",
            "confirmed_at",
            "cancelled_at",
            "last_updated_at",
        )
        == seed.SILVER
    )
    assert rows(built.where("_had_conflict"), "booking_id") == seed.CONFLICTS


def test_gold(staged):
    built = gold.daily_city_kpis(silver.silver_bookings(staged[0], staged[1]), staged[2])
    assert built.columns == schemas.GOLD_COLUMNS
    assert rows(built.drop("_computed_at")) == seed.GOLD


def test_schemas_as_declared(staged):
    s = silver.silver_bookings(staged[0], staged[1])
    g = gold.daily_city_kpis(s, staged[2])
    for built, declared in (
        (s, schemas.SILVER_BOOKINGS),
        (g, schemas.GOLD_DAILY_CITY_KPIS),
    ):
        assert [(f.name, f.dataType) for f in built.schema] == [
            (f.name, f.dataType) for f in declared
        ]


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
def test_merge_keeps_first_created_at(staged, broadcast_bytes):
    """Merging the days after the first gives the full build but for k7.created_at."""
    mark = seed.MARK
    until = F.lit(mark).cast("timestamp_ntz")
    bookings, events, _ = staged
    target = silver.silver_bookings(
        bookings.where(F.col("updated_at") <= until), events.where(F.col("event_ts") <= until)
    )
    assert rows(target, "booking_id") == {("k7",), ("m2",)}
    delta = incremental.silver_delta(bookings, events, mark, broadcast_bytes=broadcast_bytes)
    assert rows(delta, "booking_id") == {(r[0],) for r in seed.SILVER}
    merged = incremental.merge_silver(target, delta, broadcast_bytes=broadcast_bytes)
    expected = {
        (*r[:3], seed.K7_FIRST_CREATED, *r[4:]) if r[0] == "k7" else r for r in seed.SILVER
    }
    assert rows(merged, *[
        "booking_id",
        "booking_status",
        "price",
        "created_at",
        "confirmed_at",
        "cancelled_at",
        "last_updated_at",
    ]) == expected


def test_everything_passes(staged, feeds):
    s = silver.silver_bookings(staged[0], staged[1])
    g = gold.daily_city_kpis(s, staged[2])
    assert quality.gate_verdict(quality.quality_gate(s, g)).first()["approved"]
    declared = quality.declared_tests(
        {
            "bookings_raw": feeds["bookings"],
            "booking_events_raw": feeds["events"],
            "hotels_raw": feeds["hotels"],
            "stg_bookings": staged[0],
            "stg_booking_events": staged[1],
            "stg_hotels": staged[2],
            "silver_bookings": s,
            "gold_daily_city_kpis": g,
        }
    ).collect()
    assert len(declared) == 21 and all(r["passed"] for r in declared)
