from decimal import Decimal

from conftest import HOTELS, at, rows
from pyspark.sql import functions as F

from staymark.plans import gold
from staymark.plans.incremental import refresh_gold
from staymark.sinks import tables


def booking(n, status, price, *, hotel="h1", created="2025-01-01T10:00"):
    return (
        f"g{n}", "u", hotel, status, None if price is None else Decimal(price), at(created),
        None, None, None, status, None, False, at("10:00"),
    )


def test_means_round_half_up_exactly(frame):
    silver = frame(
        "silver",
        [
            booking(1, "confirmed", "0.01"),
            booking(2, "confirmed", "0.02"),
            booking(3, "cancelled", "1.00", hotel="h2"),
            booking(4, "created", None, hotel="h3"),
        ],
    )
    got = {r["city"]: r for r in gold.daily_city_kpis(silver, frame("hotels", HOTELS)).collect()}
    assert got["Tehran"]["avg_booking_price"] == Decimal("0.02")  # 0.015 rounds up
    assert got["Tehran"]["avg_confirmed_price"] == Decimal("0.02")
    assert got["Shiraz"]["avg_confirmed_price"] == Decimal("0.00")
    assert got["Shiraz"]["total_confirmed_revenue"] == Decimal("0.00")
    assert got["Isfahan"]["avg_booking_price"] is None
    assert got["Shiraz"]["cancellation_rate"] == 1.0


def test_mean_close_below_half_is_not_rounded_twice(spark):
    """The mean of 0.0049999975 is 0.00, though six digits of it would be 0.005."""
    cents = F.when(F.col("id") < 1_000_000, "0.01").otherwise("0.00")
    facts = spark.range(2_000_001).select(
        F.lit("created").alias("booking_status"),
        cents.cast("decimal(10,2)").alias("price"),
        F.lit("x").alias("city"),
    )
    assert gold.kpi_agg(facts, ["city"]).first()["avg_booking_price"] == Decimal("0.00")


def test_both_routes_agree(frame):
    silver = frame(
        "silver",
        [
            booking(
                n,
                ["created", "confirmed", "cancelled", None][n % 4],
                None if n % 11 == 0 else f"{n}.37",
                hotel=["h1", "h2", "h9", None][n % 7 % 4],
                created=f"2025-01-0{n % 3 + 1}T10:00" if n % 13 else None,
            )
            for n in range(200)
        ],
    )
    hotels = frame("hotels", [*HOTELS[:2], ("h3", None, 1)])
    direct = gold.daily_city_kpis(silver, hotels, as_of="2025-01-01")
    by_hotel = gold.daily_city_kpis(silver, hotels, as_of="2025-01-01", broadcast_bytes=0)
    assert rows(direct) == rows(by_hotel)
    assert direct.dtypes == by_hotel.dtypes


def test_enrich(frame):
    silver = frame(
        "silver",
        [booking(1, "created", "1.00"), booking(2, "created", "1.00", hotel="h9"),
         booking(3, "created", "1.00", hotel=None)],
    )
    want = {("g1", "Tehran", 4), ("g2", "Unknown", 0), ("g3", "Unknown", 0)}
    for limit in (0, 1 << 20):
        got = gold.enrich_city(silver, frame("hotels", HOTELS), broadcast_bytes=limit)
        assert rows(got, "booking_id", "city", "star_rating") == want


def test_serve(frame):
    silver = frame(
        "silver",
        [booking(n, "created", "1.00", created=f"2025-01-0{n}T10:00") for n in range(1, 6)],
    )
    kpis = gold.daily_city_kpis(silver, frame("hotels", HOTELS))
    served = gold.serve_kpis(kpis, "2025-01-03").collect()
    assert [r["booking_date"].day for r in served] == [3, 4, 5]
    assert len(served[0]) == 5


def test_refresh_moves_days_and_drops_empty_ones(spark, frame):
    hotels = frame("hotels", HOTELS)
    before = [booking(1, "created", "1.00"), booking(2, "created", "1.00", created="2025-01-02T10:00"),
              booking(3, "created", "1.00", created=None)]
    after = [booking(1, "cancelled", "1.00", created="2025-01-03T10:00"), before[1],
             booking(3, "created", "1.00", created="2025-01-03T10:00")]
    old = gold.daily_city_kpis(frame("silver", before), hotels, as_of="2025-01-01")
    touched = [at("00:00").date(), at("2025-01-03T00:00").date(), None]
    days = spark.createDataFrame([(d,) for d in touched], "day date")
    for limit in (0, 1 << 20):
        fresh = refresh_gold(
            old, frame("silver", after), hotels, days, as_of="2025-01-01", broadcast_bytes=limit
        )
        full = gold.daily_city_kpis(frame("silver", after), hotels, as_of="2025-01-01")
        assert rows(fresh) == rows(full)


def test_serving_reads_stored_days_asked_for(spark, frame, tmp_path):
    """Folders of earlier days are pruned, and only the columns shown are read."""
    silver = [booking(n, "confirmed", "1.00", created=f"2025-01-0{n}T10:00") for n in range(1, 6)]
    built = gold.daily_city_kpis(frame("silver", silver), frame("hotels", HOTELS))
    path = str(tmp_path / "gold")
    tables.write_table(built, path, partition_by=["booking_date"], sort_by=["city"])
    for file in (tmp_path / "gold" / "booking_date=2025-01-02").iterdir():
        file.unlink() if file.suffix == ".crc" else file.write_bytes(b"no parquet")
    served = gold.serve_kpis(tables.read_table(spark, path, built.schema), "2025-01-03")
    assert [r["booking_date"].day for r in served.collect()] == [3, 4, 5]
    plan = served._jdf.queryExecution().executedPlan().toString()
    schema = plan.partition("ReadSchema: ")[2].split("\n")[0]
    assert "avg_booking_price" not in schema and "total_bookings" in schema
