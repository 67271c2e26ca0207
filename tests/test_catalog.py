"""Tables, views and statistics of the catalog, and CSV seeds."""

import pytest
from conftest import HOTELS, at, event, rows, snapshot
from pyspark.sql import functions as F

from staymark import schemas
from staymark.plans import staging, views
from staymark.sinks import statistics, tables
from staymark.sources.seeds import read_seed, write_seed


@pytest.fixture
def database(spark, tmp_path):
    spark.sql(f"CREATE DATABASE tested LOCATION '{tmp_path / 'db'}'")
    yield "tested"
    spark.sql("DROP DATABASE tested CASCADE")


def test_statistics_are_read_back(spark, database, tmp_path):
    name = f"{database}.t"
    tables.create_table(spark, name, schemas.HOTELS_RAW, str(tmp_path / "t"))
    spark.sql(f"INSERT INTO {name} VALUES ('h1', 'Tehran', 3), ('h2', 'Rasht', 5), ('h3', NULL, NULL)")
    assert statistics.stored_statistics(spark, name) is None
    with pytest.raises(ValueError, match="analyzed"):
        statistics.statistics_report(spark, name)
    statistics.analyze(spark, name)
    known = statistics.stored_statistics(spark, name)
    stars = known.columns["star_rating"]
    assert (known.rows, stars.nulls, stars.distinct, stars.low, stars.high) == (3, 1, 2, "3", "5")
    assert known.columns["city"].nulls == 1 and known.columns["city"].low is None
    assert rows(statistics.statistics_report(spark, name), "column", "row_count") == {
        ("hotel_id", 3), ("city", 3), ("star_rating", 3),
    }
    # Row header, three values, and the text of two columns.
    assert known.bytes(schemas.HOTELS_RAW) == 3 * (48 + 3 * 16 + 2 + 6)


def test_joins_follow_the_statistics(spark, database, tmp_path, monkeypatch):
    name = f"{database}.t"
    tables.create_table(spark, name, schemas.HOTELS_RAW, str(tmp_path / "t"))
    spark.sql(f"INSERT INTO {name} VALUES ('h1', 'Tehran', 3)")
    statistics.analyze(spark, name)

    def measured(*_):
        raise AssertionError("the table was read to measure it")

    monkeypatch.setattr(statistics, "broadcast_if_fits", measured)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for budget, kind in ((1 << 20, "BroadcastHashJoin"), (10, "SortMergeJoin")):
            hotels = statistics.table_for_join(spark, name, budget)
            joined = spark.range(5).select(F.concat(F.lit("h"), "id").alias("hotel_id")).join(hotels, "hotel_id")
            assert kind in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_table_life(spark, database, tmp_path):
    name, path = f"{database}.t", str(tmp_path / "t")
    for _ in range(2):
        tables.create_table(spark, name, schemas.HOTELS_RAW, path)
        spark.sql(f"INSERT INTO {name} VALUES ('h', 'c', 1)")
    assert spark.table(name).count() == 2
    for _ in range(2):
        tables.drop_table(spark, name)
        assert not spark.catalog.tableExists(name)


BOOKINGS = [
    snapshot("b1", "created", "10:00", price="5.00"),
    snapshot("b1", "created", "10:00", price=None),
    snapshot("b1", "confirmed", "10:00", price="5.00"),
    snapshot("b1", "confirmed", "10:05", hotel=None),
    snapshot(None, None, None, price=None, created=None),
    snapshot(None, None, None, price="1.00", created=None),
]
EVENTS = [event("b1", "confirmed", "10:00"), event("b1", "confirmed", "10:00"), event(None, None, None)]


def test_views_agree_with_staging(spark, frame, database, tmp_path):
    raw = {
        "bookings_raw": frame("bookings", BOOKINGS),
        "booking_events_raw": frame("events", EVENTS),
        "hotels_raw": frame("hotels", [*HOTELS, ("h1", None, 9), ("h1", "Abadan", None)]),
    }
    for name, df in raw.items():
        df.write.parquet(str(tmp_path / name))
        tables.create_table(spark, f"{database}.{name}", df.schema, str(tmp_path / name))
    for _ in range(2):  # created, then replaced
        views.create_staging_views(spark, database)
    want = {
        "stg_bookings": staging.stg_bookings(raw["bookings_raw"]),
        "stg_booking_events": staging.stg_booking_events(raw["booking_events_raw"]),
        "stg_hotels": staging.stg_hotels(raw["hotels_raw"]),
    }
    for name, df in want.items():
        found = spark.sql(f"SELECT * FROM {database}.{name}")
        assert found.dtypes == df.dtypes
        assert rows(found) == rows(df)
        kinds = {r["name"]: r["tableType"] for r in map(lambda x: x._asdict(), spark.catalog.listTables(database))}
        assert kinds[name] == "VIEW"


def test_seeds_come_back_as_they_were(spark, frame, tmp_path):
    data = [
        *BOOKINGS,
        snapshot('quoted "x", y', " ", "2025-01-01T10:00:00.123456", user="line"),
        snapshot("é", "created", "0001-01-01T00:00:00", price="99999999.99"),
    ]
    df = frame("bookings", data)
    write_seed(df, str(tmp_path / "seed"))
    back = read_seed(spark, str(tmp_path / "seed"), schemas.BOOKINGS_RAW)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    assert at("2025-01-01T10:00:00.123456") in {r[0] for r in back.select("updated_at").collect()}
