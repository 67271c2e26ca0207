"""One query per operator, over the feeds derived from the order tables.

Every query reads whole tables. Checks that find nothing on sound data run on an
input that has something to find: bookings whose sources disagree stripped of their
status, refunds counted negative, prices cut by a fee, or gold built too early.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staymark.operators.sizing import broadcast_if_fits
from staymark.plans import gold as G
from staymark.plans import incremental as I
from staymark.plans import quality as Q
from staymark.plans import reports as R
from staymark.plans import silver as S
from staymark.plans import staging, views
from staymark.plans.refresh import BookingTables
from staymark.session import prepare
from staymark.sinks import statistics, tables
from staymark.sinks.day_index import DayIndex
from staymark.sinks.locations import list_folder, new_folder, written
from staymark.sources.derived import DerivedFeeds
from staymark.sources.seeds import read_seed, write_seed
from staymark.statuses import StatusModel
from staymark.streaming.silver_stream import create_empty_silver, start_silver_stream
from staymark.streaming.staging_stream import start_event_stream
from staymark.suite.oracle import AS_OF, BACKFILL, FOUND_IDS, FRESH_HOURS, LOST, MARK, RAISED, SINCE, SPARSE_DAYS, TODAY

UNCANCELLED = StatusModel(domain=("created", "confirmed"))
NO_BROADCAST = 0


class Layers:
    """The tables of the flow over one directory, each a lazy DataFrame."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = prepare(spark)
        self.feeds = DerivedFeeds(spark, directory)

    @cached_property
    def bookings(self) -> DataFrame:
        return staging.typed_bookings(self.feeds.bookings_raw())

    @cached_property
    def events(self) -> DataFrame:
        return staging.typed_events(self.feeds.booking_events_raw())

    @cached_property
    def hotels_raw(self) -> DataFrame:
        return self.feeds.hotels_raw()

    @cached_property
    def stg_bookings(self) -> DataFrame:
        return staging.stg_bookings(self.feeds.bookings_raw())

    @cached_property
    def stg_events(self) -> DataFrame:
        return staging.stg_booking_events(self.feeds.booking_events_raw())

    @cached_property
    def stg_hotels(self) -> DataFrame:
        return staging.stg_hotels(self.hotels_raw)

    @cached_property
    def silver(self) -> DataFrame:
        return S.silver_bookings(self.bookings, self.events, as_of=AS_OF)

    @cached_property
    def stored_silver(self) -> DataFrame:
        """Silver as a written table, for queries that read it more than once."""
        return written(self.silver, "silver")

    @cached_property
    def early_silver(self) -> DataFrame:
        """Silver as of the mark."""
        mark = F.lit(MARK).cast("timestamp_ntz")
        return S.silver_bookings(
            self.bookings.where(F.col("updated_at") <= mark),
            self.events.where(F.col("event_ts") <= mark),
            as_of=AS_OF,
        )

    @cached_property
    def silver_ever(self) -> DataFrame:
        return S.silver_bookings(self.bookings, self.events, as_of=AS_OF, terminal="ever")

    def delta(self, **options) -> DataFrame:
        return I.silver_delta(self.bookings, self.events, MARK, as_of=AS_OF, **options)

    def gold_of(self, silver: DataFrame, **options) -> DataFrame:
        return G.daily_city_kpis(
            silver, self.stg_hotels, as_of=AS_OF, hotels_bound=self.hotels_raw, **options
        )

    @cached_property
    def gold(self) -> DataFrame:
        return self.gold_of(self.silver)

    @cached_property
    def stored_gold(self) -> DataFrame:
        return self.gold_of(self.stored_silver)

    @cached_property
    def early_gold(self) -> DataFrame:
        return self.gold_of(self.early_silver)


def unsettled(silver: DataFrame) -> DataFrame:
    """Bookings whose sources disagree, stripped of their status."""
    return silver.withColumn(
        "booking_status", F.when(~F.col("_had_conflict"), F.col("booking_status"))
    )


def refunded(silver: DataFrame) -> DataFrame:
    """Prices of cancelled bookings counted negative."""
    price = F.col("price")
    return silver.withColumn(
        "price", F.when(F.col("booking_status") == "cancelled", -price).otherwise(price)
    )


def _comparable(df: DataFrame) -> DataFrame:
    """Without load times, and decimals as doubles so that engines agree on the type."""
    columns = [f for f in df.schema.fields if f.name not in ("_loaded_at", "_computed_at")]
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in columns
        ]
    )


def _with_created_date(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("created_date", T.DateType())])


def _write_silver(t: Layers, silver: DataFrame, label: str) -> str:
    path = new_folder(t.spark, label)
    tables.write_table(
        tables.with_day(silver, "created_at", "created_date"),
        path,
        partition_by=["created_date"],
        sort_by=["booking_id"],
    )
    return path


def _read_silver(t: Layers, path: str) -> DataFrame:
    return tables.read_table(t.spark, path, _with_created_date(t.silver.schema))


# --- incremental ----------------------------------------------------------------------


def merge_upsert(t: Layers, **options) -> DataFrame:
    target, delta = written(t.early_silver, "silver"), written(t.delta(), "delta")
    # The delta is grouped by booking, so its key need not be checked.
    return I.merge_silver(target, delta, check_source=False, **options)


def upsert_table(t: Layers) -> DataFrame:
    path = _write_silver(t, t.early_silver, "silver")
    schema = _with_created_date(t.silver.schema)
    tables.upsert_silver(t.spark, path, t.delta(), schema)
    return _read_silver(t, path)


def upsert_by_key_index(t: Layers) -> DataFrame:
    """The same merge, where an index says on which days the bookings of the delta are."""
    path = _write_silver(t, t.early_silver, "silver")
    index = DayIndex(t.spark, new_folder(t.spark, "index"))
    index.build(_read_silver(t, path), "created_date")
    delta = written(t.delta(), "delta")
    days = index.admit(delta, F.to_date("created_at"))
    schema = _with_created_date(t.silver.schema)
    tables.upsert_silver(t.spark, path, delta, schema, days=days, is_written=True)
    return _read_silver(t, path)


def gold_incremental(t: Layers) -> DataFrame:
    delta = written(t.delta(), "delta")
    before = written(t.early_silver, "silver")
    after = written(I.merge_silver(before, delta), "silver")
    return I.refresh_gold(
        t.gold_of(before),
        after,
        t.stg_hotels,
        I.affected_days(before, delta),
        as_of=AS_OF,
        hotels_bound=t.hotels_raw,
    )


def booking_tables(t: Layers) -> BookingTables:
    return BookingTables(
        t.spark,
        new_folder(t.spark, "tables"),
        t.feeds.bookings_raw(),
        t.feeds.booking_events_raw(),
        t.hotels_raw,
        as_of=AS_OF,
    )


def refreshed_tables(t: Layers) -> BookingTables:
    """Both tables built up to the mark, then refreshed with what came after."""
    stored = booking_tables(t)
    stored.full_refresh(until=MARK)
    stored.incremental_refresh(MARK)
    return stored


def stored_staging(t: Layers) -> DataFrame:
    """Rows of each stored table, and the days that it is partitioned by."""
    stored = booking_tables(t)
    stored.publish_staging()

    def told(name: str) -> DataFrame:
        df = stored.staged(name)
        day = F.col(df.columns[-1]) if name != "stg_hotels" else F.lit(None).cast("date")
        return df.agg(
            F.lit(name).alias("table"),
            F.count("*").alias("row_count"),
            F.count_distinct(day).alias("days"),
            F.min(day).alias("first_day"),
            F.max(day).alias("last_day"),
        )

    return reduce(DataFrame.unionByName, [told(name) for name in staged_tables(t)])


# --- sinks ----------------------------------------------------------------------------


def full_refresh_roundtrip(t: Layers) -> DataFrame:
    path = new_folder(t.spark, "silver")
    tables.write_table(t.silver, path, sort_by=["booking_id"])
    return tables.read_table(t.spark, path)


def idempotent_rerun(t: Layers) -> DataFrame:
    """Gold published twice: the rows of the second version, and what it changed."""
    root, gold = new_folder(t.spark, "gold"), written(t.gold, "gold")
    paths = [tables.publish(gold, root, partition_by=["booking_date"]) for _ in range(2)]
    first, second = (tables.read_table(t.spark, path, t.gold.schema) for path in paths)
    changed = R.gold_differences(first, second).count()
    numbers = {
        "versions": F.lit(len(list_folder(t.spark, f"{root}/data"))),
        "changed": F.lit(changed),
    }
    return tables.current(t.spark, root, t.gold.schema).withColumns(numbers)


def partitioned_scan(t: Layers) -> DataFrame:
    silver = _read_silver(t, _write_silver(t, t.silver, "silver"))
    return tables.between(silver, "created_at", "created_date", *BACKFILL)


def sparse_scan(t: Layers) -> DataFrame:
    """Days of silver that lie far apart."""
    silver = _read_silver(t, _write_silver(t, t.silver, "silver"))
    days = written(silver.select("created_date").distinct().where(SPARSE_DAYS), "days")
    return tables.on_days(silver, "created_date", days)


def clustered_lookup(t: Layers) -> DataFrame:
    """Bookings by id, from files sorted by it."""
    path = new_folder(t.spark, "silver")
    tables.write_clustered(t.silver, path, "booking_id")
    ids = t.feeds.table("orders").select(F.col("o_orderkey").alias("booking_id")).where(FOUND_IDS)
    return tables.lookup(tables.read_table(t.spark, path), "booking_id", written(ids, "ids"))


@contextmanager
def _database(t: Layers) -> Iterator[str]:
    """A database of the catalog, for the length of a block."""
    name = f"staymark_{uuid.uuid4().hex}"
    t.spark.sql(f"CREATE DATABASE {name} LOCATION '{new_folder(t.spark, name)}'")
    try:
        yield name
    finally:
        t.spark.sql(f"DROP DATABASE {name} CASCADE")


def created_and_dropped(t: Layers) -> DataFrame:
    """A table declared twice, filled by SQL, read and dropped."""
    t.stored_silver.createOrReplaceTempView("silver_to_insert")
    with _database(t) as database:
        name = f"{database}.silver"
        for _ in range(2):
            tables.create_table(t.spark, name, t.silver.schema, new_folder(t.spark, "silver"))
        t.spark.sql(f"INSERT INTO {name} SELECT * FROM silver_to_insert")
        held = written(t.spark.table(name), "silver")
        tables.drop_table(t.spark, name)
        tables.drop_table(t.spark, name)
        present = t.spark.catalog.tableExists(name)
    t.spark.catalog.dropTempView("silver_to_insert")
    return held.withColumn("present_after_drop", F.lit(present))


def staging_by_views(t: Layers) -> DataFrame:
    """Staging read through views of the catalog, by SQL alone."""
    raw = {
        "bookings_raw": t.feeds.bookings_raw(),
        "booking_events_raw": t.feeds.booking_events_raw(),
        "hotels_raw": t.hotels_raw,
    }
    with _database(t) as database:
        for name, df in raw.items():
            path = new_folder(t.spark, name)
            df.write.parquet(path)
            tables.create_table(t.spark, f"{database}.{name}", df.schema, path)
        views.create_staging_views(t.spark, database)
        return t.spark.sql(f"""
            SELECT b.*, h.city, coalesce(h.star_rating, 0) AS star_rating, coalesce(e.events, 0) AS events
            FROM {database}.stg_bookings b
            LEFT JOIN {database}.stg_hotels h ON h.hotel_id = b.hotel_id
            LEFT JOIN (SELECT booking_id, count(*) AS events FROM {database}.stg_booking_events
                       GROUP BY booking_id) e ON e.booking_id = b.booking_id""")


def csv_roundtrip(t: Layers) -> DataFrame:
    """Snapshots beside their events, where these are missing too, through typed CSV."""
    feed = S.snapshot_with_events(t.bookings, t.events)
    path = new_folder(t.spark, "seed")
    write_seed(feed, path)
    return read_seed(t.spark, path, feed.schema)


def serve_stored(t: Layers) -> DataFrame:
    """The serving query over the stored gold table, of which it reads the days asked for."""
    path = new_folder(t.spark, "gold")
    tables.write_table(t.gold, path, partition_by=["booking_date"], sort_by=["city"])
    return G.serve_kpis(tables.read_table(t.spark, path, t.gold.schema), SINCE)


def _early_gold_table(t: Layers) -> str:
    path = new_folder(t.spark, "gold")
    tables.write_table(t.early_gold, path, partition_by=["booking_date"], sort_by=["city"])
    return path


def partition_overwrite(t: Layers) -> DataFrame:
    path = _early_gold_table(t)
    days = written(t.delta().select(F.to_date("created_at").alias("day")).distinct(), "days")
    renewed = written(tables.on_days(t.gold, "booking_date", days), "kpis")
    tables.overwrite_days(renewed, path, "booking_date", sort_by=["city"], answers_for=days)
    return tables.read_table(t.spark, path, t.gold.schema)


def backfill_range(t: Layers) -> DataFrame:
    path = _early_gold_table(t)
    first, end = (F.lit(d).cast("date") for d in BACKFILL)

    def in_range(column: str):
        return (F.col(column) >= first) & (F.col(column) < end)

    created = t.silver.withColumn("_day", F.to_date("created_at"))
    stored = tables.read_table(t.spark, path, t.gold.schema)
    tables.overwrite_days(
        written(t.gold_of(created.where(in_range("_day"))), "kpis"),
        path,
        "booking_date",
        sort_by=["city"],
        answers_for=stored.where(in_range("booking_date")).select("booking_date"),
    )
    return tables.read_table(t.spark, path, t.gold.schema)


def backfill_tables(t: Layers) -> DataFrame:
    """Gold built too early, of which only a range of days is computed again."""
    stored = booking_tables(t)
    stored.full_refresh(until=MARK)
    tables.publish(
        tables.with_day(t.silver, "created_at", "created_date"),
        stored.silver_root,
        partition_by=["created_date"],
    )
    first, end = (dt.date.fromisoformat(d) for d in BACKFILL)
    stored.backfill(first.isoformat(), (end - dt.timedelta(days=1)).isoformat())
    return stored.gold()


def compacted(t: Layers) -> DataFrame:
    """Silver in too many files, brought into shape; and how many days are not in it after."""
    path = new_folder(t.spark, "silver")
    scattered = tables.with_day(t.silver, "created_at", "created_date").repartition(4)
    scattered.write.partitionBy("created_date").parquet(path)
    schema = _with_created_date(t.silver.schema)
    days = tables.compact(t.spark, path, "created_date", ["booking_id"], schema=schema)
    left = tables.crowded_partitions(t.spark, path, "created_date").count()
    shape = {"compacted": F.lit(len(days) > 0), "crowded_days": F.lit(left)}
    return _read_silver(t, path).withColumns(shape)


def evolved(t: Layers) -> DataFrame:
    mark = F.lit(MARK).cast("timestamp_ntz")
    old, new = new_folder(t.spark, "silver-v1"), new_folder(t.spark, "silver-v2")
    silver = t.stored_silver
    tables.write_table(
        silver.where(F.col("last_updated_at") <= mark).drop("_raw_event_status"), old
    )
    tables.write_table(silver.where(F.col("last_updated_at") > mark), new)
    return tables.read_evolved(t.spark, old, new).select(*silver.columns)


@contextmanager
def _analyzed_gold(t: Layers) -> Iterator[str]:
    """Gold as a table of the catalog that has statistics, for the length of a block."""
    path = new_folder(t.spark, "gold")
    tables.write_table(t.gold, path, partition_by=["booking_date"], sort_by=["city"])
    day = t.gold.schema["booking_date"]
    others = T.StructType([f for f in t.gold.schema.fields if f.name != day.name])
    with _database(t) as database:
        tables.create_table(t.spark, f"{database}.gold", others, path, day)
        statistics.analyze(t.spark, f"{database}.gold")
        yield f"{database}.gold"


def analyzed(t: Layers) -> DataFrame:
    """Gold read through the catalog, and how many rows its statistics say it has."""
    with _analyzed_gold(t) as name:
        known = statistics.stored_statistics(t.spark, name).rows
        read = t.spark.table(name).select(*t.gold.columns)
        # Written, for a partitioned table of the catalog is listed only when it is read.
        return written(read.withColumn("analyzed_rows", F.lit(known)), "gold")


def table_statistics(t: Layers) -> DataFrame:
    """What the catalog says of gold's columns; distinct values are approximate, so only
    whether they are within a tenth is told."""

    def shown(bound: str) -> Column:
        """Numbers as they are, days as their number, as one type for all columns."""
        day = F.expr(f"unix_date(try_cast({bound} AS date))").cast("double")
        number = F.expr(f"try_cast({bound} AS double)")
        return F.when(F.col("column") == "booking_date", day).otherwise(number).alias(bound)

    near = F.abs(F.col("distinct_count") - F.col("exact")) * 10 <= F.col("exact")
    with _analyzed_gold(t) as name:
        columns = [c for c in t.gold.columns if c != "_computed_at"]
        counts = t.spark.table(name).agg(*[F.count_distinct(c).alias(c) for c in columns])
        exact = counts.unpivot([], columns, "column", "exact")
        told = statistics.statistics_report(t.spark, name).join(exact, "column")
        told = told.select("column", "row_count", "null_count", near.alias("distinct_is_near"), shown("low"), shown("high"))
        return written(told, "statistics")


# --- streaming ------------------------------------------------------------------------


def streamed_silver(t: Layers) -> DataFrame:
    """All rows of both feeds in one batch."""
    return _streamed(t, [t.bookings], [t.events])


def streamed_batches(t: Layers) -> DataFrame:
    """Both feeds in four deliveries, each after a restart. They are dealt out by hash, so a
    delivery holds snapshots and events older than those of the deliveries before. The snapshots
    are joined once, not for every delivery."""
    parts = range(4)

    def dealt(df: DataFrame) -> list[DataFrame]:
        part = F.pmod(F.xxhash64(*df.columns), F.lit(len(parts)))
        return [df.where(part == n) for n in parts]

    return _streamed(t, dealt(written(t.bookings, "bookings")), dealt(t.events))


def _streamed(t: Layers, bookings: list[DataFrame], events: list[DataFrame]) -> DataFrame:
    feeds, state = new_folder(t.spark, "feeds"), new_folder(t.spark, "stream")
    create_empty_silver(t.spark, f"{state}/silver", t.silver.schema)
    for some_bookings, some_events in zip(bookings, events, strict=True):
        some_bookings.write.mode("append").parquet(f"{feeds}/bookings")
        some_events.write.mode("append").parquet(f"{feeds}/events")
        query = start_silver_stream(
            t.spark.readStream.schema(t.bookings.schema).parquet(f"{feeds}/bookings"),
            t.spark.readStream.schema(t.events.schema).parquet(f"{feeds}/events"),
            f"{state}/silver",
            f"{state}/checkpoint",
            t.silver.schema,
            as_of=AS_OF,
            trigger={"availableNow": True},
        )
        query.awaitTermination()
    return _read_silver(t, f"{state}/silver")


def streamed_staging(t: Layers) -> DataFrame:
    """Events in four deliveries by their time, each with copies of its own rows and with the
    last days of the one before once more."""
    feed, state = new_folder(t.spark, "feed"), new_folder(t.spark, "stream")
    ends = t.events.agg(F.min("event_ts").alias("low"), F.max("event_ts").alias("high")).first()
    quarter, again = (ends["high"] - ends["low"]) / 4, dt.timedelta(days=5)
    for n in range(4):
        low, high = (F.lit(ends["low"] + quarter * i) for i in (n, n + 1))
        at = F.col("event_ts")
        due = t.events.where((at >= low - F.lit(again)) & ((at < high) if n < 3 else F.lit(True)))
        due.unionByName(due).write.mode("append").parquet(feed)
        source = t.spark.readStream.schema(t.events.schema).parquet(feed)
        query = start_event_stream(
            source, f"{state}/events", f"{state}/checkpoint", delay="30 days", trigger={"availableNow": True}
        )
        query.awaitTermination()
    return t.spark.read.schema(t.events.schema).parquet(f"{state}/events")


# --- checks that need a prepared input ------------------------------------------------


def hotels_missing(t: Layers) -> DataFrame:
    hotels = broadcast_if_fits(t.stg_hotels, bound=t.hotels_raw)
    located = t.stg_bookings.join(hotels, "hotel_id", "left")
    return Q.not_null(located, "city").select("booking_id", "updated_at", "hotel_id", "city")


def unlisted_events(t: Layers) -> DataFrame:
    return Q.accepted_values(
        t.feeds.table("events").select("event_id", "user_id", "event_type"),
        "event_type",
        ["view", "click", "purchase"],
    )


def rate_as_percent(t: Layers) -> DataFrame:
    return t.gold.withColumn("cancellation_rate", F.col("cancellation_rate") * 100)


def price_after_fee(t: Layers) -> DataFrame:
    return unsettled(t.silver).withColumn("price", F.col("price") - 20000)


def all_tables(t: Layers) -> dict[str, DataFrame]:
    """Every table of the flow, each read more than once, so each written once."""
    raw = {
        "bookings_raw": written(t.bookings, "bookings"),
        "booking_events_raw": written(t.events, "events"),
        "hotels_raw": written(t.hotels_raw, "hotels"),
    }
    silver = written(S.silver_bookings(raw["bookings_raw"], raw["booking_events_raw"], as_of=AS_OF), "silver")
    return raw | {
        "stg_bookings": staging.stg_bookings(raw["bookings_raw"]),
        "stg_booking_events": staging.stg_booking_events(raw["booking_events_raw"]),
        "stg_hotels": written(staging.stg_hotels(raw["hotels_raw"]), "hotels"),
        "silver_bookings": silver,
        "gold_daily_city_kpis": t.gold_of(silver),
    }


def staged_tables(t: Layers) -> dict[str, DataFrame]:
    return {
        "stg_bookings": t.stg_bookings,
        "stg_booking_events": t.stg_events,
        "stg_hotels": t.stg_hotels,
    }


def _sides_as(differences: DataFrame, kind: str, *columns: str) -> DataFrame:
    """Values that one side may lack, in a type every client shows the same way."""
    sides = [f"{side}_{c}" for side in ("left", "right") for c in columns]
    return differences.withColumns({c: F.col(c).cast(kind) for c in sides})


def silver_drift(t: Layers) -> DataFrame:
    return _sides_as(R.silver_differences(t.early_silver, t.silver), "string", "_had_conflict")


def planted_silver(t: Layers) -> DataFrame:
    """Silver of which some bookings are lost and others cost more."""
    price = F.when(F.expr(RAISED), F.col("price") + 1).otherwise(F.col("price"))
    return t.stored_silver.where(f"NOT ({LOST})").withColumn("price", price.cast(t.silver.schema["price"].dataType))


def silver_drift_by_digest(t: Layers) -> DataFrame:
    planted = written(planted_silver(t), "planted")
    found = R.silver_differences_by_digest(t.stored_silver, planted)
    return _sides_as(found, "string", "_had_conflict")


def gold_drift(t: Layers) -> DataFrame:
    return _sides_as(R.gold_differences(merged_gold(t), t.gold), "double", *R.GOLD_COMPARED)


def staged_silver(t: Layers) -> DataFrame:
    return S.silver_bookings(t.stg_bookings, t.stg_events, as_of=AS_OF)


def merged_gold(t: Layers) -> DataFrame:
    return t.gold_of(merge_upsert(t))


_KPI = ("booking_date", "city")

_QUERIES: dict[str, Callable[[Layers], DataFrame]] = {
    # staging
    "stg_bookings": lambda t: t.stg_bookings,
    "stg_booking_events": lambda t: t.stg_events,
    "stg_hotels": lambda t: t.stg_hotels,
    # silver
    "latest_booking_snapshot": lambda t: S.latest_snapshot(t.bookings),
    "latest_event": lambda t: S.event_state(t.events).select(
        "booking_id", "event_status", "event_updated_at"
    ),
    "event_timestamps_pivot": lambda t: S.event_state(t.events).select(
        "booking_id", "event_created_at", "event_confirmed_at", "event_cancelled_at"
    ),
    "join_left_snapshot_event": lambda t: S.snapshot_with_events(t.bookings, t.events),
    "silver_bookings": lambda t: t.silver,
    "silver_bookings_staged": staged_silver,
    "silver_resolved_status": lambda t: t.silver.select("booking_id", "booking_status"),
    "silver_last_updated": lambda t: t.silver.select("booking_id", "last_updated_at"),
    "silver_conflicts": lambda t: R.conflicts(t.silver),
    "silver_terminal_ever": lambda t: t.silver_ever,
    # gold
    "enrich_city_broadcast": lambda t: G.enrich_city(
        t.silver, t.stg_hotels, hotels_bound=t.hotels_raw
    ),
    "gold_daily_city_kpis": lambda t: t.gold.orderBy(*_KPI),
    "gold_daily_city_kpis_large_dimension": lambda t: t.gold_of(
        t.silver, broadcast_bytes=NO_BROADCAST
    ),
    "gold_reduced": lambda t: t.gold.drop("avg_confirmed_price", "_computed_at"),
    "kpi_status_counts": lambda t: t.gold.select(
        *_KPI, "confirmed_bookings", "cancelled_bookings", "pending_bookings"
    ),
    "kpi_cancellation_rate": lambda t: t.gold.select(*_KPI, "cancellation_rate"),
    "kpi_confirmed_revenue": lambda t: t.gold.select(*_KPI, "total_confirmed_revenue"),
    "kpi_avg_prices": lambda t: t.gold.select(*_KPI, "avg_booking_price", "avg_confirmed_price"),
    "serve_kpis_since": lambda t: G.serve_kpis(t.gold, SINCE),
    "serve_stored_kpis": serve_stored,
    # incremental
    "silver_hwm_delta": lambda t: t.delta(),
    "silver_hwm_delta_large": lambda t: t.delta(broadcast_bytes=NO_BROADCAST),
    "silver_merge_upsert": merge_upsert,
    "silver_merge_upsert_large": lambda t: merge_upsert(t, broadcast_bytes=NO_BROADCAST),
    "silver_upsert_table": upsert_table,
    "silver_upsert_by_key_index": upsert_by_key_index,
    "gold_incremental_refresh": gold_incremental,
    "gold_incremental_refresh_tables": lambda t: refreshed_tables(t).gold(),
    # sinks
    "write_staging_tables": stored_staging,
    "write_full_refresh_roundtrip": full_refresh_roundtrip,
    "write_idempotent_rerun": idempotent_rerun,
    "silver_partitioned_scan": partitioned_scan,
    "sparse_days_scan": sparse_scan,
    "clustered_lookup": clustered_lookup,
    "gold_partition_overwrite": partition_overwrite,
    "gold_backfill_range": backfill_range,
    "gold_backfill_tables": backfill_tables,
    "compact_partitions": compacted,
    "schema_evolution_union": evolved,
    "analyzed_table_scan": analyzed,
    "table_statistics": table_statistics,
    "table_create_drop": created_and_dropped,
    "staging_views_sql": staging_by_views,
    "seed_csv_roundtrip": csv_roundtrip,
    # quality
    "dq_not_null": hotels_missing,
    "dq_unique": lambda t: Q.unique(t.feeds.table("lineitem"), ["l_orderkey", "l_linenumber"]),
    "dq_accepted_values": unlisted_events,
    "dq_one_row_per_key": lambda t: Q.one_row_per_key(t.stg_bookings),
    "dq_valid_status": lambda t: Q.valid_status(t.silver, UNCANCELLED),
    "dq_no_future_dates": lambda t: Q.no_future_dates(t.silver, TODAY),
    "dq_counts_add_up": lambda t: Q.counts_add_up(t.gold_of(unsettled(t.silver))),
    "dq_rate_bounds": lambda t: Q.rate_in_bounds(rate_as_percent(t)),
    "dq_non_negative": lambda t: Q.money_not_negative(t.gold_of(refunded(t.silver))),
    "dq_silver_gold_consistency": lambda t: Q.silver_gold_consistency(t.silver, t.early_gold),
    "dq_revenue_consistency": lambda t: Q.revenue_consistency(t.stored_silver, t.stored_gold),
    "dq_booking_sanity": lambda t: Q.booking_sanity(price_after_fee(t)),
    "dq_status_transitions": lambda t: Q.status_transitions(t.silver_ever),
    "quality_gate": lambda t: Q.quality_gate(t.stored_silver, t.stored_gold),
    "quality_gate_stale_gold": lambda t: Q.quality_gate(t.silver, t.early_gold),
    "quality_gate_verdict": lambda t: Q.gate_verdict(Q.quality_gate(t.silver, t.early_gold)),
    "validation_messages": lambda t: Q.validation_messages(
        t.stored_silver, t.gold_of(unsettled(t.stored_silver))
    ),
    "dq_freshness": lambda t: Q.freshness(t.events, AS_OF, FRESH_HOURS),
    "dq_declared_tests": lambda t: Q.declared_tests(all_tables(t)),
    # reports and comparisons
    "report_booking_states": lambda t: R.booking_states(t.silver),
    "report_status_distribution": lambda t: R.status_distribution(t.silver),
    "report_kpi_listing": lambda t: R.kpi_listing(t.gold),
    "report_overall_totals": lambda t: R.overall_totals(t.gold),
    "report_input_volumes": lambda t: R.input_volumes(staged_tables(t)),
    "reconcile_silver": silver_drift,
    "reconcile_silver_summary": lambda t: R.silver_match(t.early_silver, t.silver),
    "reconcile_gold": gold_drift,
    "reconcile_gold_summary": lambda t: R.gold_match(merged_gold(t), t.gold),
    "reconcile_by_digest": silver_drift_by_digest,
    "reconcile_two_builds": lambda t: R.silver_match(staged_silver(t), t.silver),
    # streaming
    "stream_silver_upsert": streamed_silver,
    "stream_silver_batches": streamed_batches,
    "stream_staging_dedupe": streamed_staging,
}


def _runner(build: Callable[[Layers], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, directory: _comparable(build(Layers(spark, directory)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _runner(build) for name, build in _QUERIES.items()}
