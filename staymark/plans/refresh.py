"""The whole flow on stored tables: full refresh and incremental refresh.

All tables live below one root as published versions (see ``sinks.tables``). A full
refresh publishes new versions; an incremental one rewrites, in the current versions,
only the days it touches. Silver and gold do not need the stored staging tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staymark.plans import staging
from staymark.plans.gold import daily_city_kpis
from staymark.plans.incremental import silver_delta
from staymark.plans.quality import quality_gate
from staymark.plans.silver import silver_bookings
from staymark.sinks import tables
from staymark.sinks.day_index import DayIndex
from staymark.sinks.locations import staged
from staymark.statuses import DEFAULT_STATUSES, StatusModel

SILVER_DAY = "created_date"
GOLD_DAY = "booking_date"
# Stored staging table -> (timestamp, day it is partitioned by); hotels are small.
_STAGING_DAYS = {
    "stg_bookings": ("created_at", "created_date"),
    "stg_booking_events": ("event_ts", "event_date"),
}


def _with_day(schema: T.StructType, day: str = SILVER_DAY) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(day, T.DateType())])


class BookingTables:
    """Silver and gold below ``root``, fed from the three raw feeds."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        bookings_raw: DataFrame,
        events_raw: DataFrame,
        hotels_raw: DataFrame,
        model: StatusModel = DEFAULT_STATUSES,
        *,
        as_of: str | None = None,
    ):
        self.spark, self.root, self.model, self.as_of = spark, root, model, as_of
        self.silver_root, self.gold_root = f"{root}/silver_bookings", f"{root}/gold_daily_city_kpis"
        self.index = DayIndex(spark, f"{root}/silver_day_index")
        self.bookings = staging.typed_bookings(bookings_raw)
        self.events = staging.typed_events(events_raw)
        self.hotels_raw = hotels_raw
        self._staging = {
            "stg_bookings": staging.stg_bookings(bookings_raw),
            "stg_booking_events": staging.stg_booking_events(events_raw),
            "stg_hotels": staging.stg_hotels(hotels_raw),
        }
        silver = silver_bookings(self.bookings, self.events, model, as_of=as_of)
        self._silver_schema = silver.schema
        # No broadcast, so nothing is measured: only the schema is wanted.
        self._gold_schema = self._kpis(silver, broadcast_bytes=0).schema

    def silver(self) -> DataFrame:
        """The current silver table, with its partition column."""
        return tables.current(self.spark, self.silver_root, _with_day(self._silver_schema))

    def gold(self) -> DataFrame:
        """The current gold table."""
        gold = tables.current(self.spark, self.gold_root, self._gold_schema)
        return gold.select(*self._gold_schema.names)  # a partition column reads last

    def staged(self, name: str) -> DataFrame:
        """The current stored staging table of that name."""
        schema = self._staging[name].schema
        if name in _STAGING_DAYS:
            schema = _with_day(schema, _STAGING_DAYS[name][1])
        return tables.current(self.spark, f"{self.root}/{name}", schema)

    def create_views(self) -> None:
        """Temporary views for SQL: lazy staging, and the current silver and gold."""
        for name, df in self._staging.items():
            df.createOrReplaceTempView(name)
        self.silver().createOrReplaceTempView("silver_bookings")
        self.gold().createOrReplaceTempView("gold_daily_city_kpis")

    def gate(self) -> DataFrame:
        """The quality gate over the current tables."""
        return quality_gate(self.silver(), self.gold(), self.model)

    def _kpis(self, silver: DataFrame, **options) -> DataFrame:
        return daily_city_kpis(
            silver,
            self._staging["stg_hotels"],
            self.model,
            as_of=self.as_of,
            hotels_bound=self.hotels_raw,
            **options,
        )

    def publish_staging(self) -> None:
        """Store the deduplicated feeds by day, sorted by booking, and hotels as they are."""
        for name, df in self._staging.items():
            timestamp, day = _STAGING_DAYS.get(name, (None, None))
            if day is None:
                tables.publish(df, f"{self.root}/{name}", sort_by=["hotel_id"])
                continue
            tables.publish(
                tables.with_day(df, timestamp, day),
                f"{self.root}/{name}",
                partition_by=[day],
                sort_by=["booking_id"],
            )

    def full_refresh(self, until: str | None = None) -> None:
        """Rebuild both tables from all rows, or from those up to a time."""
        bookings, events = self.bookings, self.events
        if until is not None:
            end = F.lit(until).cast("timestamp_ntz")
            bookings = bookings.where(F.col("updated_at") <= end)
            events = events.where(F.col("event_ts") <= end)
        silver = silver_bookings(bookings, events, self.model, as_of=self.as_of)
        tables.publish(
            tables.with_day(silver, "created_at", SILVER_DAY),
            self.silver_root,
            partition_by=[SILVER_DAY],
            sort_by=["booking_id"],
        )
        self.index.build(self.silver(), SILVER_DAY)
        tables.publish(
            self._kpis(self.silver()), self.gold_root, partition_by=[GOLD_DAY], sort_by=["city"]
        )

    def incremental_refresh(self, mark: str) -> None:
        """Merge bookings with news past ``mark`` into silver and redo their days in gold.

        Silver is read on the days that the index names, and nowhere else.
        """
        delta = silver_delta(self.bookings, self.events, mark, self.model, as_of=self.as_of)
        silver_path = tables.current_path(self.spark, self.silver_root)
        if not self.index.exists():
            self.index.build(self.silver(), SILVER_DAY)
        with staged(delta, "delta") as delta:
            if delta.isEmpty():
                return
            days = self.index.admit(delta, F.to_date("created_at"))
            tables.upsert_silver(
                self.spark,
                silver_path,
                delta,
                _with_day(self._silver_schema),
                day=SILVER_DAY,
                days=days,
                is_written=True,
            )
            self._redo_gold(days, tables.on_days(self.silver(), SILVER_DAY, days))
        if self.index.crowded():
            self.index.fold()

    def backfill(self, first: str, last: str) -> None:
        """Recompute gold for the days from ``first`` to ``last`` from current silver."""
        days = self.spark.sql(
            f"SELECT explode(sequence(DATE'{first}', DATE'{last}', INTERVAL 1 DAY)) AS day"
        )
        low, high = F.lit(first).cast("date"), F.lit(last).cast("date")
        self._redo_gold(days, self.silver().where(F.col(SILVER_DAY).between(low, high)))

    def _redo_gold(self, days: DataFrame, silver: DataFrame) -> None:
        """Replace ``days`` of gold by those of ``silver``, which has no others."""
        with staged(self._kpis(silver), "kpis") as kpis:
            tables.overwrite_days(
                kpis,
                tables.current_path(self.spark, self.gold_root),
                GOLD_DAY,
                sort_by=["city"],
                answers_for=days,
            )
