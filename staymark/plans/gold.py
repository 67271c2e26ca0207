"""Gold: daily KPIs per city.

Everything is carried as counts and sums until the last step, so partial results
add up: Spark combines them before the shuffle, and the two routes below agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staymark.functions.columns import audit_time, exact_mean, share
from staymark.operators.sizing import BROADCAST_BYTES, broadcast_if_fits, fits_broadcast
from staymark.schemas import GOLD_COLUMNS, REVENUE
from staymark.statuses import DEFAULT_STATUSES, StatusModel

UNKNOWN_CITY = "Unknown"
DIMENSIONS = ("booking_date", "city")
_SUMS = ("_price_sum", "_earned_sum")
_COUNTS = ("_price_count", "_earned_count")


def _city() -> Column:
    return F.coalesce("city", F.lit(UNKNOWN_CITY)).alias("city")


def booking_facts(silver: DataFrame) -> DataFrame:
    """The columns of silver that gold needs, with the reporting day."""
    return silver.select(
        "booking_id",
        "hotel_id",
        "booking_status",
        "price",
        F.to_date("created_at").alias("booking_date"),
    )


def enrich_city(
    silver: DataFrame,
    hotels: DataFrame,
    *,
    hotels_bound: DataFrame | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Bookings with day, city and stars; 'Unknown' and 0 where the hotel is not known.

    ``hotels`` is broadcast if it is measured to fit. ``hotels_bound`` is a cheaper
    relation to measure that cannot be smaller, such as the table before dedupe.
    """
    hotels = broadcast_if_fits(hotels, broadcast_bytes, bound=hotels_bound)
    return booking_facts(silver).join(hotels, "hotel_id", "left").select(
        "booking_id",
        "booking_status",
        "price",
        "booking_date",
        _city(),
        F.coalesce("star_rating", F.lit(0)).alias("star_rating"),
    )


def _first_measures(model: StatusModel) -> list[Column]:
    status, price = F.col("booking_status"), F.col("price")
    earned = F.when(status == model.earning, price)
    return [
        F.count("*").alias("total_bookings"),
        *[
            F.count(F.when(status == name, 1)).alias(column)
            for name, column in model.counters.items()
        ],
        F.sum(price).alias("_price_sum"),
        F.count(price).alias("_price_count"),
        F.sum(earned).alias("_earned_sum"),
        F.count(earned).alias("_earned_count"),
    ]


def _added_measures(model: StatusModel) -> list[Column]:
    counts = ["total_bookings", *model.counters.values(), *_COUNTS]
    return [F.sum(c).alias(c) for c in counts] + [
        F.sum(c).cast(REVENUE).alias(c) for c in _SUMS
    ]


def _finished(measures: DataFrame, dims: Sequence[str], model: StatusModel) -> DataFrame:
    return measures.select(
        *dims,
        "total_bookings",
        *model.counters.values(),
        share(F.col(model.counters[model.lost]), F.col("total_bookings")).alias(
            "cancellation_rate"
        ),
        F.coalesce("_earned_sum", F.lit(0)).cast(REVENUE).alias("total_confirmed_revenue"),
        exact_mean(F.col("_price_sum"), F.col("_price_count")).alias("avg_booking_price"),
        F.coalesce(
            exact_mean(F.col("_earned_sum"), F.col("_earned_count")), F.lit(0)
        )
        .cast("decimal(10,2)")
        .alias("avg_confirmed_price"),
    )


def kpi_agg(
    facts: DataFrame, dims: Sequence[str], model: StatusModel = DEFAULT_STATUSES
) -> DataFrame:
    """The KPI columns of ``facts`` (booking_status, price) for every value of ``dims``."""
    return _finished(facts.groupBy(*dims).agg(*_first_measures(model)), dims, model)


def daily_city_kpis(
    silver: DataFrame,
    hotels: DataFrame,
    model: StatusModel = DEFAULT_STATUSES,
    *,
    as_of: str | None = None,
    hotels_bound: DataFrame | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """One row per day and city.

    If hotels are measured to fit, they are broadcast and bookings are grouped by
    (day, city) at once. If not, bookings are first grouped by (day, hotel), which
    leaves at most one row per day even of a hotel with much of the data; those
    rows are joined to hotels and added up.
    """
    facts = booking_facts(silver)
    measured = hotels if hotels_bound is None else hotels_bound
    cities = hotels.select("hotel_id", "city")
    if fits_broadcast(measured, broadcast_bytes):
        located = facts.join(F.broadcast(cities), "hotel_id", "left").withColumn("city", _city())
        measures = located.groupBy(*DIMENSIONS).agg(*_first_measures(model))
    else:
        per_hotel = facts.groupBy("booking_date", "hotel_id").agg(*_first_measures(model))
        located = per_hotel.join(cities, "hotel_id", "left").withColumn("city", _city())
        measures = located.groupBy(*DIMENSIONS).agg(*_added_measures(model))
    kpis = _finished(measures, DIMENSIONS, model).withColumn("_computed_at", audit_time(as_of))
    extra = [c for c in model.counters.values() if c not in GOLD_COLUMNS]
    return kpis.select(*GOLD_COLUMNS, *extra)


def serve_kpis(gold: DataFrame, since: str) -> DataFrame:
    """The dashboard query: KPIs from a day on, in reading order."""
    return (
        gold.where(F.col("booking_date") >= F.lit(since).cast("date"))
        .select(
            "booking_date",
            "city",
            "total_bookings",
            "cancellation_rate",
            "total_confirmed_revenue",
        )
        .orderBy("booking_date", "city")
    )
