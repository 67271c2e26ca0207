"""Inspection reports and comparisons over the built tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staymark.operators.reconcile import differences, differences_by_digest, match_summary

SILVER_COMPARED = ("booking_status", "price", "_had_conflict")
GOLD_COMPARED = (
    "total_bookings",
    "confirmed_bookings",
    "cancelled_bookings",
    "pending_bookings",
    "cancellation_rate",
    "total_confirmed_revenue",
    "avg_booking_price",
    "avg_confirmed_price",
)


def booking_states(silver: DataFrame) -> DataFrame:
    return silver.select(
        "booking_id",
        "booking_status",
        "price",
        F.to_date("created_at").alias("created_date"),
        "_raw_snapshot_status",
        "_raw_event_status",
        "_had_conflict",
    ).orderBy("booking_id")


def status_distribution(silver: DataFrame) -> DataFrame:
    return (
        silver.groupBy("booking_status")
        .agg(F.count("*").alias("count"), F.round(F.sum("price"), 2).alias("total_price"))
        .orderBy("booking_status")
    )


def conflicts(silver: DataFrame) -> DataFrame:
    return silver.where("_had_conflict").select(
        "booking_id",
        "_raw_snapshot_status",
        "_raw_event_status",
        F.col("booking_status").alias("resolved_to"),
    )


def kpi_listing(gold: DataFrame) -> DataFrame:
    return gold.select(
        "booking_date",
        "city",
        "total_bookings",
        "confirmed_bookings",
        "cancelled_bookings",
        "pending_bookings",
        F.round("cancellation_rate", 4).alias("cancel_rate"),
        F.col("total_confirmed_revenue").alias("revenue"),
        F.col("avg_booking_price").alias("avg_price"),
    ).orderBy("booking_date", "city")


def overall_totals(gold: DataFrame) -> DataFrame:
    return gold.agg(
        F.sum("total_bookings").alias("total_bookings"),
        F.sum("confirmed_bookings").alias("confirmed"),
        F.sum("cancelled_bookings").alias("cancelled"),
        F.sum("pending_bookings").alias("pending"),
        F.round(F.sum("total_confirmed_revenue"), 2).alias("total_revenue"),
    )


def input_volumes(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of every table."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def silver_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    return differences(left, right, ["booking_id"], SILVER_COMPARED)


def silver_differences_by_digest(left: DataFrame, right: DataFrame) -> DataFrame:
    return differences_by_digest(left, right, ["booking_id"], SILVER_COMPARED)


def gold_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    return differences(left, right, ["booking_date", "city"], GOLD_COMPARED)


def silver_match(left: DataFrame, right: DataFrame) -> DataFrame:
    return match_summary(left, right, ["booking_id"], SILVER_COMPARED)


def gold_match(left: DataFrame, right: DataFrame) -> DataFrame:
    return match_summary(left, right, ["booking_date", "city"], GOLD_COMPARED)
