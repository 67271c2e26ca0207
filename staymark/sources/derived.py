"""Booking feeds derived from the order tables.

Line items serve as snapshots of an order, click events as the booking event log,
suppliers as hotels. Suppliers with a balance below 1,000 are not listed as hotels, so
that unknown hotels occur.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staymark.schemas import NTZ, PRICE


# Schema of every table file read so far, so that a file's footer is read once.
_SCHEMAS: dict[str, T.StructType] = {}


class DerivedFeeds:
    """The three raw feeds over one directory of tables."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory

    def table(self, name: str) -> DataFrame:
        path = f"{self.directory}/{name}.parquet"
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)

    def bookings_raw(self) -> DataFrame:
        lines, orders = self.table("lineitem"), self.table("orders")
        flag = F.col("l_returnflag")
        status = (
            F.when(flag == "N", "created").when(flag == "A", "confirmed").otherwise("cancelled")
        )
        return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.col("l_orderkey").alias("booking_id"),
            F.col("o_custkey").alias("user_id"),
            F.col("l_suppkey").alias("hotel_id"),
            status.alias("status"),
            F.col("l_extendedprice").cast(PRICE).alias("price"),
            # Month start, which gives groups of a useful size.
            F.trunc("o_orderdate", "month").cast(NTZ).alias("created_at"),
            F.col("l_shipdate").cast(NTZ).alias("updated_at"),
        )

    def booking_events_raw(self) -> DataFrame:
        kind = F.col("event_type")
        return self.table("events").select(
            (F.floor(F.col("event_id") / 3).cast("bigint") * 5).alias("booking_id"),
            F.when(kind == "purchase", "confirmed")
            .when(kind == "error", "cancelled")
            .otherwise("created")
            .alias("event_type"),
            # Back into the years of the orders, so that either source can be newer.
            (F.col("ts").cast(NTZ) - F.expr("INTERVAL 26 YEAR")).alias("event_ts"),
        )

    def hotels_raw(self) -> DataFrame:
        return (
            self.table("supplier")
            .where(F.col("s_acctbal") >= 1000)
            .join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("s_suppkey").alias("hotel_id"),
                F.col("n_name").alias("city"),
                (F.col("s_nationkey") % 5 + 1).cast("int").alias("star_rating"),
            )
        )
