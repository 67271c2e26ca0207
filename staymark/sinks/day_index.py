"""Where each booking is: a stored table from key to day.

A merge has to find the days that the bookings of its delta lie in. Without an index that
reads the keys of the whole silver table. The index is cut into buckets by the hash of the key,
so a lookup reads the buckets of its keys only, two columns of them, and a merge adds
what is new to them.

Entries are added before the table is written, and never taken away. So the days found are all
that a booking has ever been on or was about to be: one day too many costs reading it, and
a merge that dies anywhere can be repeated. Folding the index drops nothing but repetitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staymark.operators.rows import distinct_rows, rows_with
from staymark.operators.sizing import BROADCAST_BYTES, broadcast_if_fits
from staymark.sinks import tables
from staymark.sinks.locations import folder_exists, list_folder, staged, written

# Entries of a bucket when the index is built, about 64 MB of them.
BUCKET_ROWS = 4_000_000
# Files of a bucket from which on folding pays.
CROWDED_FILES = 16


class DayIndex:
    """Key and day of every row of a table, below ``root``. Rows without a key are not in it."""

    def __init__(self, spark: SparkSession, root: str, key: str = "booking_id", *, bucket_rows: int = BUCKET_ROWS):
        self.spark, self.root, self.key, self.bucket_rows = spark, root, key, bucket_rows

    def exists(self) -> bool:
        return folder_exists(self.spark, f"{self.root}/commits")

    def build(self, table: DataFrame, day: str) -> None:
        """Publish a new index of ``table``; the number of buckets follows its size."""
        entries = table.where(F.col(self.key).isNotNull()).select(F.col(self.key), F.col(day).alias("day"))
        self._publish(entries)

    def _publish(self, entries: DataFrame) -> None:
        buckets = max(1, -(-entries.count() // self.bucket_rows))
        placed = entries.withColumns({"buckets": F.lit(buckets), "bucket": self._bucket(buckets)})
        tables.publish(placed, self.root, partition_by=["buckets", "bucket"], sort_by=[self.key])

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(buckets)).cast("int")

    def entries(self) -> DataFrame:
        """All entries: key, day, buckets, bucket."""
        return self.spark.read.parquet(tables.current_path(self.spark, self.root))

    def _buckets(self) -> int:
        """The number of buckets, from the name of the folder they are in; 1 if there is none."""
        for name, _ in list_folder(self.spark, tables.current_path(self.spark, self.root)):
            if name.startswith("buckets="):
                return int(name.partition("=")[2])
        return 0

    def of(self, keys: DataFrame, *, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
        """key and day of the entries of ``keys`` (one column, read several times)."""
        buckets = self._buckets()
        if not buckets:
            return keys.limit(0).toDF(self.key).withColumn("day", F.lit(None).cast("date"))
        wanted = keys.where(F.col(self.key).isNotNull()).select(self._bucket(buckets).alias("bucket"))
        numbers = [row["bucket"] for row in wanted.distinct().collect()]  # no more than buckets
        near = self.entries().where(F.col("bucket").isin(numbers))
        return rows_with(near, broadcast_if_fits(keys, broadcast_bytes), self.key).select(self.key, "day")

    def admit(
        self, delta: DataFrame, day: Column, *, moves: bool = False, broadcast_bytes: int = BROADCAST_BYTES
    ) -> DataFrame:
        """The days that merging ``delta`` concerns (one column, ``day``), for the table's sake
        stored in the index first.

        A booking that the table has stays on its day, unless the merge ``moves`` it to that of the
        delta. ``delta`` is read several times, so pass a written table.
        """
        given = delta.select(F.col(self.key), day.alias("day"))
        keys = given.select(self.key).where(F.col(self.key).isNotNull())
        with staged(self.of(keys, broadcast_bytes=broadcast_bytes), "entries") as held:
            known = held if moves else held.select(self.key)
            same = [given[c].eqNullSafe(known[c]) for c in known.columns]
            fresh = given.join(known, same, "left_anti")
            with staged(fresh, "fresh") as fresh:
                self._add(fresh.where(F.col(self.key).isNotNull()))
                days = held.select("day").unionByName(fresh.select("day"))
                return written(distinct_rows(days, ["day"]), "days")

    def _add(self, entries: DataFrame) -> None:
        buckets = self._buckets()
        if not buckets:
            self._publish(entries)
        elif not entries.isEmpty():
            placed = entries.withColumns({"buckets": F.lit(buckets), "bucket": self._bucket(buckets)})
            by = ["buckets", "bucket"]
            ordered = tables.laid_out(placed, by, [self.key])
            ordered.write.mode("append").partitionBy(*by).parquet(tables.current_path(self.spark, self.root))

    def crowded(self) -> bool:
        """Whether merges have left so many files in a bucket that folding pays."""
        path = tables.current_path(self.spark, self.root)
        if not self._buckets():
            return False
        return not tables.file_sizes(self.spark, path, "bucket").where(F.col("files") > CROWDED_FILES).isEmpty()

    def fold(self) -> None:
        """Publish the index anew, without repeated entries and in few files."""
        self._publish(distinct_rows(self.entries().select(self.key, "day"), [self.key, "day"]))
