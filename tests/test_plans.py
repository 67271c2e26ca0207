"""The physical plans the jobs are written for, and hot keys."""

import re

import pytest
from conftest import HOTELS
from pyspark.sql import functions as F

from staymark.operators.rows import first_per_key
from staymark.plans import gold, incremental, silver
from staymark.sinks import tables
from staymark.sources.derived import DerivedFeeds


@pytest.fixture(scope="module")
def stored(spark, frame, tmp_path_factory):
    """The feeds as Parquet tables, so that scans and pushdown show in plans."""
    folder = tmp_path_factory.mktemp("stored")
    for kind in ("bookings", "events", "hotels", "silver"):
        frame(kind, HOTELS if kind == "hotels" else []).write.parquet(str(folder / kind))
    return lambda kind: spark.read.parquet(str(folder / kind))


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    old = {}

    def change(**options):
        for name, value in options.items():
            key = "spark.sql." + name.replace("__", ".")
            old[key] = spark.conf.get(key)
            spark.conf.set(key, value)

    yield change
    for key, value in old.items():
        spark.conf.set(key, value)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df) -> list[str]:
    return re.findall(r"Exchange (\w+)\(", plan(df))


def test_silver_takes_one_shuffle_per_feed(stored, conf):
    conf(autoBroadcastJoinThreshold="-1")
    built = silver.silver_bookings(stored("bookings"), stored("events"))
    text = plan(built)
    assert shuffles(built) == ["hashpartitioning", "hashpartitioning"]
    assert text.count("FileScan") == 2 and text.count("SortMergeJoin") == 1
    # Both feeds are cut to one row per booking before they are shuffled.
    assert "partial_min(struct(" in text and "partial_max(struct(" in text
    # The join takes rows as the aggregates leave them, already sorted.
    assert text.index("SortMergeJoin") < text.index("SortAggregate") < text.index("Sort [")


def test_gold_does_not_shuffle_bookings_by_hotel(stored, conf):
    conf(autoBroadcastJoinThreshold="-1")
    built = gold.daily_city_kpis(
        silver.silver_bookings(stored("bookings"), stored("events")), stored("hotels")
    )
    text = plan(built)
    assert "BroadcastHashJoin [hotel_id" in text
    assert "hashpartitioning(hotel_id" not in text
    # Columns nobody asks for are not read, nor times nobody asks for computed.
    assert "star_rating" not in text and "event_confirmed_at" not in text


def test_large_dimension_is_joined_after_grouping(stored, conf):
    conf(autoBroadcastJoinThreshold="-1")
    built = gold.daily_city_kpis(stored("silver"), stored("hotels"), broadcast_bytes=0)
    text = plan(built)
    join = text.index("SortMergeJoin")
    assert "Broadcast" not in text
    # Below the join, bookings are already grouped by (day, hotel).
    assert "HashAggregate(keys=[booking_date" in text[join:]
    assert text[join:].count("hashpartitioning(booking_date") == 1


def test_mark_is_pushed_into_the_scans(stored):
    changed = incremental.changed_bookings(
        stored("bookings"), stored("events"), "2025-01-01 00:00:00"
    )
    text = plan(changed)
    assert "GreaterThan(updated_at,2025-01-01T00:00)" in text
    assert "GreaterThan(event_ts,2025-01-01T00:00)" in text
    assert "ReadSchema: struct<booking_id:string,updated_at:timestamp_ntz>" in text


def test_merge_leaves_the_target_in_place(stored, frame):
    delta = frame("silver", [])
    merged = incremental.merge_silver(stored("silver"), delta, check_source=False)
    text = plan(merged)
    # The updated target is a broadcast join over its scan: no shuffle in that branch.
    branch = text[: text.index("LeftAnti")]
    assert "BroadcastHashJoin [booking_id" in branch and "hashpartitioning" not in branch


def test_serving_reads_only_days_and_columns_asked_for(spark, tmp_path):
    path = str(tmp_path / "gold")
    kpis = spark.range(4).select(
        F.date_add(F.lit("2025-01-01"), F.col("id").cast("int")).alias("booking_date"),
        F.lit("x").alias("city"),
        F.col("id").alias("total_bookings"),
        F.lit(0.0).alias("cancellation_rate"),
        F.lit(1).cast("decimal(20,2)").alias("total_confirmed_revenue"),
        F.lit(1).cast("decimal(10,2)").alias("avg_booking_price"),
    )
    tables.write_table(kpis, path, partition_by=["booking_date"])
    served = gold.serve_kpis(tables.read_table(spark, path), "2025-01-03")
    text = plan(served)
    assert "(booking_date#" in text and ">= 2025-01-03" in text
    assert "PartitionFilters: [isnotnull(booking_date" in text
    assert "avg_booking_price" not in text
    assert served.count() == 2


def test_hot_key_leaves_each_task_as_one_row(spark, tmp_path):
    """Half of all rows share a key; one row of it per task is shuffled, not 100,000."""
    data = spark.range(0, 200_000, 1, 8).select(
        F.when(F.col("id") % 2 == 0, F.lit(-1)).otherwise(F.col("id") % 1000).alias("k"),
        F.col("id").alias("v"),
    )
    best = first_per_key(data, ["k"], ties=["v"])
    assert {tuple(r) for r in best.collect()} == {(-1, 0), *[(n, n) for n in range(1, 1000, 2)]}
    shuffled = re.search(r"SortAggregate\(key=\[k.*partial_min", plan(best))
    assert shuffled, plan(best)


def test_hot_order_is_split_in_the_feed_join(spark, conf, tmp_path):
    """A third of the lines belong to one order: the join splits them, and each part
    is cut to one row before the parts meet again."""
    conf(
        autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="20k",
        adaptive__skewJoin__skewedPartitionFactor="2",
        adaptive__advisoryPartitionSizeInBytes="20k",
    )
    source = DerivedFeeds(spark, "/root/testdata/sf0.01")
    hot = F.pmod(F.hash("l_suppkey", "l_partkey"), F.lit(3)) == 0
    lines = source.table("lineitem").withColumn(
        "l_orderkey", F.when(hot, F.lit(5)).otherwise(F.col("l_orderkey"))
    )
    lines.repartition(8).write.parquet(str(tmp_path / "lineitem.parquet"))
    source.table("orders").write.parquet(str(tmp_path / "orders.parquet"))
    feed = DerivedFeeds(spark, str(tmp_path)).bookings_raw()
    newest = silver.latest_snapshot(feed)
    got = {tuple(r) for r in newest.collect()}
    text = plan(newest)
    final = text[: text.index("Initial Plan")]
    assert "SortMergeJoin(skew=true)" in final
    exchange = final.index("Exchange hashpartitioning(booking_id")
    assert exchange < final.index("partial_min(") < final.index("SortMergeJoin(skew=true)")
    conf(adaptive__enabled="false")
    assert {tuple(r) for r in silver.latest_snapshot(feed).collect()} == got
