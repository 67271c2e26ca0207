"""Values as ranges, and what scans skip by them."""

import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from staymark.operators.ranges import Cover, covering
from staymark.sinks import tables


def values(spark, items, kind):
    return spark.createDataFrame([(i,) for i in items], f"v {kind}")


def test_days_become_islands(spark):
    day = dt.date(2025, 1, 1)
    numbers = [0, 1, 2, 40, 41, 400, None, 1]
    items = [None if n is None else day + dt.timedelta(n) for n in numbers]
    cover = covering(values(spark, items, "date"))
    assert cover.null
    assert [((a - day).days, (b - day).days) for a, b in cover.ranges] == [(0, 2), (40, 41), (400, 400)]
    assert len(covering(values(spark, items, "date"), most=2).ranges) == 2
    # The widest gap is the one left out.
    assert covering(values(spark, items, "date"), most=2).ranges[1] == (items[5], items[5])


def test_nothing_and_null(spark):
    assert covering(values(spark, [], "long")) == Cover((), False)
    assert covering(values(spark, [None], "string")) == Cover((), True)
    df = values(spark, [1, None], "long")
    assert df.where(Cover((), False).holds("v")).count() == 0
    assert rows(df.where(Cover((), True).holds("v"))) == {(None,)}


@pytest.mark.parametrize("kind", ["long", "string", "date"])
def test_ranges_hold_all_values_and_skip_gaps(spark, kind):
    rng = random.Random(kind)
    for n in (1, 5, 300):
        picked = {rng.randrange(60) * 1000 + rng.randrange(9) for _ in range(n)}
        if kind == "long":
            items = [p - 30_000 for p in picked] + [-(2**62), 2**62] * (n == 300)
        elif kind == "string":
            items = [f"bk-{p:06d}é" for p in picked]
        else:
            items = [dt.date(1900, 1, 1) + dt.timedelta(p) for p in picked]
        cover = covering(values(spark, items, kind), most=20)
        assert len(cover.ranges) <= 20
        lows = [x for r in cover.ranges for x in r]
        assert lows == sorted(lows)
        assert all(any(a <= i <= b for a, b in cover.ranges) for i in items)
        ends = {x for r in cover.ranges for x in r}
        assert ends <= set(items)


def read_rows(df) -> int:
    """Rows that the scan of ``df`` gave out, after row groups were skipped."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    scans = [leaves.apply(i) for i in range(leaves.size()) if "FileScan" in leaves.apply(i).toString()]
    return sum(s.metrics().apply("numOutputRows").value() for s in scans)


@pytest.fixture
def plain_plans(spark):
    """Plans as they run, so that metrics can be read off them."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("kind", ["long", "string"])
def test_lookup_skips_row_groups(spark, tmp_path, plain_plans, kind):
    """Keys far apart, in files sorted by key of several row groups."""
    path = str(tmp_path / "t")
    key = F.col("id") if kind == "long" else F.format_string("bk-%08d", "id")
    table = spark.range(0, 200_000, 1, 8).select(key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    spark.sparkContext._jsc.hadoopConfiguration().setInt("parquet.block.size", 1 << 18)
    try:
        tables.write_clustered(table, path, "k", file_bytes=8 << 20)
    finally:
        spark.sparkContext._jsc.hadoopConfiguration().unset("parquet.block.size")
    ids = [5, 6, 100_000, 199_999, 7_000_000]
    wanted = spark.createDataFrame([(i,) for i in ids], "id long").select(key.alias("k"))
    wanted.write.parquet(str(tmp_path / "keys"))
    keys = spark.read.parquet(str(tmp_path / "keys"))
    for budget in (0, 1 << 20):
        found = tables.lookup(spark.read.parquet(path), "k", keys, broadcast_bytes=budget)
        assert found.count() == 4
    near = spark.read.parquet(path).where(covering(keys).holds("k"))
    assert read_rows(near) < 40_000


def test_days_between_islands_are_not_read(spark, tmp_path, plain_plans):
    path = str(tmp_path / "t")
    day = F.date_add(F.lit("2025-01-01").cast("date"), F.col("id").cast("int"))
    spark.range(60).select("id", day.alias("day")).write.partitionBy("day").parquet(path)
    # A file of a day between the two islands is broken: reading it would fail.
    broken = next((tmp_path / "t" / "day=2025-01-20").glob("*.parquet"))
    broken.write_bytes(b"no parquet")
    for crc in (tmp_path / "t" / "day=2025-01-20").glob(".*.crc"):
        crc.unlink()
    schema = "id long, day date"
    wanted = spark.range(60).where("id < 3 OR id IN (40, 41, 59)").select(day.alias("d"))
    wanted.write.parquet(str(tmp_path / "days"))
    found = tables.on_days(spark.read.schema(schema).parquet(path), "day", spark.read.parquet(str(tmp_path / "days")))
    assert rows(found, "id") == {(i,) for i in (0, 1, 2, 40, 41, 59)}
    with pytest.raises(Exception):  # noqa: B017 (whatever Spark raises)
        spark.read.schema(schema).parquet(path).collect()
