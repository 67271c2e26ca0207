"""Writing, replacing, merging and compacting tables on disk."""

import datetime as dt
from pathlib import Path

import pytest
from conftest import at, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_merge import silver_row

from staymark import schemas
from staymark.plans.incremental import merge_silver
from staymark.sinks import locations, statistics, tables

DAY = T.StructField("created_date", T.DateType())
TABLE = T.StructType([*schemas.SILVER_BOOKINGS.fields, DAY])


def day(n: int) -> str:
    return f"2025-01-{n:02d}T10:00"


def stored(spark, path):
    return tables.read_table(spark, path, TABLE)


def write_silver(frame, path, data):
    tables.write_table(
        tables.with_day(frame("silver", data), "created_at", "created_date"),
        path,
        partition_by=["created_date"],
        sort_by=["booking_id"],
    )


def folders(path) -> set[str]:
    return {p.name.split("=")[1] for p in Path(path).iterdir() if "=" in p.name}


def test_full_refresh_replaces_all_days(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    write_silver(frame, path, [silver_row("a", "created", "10:00", created=day(1))])
    write_silver(frame, path, [silver_row("b", "created", "10:00", created=day(2))])
    assert rows(stored(spark, path), "booking_id") == {("b",)}
    assert folders(path) == {"2025-01-02"}


def test_day_filter_prunes_folders(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    write_silver(
        frame, path, [silver_row(f"d{n}", "created", "10:00", created=day(n)) for n in range(1, 9)]
    )
    part = tables.between(
        stored(spark, path), "created_at", "created_date", "2025-01-03 10:00:00", "2025-01-05 10:00:00"
    )
    assert rows(part, "booking_id") == {("d3",), ("d4",)}
    plan = part._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(created_date" in plan


def test_publish_is_all_or_nothing(spark, frame, tmp_path):
    root = str(tmp_path / "t")
    with pytest.raises(Exception, match="no committed version"):
        tables.current(spark, root)
    first = frame("silver", [silver_row("a", "created", "10:00")])
    tables.publish(first, root)
    tables.publish(first, root)
    assert rows(tables.current(spark, root)) == rows(first)
    # A version that was written but not committed is not seen.
    tables.write_table(frame("silver", [silver_row("b", "created", "10:00")]), f"{root}/data/dead")
    assert rows(tables.current(spark, root)) == rows(first)
    second = frame("silver", [silver_row("c", "created", "10:00")])
    tables.publish(second, root)
    assert rows(tables.current(spark, root)) == rows(second)


def test_overwrite_days(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    write_silver(
        frame, path, [silver_row(f"d{n}", "created", "10:00", created=day(n)) for n in range(1, 5)]
    )
    new = tables.with_day(
        frame("silver", [silver_row("new", "created", "10:00", created=day(2))]),
        "created_at",
        "created_date",
    )
    asked = spark.createDataFrame([(dt.date(2025, 1, 2),), (dt.date(2025, 1, 3),)], "day date")
    tables.overwrite_days(new, path, "created_date", answers_for=asked)
    assert rows(stored(spark, path), "booking_id") == {("d1",), ("new",), ("d4",)}
    assert folders(path) == {"2025-01-01", "2025-01-02", "2025-01-04"}


def test_overwrite_takes_few_jobs_however_many_partitions(spark, frame, tmp_path):
    """As in a batch of a stream, where nothing puts small partitions together."""
    path, tracker = str(tmp_path / "t"), spark.sparkContext.statusTracker()
    old = [silver_row(f"d{n}", "created", "10:00", created=day(n)) for n in range(1, 5)]
    write_silver(frame, path, old)
    new = tables.with_day(frame("silver", old[1:2]), "created_at", "created_date")
    asked = stored(spark, path).select("created_date")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    settings = {"spark.sql.adaptive.enabled": ("false", "true"), "spark.sql.shuffle.partitions": ("40", before)}
    for name, (value, _) in settings.items():
        spark.conf.set(name, value)
    spark.sparkContext.setJobGroup("overwrite", "")
    try:
        tables.overwrite_days(new, path, "created_date", answers_for=asked)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for name, (_, value) in settings.items():
            spark.conf.set(name, value)
    assert folders(path) == {"2025-01-02"}
    assert len(tracker.getJobIdsForGroup("overwrite")) < 20


TARGET = [
    silver_row("a", "created", "10:00", created=day(1)),
    silver_row("b", "created", "10:00", created=day(2)),
    silver_row("c", "created", "10:00", created=day(3)),
    silver_row("n", "created", "10:00", created=None),
]
DELTA = [
    silver_row("a", "cancelled", "11:00", created=day(5)),
    silver_row("n", "cancelled", "11:00", created=day(2)),
    silver_row("new", "created", "11:00", created=day(6)),
]


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
def test_upsert_merges_only_touched_days(spark, frame, tmp_path, broadcast_bytes):
    path = str(tmp_path / "t")
    write_silver(frame, path, TARGET)
    untouched = {p.name for p in (Path(path) / "created_date=2025-01-03").iterdir()}
    want = rows(merge_silver(frame("silver", TARGET), frame("silver", DELTA)))
    for _ in range(2):  # the same delta again changes nothing
        tables.upsert_silver(
            spark, path, frame("silver", DELTA), TABLE, broadcast_bytes=broadcast_bytes
        )
        assert rows(stored(spark, path).drop("created_date")) == want
    assert {p.name for p in (Path(path) / "created_date=2025-01-03").iterdir()} == untouched
    days = rows(stored(spark, path), "created_at", "created_date")
    assert all(created is None or created.date() == d for created, d in days)


def test_replace_moves_bookings_and_removes_empty_days(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    write_silver(frame, path, TARGET)
    tables.upsert_silver(spark, path, frame("silver", DELTA), TABLE, replace=True)
    ids = {r[0] for r in DELTA}
    assert rows(stored(spark, path).drop("created_date")) == set(DELTA) | {
        r for r in TARGET if r[0] not in ids
    }
    assert folders(path) == {"2025-01-02", "2025-01-03", "2025-01-05", "2025-01-06"}


def test_compact(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    data = [silver_row(f"k{n}", "created", "10:00", created=day(n % 3 + 1)) for n in range(60)]
    data += [silver_row(f"k{n}", "created", "10:00", created=None) for n in range(60, 70)]
    many = tables.with_day(frame("silver", data), "created_at", "created_date")
    many.repartition(6).write.partitionBy("created_date").parquet(path)
    before = rows(stored(spark, path))
    sizes = {r["created_date"]: r["files"] for r in tables.file_sizes(spark, path, "created_date").collect()}
    assert len(sizes) == 4 and min(sizes.values()) > 1
    done = tables.compact(spark, path, "created_date", ["booking_id"], schema=TABLE)
    assert set(done) == set(sizes)
    after = tables.file_sizes(spark, path, "created_date")
    assert {r["files"] for r in after.collect()} == {1}
    assert rows(stored(spark, path)) == before
    assert tables.compact(spark, path, "created_date", ["booking_id"], schema=TABLE) == []


def test_compact_sizes_files(spark, tmp_path):
    """A big partition is split into several files, copies of one row included."""
    path = str(tmp_path / "t")
    data = spark.range(20_000).select(
        F.sha2(F.greatest(F.col("id"), F.lit(7_000)).cast("string"), 256).alias("text"),
        F.when(F.col("id") < 19_000, F.lit("2025-01-01")).otherwise("2025-01-02").cast("date").alias("day"),
    )
    data.repartition(12).write.partitionBy("day").parquet(path)
    total = {r["day"]: r["bytes"] for r in tables.file_sizes(spark, path, "day").collect()}
    big = dt.date(2025, 1, 1)
    tables.compact(spark, path, "day", ["text"], file_bytes=total[big] // 3)
    files = {r["day"]: r["files"] for r in tables.file_sizes(spark, path, "day").collect()}
    assert 2 <= files[big] <= 4 and files[dt.date(2025, 1, 2)] == 1
    table = spark.read.parquet(path)
    assert (table.count(), table.distinct().count()) == (20_000, 13_000)
    hot = table.groupBy("text").count().orderBy(F.desc("count")).first()["text"]
    copies = table.where(F.col("text") == hot).select("_metadata.file_name").distinct().count()
    assert copies == files[big]


def test_hot_day_is_written_by_several_tasks(spark, tmp_path):
    """REBALANCE splits a day that holds most of the data."""
    path = str(tmp_path / "t")
    data = spark.range(0, 200_000, 1, 8).select(
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
        F.when(F.col("id") % 10 == 0, F.lit("2025-01-02")).otherwise("2025-01-01").cast("date").alias("day"),
    )
    tables.write_table(data, path, partition_by=["day"], sort_by=["text"], file_bytes=1 << 20)
    files = {r["day"]: r["files"] for r in tables.file_sizes(spark, path, "day").collect()}
    assert files[dt.date(2025, 1, 1)] > 3
    assert spark.read.parquet(path).count() == 200_000


def test_schema_evolution(spark, tmp_path):
    old, new = str(tmp_path / "v1"), str(tmp_path / "v2")
    spark.createDataFrame([(1,)], "id int").write.parquet(old)
    spark.createDataFrame([(2, "x")], "id int, extra string").write.parquet(new)
    assert rows(tables.read_evolved(spark, old, new)) == {(1, None), (2, "x")}


def test_table_declaration_and_statistics(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    write_silver(frame, path, TARGET)
    for _ in range(2):
        tables.create_table(spark, "silver_declared", schemas.SILVER_BOOKINGS, path, DAY)
    assert rows(spark.table("silver_declared"), "booking_id") == {("a",), ("b",), ("c",), ("n",)}
    statistics.analyze(spark, "silver_declared")
    described = spark.sql("DESCRIBE EXTENDED silver_declared").collect()
    assert any(r["col_name"] == "Statistics" and "4 rows" in r["data_type"] for r in described)
    tables.drop_table(spark, "silver_declared")
    tables.drop_table(spark, "silver_declared")
    assert not spark.catalog.tableExists("silver_declared")


def test_shared_folder_comes_from_the_session(spark):
    assert locations.new_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert locations.new_folder(spark, "x") != locations.new_folder(spark, "x")


def test_staged_table_goes_away(spark, frame):
    folder = Path(locations.new_folder(spark, "x")).parent
    with locations.staged(frame("hotels", [("h", "c", 1)]), "gone") as copy:
        assert copy.count() == 1 and list(folder.glob("gone-*"))
    assert not list(folder.glob("gone-*"))


def test_written_keeps_types(spark, frame):
    data = frame("silver", [silver_row("a", "created", "10:00", created=None)])
    copy = locations.written(data, "copy")
    assert copy.dtypes == data.dtypes and rows(copy) == rows(data)
    assert at("10:00") in {r[0] for r in copy.select("last_updated_at").collect()}


def test_days_are_exact_and_prune_folders(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    write_silver(frame, path, [silver_row(f"k{n}", "created", "10:00", created=day(n)) for n in range(1, 8)])
    wanted = spark.createDataFrame([(dt.date(2025, 1, 3),), (dt.date(2025, 1, 5),)], "d date")
    found = tables.on_days(stored(spark, path), "created_date", wanted)
    assert rows(found, "booking_id") == {("k3",), ("k5",)}
    plan = found._jdf.queryExecution().executedPlan().toString()
    bounds = [line for line in plan.splitlines() if "FileScan" in line]
    assert all("2025-01-03" in b or ">=" in b for b in bounds) and "PartitionFilters: []" not in plan
    undated = spark.createDataFrame([(None,)], "d date")
    assert tables.on_days(stored(spark, path), "created_date", undated).count() == 0
    assert tables.on_days(stored(spark, path), "created_date", wanted.limit(0)).count() == 0


def test_commits_are_numbered(spark, frame, tmp_path):
    root = str(tmp_path / "t")
    hotels = [frame("hotels", [("h", str(n), n)]) for n in range(3)]
    for n in (0, 1):
        tables.publish(hotels[n], root)
    # The number decides, not the clock; and a number is given once.
    assert rows(tables.current(spark, root)) == {("h", "1", 1)}
    with pytest.raises(Exception, match="(?i)exists"):
        tables._commit(spark, root, 2, "elsewhere")
    assert rows(tables.current(spark, root)) == {("h", "1", 1)}


def test_old_versions_expire(spark, frame, tmp_path):
    root = tmp_path / "t"
    for n in range(3):
        tables.publish(frame("hotels", [("h", "c", n)]), str(root))
    assert tables.expire_versions(spark, str(root), dt.timedelta(hours=1)) == []
    assert len(tables.expire_versions(spark, str(root), dt.timedelta(0))) == 2
    assert len(list((root / "data").iterdir())) == 1
    assert rows(tables.current(spark, str(root))) == {("h", "c", 2)}


def test_broken_compaction_is_finished_by_the_next(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    data = spark.range(300).select("id", F.lit("2025-01-01").cast("date").alias("day"))
    data.repartition(5).write.partitionBy("day").parquet(path)
    real = tables.delete_folder
    # The first run loses the partition in the swap and dies before it clears its copy.
    monkeypatch.setattr(tables, "delete_folder", lambda *a: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        tables.compact(spark, path, "day", ["id"])
    monkeypatch.setattr(tables, "delete_folder", real)
    real(spark, f"{path}/day=2025-01-01")
    tables.compact(spark, path, "day", ["id"])
    assert spark.read.parquet(path).agg(F.sum("id")).first()[0] == sum(range(300))
    assert not Path(f"{path}_compacted").exists()


def scattered(spark, path):
    data = spark.range(300).select("id", F.expr("date_add(DATE'2025-01-01', int(id % 3))").alias("day"))
    data.repartition(5).write.partitionBy("day").parquet(path)
    return data


def test_failed_check_leaves_no_copy_to_swap_in(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    data = scattered(spark, path)

    def differs(*_):
        raise RuntimeError("the compacted copy differs from its table")

    with monkeypatch.context() as patch:
        patch.setattr(tables, "_same_rows", differs)
        with pytest.raises(RuntimeError, match="differs"):
            tables.compact(spark, path, "day", ["id"])
    assert not Path(f"{path}_compacted").exists()
    # Nor does a copy that a lost driver left before the check.
    spark.range(1).select("id", F.lit("2025-01-01").cast("date").alias("day"), F.lit(0).alias("_slot")).write.parquet(
        f"{path}_compacted/rows"
    )
    assert len(tables.compact(spark, path, "day", ["id"])) == 3
    assert rows(spark.read.parquet(path)) == rows(data)


def test_stale_copy_does_not_undo_later_writes(spark, tmp_path, monkeypatch):
    """A run dies between check and swap; a day is written anew; the next run leaves it alone."""
    path = str(tmp_path / "t")
    data = scattered(spark, path)

    def lost(*_):
        raise OSError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(tables, "_swap_in", lost)
        with pytest.raises(OSError):
            tables.compact(spark, path, "day", ["id"])
    assert Path(f"{path}_compacted/checked").exists()
    newer = spark.range(1000, 1005).select("id", F.lit("2025-01-02").cast("date").alias("day"))
    tables.overwrite_days(newer, path, "day")
    done = tables.compact(spark, path, "day", ["id"])
    assert set(done) == {dt.date(2025, 1, 1), dt.date(2025, 1, 3)}
    want = rows(data.where("day <> DATE'2025-01-02'")) | rows(newer)
    assert rows(spark.read.parquet(path)) == want
    assert not Path(f"{path}_compacted").exists()
