"""Parquet tables: layout, full refresh, partition overwrite, upsert, compaction."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterator, Sequence
from contextlib import ExitStack, contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staymark.operators.ranges import covering
from staymark.operators.rows import rows_with, rows_without
from staymark.operators.sizing import BROADCAST_BYTES, broadcast_if_fits
from staymark.plans.incremental import affected_days, merge_silver
from staymark.sinks.locations import create_file, delete_folder, folder_exists, list_folder, staged

# Files this large read well and are few.
FILE_BYTES = 192 * 1024 * 1024

_COMMIT = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("path", T.StringType()),
    ]
)


# --- layout ---------------------------------------------------------------------------


def with_day(df: DataFrame, timestamp: str, day: str) -> DataFrame:
    """``df`` with the partition column of its table, the day of a timestamp."""
    return df.withColumn(day, F.to_date(timestamp))


def laid_out(df: DataFrame, partition_by: Sequence[str], sort_by: Sequence[str]) -> DataFrame:
    """Rows gathered by partition value and sorted within each file.

    REBALANCE lets the adaptive planner split a day that holds much of the data over
    several tasks and put small days together, so no task writes a whole hot day.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    if partition_by or sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    return df


@contextmanager
def _file_size(spark: SparkSession, file_bytes: int) -> Iterator[None]:
    """Have the adaptive planner aim at this much data per written file."""
    option = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(option)
    spark.conf.set(option, str(file_bytes))
    try:
        yield
    finally:
        spark.conf.set(option, before)


def _write(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    sort_by: Sequence[str],
    file_bytes: int,
    overwrite: str,
) -> None:
    writer = laid_out(df, partition_by, sort_by).write.mode("overwrite")
    if partition_by:
        writer = writer.option("partitionOverwriteMode", overwrite).partitionBy(*partition_by)
    with _file_size(df.sparkSession, file_bytes):
        writer.parquet(path)


def write_table(
    df: DataFrame,
    path: str,
    *,
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    file_bytes: int = FILE_BYTES,
) -> None:
    """Full refresh: replace the table at ``path``."""
    _write(df, path, partition_by, sort_by, file_bytes, "static")


def write_clustered(df: DataFrame, path: str, key: str, *, file_bytes: int = FILE_BYTES) -> None:
    """Replace the table at ``path`` by files that are sorted by ``key`` and, but for a hot key,
    share none of its values: a lookup opens few of them (see ``lookup``)."""
    ordered = df.repartitionByRange(key).sortWithinPartitions(key)
    with _file_size(df.sparkSession, file_bytes):
        ordered.write.mode("overwrite").parquet(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The table at ``path``. Pass the schema where partition values might not show it."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def between(df: DataFrame, timestamp: str, day: str, start: str, end: str) -> DataFrame:
    """Rows with ``start <= timestamp < end``.

    Spark does not derive a filter on the partition column from one on the
    timestamp, so both are given: the first prunes folders, the second is exact.
    """
    low, high = F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    return df.where(F.col(day).between(F.to_date(low), F.to_date(high))).where(
        (F.col(timestamp) >= low) & (F.col(timestamp) < high)
    )


# --- whole-table replacement that readers never see half done -------------------------


def publish(
    df: DataFrame,
    root: str,
    *,
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
) -> str:
    """Write a new version below ``root`` and commit it by one small record.

    Readers keep the last committed version until the record appears. A run that
    dies before leaves files that no record names.
    """
    spark = df.sparkSession
    path = f"{root}/data/{uuid.uuid4().hex}"
    write_table(df, path, partition_by=partition_by, sort_by=sort_by)
    last = _last_commit(spark, root)
    _commit(spark, root, last["version"] + 1 if last else 1, path)
    return path


def _commit(spark: SparkSession, root: str, version: int, path: str) -> None:
    """Record ``path`` as a version; fails if another writer took the number.

    The record is one file that the file system creates only if there is none.
    """
    create_file(spark, f"{root}/commits/{version:012d}.json", json.dumps({"version": version, "path": path}))


def _last_commit(spark: SparkSession, root: str):
    """The commit of the highest number, None if there is none yet."""
    if not folder_exists(spark, f"{root}/commits"):
        return None
    reader = spark.read.schema(_COMMIT).option("recursiveFileLookup", True)
    last = reader.json(f"{root}/commits").agg(F.max(F.struct("version", "path")).alias("last")).first()
    return last["last"]


def current_path(spark: SparkSession, root: str) -> str:
    """Where the last committed version below ``root`` is."""
    last = _last_commit(spark, root)
    if last is None:
        raise FileNotFoundError(f"no committed version below {root}")
    return last["path"]


def expire_versions(spark: SparkSession, root: str, older_than: dt.timedelta) -> list[str]:
    """Delete version folders that are neither current nor younger than ``older_than``.

    Readers of an old version and writers that have not committed yet need its folder, so
    choose an age beyond the longest of them. Returns the folders deleted.
    """
    keep = current_path(spark, root).rpartition("/")[2]
    before = dt.datetime.now().timestamp() - older_than.total_seconds()
    gone = []
    for name, modified in list_folder(spark, f"{root}/data"):
        if name != keep and modified <= before:
            delete_folder(spark, f"{root}/data/{name}")
            gone.append(name)
    return gone


def current(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame:
    """The last committed version below ``root``."""
    return read_table(spark, current_path(spark, root), schema)


# --- partition overwrite --------------------------------------------------------------


def on_days(df: DataFrame, column: str, days: DataFrame) -> DataFrame:
    """Rows of ``df`` whose partition ``column`` is among ``days`` (one column; NULL is a day).

    The days become a few literal ranges, so that folders outside are pruned, also those
    between two stretches of days; a semi join keeps exactly the days wanted, however many
    they are. ``days`` is read three times, so pass a written table.
    """
    return rows_with(df.where(covering(days).holds(column)), days, column)


def lookup(df: DataFrame, column: str, keys: DataFrame, *, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Rows of ``df`` whose ``column`` is among ``keys`` (one column; NULL finds NULL).

    The keys become a few literal ranges, by which files sorted by ``column`` skip the row
    groups that hold none; a semi join keeps exactly the keys wanted. ``keys`` is read
    several times, so pass a written table.
    """
    near = df.where(covering(keys).holds(column))
    return rows_with(near, broadcast_if_fits(keys, broadcast_bytes), column)


def partition_folder(path: str, column: str, day: dt.date | None) -> str:
    value = "__HIVE_DEFAULT_PARTITION__" if day is None else day.isoformat()
    return f"{path}/{column}={value}"


def overwrite_days(
    df: DataFrame,
    path: str,
    day: str,
    *,
    sort_by: Sequence[str] = (),
    answers_for: DataFrame | None = None,
    file_bytes: int = FILE_BYTES,
) -> None:
    """Replace only the days that occur in ``df``; other days stay untouched.

    ``answers_for`` is a one-column frame of the days this run recomputed. Those of
    them without a row in ``df`` are removed: an overwrite by itself leaves their old
    rows in place. ``df`` is then read twice, so pass a written table.
    """
    emptied = []
    if answers_for is not None:
        gone = rows_without(answers_for.toDF("_day").distinct(), df.select(day).distinct(), "_day")
        emptied = [row["_day"] for row in gone.collect()]  # one value for each partition removed
    _write(df, path, [day], sort_by, file_bytes, "dynamic")
    for gone_day in emptied:
        delete_folder(df.sparkSession, partition_folder(path, day, gone_day))


def upsert_silver(
    spark: SparkSession,
    path: str,
    delta: DataFrame,
    schema: T.StructType,
    *,
    day: str = "created_date",
    replace: bool = False,
    days: DataFrame | None = None,
    is_written: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> None:
    """Bring the rows of ``delta`` into the silver table at ``path``.

    By default by MERGE rules: a matched booking keeps its created_at and so its day.
    With ``replace`` the rows of ``delta`` stand in for those they match and may move
    to another day. ``days`` are the days concerned, if the caller has them already, written
    (see ``DayIndex.admit``); else the whole table is looked through for them. Only these
    are rewritten, and nothing if the delta is empty. They
    are written to the shared folder first and swapped in from there, so a run that dies can be
    repeated: the same delta a second time changes nothing. ``is_written`` says that
    ``delta`` is a written table.
    """
    with ExitStack() as stack:
        if not is_written:
            delta = stack.enter_context(staged(delta, "delta"))
        if delta.isEmpty():
            return
        target = read_table(spark, path, schema)
        if days is None:
            found = affected_days(target, delta, broadcast_bytes=broadcast_bytes)
            days = stack.enter_context(staged(found, "days"))
        old_days = on_days(target, day, days)
        old = old_days.drop(day)
        if replace:
            ids = broadcast_if_fits(delta.select("booking_id"), broadcast_bytes)
            new = rows_without(old, ids, "booking_id").unionByName(delta)
        else:
            new = merge_silver(old, delta, broadcast_bytes=broadcast_bytes)
        with staged(with_day(new, "created_at", day), "merged") as merged:
            overwrite_days(
                merged, path, day, sort_by=["booking_id"], answers_for=old_days.select(day)
            )


# --- maintenance ----------------------------------------------------------------------


def _listed(spark: SparkSession, path: str) -> DataFrame:
    """The Parquet files of a table, from the file listing alone."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)


def file_sizes(spark: SparkSession, path: str, partition: str) -> DataFrame:
    """Files and bytes per partition value."""
    listed = _listed(spark, path).groupBy(partition)
    return listed.agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))


def compact(
    spark: SparkSession,
    path: str,
    partition: str,
    sort_by: Sequence[str],
    *,
    schema: T.StructType | None = None,
    file_bytes: int = FILE_BYTES,
) -> list[dt.date | None]:
    """Rewrite partitions that have more files than their bytes need; returns them.

    Rows do not change. A partition gets as many files as it has ``file_bytes``. Its rows
    are dealt out to them by position, so copies of one row spread too, and a task that is
    run again deals the same way. Partitions already in shape are not read.

    The new files come from a copy beside the table, which counts only once it has been
    compared with its source and a mark says so: an unmarked copy is deleted. A run that
    dies while swapping in is finished by the next one. It leaves a partition alone whose files are
    not those that were copied, so a later write is never undone; one without files was being
    swapped in, and gets its rows back. So days must not be emptied between two such runs.
    """
    beside = f"{path}_compacted"
    if not folder_exists(spark, f"{beside}/checked"):
        if folder_exists(spark, beside):
            delete_folder(spark, beside)
        crowded = crowded_partitions(spark, path, partition, file_bytes)
        with staged(crowded, "crowded") as crowded:
            if crowded.isEmpty():
                return []
            _copy_checked(spark, path, partition, crowded, schema, beside)
    return _swap_in(spark, path, partition, sort_by, beside)


def crowded_partitions(spark: SparkSession, path: str, partition: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """_day and _files (needed) of the partitions that have more files than their bytes need."""
    wanted = F.ceil(F.col("bytes") / F.lit(file_bytes)).cast("int")
    sizes = file_sizes(spark, path, partition).withColumn("_files", wanted)
    return sizes.where(F.col("files") > F.col("_files")).select(F.col(partition).alias("_day"), "_files")


def _files_of(spark: SparkSession, path: str, partition: str) -> DataFrame:
    """_day and the sorted names and lengths of its files."""
    name = F.element_at(F.split("path", "/"), -1)
    listed = _listed(spark, path)
    if partition not in listed.columns:  # no folder at all
        listed = listed.withColumn(partition, F.lit(None).cast("date"))
    return (
        listed.groupBy(F.col(partition).alias("_day"))
        .agg(F.array_sort(F.collect_list(F.struct(name.alias("name"), "length"))).alias("files"))
    )


def _copy_checked(
    spark: SparkSession, path: str, partition: str, crowded: DataFrame, schema: T.StructType | None, beside: str
) -> None:
    """Copy the crowded partitions, each row with the file it goes to, and mark the copy."""
    sources = rows_with(_files_of(spark, path, partition), crowded.select("_day"), "_day")
    sources.write.parquet(f"{beside}/sources")
    table = on_days(read_table(spark, path, schema), partition, crowded.select("_day"))
    dealt = (
        table.select("*", F.col("_metadata.row_index").alias("_position"))
        .join(broadcast_if_fits(crowded), F.col(partition).eqNullSafe(F.col("_day")))
        .withColumn("_slot", F.pmod("_position", "_files"))
        .drop("_position", "_day", "_files")
    )
    dealt.write.parquet(f"{beside}/rows")
    try:
        _same_rows(table, spark.read.parquet(f"{beside}/rows"))
    except RuntimeError:
        delete_folder(spark, beside)
        raise
    create_file(spark, f"{beside}/checked", "")


def _swap_in(
    spark: SparkSession, path: str, partition: str, sort_by: Sequence[str], beside: str
) -> list[dt.date | None]:
    """Replace the partitions of a checked copy that still have the files copied, or none."""
    sources = spark.read.parquet(f"{beside}/sources").withColumnRenamed("files", "copied")
    now = _files_of(spark, path, partition).withColumnRenamed("_day", "_now")
    unchanged = F.col("files").isNull() | (F.col("files") == F.col("copied"))
    due = sources.join(now, F.col("_day").eqNullSafe(F.col("_now")), "left").where(unchanged)
    with staged(due.select("_day"), "due") as due:
        copy = rows_with(spark.read.parquet(f"{beside}/rows"), due, partition)
        files = copy.select(partition, "_slot").distinct()
        (
            copy.repartition(max(1, files.count()), partition, "_slot")
            .sortWithinPartitions(partition, "_slot", *sort_by)
            .drop("_slot")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(partition)
            .parquet(path)
        )
        days = [row["_day"] for row in due.collect()]  # one value for each partition rewritten
    delete_folder(spark, beside)
    return days


def _same_rows(table: DataFrame, copy: DataFrame) -> None:
    """Fail unless ``copy`` has the rows of ``table``, as far as counts and hashes tell."""

    def told(df: DataFrame):
        row = F.xxhash64(*table.columns)
        return df.agg(F.count("*").alias("n"), F.sum(row % 1_000_003).alias("hashes")).first()

    if told(table) != told(copy):
        raise RuntimeError("the compacted copy differs from its table")


def read_evolved(spark: SparkSession, *paths: str) -> DataFrame:
    """Files of several schema versions as one table; columns a file lacks read as NULL."""
    return spark.read.option("mergeSchema", True).parquet(*paths)


def create_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    path: str,
    partition_by: T.StructField | None = None,
) -> None:
    """Declare a Parquet table over ``path`` unless it exists."""
    fields = [*schema.fields] + ([partition_by] if partition_by else [])
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    by = f"PARTITIONED BY (`{partition_by.name}`)" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {by} LOCATION '{path}'")
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {name}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")
