"""Session settings the jobs rely on."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

from staymark.sinks.locations import provide_folder

_RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # Split a hot join key even if the next aggregate then needs a shuffle of its own.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # One row of stream state per booking outgrows executor memory: keep it on disk,
    # and put only its changes into the checkpoint.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# Rows of two or three numbers take some 12 bytes in a shuffle and, joined, sorted and grouped,
# 50 times that in a task: small partitions keep a task small, however many rows there are.
# A size given when the session was started stays.
_UNLESS_GIVEN = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m"}


# Texts go to Python workers and come back in batches of so many bytes, however long they are.
# Workers and executors live on and keep the memory of the largest batches that they met.
_SMALL_BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": "2m"}


# Otherwise shuffle files stay until the driver happens to collect its garbage.
_SHUFFLES_END = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Files of shuffles go as soon as the action that made them ends. For what is run once:
    an action repeated on the same DataFrame would shuffle anew."""
    before = spark.conf.get(_SHUFFLES_END, None)
    spark.conf.set(_SHUFFLES_END, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_SHUFFLES_END)
        else:
            spark.conf.set(_SHUFFLES_END, before)


def try_out(spark: SparkSession) -> SparkSession:
    """For runs straight from this repository: the shared folder of a trial run, and the
    place where Python workers find the package."""
    root = str(Path(__file__).resolve().parent.parent)
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)
    return provide_folder(spark)


def small_batches(spark: SparkSession) -> SparkSession:
    """For jobs of many stages that hand whole texts to Python workers."""
    return _unless_given(spark, _SMALL_BATCHES)


def prepare(spark: SparkSession) -> SparkSession:
    for name, value in _RUNTIME.items():
        spark.conf.set(name, value)
    return _unless_given(spark, _UNLESS_GIVEN)


def _unless_given(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    given = spark.sparkContext.getConf()
    for name, value in settings.items():
        if not given.contains(name):
            spark.conf.set(name, value)
    return spark
