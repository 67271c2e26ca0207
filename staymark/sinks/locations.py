"""Where written data goes.

Every intermediate table lies below one folder per process, which is deleted when the
process ends, whether its work succeeded or not.
"""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_given: dict[str, str] = {}  # "folder": the folder named by use_folder()
_owned: dict[str, SparkSession] = {}  # run folders of this process, by path


def use_folder(path: str) -> None:
    """Name the shared folder for sessions that do not set spark.checkpoint.dir."""
    _given["folder"] = path


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, else the one named."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or _given.get("folder")
    if folder is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return folder.rstrip("/")


def provide_folder(spark: SparkSession) -> SparkSession:
    """For trial runs on one machine: name a new folder there if none is set.

    A cluster must set its own; there this raises.
    """
    if spark.conf.get("spark.checkpoint.dir", None) is None and "folder" not in _given:
        if not spark.sparkContext.master.startswith("local["):
            shared_folder(spark)
        use_folder(tempfile.mkdtemp(prefix="staymark-"))
    return spark


def _run_folder(spark: SparkSession) -> str:
    base = shared_folder(spark)
    for path in _owned:
        if path.startswith(f"{base}/"):
            _owned[path] = spark
            return path
    path = f"{base}/staymark-{uuid.uuid4().hex}"
    _owned[path] = spark
    return path


@atexit.register
def delete_run_folders() -> None:
    """Delete what this process wrote below its run folders."""
    for path, spark in list(_owned.items()):
        with contextlib.suppress(Exception):  # the JVM may be gone already
            delete_folder(spark, path)
        _owned.pop(path)


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below this process's run folder that nothing else uses."""
    return f"{_run_folder(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the run folder: computed once, and safe to read again
    after losing executors. It stays as long as the process, for lazy readers."""
    return _write_and_read(df, new_folder(df.sparkSession, label))


def _write_and_read(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staged(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """Like ``written``, for the length of a block; deleted also when the block fails."""
    path = new_folder(df.sparkSession, label)
    try:
        yield _write_and_read(df, path)
    finally:
        delete_folder(df.sparkSession, path)


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def folder_exists(spark: SparkSession, path: str) -> bool:
    store, target = _file_system(spark, path)
    return store.exists(target)


def list_folder(spark: SparkSession, path: str) -> list[tuple[str, float]]:
    """Name and time of last change (seconds) of everything directly in a folder."""
    store, target = _file_system(spark, path)
    found = store.listStatus(target) if store.exists(target) else []
    return [(f.getPath().getName(), f.getModificationTime() / 1000) for f in found]


def create_file(spark: SparkSession, path: str, content: str) -> None:
    """Write a small file that must not exist yet; of two writers one fails."""
    store, target = _file_system(spark, path)
    out = store.create(target, False)
    try:
        out.write(bytearray(content.encode()))
    finally:
        out.close()


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Delete a table folder, wherever Hadoop can reach it."""
    store, target = _file_system(spark, path)
    return store.delete(target, True)
