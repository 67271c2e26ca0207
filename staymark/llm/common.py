"""What several operators need: tables, batches, tokenizer units."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staymark.session import shuffles_deleted
from staymark.sinks.locations import delete_folder, new_folder


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def two_columns(documents: DataFrame, *more: str) -> DataFrame:
    """doc_id and text (and more), whatever else the table holds."""
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *more
    )


def carried(documents: DataFrame) -> DataFrame:
    """doc_id, text, and all other columns in one, so that none clashes with a new name."""
    others = [F.col(f"`{c}`") for c in documents.columns if c not in ("doc_id", "text")]
    rest = F.struct(*others) if others else F.lit(True)
    return documents.select("doc_id", "text", rest.alias("carried"))


def uncarried(columns: list[str]) -> dict[str, Column]:
    """By name, the columns that ``carried`` was given."""
    return {c: F.col(c) if c in ("doc_id", "text") else F.col("carried")[c] for c in columns}


class Kept:
    """Tables written while an operator runs, deleted one by one when no longer read."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[str, str] = {}

    def write(self, df: DataFrame, label: str) -> DataFrame:
        """``df`` computed once, stored in the shared folder; replaces the label's last."""
        path = new_folder(self.spark, label)
        with shuffles_deleted(self.spark):
            df.write.parquet(path)
        self.drop(label)
        self.paths[label] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def write_folders(self, df: DataFrame, label: str, key: str) -> DataFrame:
        """Like ``write``, with a folder for each value of ``key``: who asks for some reads these
        alone. For texts, hence compressed well."""
        path = new_folder(self.spark, label)
        with shuffles_deleted(self.spark):
            df.write.partitionBy(key).option("compression", "zstd").parquet(path)
        self.drop(label)
        self.paths[label] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def write_bucketed(self, df: DataFrame, label: str, key: str) -> DataFrame:
        """Like ``write``, dealt to as many buckets by ``key`` as a shuffle has partitions: later
        joins by it shuffle their other side alone, however often and large ``df`` is."""
        path, name = new_folder(self.spark, label), f"staymark_{uuid.uuid4().hex}"
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
        with shuffles_deleted(self.spark):
            writer.option("path", path).saveAsTable(name)
        self.drop(label)
        self.paths[label] = path
        bucketed = self.spark.table(name)
        self.spark.sql(f"DROP TABLE {name}")  # its files stay, and so does what is read
        return bucketed

    def drop_others(self, *labels: str) -> None:
        self.drop(*[label for label in self.paths if label not in labels])

    def drop(self, *labels: str) -> None:
        for label in labels:
            if label in self.paths:
                delete_folder(self.spark, self.paths.pop(label))


# Keys that hold at least one of so many rows are looked up in a broadcast.
FREQUENT = 1000


def join_counted(rows: DataFrame, counted: DataFrame, keys: list[str], count: str) -> DataFrame:
    """``rows`` with the row of ``counted`` of their keys (NULL equals NULL), without ``count``.

    ``counted`` has one row for each key of ``rows`` and how many rows hold it. Keys of at
    least a thousandth of all rows are at most a thousand: these are broadcast, however large
    the tables are. The rest is shuffled, and none of its keys is frequent. Both are
    read more than once, so pass written tables.
    """
    total = counted.agg(F.sum(count).alias("total")).first()["total"] or 0
    names = {k: f"_key_{k}" for k in keys}
    renamed = counted.withColumnsRenamed(names)
    frequent = F.col(count) * FREQUENT >= total

    def joined(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        return left.join(right, [F.col(k).eqNullSafe(F.col(name)) for k, name in names.items()], how)

    hot = F.broadcast(renamed.where(frequent))
    found = joined(rows, hot, "inner").unionByName(
        joined(joined(rows, hot, "left_anti"), renamed.where(~frequent), "inner")
    )
    return found.drop(count, *names.values())
