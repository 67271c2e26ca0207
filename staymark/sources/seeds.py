"""Typed CSV seeds: an empty field is NULL (so an empty text comes back as NULL), times are
ISO 8601, and a value has no line break."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header line and declared types; a value that does not fit fails the job."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )


def write_seed(df: DataFrame, path: str) -> None:
    """``df`` as CSV with a header line, such that ``read_seed`` gives the same rows."""
    (
        df.write.option("header", True)
        .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
