"""Comparison of two results by key.

The two sides are stacked and grouped by key rather than joined. That is one
shuffle with partial aggregation, treats NULL keys as equal, and a key repeated
many times on both sides costs one row, not their product.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _grouped(
    left: DataFrame, right: DataFrame, keys: Sequence[str], compare: Sequence[str]
) -> DataFrame:
    def side(df: DataFrame, is_left: bool) -> DataFrame:
        return df.select(*keys, F.struct(*compare).alias("_row"), F.lit(is_left).alias("_left"))

    is_left = F.col("_left")
    return (
        side(left, True)
        .unionByName(side(right, False))
        .groupBy(*keys)
        .agg(
            F.count(F.when(is_left, 1)).alias("left_rows"),
            F.count(F.when(~is_left, 1)).alias("right_rows"),
            F.max(F.when(is_left, F.col("_row"))).alias("_l"),
            F.max(F.when(~is_left, F.col("_row"))).alias("_r"),
        )
    )


def _presence() -> Column:
    left, right = F.col("left_rows"), F.col("right_rows")
    return (
        F.when(right == 0, "left_only")
        .when(left == 0, "right_only")
        .when((left > 1) | (right > 1), "repeated_key")
        .otherwise("both")
    )


def _differing(compare: Sequence[str]) -> Column:
    """Comma-separated names of the columns whose values differ; NULL equals NULL."""
    names = [
        F.when(~F.col(f"_l.{c}").eqNullSafe(F.col(f"_r.{c}")), F.lit(c)) for c in compare
    ]
    return F.when(F.col("presence") == "both", F.concat_ws(",", *names)).otherwise(F.lit(""))


def differences(
    left: DataFrame, right: DataFrame, keys: Sequence[str], compare: Sequence[str]
) -> DataFrame:
    """Keys on which two results differ, with both sides' values.

    ``presence`` says where the key occurs; ``differing`` names the columns that
    differ. A key that occurs twice on one side is reported as such, with the
    greatest row of each side.
    """
    return (
        _grouped(left, right, keys, compare)
        .withColumn("presence", _presence())
        .withColumn("differing", _differing(compare))
        .where((F.col("presence") != "both") | (F.col("differing") != ""))
        .select(
            *keys,
            "presence",
            "differing",
            *[F.col(f"_l.{c}").alias(f"left_{c}") for c in compare],
            *[F.col(f"_r.{c}").alias(f"right_{c}") for c in compare],
        )
    )


def match_summary(
    left: DataFrame, right: DataFrame, keys: Sequence[str], compare: Sequence[str]
) -> DataFrame:
    """One row: size of either side, keys that match and do not, and the verdict."""
    same = (F.col("presence") == "both") & (F.col("differing") == "")
    return (
        _grouped(left, right, keys, compare)
        .withColumn("presence", _presence())
        .withColumn("differing", _differing(compare))
        .agg(
            F.coalesce(F.sum("left_rows"), F.lit(0)).alias("left_rows"),
            F.coalesce(F.sum("right_rows"), F.lit(0)).alias("right_rows"),
            F.count_if(same).alias("matching_keys"),
            F.count_if(~same).alias("differing_keys"),
        )
        .withColumn("results_match", F.col("differing_keys") == 0)
    )


# Buckets that keys are dealt to by their hash, whose digests are compared first.
BUCKETS = 4096


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def bucket_digests(
    df: DataFrame, keys: Sequence[str], compare: Sequence[str], buckets: int = BUCKETS
) -> DataFrame:
    """bucket, and the number and two sums of 64-bit hashes of its rows.

    The sums do not depend on the order of rows. Hashes skip NULLs, so which values are NULL is
    hashed along. No row leaves its task: a task sends one row for each bucket.
    """
    columns = [*keys, *compare]
    missing = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])

    def total(seed: int) -> Column:
        return F.sum(F.xxhash64(F.lit(seed), missing, *columns).cast("decimal(38,0)"))

    return df.groupBy(_bucket(keys, buckets).alias("bucket")).agg(
        F.count("*").alias("rows"), total(1).alias("first_sum"), total(2).alias("second_sum")
    )


def differing_buckets(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str],
    buckets: int = BUCKETS,
) -> list[int]:
    """Numbers of the buckets that do not hold the same rows on both sides."""
    told = ["rows", "first_sum", "second_sum"]
    sides = [
        bucket_digests(df, keys, compare, buckets).select("bucket", F.struct(*told).alias("told"), F.lit(n).alias("side"))
        for n, df in enumerate((left, right))
    ]
    both = sides[0].unionByName(sides[1]).groupBy("bucket")
    found = both.agg(F.count("*").alias("sides"), F.count_distinct("told").alias("kinds"))
    return sorted(row["bucket"] for row in found.where("sides < 2 OR kinds > 1").collect())


def differences_by_digest(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str],
    buckets: int = BUCKETS,
) -> DataFrame:
    """``differences`` of two results that mostly agree, such as those of two engines.

    Both sides are read twice, so pass written tables: once for the digests of their buckets,
    once for the rows of the buckets whose digests differ. Only these are shuffled.
    """
    numbers = differing_buckets(left, right, keys, compare, buckets)

    def unsettled(df: DataFrame) -> DataFrame:
        return df.where(_bucket(keys, buckets).isin(numbers))

    return differences(unsettled(left), unsettled(right), keys, compare)
