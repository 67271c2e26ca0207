"""Keeping one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staymark.schemas import NTZ


# Later than any time in the data: the distance to it sorts newest first.
_END_OF_TIME = "9999-12-31 23:59:59"


def _newest_first(column: str) -> Column:
    return F.lit(_END_OF_TIME).cast(NTZ) - F.col(column)


def rank_struct(order: Sequence[str], newest: str | None = None) -> Column:
    """A row as a struct that is least for the row to keep.

    Newest by a timestamp column first, then ascending by ``order``; NULLs last
    throughout. The struct holds the values of ``order`` under their own names.
    """
    fields = []
    if newest is not None:
        fields = [F.col(newest).isNull().alias("_undated"), _newest_first(newest).alias("_age")]
    for name in order:
        fields += [F.col(name).isNull().alias(f"_no_{name}"), F.col(name)]
    return F.struct(*fields)


def first_per_key(
    df: DataFrame,
    keys: Sequence[str],
    *,
    newest: str | None = None,
    ties: Sequence[str] = (),
    also: Sequence[Column] = (),
) -> DataFrame:
    """One row per key: the newest by a timestamp column, then the first by ``ties``.

    Columns not named break what ties remain, so the winner does not depend on how the
    data is laid out. See ``rank_struct`` for the order. ``also`` are named aggregates over all
    rows of the key, which become columns of its row.

    The winner is the least struct of a group, hence an aggregate. Unlike a ranking
    window, an aggregate always has a partial step in front of its shuffle, also where
    a join already brought equal keys together and had to be split: a key that holds
    much of the data leaves every task as one row.
    """
    others = [c for c in df.columns if c not in keys]
    order = [*ties, *[c for c in others if c not in ties]]
    grouped = df.groupBy(*keys).agg(F.min(rank_struct(order, newest)).alias("_first"), *also)
    return grouped.select(
        *[F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns],
        *grouped.columns[len(keys) + 1 :],
    )


def distinct_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct values of ``keys``: a hash aggregate, combined before the shuffle."""
    return df.select(*keys).dropDuplicates()


def _key_join(df: DataFrame, keys: DataFrame, column: str, how: str) -> DataFrame:
    other = keys.toDF("_key")
    return df.join(other, F.col(column).eqNullSafe(F.col("_key")), how)


def rows_with(df: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` is in the one-column frame ``keys``; NULL equals NULL."""
    return _key_join(df, keys, column, "left_semi")


def rows_without(df: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` is not in the one-column frame ``keys``; NULL equals NULL."""
    return _key_join(df, keys, column, "left_anti")
