"""Upsert of one keyed relation into another.

Plain Parquet tables have no MERGE, so the merged table is computed as a relation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staymark.operators.sizing import BROADCAST_BYTES, fits_broadcast


def require_unique(df: DataFrame, key: str) -> None:
    """Raise if a non-NULL key occurs twice, as MERGE would."""
    repeated = df.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1")
    if not repeated.isEmpty():
        raise ValueError(f"merge source has more than one row for a {key}")


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    key: str,
    version: str,
    updated: Sequence[str],
    *,
    broadcast_bytes: int = BROADCAST_BYTES,
    check_source: bool = True,
) -> DataFrame:
    """``target`` after merging ``source`` into it.

    A matched row takes the ``updated`` columns of the source where the source's
    ``version`` is greater (a NULL on either side means no update) and keeps all
    others. An unmatched source row is inserted whole. NULL keys match nothing.

    If the source is measured to fit, it is broadcast and the target is not
    shuffled: one pass updates it, and a second over its key column finds the
    source rows that are new. If not, both are shuffled into one full outer join.
    The source is read several times, so pass a written table, not a long plan.
    """
    if check_source:
        require_unique(source, key)
    columns = target.columns
    incoming = source.select(F.col(key), F.struct(*columns).alias("_in"))
    newer = F.col(f"_in.{version}") > F.col(version)

    def updated_or_kept(name: str):
        if name not in updated:
            return F.col(name)
        return F.when(newer, F.col(f"_in.{name}")).otherwise(F.col(name)).alias(name)

    if fits_broadcast(source, broadcast_bytes):
        kept = target.join(F.broadcast(incoming), key, "left").select(
            *[updated_or_kept(c) for c in columns]
        )
        matched = target.select(key).join(
            F.broadcast(source.select(key)), key, "left_semi"
        )
        inserted = source.select(*columns).join(matched, key, "left_anti")
        return kept.unionByName(inserted)

    current = target.withColumn("_in_target", F.lit(True))
    joined = current.join(incoming, key, "full_outer")
    return joined.select(
        *[
            F.when(F.col("_in_target"), updated_or_kept(c)).otherwise(F.col(f"_in.{c}")).alias(c)
            if c != key
            else F.col(c)
            for c in columns
        ]
    )
