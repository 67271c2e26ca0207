"""Broadcasting by measured size."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Largest relation, measured as uncompressed rows, that is sent to every executor.
BROADCAST_BYTES = 64 * 1024 * 1024
# Row header, hash table slot and null bits; and the most a fixed-width value takes.
ROW_OVERHEAD = 48
FIXED_WIDTH = 16


def measured_bytes(df: DataFrame) -> int:
    """Size of the rows of ``df``, from one distributed aggregate over it."""

    def width(field: T.StructField) -> Column:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(field.name), F.lit(0)) + F.lit(FIXED_WIDTH)
        if isinstance(field.dataType, T.AtomicType):
            return F.lit(FIXED_WIDTH)
        raise TypeError(f"no size rule for column {field.name}: {field.dataType.simpleString()}")

    row = reduce(lambda a, b: a + b, [width(f) for f in df.schema.fields], F.lit(ROW_OVERHEAD))
    total = df.agg(F.sum(row.cast("long")).alias("bytes")).first()["bytes"]
    return int(total or 0)


def fits_broadcast(df: DataFrame, budget: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` is small enough to broadcast. Runs one job unless budget is 0."""
    return budget > 0 and measured_bytes(df) <= budget


def broadcast_if_fits(
    df: DataFrame, budget: int = BROADCAST_BYTES, *, bound: DataFrame | None = None
) -> DataFrame:
    """``df``, marked for broadcast if it is measured to fit.

    ``bound`` is a relation that cannot be smaller and is cheaper to measure.
    """
    return F.broadcast(df) if fits_broadcast(df if bound is None else bound, budget) else df
