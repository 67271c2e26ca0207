"""A set of values as a few ranges, given to a scan as literals.

A scan prunes folders and skips row groups by literal bounds only. A list of all values wanted
grows with them, and their first and last one alone cover all that lies between; so values
that lie close together become one range, and the widest gaps are left out.
"""

from __future__ import annotations

from dataclasses import dataclass
from os.path import commonprefix
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Ranges of a cover, and cells that the values are counted into to find its gaps.
MOST_RANGES = 64
CELLS = 4096
# Bytes behind their common beginning that text values are placed by.
_PLACED_BYTES = 6


@dataclass(frozen=True)
class Cover:
    """Ascending ranges with both ends in them, which hold all values; and whether NULL is one."""

    ranges: tuple[tuple[Any, Any], ...]
    null: bool

    def holds(self, column: str | Column) -> Column:
        value = F.col(column) if isinstance(column, str) else column
        inside = F.lit(False)
        for low, high in self.ranges:
            one = value == F.lit(low) if low == high else value.between(F.lit(low), F.lit(high))
            inside = inside | one
        return inside | value.isNull() if self.null else inside


def _place(value: Column, kind: T.DataType, low: Any, high: Any) -> tuple[Column, float]:
    """A number that orders values as they order themselves (equal ones may be told apart by
    more than it says), counted from ``low``; and its greatest value."""
    if isinstance(kind, T.DateType):
        return F.datediff(value, F.lit(low)).cast("double"), float((high - low).days)
    if isinstance(kind, T.IntegralType):
        return value.cast("double") - F.lit(float(low)), float(high) - float(low)
    if isinstance(kind, T.StringType):
        shared = len(commonprefix([low.encode(), high.encode()]))

        def number(binary: Column) -> Column:
            hexed = F.rpad(F.hex(F.substring(binary, shared + 1, _PLACED_BYTES)), 2 * _PLACED_BYTES, "0")
            return F.conv(hexed, 16, 10).cast("double")

        def of(text: str) -> float:
            return float(int.from_bytes(text.encode()[shared : shared + _PLACED_BYTES].ljust(_PLACED_BYTES, b"\0")))

        return number(value.cast("binary")) - F.lit(of(low)), of(high) - of(low)
    raise TypeError(f"no ranges over {kind.simpleString()}")


def _cell(values: DataFrame, value: Column, kind: T.DataType, low: Any, high: Any, place: Column, farthest: float) -> Column:
    """What values are counted by: stretches of equal length, or, for text, beginnings as
    long as about ``CELLS`` distinct ones allow (letters use few of all bytes)."""
    if not isinstance(kind, T.StringType):
        return F.floor(place * F.lit(CELLS / (farthest + 1)))
    shared = len(commonprefix([low, high]))
    lengths = range(shared, shared + _PLACED_BYTES + 1)
    counts = values.agg(*[F.approx_count_distinct(F.substring(value, 1, n)).alias(str(n)) for n in lengths]).first()
    return F.substring(value, 1, max(n for n in lengths if n == shared or counts[str(n)] <= CELLS))


def covering(values: DataFrame, most: int = MOST_RANGES) -> Cover:
    """At most ``most`` ranges that hold the one column of ``values``.

    Aggregates over it: its ends, then the least and greatest value of each of some 4096 cells
    between them, of which only these come to the driver.
    """
    field = values.schema.fields[0]
    value = F.col(field.name)
    ends = values.agg(
        F.min(value).alias("low"), F.max(value).alias("high"), F.bool_or(value.isNull()).alias("null")
    ).first()
    if ends["low"] is None:
        return Cover((), bool(ends["null"]))
    place, farthest = _place(value, field.dataType, ends["low"], ends["high"])
    cell = _cell(values, value, field.dataType, ends["low"], ends["high"], place, farthest).alias("cell")
    cells = (
        values.where(value.isNotNull())
        .select(value.alias("value"), place.alias("place"), cell)
        .groupBy("cell")
        .agg(*[f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in ("value", "place")])
        .orderBy("min_value")
        .collect()
    )
    gaps = sorted(range(1, len(cells)), key=lambda i: cells[i - 1]["max_place"] - cells[i]["min_place"])
    # Next to each other is no gap: days and numbers have nothing between them.
    step = 0 if isinstance(field.dataType, T.StringType) else 1
    cuts = sorted(i for i in gaps[: most - 1] if cells[i]["min_place"] - cells[i - 1]["max_place"] > step)
    firsts, lasts = [0, *cuts], [*cuts, len(cells)]
    return Cover(
        tuple((cells[a]["min_value"], cells[b - 1]["max_value"]) for a, b in zip(firsts, lasts, strict=True)),
        bool(ends["null"]),
    )
