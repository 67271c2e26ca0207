"""Statistics that the catalog keeps of a table, and plans that rest on them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staymark.operators.sizing import BROADCAST_BYTES, FIXED_WIDTH, ROW_OVERHEAD, broadcast_if_fits


def analyze(spark: SparkSession, name: str) -> None:
    """Collect table and column statistics."""
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")


@dataclass(frozen=True)
class ColumnStatistics:
    """Of one column: NULLs, distinct values (approximate), least and greatest value (as text,
    None where the catalog keeps none), and mean length in bytes."""

    nulls: int
    distinct: int
    low: str | None
    high: str | None
    mean_length: int


@dataclass(frozen=True)
class TableStatistics:
    rows: int
    columns: dict[str, ColumnStatistics]

    def bytes(self, schema: T.StructType) -> int:
        """Size of the rows uncompressed, by the rule that measured tables follow."""
        width = ROW_OVERHEAD
        for field in schema.fields:
            width += FIXED_WIDTH
            if isinstance(field.dataType, (T.StringType, T.BinaryType)):
                width += self.columns[field.name].mean_length
        return self.rows * width


def _rows(spark: SparkSession, name: str) -> int | None:
    described = spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Statistics'").first()
    _, found, rows = (described["data_type"] if described else "").partition(", ")
    return int(rows.removesuffix(" rows")) if found else None


def stored_statistics(spark: SparkSession, name: str) -> TableStatistics | None:
    """What the catalog knows of a table; None unless it knows all its columns.

    Reads the catalog alone. Statistics are of the time of ``analyze``: writes by path that
    follow do not change them.
    """
    rows = _rows(spark, name)
    if rows is None:
        return None
    columns = {}
    for column in spark.table(name).columns:
        told = {r["info_name"]: r["info_value"] for r in spark.sql(f"DESCRIBE EXTENDED {name} `{column}`").collect()}
        if told["distinct_count"] == "NULL":
            return None
        low, high = (None if told[c] == "NULL" else told[c] for c in ("min", "max"))
        columns[column] = ColumnStatistics(
            int(told["num_nulls"]), int(told["distinct_count"]), low, high, int(told["avg_col_len"])
        )
    return TableStatistics(rows, columns)


def statistics_report(spark: SparkSession, name: str) -> DataFrame:
    """One row for each column: column, row_count, null_count, distinct_count, low, high."""
    stored = stored_statistics(spark, name)
    if stored is None:
        raise ValueError(f"{name} has not been analyzed")
    rows = [(c, stored.rows, s.nulls, s.distinct, s.low, s.high) for c, s in stored.columns.items()]
    fields = "column string, row_count long, null_count long, distinct_count long, low string, high string"
    return spark.createDataFrame(rows, fields)


def table_for_join(spark: SparkSession, name: str, budget: int = BROADCAST_BYTES) -> DataFrame:
    """The table, marked for broadcast if its statistics say that it fits; a table without
    statistics is measured instead."""
    table, stored = spark.table(name), stored_statistics(spark, name)
    if stored is None:
        return broadcast_if_fits(table, budget)
    return F.broadcast(table) if stored.bytes(table.schema) <= budget else table
