"""Silver kept current from streams of snapshots and events.

Spark keeps the latest snapshot and the event state of every booking as aggregation
state, so a micro-batch costs its own rows, not the history. Each batch then yields
the bookings it changed, whole, and these take the place of their rows in the table.
The state also holds the days that a booking's snapshots ever named, nearly always one:
the row to replace lies on one of them, so a batch reads these days of the table and no
other. Order and time of arrival do not matter, a repeated batch changes nothing, and the
table equals a batch build over all rows received so far.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from staymark.operators.rows import distinct_rows
from staymark.operators.sizing import BROADCAST_BYTES
from staymark.plans.silver import reconcile_state, silver_columns, stacked_state
from staymark.sinks.day_index import DayIndex
from staymark.sinks.locations import staged
from staymark.sinks.tables import upsert_silver, write_table
from staymark.statuses import DEFAULT_STATUSES, StatusModel

DAY = "created_date"


def _table_schema(silver_schema: T.StructType) -> T.StructType:
    return T.StructType([*silver_schema.fields, T.StructField(DAY, T.DateType())])


def create_empty_silver(spark: SparkSession, path: str, silver_schema: T.StructType) -> None:
    """An empty silver table for the stream to fill."""
    nothing = spark.createDataFrame([], _table_schema(silver_schema))
    write_table(nothing, path, partition_by=[DAY])


def start_silver_stream(
    bookings: DataFrame,
    events: DataFrame,
    silver_path: str,
    checkpoint: str,
    silver_schema: T.StructType,
    *,
    model: StatusModel = DEFAULT_STATUSES,
    as_of: str | None = None,
    index: DayIndex | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start the query that brings two streams of typed feeds into the silver table.

    ``silver_path`` and ``checkpoint`` are shared folders. The number of state
    partitions is fixed by spark.sql.shuffle.partitions at the first start. A table that holds
    bookings whose snapshots the streams do not deliver needs its ``index``, for the state
    does not know where these are.
    """

    def absorb(changed: DataFrame, batch_id: int) -> None:
        whole = reconcile_state(changed, model, as_of=as_of)
        with staged(whole.select(*silver_columns(model), "_days"), "batch") as batch:
            if batch.isEmpty():
                return
            delta = batch.drop("_days")
            days = batch.select(F.explode("_days").alias("_d")).select("_d.day")
            if index is not None:
                found = index.admit(delta, F.to_date("created_at"), moves=True, broadcast_bytes=broadcast_bytes)
                days = days.unionByName(found)
            with staged(distinct_rows(days, ["day"]), "days") as days:
                upsert_silver(
                    batch.sparkSession,
                    silver_path,
                    delta,
                    _table_schema(silver_schema),
                    day=DAY,
                    replace=True,
                    days=days,
                    is_written=True,
                    broadcast_bytes=broadcast_bytes,
                )

    return (
        stacked_state(bookings, events, model, days=True)
        .writeStream.outputMode("update")
        .foreachBatch(absorb)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )
