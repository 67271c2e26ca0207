"""Data-quality checks. Each returns a DataFrame; no violating rows means passed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staymark.statuses import DEFAULT_STATUSES, StatusModel

# --- generic checks: violating rows or keys -------------------------------------------


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def _repeated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("cnt")).where(F.col("cnt") > 1)


def unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; keys with a NULL are not judged."""
    return _repeated(df.dropna(subset=list(keys)), keys)


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows whose value is not listed; NULL passes."""
    return df.where(~F.col(column).isin(*values))


# --- checks on silver and gold --------------------------------------------------------


def one_row_per_key(df: DataFrame, key: str = "booking_id") -> DataFrame:
    """Keys that occur more than once, NULL included."""
    return _repeated(df, [key])


def valid_status(silver: DataFrame, model: StatusModel = DEFAULT_STATUSES) -> DataFrame:
    return accepted_values(silver, "booking_status", model.domain)


def no_future_dates(silver: DataFrame, as_of: str | None = None) -> DataFrame:
    """Bookings created after the day ``as_of``, by default today."""
    today = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    return silver.where(F.to_date("created_at") > today)


def _miscounted(model: StatusModel) -> Column:
    counted = reduce(lambda a, b: a + b, [F.col(c) for c in model.counters.values()])
    return F.col("total_bookings") != counted


def _rate_out_of_bounds() -> Column:
    rate = F.col("cancellation_rate")
    return (rate < 0) | (rate > 1)


def counts_add_up(gold: DataFrame, model: StatusModel = DEFAULT_STATUSES) -> DataFrame:
    return gold.where(_miscounted(model))


def rate_in_bounds(gold: DataFrame) -> DataFrame:
    return gold.where(_rate_out_of_bounds())


def money_not_negative(gold: DataFrame) -> DataFrame:
    return gold.where((F.col("total_confirmed_revenue") < 0) | (F.col("avg_booking_price") < 0))


def side_by_side(*one_row_frames: DataFrame) -> DataFrame:
    """One-row frames with distinct column names as one row."""
    stacked = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), one_row_frames
    )
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def _booking_totals(silver: DataFrame, gold: DataFrame) -> DataFrame:
    return side_by_side(
        silver.agg(F.count("*").alias("silver_count")),
        gold.agg(F.coalesce(F.sum("total_bookings"), F.lit(0)).alias("gold_total")),
    )


def silver_gold_consistency(silver: DataFrame, gold: DataFrame) -> DataFrame:
    """Both booking totals, if they differ."""
    return _booking_totals(silver, gold).where(F.col("silver_count") != F.col("gold_total"))


def revenue_consistency(
    silver: DataFrame, gold: DataFrame, model: StatusModel = DEFAULT_STATUSES
) -> DataFrame:
    """One row: booking counts and revenue of both layers, and whether they agree."""
    earned = F.when(F.col("booking_status") == model.earning, F.col("price"))
    zero = F.lit(0)
    totals = side_by_side(
        silver.agg(
            F.count("*").alias("silver_count"),
            F.coalesce(F.sum(earned), zero).cast("decimal(30,2)").alias("silver_revenue"),
        ),
        gold.agg(
            F.coalesce(F.sum("total_bookings"), zero).alias("gold_total"),
            F.coalesce(F.sum("total_confirmed_revenue"), zero)
            .cast("decimal(30,2)")
            .alias("gold_revenue"),
        ),
    )
    return totals.select(
        "silver_count",
        "gold_total",
        (F.col("silver_count") == F.col("gold_total")).alias("counts_match"),
        "silver_revenue",
        "gold_revenue",
        (F.col("silver_revenue") == F.col("gold_revenue")).alias("revenue_matches"),
    )


def booking_sanity(silver: DataFrame, model: StatusModel = DEFAULT_STATUSES) -> DataFrame:
    """Bookings with a status outside the domain (NULL included) or no positive price."""
    status, price = F.col("booking_status"), F.col("price")
    bad_status = ~F.coalesce(status.isin(*model.domain), F.lit(False))
    bad_price = ~F.coalesce(price > 0, F.lit(False))
    reason = F.concat_ws(
        ", ",
        F.when(bad_status, F.lit("invalid status")),
        F.when(bad_price, F.lit("invalid price")),
    )
    return silver.where(bad_status | bad_price).select(
        "booking_id", "booking_status", "price", reason.alias("reason")
    )


def status_transitions(silver: DataFrame, model: StatusModel = DEFAULT_STATUSES) -> DataFrame:
    """Cancelled bookings no source confirms, confirmed ones a source shows as cancelled."""
    lost_somewhere = F.coalesce(F.col("_raw_snapshot_status") == model.lost, F.lit(False)) | (
        F.coalesce(F.col("_raw_event_status") == model.lost, F.lit(False))
    )
    status = F.col("booking_status")
    reason = F.when(
        (status == model.lost) & ~lost_somewhere, F.lit("cancelled but no source confirms it")
    ).when(
        (status == model.earning) & lost_somewhere,
        F.lit("confirmed but a source shows cancelled"),
    )
    return (
        silver.withColumn("reason", reason)
        .where(F.col("reason").isNotNull())
        .select(
            "booking_id",
            "booking_status",
            "_raw_snapshot_status",
            "_raw_event_status",
            "reason",
        )
    )


def freshness(events: DataFrame, as_of: str, within_hours: int) -> DataFrame:
    """Last event time and whether it lies more than some hours before ``as_of``; a log
    without a dated event is stale."""
    bound = F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(hours=F.lit(within_hours))
    last = F.col("last_event_ts")
    return events.agg(F.max("event_ts").alias("last_event_ts")).withColumn(
        "stale", F.coalesce(last < bound, F.lit(True))
    )


# --- reports: one row per check -------------------------------------------------------


def _silver_facts(silver: DataFrame, model: StatusModel) -> DataFrame:
    status = F.col("booking_status")
    return silver.agg(
        F.count("*").alias("total_rows"),
        F.count_distinct("booking_id").alias("unique_bookings"),
        F.count_if(F.col("booking_id").isNull()).alias("null_ids"),
        F.count_if(~status.isin(*model.domain)).alias("invalid_status"),
    )


def _gold_facts(gold: DataFrame, model: StatusModel) -> DataFrame:
    return gold.agg(
        F.count_if(_miscounted(model)).alias("mismatched"),
        F.count_if(_rate_out_of_bounds()).alias("out_of_bounds"),
        F.count_if(F.col("total_confirmed_revenue") < 0).alias("negative_revenue"),
        F.coalesce(F.sum("total_bookings"), F.lit(0)).alias("gold_total"),
    )


def _rows(facts: DataFrame, fields: Sequence[str], rows: Sequence[Sequence[Column]]) -> DataFrame:
    """One output row per entry of ``rows``, all read off the one row of ``facts``."""
    entries = [
        F.struct(*[value.alias(name) for name, value in zip(fields, row, strict=True)])
        for row in rows
    ]
    return facts.select(F.inline(F.array(*entries)))


def quality_gate(
    silver: DataFrame, gold: DataFrame, model: StatusModel = DEFAULT_STATUSES
) -> DataFrame:
    """The deployment gate: seven checks as (name, passed, detail), one pass per layer."""
    facts = side_by_side(_silver_facts(silver, model), _gold_facts(gold, model))
    c = F.col

    def none_of(name: str, fact: str, label: str) -> list[Column]:
        return [F.lit(name), c(fact) == 0, F.format_string(f"{label}=%d", c(fact))]

    # Check names and detail formats are fixed values of the report.
    return _rows(
        facts,
        ("name", "passed", "detail"),
        [
            [
                F.lit("Silver: one row per booking"),
                c("total_rows") == c("unique_bookings"),
                F.format_string(
                    "total_rows=%d, unique_bookings=%d", c("total_rows"), c("unique_bookings")
                ),
            ],
            none_of("Silver: no NULL booking_ids", "null_ids", "null_booking_ids"),
            none_of("Silver: valid status values", "invalid_status", "invalid_status_count"),
            none_of("Gold: counts add up", "mismatched", "mismatched_rows"),
            none_of("Gold: cancellation rate 0-1", "out_of_bounds", "out_of_bounds_rows"),
            none_of("Gold: non-negative revenue", "negative_revenue", "negative_revenue_rows"),
            [
                F.lit("Cross-layer: Silver count = Gold sum"),
                c("total_rows") == c("gold_total"),
                F.format_string("silver=%d, gold_sum=%d", c("total_rows"), c("gold_total")),
            ],
        ],
    )


def gate_verdict(report: DataFrame) -> DataFrame:
    """One row: whether all checks passed, and how many did not."""
    return report.agg(
        F.min("passed").alias("approved"), F.count_if(~F.col("passed")).alias("failed_checks")
    )


def validation_messages(
    silver: DataFrame, gold: DataFrame, model: StatusModel = DEFAULT_STATUSES
) -> DataFrame:
    """The integration tests: PASS or FAIL text per check."""
    facts = side_by_side(_silver_facts(silver, model), _gold_facts(gold, model))
    c = F.col

    def verdict(layer: str, check: str, passed: Column, good: str, bad: str) -> list[Column]:
        text = F.when(passed, f"PASS: {good}").otherwise(f"FAIL: {bad}")
        return [F.lit(layer), F.lit(check), text]

    # Message texts are fixed values of the report.
    return _rows(
        facts,
        ("layer", "check", "test_result"),
        [
            verdict(
                "silver",
                "row count",
                c("total_rows") == c("unique_bookings"),
                "One row per booking",
                "Duplicate booking_ids found",
            ),
            verdict(
                "silver",
                "valid statuses",
                c("invalid_status") == 0,
                "All statuses valid",
                "Invalid status values found",
            ),
            verdict(
                "silver",
                "no NULL keys",
                c("null_ids") == 0,
                "No NULL booking_ids",
                "NULL booking_ids found",
            ),
            verdict(
                "gold",
                "counts add up",
                c("mismatched") == 0,
                "Counts are consistent",
                "Count mismatch detected",
            ),
            verdict(
                "gold",
                "cancellation rate bounds",
                c("out_of_bounds") == 0,
                "Cancellation rates in bounds",
                "Cancellation rate out of bounds",
            ),
            verdict(
                "gold",
                "non-negative revenue",
                c("negative_revenue") == 0,
                "Revenue non-negative",
                "Negative revenue found",
            ),
        ],
    )


# The column tests declared for every table: not-null columns, unique keys, and
# columns restricted to the status domain.
DECLARED_NOT_NULL: Mapping[str, tuple[str, ...]] = {
    "bookings_raw": ("booking_id",),
    "booking_events_raw": ("booking_id",),
    "hotels_raw": ("hotel_id",),
    "stg_bookings": ("booking_id", "price"),
    "stg_booking_events": ("booking_id",),
    "stg_hotels": ("hotel_id",),
    "silver_bookings": ("booking_id", "booking_status", "user_id", "hotel_id", "price"),
    "gold_daily_city_kpis": ("booking_date", "city", "total_bookings"),
}
DECLARED_UNIQUE: Mapping[str, tuple[str, ...]] = {
    "hotels_raw": ("hotel_id",),
    "stg_hotels": ("hotel_id",),
    "silver_bookings": ("booking_id",),
}
DECLARED_STATUS: Mapping[str, tuple[str, ...]] = {
    "bookings_raw": ("status",),
    "booking_events_raw": ("event_type",),
    "silver_bookings": ("booking_status",),
}


def declared_tests(
    tables: Mapping[str, DataFrame], model: StatusModel = DEFAULT_STATUSES
) -> DataFrame:
    """All declared column tests: (table, column, test, violations, passed).

    Not-null and accepted-values tests of a table share one aggregate over it; a
    unique test counts its repeated keys.
    """
    reports = []
    for table, df in tables.items():
        tests = [
            (column, "not_null", F.col(column).isNull())
            for column in DECLARED_NOT_NULL.get(table, ())
        ] + [
            (column, "accepted_values", ~F.col(column).isin(*model.domain))
            for column in DECLARED_STATUS.get(table, ())
        ]
        counted = df.agg(*[F.count_if(bad).alias(f"_{i}") for i, (_, _, bad) in enumerate(tests)])
        fields = ("table", "column", "test", "violations")
        rows = [
            [F.lit(table), F.lit(column), F.lit(test), F.col(f"_{i}")]
            for i, (column, test, _) in enumerate(tests)
        ]
        reports.append(_rows(counted, fields, rows))
        for column in DECLARED_UNIQUE.get(table, ()):
            repeated = unique(df, [column]).agg(F.count("*").alias("_n"))
            row = [F.lit(table), F.lit(column), F.lit("unique"), F.col("_n")]
            reports.append(_rows(repeated, fields, [row]))
    return reduce(DataFrame.unionByName, reports).withColumn(
        "passed", F.col("violations") == 0
    )
