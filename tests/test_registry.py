"""The driver contract, and a few queries against their SQL on the smallest tables.

`python check.py` compares all of them.
"""

import check
import pytest

import __spark_entry__ as entry
from staymark.suite import oracle, queries

DIRECTORY = "/root/testdata/sf0.001"
SAMPLE = [
    "silver_bookings",
    "silver_terminal_ever",
    "gold_daily_city_kpis_large_dimension",
    "silver_merge_upsert",
    "silver_upsert_table",
    "gold_incremental_refresh",
    "gold_backfill_range",
    "dq_declared_tests",
    "quality_gate_stale_gold",
    "reconcile_silver",
]


@pytest.fixture(scope="module")
def db():
    return check.connect(DIRECTORY)


def test_every_query_has_its_sql():
    assert set(queries.queries()) == set(oracle.oracle_sql())
    assert set(queries.queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    flagship = entry.entry(spark)
    assert flagship.columns[:3] == ["booking_date", "city", "total_bookings"]
    assert flagship.count() == 666


@pytest.mark.parametrize("name", SAMPLE)
def test_same_as_sql(spark, db, name):
    same, got, want, _, diff = check.compare(spark, db, DIRECTORY, name)
    assert same, (got, want, diff)
    assert got > 0
