"""Session settings."""

from pyspark.sql import functions as F

from staymark.session import prepare


def test_tasks_stay_small_where_cores_do_not_spread_them(spark):
    """Some 30 MB of shuffled keys are no single task's."""
    spread = "spark.sql.adaptive.coalescePartitions.parallelismFirst"
    prepare(spark).conf.set(spread, "false")
    try:
        keys = spark.range(0, 3_000_000, 1, 4).select(F.xxhash64("id").alias("a"), F.hash("id").alias("b"))
        assert keys.groupBy("a", "b").count().rdd.getNumPartitions() > 1
    finally:
        spark.conf.unset(spread)
