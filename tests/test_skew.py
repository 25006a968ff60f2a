"""One key holds a third of all rows: joins split it, ordered operators spread it."""

import pytest
from airline import airline
from pyspark.sql import functions as F

from tarmac.operators.ranges import PART, ranged
from tarmac.plans.gold import booking_experience

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.shuffle.partitions": "8",
}


@pytest.fixture
def shuffling(spark):
    """A session of its own, in which no side is broadcast and small partitions count as skewed."""
    session = spark.newSession()
    for key, value in SETTINGS.items():
        session.conf.set(key, value)
    return session


def hot(column, every=3):
    """Key 7 for every third row, the row's own number otherwise."""
    return F.when(F.col("id") % every == 0, 7).otherwise(F.col(column))


def test_hot_flight_is_split_in_the_join(shuffling):
    rows = shuffling.range(200000, numPartitions=8)
    t = airline(shuffling)
    t._tables["booking"] = rows.select(
        F.col("id").alias("booking_key"), hot("id").alias("flight_event_key"), (F.col("id") % 50).alias("passenger_key"),
        F.xxhash64("id").alias("total_amount"))
    t._tables["flight"] = rows.select(F.col("id").alias("flight_event_key"), (F.col("id") % 90).alias("arrival_delay_min"))
    per_passenger = booking_experience(t).groupBy("passenger_key").agg(F.count(F.lit(1)).alias("n"), F.sum("arrival_delay_min").alias("late"))
    found = per_passenger.agg(F.sum("n").alias("n"), F.sum("late").alias("late"))
    hot_rows = 66667
    want = sum(n % 90 for n in range(200000) if n % 3) + 7 * hot_rows
    assert tuple(found.collect()[0]) == (200000, want)
    assert "skew" in found._jdf.queryExecution().executedPlan().toString()


def test_hot_key_is_spread_over_ranges(shuffling):
    rows = shuffling.range(40000, numPartitions=8).select(hot("id").alias("k"), F.col("id").alias("n"))
    sizes = ranged(rows, ["k"], ["n"], range_rows=5000).groupBy(PART).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("k") == 7).alias("hot")).collect()
    assert len(sizes) == 8 and sum(r.hot > 0 for r in sizes) >= 3
    assert max(r.n for r in sizes) < 40000 / 8 * 2
