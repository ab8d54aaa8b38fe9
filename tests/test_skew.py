"""A key holding a third of all samples: the bucketed interval join spreads
it over the shuffle partitions, the plain join puts it in one."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from raceline.operators.interval_join import interval_join

CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def shuffle_only(spark):
    before = {k: spark.conf.get(k, None) for k in CONF}
    for k, v in CONF.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _largest_share(df) -> float:
    sizes = [r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
    return max(sizes) / sum(sizes)


def test_hot_key_is_spread_by_buckets(shuffle_only):
    spark = shuffle_only
    n = 60_000
    t0 = F.lit("2024-03-01 00:00:00").cast("timestamp")
    # one third of the samples belong to (session 0, car 1); the rest spread over 300 pairs
    samples = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 100 + 1).cast("int").alias("session_key"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 3 + 1).cast("int").alias("driver_number"),
        (t0 + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("id") % 36000).cast("decimal(18,6)"))).alias("date"),
    )
    laps = spark.range(101 * 4 * 100).select(
        (F.col("id") % 101).cast("int").alias("session_key"),
        (F.col("id") / 101 % 4).cast("int").alias("driver_number"),
        (F.col("id") / 404).cast("int").alias("lap_number"),
    ).withColumn("date_start", t0 + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("lap_number") * 360).cast("decimal(18,6)")))
    laps = laps.withColumn("date_end", F.col("date_start") + F.expr("INTERVAL 359 SECONDS"))
    keys = ["session_key", "driver_number"]
    plain = interval_join(samples, laps, keys, "date", "date_start", "date_end", None)
    bucketed = interval_join(samples, laps, keys, "date", "date_start", "date_end", 600)
    assert plain.count() == bucketed.count()
    plain_share, bucketed_share = _largest_share(plain), _largest_share(bucketed)
    print(f"largest partition share: plain {plain_share:.3f}, bucketed {bucketed_share:.3f}")
    assert plain_share > 0.3  # the hot key sits in one task
    assert bucketed_share < 0.15, (plain_share, bucketed_share)
