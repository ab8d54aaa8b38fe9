"""Ranges of any length: bounded rows, dyadic covers, exact results."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from raceline.operators import interval_join as ij
from raceline.plans import intermediate, marts
from tests.conftest import raw_of, ts


def test_a_lap_of_years_has_few_rows(spark):
    start = ts("2024-03-01 10:00:00")
    ranges = spark.createDataFrame([(1, start, start + dt.timedelta(seconds=90)), (1, start, start + dt.timedelta(seconds=1_000_000_000))], "k int, lo timestamp, hi timestamp")
    rows = ij.bucketed_ranges(ranges, "lo", "hi", 900).groupBy("hi").count().collect()
    assert all(r["count"] <= ij.MOST_BUCKETS + 1 for r in rows)
    points = spark.createDataFrame([(1, start + dt.timedelta(seconds=s)) for s in (0, 60, 5_000_000, 999_999_999, 1_000_000_001)], "k int, t timestamp")
    got = ij.interval_join(points, ranges, ["k"], "t", "lo", "hi", 900)
    assert got.count() == 2 + 4


def test_models_with_a_lap_of_years(spark):
    laps = [dict(session_key=1, driver_number=1, lap_number=n, date_start=ts(f"2024-01-01 01:{n:02}:00"), lap_duration=d) for n, d in ((1, 60.0), (2, 1e9), (3, 60.0))]
    where = [dict(session_key=1, driver_number=1, position=p, date=ts(f"2024-01-01 01:{m:02}:30")) for p, m in ((3, 1), (2, 2), (1, 3))]
    raw = raw_of(spark, laps=laps, position=where)
    got = sorted((r.lap_number, r.position) for r in intermediate.int_lap_position(raw).collect())
    assert got == [(1, 3), (2, 1), (2, 2), (3, 1)]
    assert marts.final_historical_analysis(raw).count() == 3


def test_dyadic_cover_is_exact_and_short(spark):
    random.seed(3)
    spans = [(a, a + n) for a, n in [(random.randrange(1, 1 << 40), random.randrange(0, 1 << random.randrange(1, 40))) for _ in range(300)]]
    spans += [(1, 1), (1, 2), (5, 4), (8, 16), (7, 17)]
    df = spark.createDataFrame(spans, "a long, b long").withColumn("c", ij.dyadic_cover(F.col("a"), F.col("b")))
    for r in df.collect():
        parts = sorted(((x.block << x.level, (x.block + 1) << x.level) for x in r.c))
        assert len(parts) <= 2 * 40
        if r.b <= r.a:
            assert parts == []
        else:
            assert parts[0][0] == r.a and parts[-1][1] == r.b
            assert all(x[1] == y[0] for x, y in zip(parts, parts[1:]))
