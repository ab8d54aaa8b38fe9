"""Rows that cross the network, counted by the exchanges of a run."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from raceline.functions.columns import exact_sum
from raceline.operators import interval_join as ij
from raceline.operators.incremental import anti_by_session
from raceline.operators.ordered import blocked_running_max
from raceline.plans import marts
from tests.conftest import raw_of, ts

PLAIN = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}


def with_conf(spark, conf, run):
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        return run()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shuffled_rows(df) -> tuple[list, int]:
    """The rows of ``df`` and how many all its exchanges wrote (a reused one counts once)."""
    rows = df.collect()

    def written(plan) -> int:
        own = plan.metrics().get("shuffleRecordsWritten") if plan.nodeName() == "Exchange" else None
        n = own.get().value() if own is not None and own.isDefined() else 0
        return n + sum(written(plan.children().apply(i)) for i in range(plan.children().size()))

    return rows, written(df._jdf.queryExecution().executedPlan())


def test_lap_history_sends_each_lap_a_few_times(spark):
    start = ts("2024-01-01 00:00:00")
    laps = [
        dict(session_key=1, driver_number=car, lap_number=n, date_start=start + dt.timedelta(hours=n), lap_duration=3590.0 + n / 4)
        for car in range(40) for n in range(24)
    ]
    gaps = [dict(session_key=1, driver_number=3, date=start + dt.timedelta(hours=5, minutes=m), gap_to_leader="2.5", interval="1.0") for m in range(3)]
    where = [dict(session_key=1, driver_number=3, date=start + dt.timedelta(hours=7, minutes=m), position=4 + m) for m in range(3)]
    raw = raw_of(spark, laps=laps, intervals=gaps, position=where)
    rows, written = with_conf(spark, PLAIN, lambda: shuffled_rows(marts.final_historical_analysis(raw)))
    assert len(rows) == len(laps)
    assert written <= 7 * len(laps), written / len(laps)


def test_lap_history_against_every_sample(spark):
    random.seed(5)
    start = ts("2024-01-01 00:00:00")
    laps = [
        dict(session_key=s, driver_number=car, lap_number=n, date_start=start + dt.timedelta(seconds=200 * (n or 60)), lap_duration=float(random.choice([90, 200, 1900, 7000])))
        for s, car in ((1, 1), (1, 2), (None, 1)) for n in [*range(1, 50), None]
    ]
    laps += laps[:7] + [dict(lap, lap_number=5, date_start=start + dt.timedelta(seconds=777)) for lap in laps[:1]]
    where = [
        dict(session_key=s, driver_number=car, date=start + dt.timedelta(seconds=random.randrange(1, 12_000)), position=random.choice([None, *range(1, 21)]))
        for s, car in ((1, 1), (1, 2), (None, 1)) for _ in range(12)
    ]
    gaps = [dict(w, gap_to_leader=str(random.randrange(9)), interval=str(random.randrange(9))) for w in where]
    got = marts.final_historical_analysis(raw_of(spark, laps=laps, position=where, intervals=gaps)).collect()

    late = (1, 99)
    nulls_last = lambda x: late if x is None else (0, x)
    want = set()
    ends = {}
    for lap in laps:
        a, z = lap["date_start"], lap["date_start"] + dt.timedelta(seconds=lap["lap_duration"])
        key = (lap["session_key"], lap["driver_number"], lap["lap_number"])
        inside = [w for w in where if key[0] is not None and (w["session_key"], w["driver_number"]) == key[:2] and a <= w["date"] <= z]
        for side, at in enumerate((a, z)):
            ends.setdefault((*key, side), []).extend((abs((w["date"] - at).total_seconds()), nulls_last(w["position"]), w["date"], w["position"]) for w in inside)
    own = {k: min(v)[3] if v and k[2] is not None else None for k, v in ends.items()}
    for lap in laps:
        s, car, n = lap["session_key"], lap["driver_number"], lap["lap_number"]
        a, z = lap["date_start"], lap["date_start"] + dt.timedelta(seconds=lap["lap_duration"])
        mine = [w for w in where if s is not None and (w["session_key"], w["driver_number"]) == (s, car)]
        first = min(mine, key=lambda w: (w["date"], nulls_last(w["position"])))["position"] if mine else None
        met = [float(g["interval"]) for g in gaps if s is not None and (g["session_key"], g["driver_number"]) == (s, car) and a <= g["date"] <= z]
        filled = []
        for side in (0, 1):
            before = [p for (s2, c2, n2, x), p in own.items() if (s2, c2, x) == (s, car, side) and p is not None and (n is None or n2 is not None and n2 <= n)]
            mine_here = own[s, car, n, side]
            filled.append(first if n == 1 else next((p for p in (mine_here, max(before, default=None), first) if p is not None), None))
        want.add((s, car, n, a, z, min(met, default=None), max(met, default=None), *filled, first))
    names = ("session_key", "driver_number", "lap_number", "lap_start_time", "lap_end_time", "min_gap_to_next", "max_gap_to_next", "lap_start_position", "lap_end_position", "race_start_position")
    assert sorted((tuple(r[c] for c in names) for r in got), key=str) == sorted(want, key=str)


def test_long_ranges_take_few_buckets(spark):
    hours = spark.sql("SELECT id, timestamp_seconds(id * 3600) AS lo, timestamp_seconds(id * 3600 + 3599) AS hi FROM range(100)")
    assert ij.bucketed_ranges(hours, "lo", "hi", 900, most=2).count() <= 3 * 100


def test_running_max_takes_block_maxima_from_a_summary(spark):
    rows = [(k, n, n // 4, (7 * n + (k or 0)) % 23 if n % 5 == 2 else None) for k in (1, 2, None) for n in range(40)]
    df = spark.createDataFrame(rows, "k int, n int, b int, v int")
    wide = df.withColumn("other", F.lit("x"))
    first = spark.createDataFrame([(1, -9, 21)], "k int, b int, v int")
    got = blocked_running_max(wide, ["k"], "b", [F.col("n")], {"m": "v"}, summary=df.drop("n").unionByName(first)).collect()
    assert len(got) == len(rows) and set(got[0].asDict()) == {"k", "n", "b", "v", "other", "m"}
    for r in got:
        seen = [v for k, n, _, v in rows if k == r["k"] and n <= r["n"] and v is not None] + [21] * (r["k"] == 1)
        assert r["m"] == max(seen, default=None) and r["other"] == "x"


def test_skip_of_loaded_sessions_shuffles_no_rows(spark):
    rows = spark.range(9000).select((F.col("id") % 3).cast("int").alias("session_key"), F.col("id").alias("other"))
    rows = rows.unionByName(spark.createDataFrame([(None, 1)], "session_key int, other long"))
    target = rows.where("session_key = 1 OR session_key IS NULL")
    kept, written = with_conf(spark, PLAIN, lambda: shuffled_rows(anti_by_session(rows, target)))
    assert len(kept) == 6001 and {r["session_key"] for r in kept} == {0, 2, None}
    assert written < 1000, written
    assert anti_by_session(rows, None) is rows


def joined_rows(df) -> tuple[list, int]:
    """The rows of ``df`` and the most that a join of its plan made."""
    rows = df.collect()

    def most(plan) -> int:
        made = plan.metrics().get("numOutputRows") if "Join" in plan.nodeName() else None
        own = made.get().value() if made is not None and made.isDefined() else 0
        return max([own, *(most(plan.children().apply(i)) for i in range(plan.children().size()))])

    return rows, most(df._jdf.queryExecution().executedPlan())


def test_range_ends_meet_no_instants_one_by_one(spark):
    """Ends in a block of many instants: rows as many as ends, exact results."""
    random.seed(7)
    t0 = dt.datetime(1970, 1, 1) - dt.timedelta(seconds=40)  # before and after the epoch
    points = [(random.choice([1, 2, None]), t0 + dt.timedelta(microseconds=random.randrange(0, 200_000_000)), random.choice([None, *map(float, range(90))])) for _ in range(3000)]
    points += points[:20] + [(1, None, 5.0)]
    spans = []
    for i in range(400):
        a = random.choice([p[1] for p in points[:2000]])
        z = a + dt.timedelta(microseconds=random.choice([0, 0, 1, random.randrange(1 << random.randrange(1, 27)), random.randrange(200_000_000), -5]))
        spans.append((i, random.choice([1, 2, 3, None]), a, z))
    spans += [(400 + i, 1, *spans[0][2:]) for i in range(50)] + [(500, 1, None, t0), (501, 1, t0, None)]
    ranges = spark.createDataFrame(spans, "i int, k int, lo timestamp, hi timestamp")
    samples = spark.createDataFrame(points, "k int, date timestamp, v double")
    partials = {"s": (exact_sum("v"), F.sum), "n": (F.count("v"), F.sum), "m": (F.max("v"), F.max)}
    df = ij.range_aggregate(ranges, samples, ["k"], "date", "lo", "hi", 60, partials)
    rows, most = with_conf(spark, PLAIN, lambda: joined_rows(df))
    assert df.columns == ["i", "k", "lo", "hi", "s", "n", "m"] and len(rows) == len(spans)
    for r in rows:
        inside = [v for k, d, v in points if k is not None and k == r["k"] and d and r["lo"] and r["hi"] and r["lo"] <= d <= r["hi"]]
        held = [v for v in inside if v is not None]
        assert ((r["n"] or 0), r["m"], float(r["s"] or 0)) == (len(held), max(held, default=None), sum(held)), r
    assert most <= 8 * len(spans), most
