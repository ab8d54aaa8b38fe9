"""One check per value-changing semantic rule of the models (tiny frames)."""

from __future__ import annotations

import datetime as dt

from raceline.plans import intermediate as it
from raceline.plans import marts, staging
from tests.conftest import raw_of, ts

SESSION = {"session_key": 1, "meeting_key": 10, "session_name": "Race", "session_type": "Race",
           "date_start": ts("2024-03-01 10:00:00"), "date_end": ts("2024-03-01 12:00:00"),
           "country_name": "Bahrain", "year": 2024, "circuit_short_name": "Sakhir", "location": "Sakhir"}
MEETING = {"meeting_key": 10, "meeting_name": "Bahrain GP", "meeting_official_name": "FORMULA 1 BAHRAIN GP",
           "country_name": "Bahrain", "circuit_short_name": "Sakhir", "date_start": ts("2024-03-01 00:00:00"),
           "year": 2024}
DRIVER = {"driver_number": 1, "session_key": 1, "broadcast_name": "M VERSTAPPEN", "full_name": "Max VERSTAPPEN",
          "name_acronym": "VER", "team_name": "Red Bull Racing", "team_colour": "3671C6"}


def lap(n, start, duration, **extra):
    return {"session_key": 1, "driver_number": 1, "lap_number": n, "date_start": ts(start), "lap_duration": duration,
            **extra}


def pos(date, position, driver=1):
    return {"session_key": 1, "driver_number": driver, "date": ts(date) if date else None, "position": position}


def test_t1_lap_end_from_uncut_start(spark):
    raw = raw_of(spark, laps=[lap(1, "2024-03-01 10:00:00.900", 1.5)])
    row = staging.stg_laps(raw).collect()[0]
    assert row.date_start == ts("2024-03-01 10:00:00")
    assert row.date_end == ts("2024-03-01 10:00:02.400")


def test_t2_text_min_max_and_numeric_max(spark):
    raw = raw_of(
        spark,
        laps=[lap(2, "2024-03-01 10:00:00", 100.0)],
        intervals=[
            {"session_key": 1, "driver_number": 1, "date": ts("2024-03-01 10:00:10"), "gap_to_leader": "9.1", "interval": "9.1"},
            {"session_key": 1, "driver_number": 1, "date": ts("2024-03-01 10:00:20"), "gap_to_leader": "10.5", "interval": "10.5"},
        ],
    )
    row = marts.final_historical_analysis(raw).collect()[0]
    assert (row.min_gap_to_leader, row.max_gap_to_leader) == ("10.5", "9.1")
    assert (row.min_gap_to_next, row.max_gap_to_next) == (10.5, 9.1)
    assert it.int_final_intervals(raw).collect()[0].max_gap_to_leader == 10.5


def test_t3_running_max_fill_and_t32_lap_one(spark):
    laps = [lap(n, f"2024-03-01 10:0{n}:00", 50.0) for n in (1, 2, 3, 4)]
    positions = [pos("2024-03-01 09:59:00", 7), pos("2024-03-01 10:01:00", 2),  # lap 1 own sample ignored
                 pos("2024-03-01 10:02:00", 5), pos("2024-03-01 10:03:00", 3)]
    rows = {r.lap_number: r for r in marts.final_historical_analysis(raw_of(spark, laps=laps, position=positions)).collect()}
    assert rows[1].lap_start_position == rows[1].lap_end_position == 7  # T32: first recorded position
    assert rows[2].lap_start_position == 5 and rows[3].lap_start_position == 3
    assert rows[4].lap_start_position == 5  # T3: running MAX of 5, 3, NULL -> 5, not 3
    assert {r.race_start_position for r in rows.values()} == {7}


def test_t4_null_date_wins_final_but_not_first(spark):
    raw = raw_of(spark, position=[pos(None, 9), pos("2024-03-01 10:00:00", 4), pos("2024-03-01 11:00:00", 2)],
                 laps=[lap(2, "2024-03-01 10:30:00", 60.0)])
    final = it.int_final_position(raw).collect()[0]
    assert final.position == 9 and final.latest_date is None
    assert marts.final_historical_analysis(raw).collect()[0].race_start_position == 4


def test_t5_tie_on_date_goes_to_smaller_position(spark):
    raw = raw_of(spark, position=[pos("2024-03-01 10:00:00", 6), pos("2024-03-01 10:00:00", 3)])
    assert it.int_final_position(raw).collect()[0].position == 3


def _stint_raw(spark, weather):
    laps = [lap(n, f"2024-03-01 10:0{n}:00", 50.0) for n in (1, 2, 3)]
    stints = [{"session_key": 1, "driver_number": 1, "stint_number": 1, "compound": "SOFT", "lap_start": 1,
               "lap_end": 3, "tyre_age_at_start": 0}]
    return raw_of(spark, laps=laps, stints=stints, weather=weather, sessions=[SESSION], drivers=[DRIVER])


def test_t6_no_weather_is_hot_and_dry(spark):
    row = it.int_tyre_stints_weather(_stint_raw(spark, [])).collect()[0]
    assert row.avg_track_temp is None and row.had_rainfall is None
    assert (row.track_temp_category, row.weather_condition) == ("Hot", "Dry")


def test_t9_last_lap_weather_excluded(spark):
    weather = [{"session_key": 1, "date": ts("2024-03-01 10:02:00"), "track_temperature": 20.0, "humidity": 80, "rainfall": 0.0},
               {"session_key": 1, "date": ts("2024-03-01 10:03:30"), "track_temperature": 50.0, "humidity": 10, "rainfall": 1.0}]
    row = it.int_tyre_stints_weather(_stint_raw(spark, weather)).collect()[0]
    assert row.avg_track_temp == 20.0 and row.had_rainfall == 0.0
    assert (row.track_temp_category, row.weather_condition) == ("Cold", "High Humidity")


def test_t7_concat_variants(spark):
    session = {**SESSION, "country_name": None}
    driver = {**DRIVER, "name_acronym": None}
    raw = raw_of(spark, sessions=[session], drivers=[driver], meetings=[MEETING])
    assert marts.final_session_mapping(raw).collect()[0].session_display_name is None
    label = marts.final_session_driver_mapping(raw).collect()[0].driver_display_name
    assert label == " - Max VERSTAPPEN (Red Bull Racing)"
    raw2 = raw_of(spark, sessions=[SESSION], drivers=[driver], meetings=[MEETING])
    row = marts.final_session_filters(raw2).collect()[0]
    assert row.session_display_name == "2024 - Bahrain - Race"
    assert row.available_driver_names == [" - Max VERSTAPPEN (Red Bull Racing)"]


def test_t8_two_meetings_one_country_fan_out(spark):
    second = {**MEETING, "meeting_key": 11, "meeting_name": "Sakhir GP"}
    raw = raw_of(spark, sessions=[SESSION], drivers=[DRIVER], meetings=[MEETING, second])
    assert sorted(r.meeting_name for r in marts.final_session_filters(raw).collect()) == ["Bahrain GP", "Sakhir GP"]


def test_t10_mean_of_driver_means(spark):
    car = [{"session_key": 1, "driver_number": 1, "date": ts("2024-03-01 10:00:00"), "speed": 100}] + [
        {"session_key": 1, "driver_number": 2, "date": ts(f"2024-03-01 10:00:0{i}"), "speed": 200} for i in range(3)]
    raw = raw_of(spark, sessions=[SESSION], car_data=car, position=[pos("2024-03-01 10:00:00", 1)],
                 laps=[lap(1, "2024-03-01 10:00:00", 90.0)])
    row = marts.final_race_summary(raw).collect()[0]
    assert row.average_speed == 150.0 and row.fastest_speed == 200


def test_t12_points_everywhere_null_pits(spark):
    quali = {**SESSION, "session_type": "Qualifying", "session_name": "Qualifying"}
    d2 = {**DRIVER, "driver_number": 2, "broadcast_name": "L NORRIS"}
    raw = raw_of(spark, sessions=[quali], drivers=[DRIVER, d2],
                 position=[pos("2024-03-01 10:00:00", 1), pos("2024-03-01 10:00:00", None, driver=2)],
                 intervals=[{"session_key": 1, "driver_number": 1, "date": ts("2024-03-01 10:00:00"), "gap_to_leader": "3.5"}])
    rows = {r.driver_number: r for r in marts.final_race_leaderboard(raw).collect()}
    assert (rows[1].points, rows[1].gap_to_leader, rows[1].pit_stop_count) == (25, 0.0, None)
    assert rows[2].points == 0


def test_t13_stint_without_session_dropped(spark):
    stints = [{"session_key": 1, "driver_number": 1, "stint_number": 1, "compound": "HARD", "lap_start": 1, "lap_end": 5},
              {"session_key": 2, "driver_number": 1, "stint_number": 1, "compound": "HARD", "lap_start": 1, "lap_end": 5}]
    rows = it.int_tyre_stint(raw_of(spark, sessions=[SESSION], drivers=[DRIVER], stints=stints)).collect()
    assert [(r.session_key, r.stint_length) for r in rows] == [(1, 5)]


def test_t14_gap_text_cleaning(spark):
    base = {"session_key": 1, "driver_number": 1, "date": ts("2024-03-01 10:00:00")}
    raw = raw_of(spark, intervals=[{**base, "gap_to_leader": g} for g in ("None", "+1 LAP", "1 lap")])
    values = [r.gap_to_leader for r in staging.stg_intervals(raw).collect()]
    assert sorted(values, key=str) == ["1 lap", None, None]


def test_t25_rounded_int_is_double(spark):
    car = [{"session_key": 1, "driver_number": 1, "date": ts("2024-03-01 10:00:00"), "speed": 301, "throttle": 99, "brake": 0}]
    row = marts.final_car(raw_of(spark, car_data=car, drivers=[DRIVER], sessions=[SESSION], meetings=[MEETING])).collect()[0]
    assert isinstance(row.speed, float) and row.speed == 301.0
    assert row.driver == "VER (Red Bull Racing)" and row.meeting_key == 10


def test_t31_shared_bound_counts_in_both_laps(spark):
    laps = [lap(1, "2024-03-01 10:00:00", 60.0), lap(2, "2024-03-01 10:01:00", 60.0)]
    raw = raw_of(spark, laps=laps, position=[pos("2024-03-01 10:01:00", 4)])
    assert sorted(r.lap_number for r in it.int_lap_position(raw).collect()) == [1, 2]


def test_tyre_performance_two_levels(spark):
    stints = [{"session_key": 1, "driver_number": 1, "stint_number": i, "compound": "SOFT", "lap_start": 1,
               "lap_end": n, "tyre_age_at_start": a} for i, (n, a) in enumerate([(10, 0), (20, 3)], start=1)]
    d2 = {**DRIVER, "driver_number": 2}
    stints.append({"session_key": 1, "driver_number": 2, "stint_number": 1, "compound": "SOFT", "lap_start": 1,
                   "lap_end": 31, "tyre_age_at_start": 1})
    row = marts.final_tyre_performance(raw_of(spark, sessions=[SESSION], drivers=[DRIVER, d2], stints=stints)).collect()[0]
    # driver means 15 and 31 -> 23.0; ages 1.5 and 1 -> 1.25
    assert (row.circuit_compound_avg_stint_length, row.circuit_compound_max_stint_length) == (23.0, 31)
    assert (row.avg_tire_age_start, row.total_stints) == (1.25, 3)


def test_every_model_is_one_lazy_plan(spark):
    raw = raw_of(spark)
    for fn in list(staging.MODELS.values()) + list(it.MODELS.values()) + list(marts.MODELS.values()):
        assert fn(raw).count() == 0
    assert dt.timezone.utc


def test_block_results_equal_plain_windows(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from raceline.sources.fixtures import raw_tables

    raw = raw_tables(spark, "/root/testdata/sf0.001")
    ranked = it.int_lap_position(raw)
    for diff, rank in (("start_time_diff", "start_position_rank"), ("end_time_diff", "end_position_rank")):
        order = Window.partitionBy("session_key", "driver_number", "lap_number").orderBy(diff, "position", "date", "date_start")
        assert ranked.withColumn("plain", F.row_number().over(order)).where(F.col("plain") != F.col(rank)).count() == 0


def test_lap_without_number_keeps_its_gaps(spark):
    laps = [
        dict(session_key=1, driver_number=1, lap_number=n, date_start=ts(f"2024-01-01 0{h}:00:00"), lap_duration=3000.0)
        for n, h in ((1, 1), (None, 2))
    ]
    gaps = [dict(session_key=1, driver_number=1, date=ts("2024-01-01 02:10:00"), gap_to_leader="5.5", interval="1.25")]
    rows = {r["lap_number"]: r for r in marts.final_historical_analysis(raw_of(spark, laps=laps, intervals=gaps)).collect()}
    assert rows[None]["max_gap_to_leader"] == "5.5" and rows[1]["max_gap_to_leader"] is None


def test_gaps_compare_as_text_or_as_numbers(spark):
    laps = [dict(session_key=1, driver_number=1, lap_number=1, date_start=ts("2024-01-01 01:00:00"), lap_duration=3000.0)]
    gaps = [dict(session_key=1, driver_number=1, date=ts("2024-01-01 01:10:00"), gap_to_leader=g) for g in ("9.5", "10.25")]
    raw = raw_of(spark, laps=laps, intervals=gaps)
    assert marts.final_historical_analysis(raw).first()["max_gap_to_leader"] == "9.5"
    assert marts.final_historical_analysis(raw, numeric_gaps=True).first()["max_gap_to_leader"] == 10.25


def test_weather_of_a_stint_equals_all_samples(spark):
    """Whole blocks of every level plus the ends: the same mean as one by one."""
    import datetime as dt_

    start = dt_.datetime(2024, 1, 1, 0, 0, 30)
    samples = [(1, start + dt_.timedelta(seconds=37 * i), float(i % 91)) for i in range(20_000)]
    spans = [(1, start + dt_.timedelta(seconds=a), start + dt_.timedelta(seconds=b)) for a, b in ((0, 0), (5, 30), (100, 5_000), (3, 700_000), (-50, 10), (90_000, 80_000))]
    from pyspark.sql import functions as F

    from raceline.functions.columns import exact_sum
    from raceline.operators.interval_join import range_aggregate

    points = spark.createDataFrame(samples, "k int, date timestamp, v double")
    ranges = spark.createDataFrame(spans, "k int, lo timestamp, hi timestamp")
    got = range_aggregate(ranges, points, ["k"], "date", "lo", "hi", 60, {"s": (exact_sum("v"), F.sum), "n": (F.count("v"), F.sum), "m": (F.max("v"), F.max)})
    rows = {(r["lo"], r["hi"]): r for r in got.collect()}
    assert len(rows) == len(spans)
    for _, lo, hi in spans:
        inside = [v for _, d, v in samples if lo <= d <= hi]
        r = rows[lo, hi]
        assert (r["n"] or 0) == len(inside) and r["m"] == (max(inside) if inside else None)
        assert float(r["s"] or 0) == sum(inside)


def test_models_as_named_views_and_tables(spark, tmp_path):
    from raceline.plans.views import materialize, register_views
    from raceline.sources.fixtures import raw_tables

    raw = raw_tables(spark, "/root/testdata/sf0.001")
    names = register_views(spark, raw, ["stg_laps", "final_race_leaderboard", "example_union"])
    assert "raw_laps" in names and "final_race_leaderboard" in names
    top = spark.sql("SELECT session_key, count(*) AS n FROM final_race_leaderboard WHERE points = 25 GROUP BY 1")
    assert top.filter("n >= 1").count() == top.count() > 0
    materialize(spark.table("example_union"), str(tmp_path / "first"))
    assert spark.read.parquet(str(tmp_path / "first")).count() == spark.table("example_union").count()
