"""Intermediate models (per-driver aggregates, lap/stint/weather windows)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from raceline.functions.columns import epoch_seconds_between, exact_sum, strip_lapped
from raceline.operators.interval_join import interval_join, range_aggregate
from raceline.operators.ordered import blocked_row_numbers
from raceline.plans import staging as stg
from raceline.plans.graph import model
from raceline.plans.staging import Raw

PAIR = ["session_key", "driver_number"]

# Bucket widths of the interval joins. They change cost only, never results:
# about one lap (time in lap), the finest block of weather in stint, one
# stint of laps (lap number in stint).
LAP_BUCKET_SECONDS = 900
WEATHER_BLOCK_SECONDS = 60
# Buckets of a lap, about: a lap that is several buckets long gets wider ones
# instead of a row for each.
LAP_BUCKETS = 2
STINT_BUCKET_LAPS = 8
# Width of the distance blocks of the nearest-sample ranks.
RANK_BLOCK_SECONDS = 60

# Stint weather classes. Track temperature below 25 is Cold,
# below 35 Medium, otherwise Hot; any rainfall above 0 is Wet, otherwise a
# mean humidity above 70 is High Humidity, otherwise Dry.
TRACK_COLD_BELOW, TRACK_MEDIUM_BELOW = 25, 35
HUMID_ABOVE = 70


@model
def int_best_laps(raw: Raw) -> DataFrame:
    return stg.stg_laps(raw).groupBy(*PAIR).agg(F.min("lap_duration").alias("fastest_lap"))


@model
def int_car_base(raw: Raw) -> DataFrame:
    """Telemetry enriched with the driver row of its session. The driver
    dimension is small per session; AQE turns the join into a broadcast join
    when its measured size is under the threshold and keeps the shuffle join
    (with skew splitting) otherwise."""
    drivers = stg.stg_drivers(raw).select(*PAIR, "name_acronym", "team_name", "team_colour")
    return stg.stg_car_data(raw).join(drivers, ["driver_number", "session_key"], "left").select(
        "driver_number", "session_key", "name_acronym", "team_name", "team_colour",
        "date", "rpm", "speed", "throttle", "brake",
    )


@model
def int_final_intervals(raw: Raw) -> DataFrame:
    """Largest numeric gaps per driver and session (cast before MAX)."""
    return stg.stg_intervals(raw).groupBy(*PAIR).agg(
        F.max(strip_lapped("gap_to_leader").cast("double")).alias("max_gap_to_leader"),
        F.max(strip_lapped("gap_to_next").cast("double")).alias("max_gap_to_next"),
    )


@model
def int_final_position(raw: Raw) -> DataFrame:
    """Last recorded position per driver and session. NULL dates sort first
    in a descending order (warehouse rule); ties go to the smaller position.
    ``row_number() == 1`` is planned as a partial WindowGroupLimit, so each
    map task forwards one row per key before the shuffle."""
    w = Window.partitionBy(*PAIR).orderBy(F.col("date").desc_nulls_first(), F.col("position").asc_nulls_last())
    return (
        stg.stg_position(raw)
        .withColumn("rn", F.row_number().over(w))
        .filter(F.col("rn") == 1)
        .select(*PAIR, "position", F.col("date").alias("latest_date"))
    )


@model
def lap_position_samples(raw: Raw) -> DataFrame:
    """Position samples inside each lap (inclusive bounds) with the absolute
    distance in seconds to both lap ends."""
    positions = stg.stg_position(raw)
    laps = stg.stg_laps(raw).select(*PAIR, "lap_number", "date_start", "date_end")
    inside = interval_join(positions, laps, PAIR, "date", "date_start", "date_end", LAP_BUCKET_SECONDS, most=LAP_BUCKETS)
    return inside.withColumn("start_time_diff", F.abs(epoch_seconds_between("date", "date_start"))).withColumn(
        "end_time_diff", F.abs(epoch_seconds_between("date", "date_end"))
    )


@model
def int_lap_position(raw: Raw, materialize: bool = False) -> DataFrame:
    """Position samples inside each lap with the nearest-sample ranks to the
    lap start and end (ties: smaller position, then earlier sample).

    A lap's samples are numbered in blocks of RANK_BLOCK_SECONDS of distance,
    each shifted by the samples of the nearer blocks, so no task sorts a whole
    lap. Both ranks read the samples from one exchange; ``materialize`` writes
    them to the checkpoint folder first, which runs a job here and now.
    """
    keys = [*PAIR, "lap_number"]
    tie = [F.col("position").asc_nulls_last(), F.col("date").asc_nulls_last(), F.col("date_start").asc_nulls_last()]
    ranks = {"start_position_rank": "start_time_diff", "end_position_rank": "end_time_diff"}
    blocks = {diff: F.floor(F.col(diff) / RANK_BLOCK_SECONDS) for diff in ranks.values()}
    inside = blocked_row_numbers(
        lap_position_samples(raw), keys, {rank: (blocks[diff], [F.col(diff).asc_nulls_last(), *tie]) for rank, diff in ranks.items()}, materialize
    )
    return inside.select(
        *PAIR, "position", "date", "lap_number", "date_start", "date_end", "start_time_diff", "end_time_diff",
        "start_position_rank", "end_position_rank",
    )


@model
def int_pit_stop(raw: Raw) -> DataFrame:
    return stg.stg_pit(raw).groupBy(*PAIR).agg(F.count(F.lit(1)).alias("pit_stop_count"))


@model
def int_tyre_stint(raw: Raw) -> DataFrame:
    """Race stints with team and circuit. The WHERE on the session side makes
    the session join an inner join (Catalyst rewrites it so)."""
    stints = stg.stg_stints(raw)
    drivers = stg.stg_drivers(raw).select(*PAIR, "team_name")
    sessions = stg.stg_sessions(raw).select("session_key", "circuit_short_name", "country_name", "session_type")
    base = (
        stints.join(drivers, ["driver_number", "session_key"], "left")
        .join(sessions, "session_key", "left")
        .filter(F.col("session_type") == "Race")
    )
    return base.select(
        "driver_number", "session_key", "stint_number", "compound", "lap_start", "lap_end", "tyre_age_at_start",
        "team_name", "circuit_short_name", "country_name", "session_type",
        (F.col("lap_end") - F.col("lap_start") + 1).alias("stint_length"),
    )


@model
def int_tyre_stint_laps(raw: Raw) -> DataFrame:
    """Stint time window: first and last lap start inside the lap range.
    Stints without a timed lap are dropped (so the left join is an inner
    join followed by the NULL filter)."""
    stints = stg.stg_stints(raw).select(*PAIR, "stint_number", "compound", "lap_start", "lap_end")
    laps = stg.stg_laps(raw).select(*PAIR, "lap_number", F.col("date_start").alias("lap_date_start"))
    matched = interval_join(laps, stints, PAIR, "lap_number", "lap_start", "lap_end", STINT_BUCKET_LAPS)
    keys = [*PAIR, "stint_number", "compound", "lap_start", "lap_end"]
    return (
        matched.groupBy(*keys)
        .agg(F.min("lap_date_start").alias("stint_start_time"), F.max("lap_date_start").alias("stint_end_time"))
        .filter(F.col("stint_end_time").isNotNull() & F.col("stint_start_time").isNotNull())
        .select(*keys, (F.col("lap_end") - F.col("lap_start") + 1).alias("stint_length"), "stint_start_time", "stint_end_time")
    )


@model
def int_tyre_stints_weather(raw: Raw) -> DataFrame:
    """Mean weather inside each stint window; no sample -> NULL means, which
    classify as 'Hot' and 'Dry'.

    A window takes whole time blocks as one row each, two of each size at
    most, so the joined rows grow with windows and samples and not with their
    product. The means divide exact sums."""
    stints = int_tyre_stint_laps(raw)
    measures = {"air_temperature": "avg_air_temp", "track_temperature": "avg_track_temp", "humidity": "avg_humidity", "wind_speed": "avg_wind_speed"}
    weather = stg.stg_weather(raw).select("session_key", "date", "rainfall", *measures)
    partials = {f"sum_{c}": (exact_sum(c), F.sum) for c in measures}
    partials |= {f"n_{c}": (F.count(c), F.sum) for c in measures}
    partials["had_rainfall"] = (F.max("rainfall"), F.max)
    totals = range_aggregate(
        stints, weather, ["session_key"], "date", "stint_start_time", "stint_end_time", WEATHER_BLOCK_SECONDS, partials
    )
    means = [(F.col(f"sum_{c}").cast("double") / F.when(F.col(f"n_{c}") > 0, F.col(f"n_{c}"))).alias(out) for c, out in measures.items()]
    conditions = totals.select(*stints.columns, *means, "had_rainfall")
    track = F.col("avg_track_temp")
    return conditions.select(
        *PAIR, "stint_number", "compound", "lap_start", "lap_end", "stint_length",
        "avg_air_temp", "avg_track_temp", "avg_humidity", "had_rainfall", "avg_wind_speed",
        F.when(track < TRACK_COLD_BELOW, "Cold").when(track < TRACK_MEDIUM_BELOW, "Medium").otherwise("Hot").alias("track_temp_category"),
        F.when(F.col("had_rainfall") > 0, "Wet")
        .when(F.col("avg_humidity") > HUMID_ABOVE, "High Humidity")
        .otherwise("Dry")
        .alias("weather_condition"),
    )


MODELS = {
    "int_best_laps": int_best_laps,
    "int_car_base": int_car_base,
    "int_final_intervals": int_final_intervals,
    "int_final_position": int_final_position,
    "int_lap_position": int_lap_position,
    "int_pit_stop": int_pit_stop,
    "int_tyre_stint": int_tyre_stint,
    "int_tyre_stint_laps": int_tyre_stint_laps,
    "int_tyre_stints_weather": int_tyre_stints_weather,
}
