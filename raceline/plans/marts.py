"""Marts: leaderboard, race summary, lap history, tyres, session lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from raceline.functions.columns import concat_ignore_nulls, round_half_up
from raceline.operators.interval_join import interval_left_aggregate
from raceline.operators.ordered import blocked_running_max
from raceline.plans import intermediate as it
from raceline.plans import staging as stg
from raceline.plans.graph import model
from raceline.plans.staging import Raw

PAIR = it.PAIR

# Race points for finishing positions 1 to 10; every other
# position (and NULL) scores 0.
POINTS_BY_POSITION = [25, 18, 15, 12, 10, 8, 6, 4, 2, 1]

# Laps per block of the running position fill.
LAP_BLOCK = 16
# A block number below that of any lap.
BEFORE_ALL_BLOCKS = -(1 << 62)

# Label formats. Driver in telemetry "ACR (Team)", driver in
# lists "ACR - Full Name (Team)", session "YEAR - Country - Session name".
LABEL_SEP, TEAM_OPEN, TEAM_CLOSE = " - ", " (", ")"


def _points(position: str) -> F.Column:
    table = F.array(*[F.lit(p) for p in POINTS_BY_POSITION])
    pos = F.col(position)
    return F.when(pos.between(1, len(POINTS_BY_POSITION)), F.element_at(table, pos)).otherwise(F.lit(0))


def _driver_display_name() -> F.Column:
    return concat_ignore_nulls(
        "name_acronym", F.lit(LABEL_SEP), "full_name", F.lit(TEAM_OPEN), "team_name", F.lit(TEAM_CLOSE)
    )


@model
def final_car(raw: Raw) -> DataFrame:
    """Telemetry with a driver label and the meeting of its session."""
    sessions = stg.stg_sessions(raw).select("session_key", F.col("meeting_key").alias("s_meeting_key"))
    meetings = stg.stg_meeting(raw).select(F.col("meeting_key").alias("s_meeting_key"), "meeting_key")
    car = it.int_car_base(raw).join(sessions, "session_key", "left").join(meetings, "s_meeting_key", "left")
    return car.select(
        "date",
        concat_ignore_nulls("name_acronym", F.lit(TEAM_OPEN), "team_name", F.lit(TEAM_CLOSE)).alias("driver"),
        "driver_number",
        F.round(F.col("speed").cast("double")).alias("speed"),
        F.round(F.col("throttle").cast("double")).alias("throttle"),
        F.round(F.col("brake").cast("double")).alias("brake"),
        "rpm", "session_key", "meeting_key",
    )


@model
def final_session_mapping(raw: Raw) -> DataFrame:
    """``year || ' - ' || country || ' - ' || name`` (NULL if any part is)."""
    s = stg.stg_sessions(raw)
    label = F.concat(
        F.year("date_start").cast("string"), F.lit(LABEL_SEP), F.col("country_name"), F.lit(LABEL_SEP),
        F.col("session_name"),
    )
    return s.select(label.alias("session_display_name"), "session_key").distinct()


@model
def final_race_leaderboard(raw: Raw) -> DataFrame:
    """Final classification per session with gaps, best lap, pit stops and
    points (points are awarded in every session type)."""
    final = it.int_final_position(raw).select(*PAIR, "position")
    drivers = stg.stg_drivers(raw).select(
        *PAIR, F.col("broadcast_name").alias("driver_name"), "team_name", F.col("team_colour").alias("team_color")
    )
    mapping = final_session_mapping(raw).select("session_key")
    board = (
        final.join(drivers, PAIR, "inner")
        .join(it.int_final_intervals(raw), PAIR, "left")
        .join(it.int_best_laps(raw), PAIR, "left")
        .join(it.int_pit_stop(raw), PAIR, "left")
        .join(mapping, "session_key", "inner")
    )
    return board.select(
        "session_key", "driver_number", "driver_name", "position", "team_name", "team_color",
        F.when(F.col("position") == 1, F.lit(0.0)).otherwise(F.col("max_gap_to_leader")).alias("gap_to_leader"),
        F.col("max_gap_to_next").alias("gap_to_next"),
        "fastest_lap", "pit_stop_count",
        _points("position").alias("points"),
    ).orderBy(F.col("position").asc_nulls_last())


@model
def final_race_summary(raw: Raw) -> DataFrame:
    """Per session: drivers, laps, teams, pit stops, top speed and the mean of
    the per-driver mean speeds (unweighted)."""
    positions = stg.stg_position(raw).groupBy("session_key").agg(F.countDistinct("driver_number").alias("total_drivers"))
    laps = stg.stg_laps(raw).groupBy("session_key").agg(F.max("lap_number").alias("total_laps"))
    team_stats = final_race_leaderboard(raw).groupBy("session_key").agg(
        F.sum("pit_stop_count").alias("total_pit_stops"), F.countDistinct("team_name").alias("total_teams")
    )
    driver_stats = stg.stg_car_data(raw).groupBy(*PAIR).agg(
        F.max("speed").alias("top_speed"), F.avg("speed").alias("avg_speed")
    )
    mapping = final_session_mapping(raw)
    keys = ["session_key", "session_display_name", "total_drivers", "total_laps"]
    cte = (
        positions.join(laps, "session_key", "inner")
        .join(mapping, "session_key", "inner")
        .join(driver_stats, "session_key", "left")
        .groupBy(*keys)
        .agg(F.max("top_speed").alias("fastest_speed"), F.avg("avg_speed").alias("average_speed"))
    )
    return cte.join(team_stats, "session_key", "left").select(
        "session_key", "session_display_name", "total_drivers", "total_teams", "total_laps",
        "total_pit_stops", "fastest_speed", round_half_up("average_speed", 3).alias("average_speed"),
    )


@model
def final_session_driver_mapping(raw: Raw) -> DataFrame:
    sessions = stg.stg_sessions(raw).select("session_key")
    return (
        stg.stg_drivers(raw)
        .join(sessions, "session_key", "left_semi")
        .select("session_key", _driver_display_name().alias("driver_display_name"), "driver_number")
        .distinct()
    )


@model
def final_session_filters(raw: Raw) -> DataFrame:
    """Per session: display name, sorted distinct driver labels and the
    meeting matched on (year, country_name) (a country with two meetings in a
    year gives two rows)."""
    sessions = stg.stg_sessions(raw)
    # DISTINCT (session, driver label) first: the later per-session collect
    # then merges at most one entry per driver label.
    labels = (
        stg.stg_drivers(raw)
        .join(sessions.select("session_key"), "session_key", "inner")
        .select("session_key", _driver_display_name().alias("driver_display_name"))
        .distinct()
    )
    per_session = labels.groupBy("session_key").agg(
        F.array_sort(F.collect_set("driver_display_name")).alias("available_driver_names")
    )
    meetings = stg.stg_meeting(raw).select(
        F.col("year").alias("m_year"), F.col("country_name").alias("m_country"), "meeting_name", "meeting_official_name"
    )
    keys = [
        "session_key", "year", "country_name", "circuit_short_name", "session_name", "session_type",
        "session_display_name", "meeting_name", "meeting_official_name", "date_start",
    ]
    joined = (
        sessions.join(meetings, (F.col("year") == F.col("m_year")) & (F.col("country_name") == F.col("m_country")), "inner")
        .withColumn(
            "session_display_name",
            concat_ignore_nulls("year", F.lit(LABEL_SEP), "country_name", F.lit(LABEL_SEP), "session_name"),
        )
        .select(*keys)
    )
    # Identical rows (duplicate sessions or meetings) collapse; their driver
    # list is that of the session key, which is among the columns.
    return joined.distinct().join(per_session, "session_key", "inner").select(
        "session_key", "year", "country_name", "circuit_short_name", "session_name", "session_type",
        "session_display_name", "available_driver_names", "meeting_name", "meeting_official_name", "date_start",
    )


@model
def final_tyre_performance(raw: Raw) -> DataFrame:
    """Two-level aggregate: per driver on circuit/compound/team, then per
    circuit/compound (averages of averages, unweighted)."""
    per_driver = it.int_tyre_stint(raw).groupBy("circuit_short_name", "compound", "team_name", "driver_number").agg(
        F.avg("stint_length").alias("avg_stint_length"),
        F.max("stint_length").alias("max_stint_length"),
        F.avg("tyre_age_at_start").alias("avg_starting_age"),
        F.count(F.lit(1)).alias("number_of_stints"),
    )
    return per_driver.groupBy("circuit_short_name", "compound").agg(
        round_half_up(F.avg("avg_stint_length"), 2).alias("circuit_compound_avg_stint_length"),
        F.max("max_stint_length").alias("circuit_compound_max_stint_length"),
        round_half_up(F.avg("avg_starting_age"), 2).alias("avg_tire_age_start"),
        F.sum("number_of_stints").alias("total_stints"),
    )


@model
def final_historical_analysis(raw: Raw, numeric_gaps: bool = False) -> DataFrame:
    """One row per lap: first recorded position, gap range during the lap and
    start/end positions (lap 1 = first recorded position; otherwise the lap's
    own nearest sample, else the running MAX so far, else the first
    position).

    Plan: the gap samples are aggregated per lap right after the bucketed
    interval join (min/max do not care how often a lap row repeats), and the
    start/end samples are picked in one grouped pass; both joins read the lap
    ranges from one exchange. Whole lap rows are
    shuffled twice: to their gaps, and by blocks of laps for the running fill
    (so no task sorts all laps of a car), where the positions of the laps and
    the first positions are rows of the same blocks. The leader gaps are texts
    and compare as texts (warehouse rule); ``numeric_gaps`` compares and
    returns them as numbers.
    """
    laps = stg.stg_laps(raw).select(
        *PAIR, "lap_number", "date_start", "date_end", "is_pit_out_lap",
        "duration_sector_1", "duration_sector_2", "duration_sector_3",
    )
    first_w = Window.partitionBy(*PAIR).orderBy(F.col("date").asc_nulls_last(), F.col("position").asc_nulls_last())
    first = (
        stg.stg_position(raw)
        .withColumn("rn", F.row_number().over(first_w))
        .filter(F.col("rn") == 1)
        .select(*PAIR, F.col("position").alias("first_position"))
    )
    lap_key = [*PAIR, "date_start", "date_end"]
    # Duplicate lap rows fall into the same group and min/max are idempotent,
    # so the lap ranges need no DISTINCT (and no shuffle for it). They are
    # those of lap_position_samples, and grouped by lap number, too, so that
    # both joins read them from one exchange. A lap's gaps do not depend on
    # its number, so NULL may share one with a number.
    number = F.coalesce("lap_number", F.lit(0)).alias("__number")
    gaps = interval_left_aggregate(
        laps.select(*PAIR, "lap_number", "date_start", "date_end"),
        stg.stg_intervals(raw).select(
            *PAIR, F.date_trunc("second", "date").alias("gap_date"),
            F.col("gap_to_leader").try_cast("double").alias("gap_to_leader") if numeric_gaps else "gap_to_leader", "gap_to_next"
        ),
        PAIR, "gap_date", "date_start", "date_end", it.LAP_BUCKET_SECONDS,
        group_by=[*lap_key, number],
        aggs=[
            F.min("gap_to_leader").alias("min_gap_to_leader"),
            F.max("gap_to_leader").alias("max_gap_to_leader"),
            round_half_up(F.min("gap_to_next"), 3).alias("min_gap_to_next"),
            round_half_up(F.max("gap_to_next"), 3).alias("max_gap_to_next"),
        ],
        matched_only=True,
        most=it.LAP_BUCKETS,
    )
    # Nearest sample to each lap end: the rank-1 rows of int_lap_position,
    # picked with min_by over the same ordering (NULL positions last), so
    # the samples are reduced per task before the shuffle instead of being
    # sorted twice per lap.
    inside = it.lap_position_samples(raw)

    def nearest(diff: str) -> F.Column:
        order = F.struct(F.col(diff), F.col("position").isNull(), "position", "date", "date_start")
        return F.min_by("position", order)

    ends = inside.groupBy(*PAIR, "lap_number").agg(
        nearest("start_time_diff").alias("start_position"), nearest("end_time_diff").alias("end_position")
    )
    metrics = laps.select("*", number).join(gaps, [*lap_key, "__number"], "left").dropDuplicates().drop("__number")
    # Start/end positions depend on (session, driver, lap_number) only. They
    # are rows beside the laps in blocks of LAP_BLOCK laps: a lap takes its
    # own from the rows of its number, and the running MAX from those before
    # it. The first position of a car is the value of a block before all laps.
    block = F.floor(F.col("lap_number") / LAP_BLOCK).alias("__lap_block")
    found = ends.where(F.col("lap_number").isNotNull()).select("*", block)
    summary = (
        laps.select(*PAIR, block)
        .unionByName(found.drop("lap_number"), allowMissingColumns=True)
        .unionByName(
            first.dropna(subset=PAIR).select(*PAIR, F.lit(BEFORE_ALL_BLOCKS).alias("__lap_block"), "first_position"),
            allowMissingColumns=True,
        )
    )
    rows = metrics.select("*", block, F.lit(True).alias("__lap"), F.lit(None).cast("int").alias("first_position"))
    rows = blocked_running_max(
        rows.unionByName(found, allowMissingColumns=True),
        PAIR, "__lap_block", [F.col("lap_number").asc_nulls_last()],
        {"__run_start": "start_position", "__run_end": "end_position", "__first": "first_position"},
        summary=summary,
    )
    same_lap = Window.partitionBy(*PAIR, "__lap_block", "lap_number")
    own = {c: F.max(c).over(same_lap) for c in ("start_position", "end_position")}
    metrics = rows.withColumns({**own, "first_position": F.col("__first")}).where("__lap")

    def filled(col: str, running: str) -> F.Column:
        return F.when(F.col("lap_number") == 1, F.col("first_position")).otherwise(
            F.coalesce(F.col(col), F.col(running), F.col("first_position"))
        )

    return metrics.select(
        "lap_number", "session_key", "driver_number",
        F.col("date_start").alias("lap_start_time"), F.col("date_end").alias("lap_end_time"),
        "is_pit_out_lap", "duration_sector_1", "duration_sector_2", "duration_sector_3",
        "min_gap_to_leader", "max_gap_to_leader", "min_gap_to_next", "max_gap_to_next",
        filled("start_position", "__run_start").alias("lap_start_position"),
        filled("end_position", "__run_end").alias("lap_end_position"),
        F.col("first_position").alias("race_start_position"),
    )


MODELS = {
    "final_car": final_car,
    "final_historical_analysis": final_historical_analysis,
    "final_race_leaderboard": final_race_leaderboard,
    "final_race_summary": final_race_summary,
    "final_session_driver_mapping": final_session_driver_mapping,
    "final_session_filters": final_session_filters,
    "final_session_mapping": final_session_mapping,
    "final_tyre_performance": final_tyre_performance,
}
