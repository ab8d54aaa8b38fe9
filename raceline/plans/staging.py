"""Staging models: one thin projection / filter per raw table.

Every model is ``f(raw) -> DataFrame`` over a mapping of raw DataFrames; the
composition of models is one lazy plan, so unused columns never leave the
parquet scan and filters reach it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raceline.functions.columns import add_seconds, clean_gap
from raceline.plans.graph import model

Raw = Mapping[str, DataFrame]


@model
def stg_car_data(raw: Raw) -> DataFrame:
    return raw["car_data"].select("session_key", "driver_number", "date", "rpm", "speed", "throttle", "brake")


@model
def stg_drivers(raw: Raw) -> DataFrame:
    return raw["drivers"].select(
        F.col("driver_number").cast("int").alias("driver_number"),
        "broadcast_name", "first_name", "last_name", "full_name", "name_acronym",
        "team_name", "team_colour", "country_code", "session_key",
    )


@model
def stg_intervals(raw: Raw) -> DataFrame:
    return raw["intervals"].select(
        "session_key", "driver_number", "date",
        clean_gap("gap_to_leader").alias("gap_to_leader"),
        clean_gap("interval").alias("gap_to_next"),
    )


@model
def stg_laps(raw: Raw) -> DataFrame:
    """date_start is cut to the second; date_end adds the lap duration to the
    *uncut* start (both computed from the raw column in one projection)."""
    laps = raw["laps"]
    return laps.filter(F.col("lap_duration").isNotNull()).select(
        "session_key", "driver_number",
        F.date_trunc("second", "date_start").alias("date_start"),
        add_seconds("date_start", "lap_duration").alias("date_end"),
        "lap_duration", "lap_number", "is_pit_out_lap",
        "duration_sector_1", "duration_sector_2", "duration_sector_3",
    )


@model
def stg_meeting(raw: Raw) -> DataFrame:
    return raw["meetings"].select(
        "meeting_key", "meeting_name", "meeting_official_name", "country_name",
        "circuit_short_name", "date_start", "year",
    )


@model
def stg_pit(raw: Raw) -> DataFrame:
    return raw["pit"].filter(F.col("pit_duration").isNotNull())


@model
def stg_position(raw: Raw) -> DataFrame:
    return raw["position"].select("session_key", "driver_number", "position", "date")


@model
def stg_sessions(raw: Raw) -> DataFrame:
    """No session-type filter: every session reaches the marts."""
    return raw["sessions"].select(
        "session_key", "meeting_key", "country_name", "session_name", "session_type",
        "year", "circuit_short_name", "date_start", "date_end",
    )


@model
def stg_stints(raw: Raw) -> DataFrame:
    return raw["stints"].filter(
        F.col("compound").isNotNull() & F.col("lap_start").isNotNull() & F.col("lap_end").isNotNull()
    )


@model
def stg_weather(raw: Raw) -> DataFrame:
    return raw["weather"].select("*")


MODELS = {
    "stg_car_data": stg_car_data,
    "stg_drivers": stg_drivers,
    "stg_intervals": stg_intervals,
    "stg_laps": stg_laps,
    "stg_meeting": stg_meeting,
    "stg_pit": stg_pit,
    "stg_position": stg_position,
    "stg_sessions": stg_sessions,
    "stg_stints": stg_stints,
    "stg_weather": stg_weather,
}
