"""Raw table schemas (explicit, never inferred).

The union of both DDL variants of the loaders: sessions carry country_name,
year and circuit_short_name; weather carries wind_direction and rainfall.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _schema(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


INT, DBL, STR, TS, BOOL = IntegerType(), DoubleType(), StringType(), TimestampType(), BooleanType()

RAW: dict[str, StructType] = {
    "sessions": _schema(
        ("session_key", INT), ("meeting_key", INT), ("session_name", STR), ("session_type", STR),
        ("date_start", TS), ("date_end", TS), ("location", STR), ("country_name", STR),
        ("year", INT), ("circuit_short_name", STR),
    ),
    "meetings": _schema(
        ("meeting_key", INT), ("circuit_key", INT), ("circuit_short_name", STR), ("meeting_code", STR),
        ("location", STR), ("country_key", INT), ("country_code", STR), ("country_name", STR),
        ("meeting_name", STR), ("meeting_official_name", STR), ("gmt_offset", STR),
        ("date_start", TS), ("year", INT),
    ),
    "drivers": _schema(
        ("driver_number", INT), ("session_key", INT), ("broadcast_name", STR), ("full_name", STR),
        ("name_acronym", STR), ("team_name", STR), ("team_colour", STR), ("first_name", STR),
        ("last_name", STR), ("headshot_url", STR), ("country_code", STR),
    ),
    "laps": _schema(
        ("meeting_key", INT), ("session_key", INT), ("driver_number", INT), ("lap_number", INT),
        ("date_start", TS), ("duration_sector_1", DBL), ("duration_sector_2", DBL),
        ("duration_sector_3", DBL), ("lap_duration", DBL), ("is_pit_out_lap", BOOL),
        ("i1_speed", INT), ("i2_speed", INT), ("st_speed", INT),
    ),
    "car_data": _schema(
        ("driver_number", INT), ("session_key", INT), ("date", TS), ("speed", INT), ("rpm", INT),
        ("throttle", INT), ("brake", INT), ("n_gear", INT), ("drs", INT),
    ),
    "intervals": _schema(
        ("driver_number", INT), ("session_key", INT), ("date", TS), ("gap_to_leader", STR),
        ("interval", STR),
    ),
    "position": _schema(
        ("driver_number", INT), ("session_key", INT), ("date", TS), ("position", INT),
    ),
    "pit": _schema(
        ("driver_number", INT), ("session_key", INT), ("date", TS), ("lap_number", INT),
        ("pit_duration", DBL),
    ),
    "stints": _schema(
        ("driver_number", INT), ("session_key", INT), ("stint_number", INT), ("compound", STR),
        ("lap_start", INT), ("lap_end", INT), ("tyre_age_at_start", INT),
    ),
    "weather": _schema(
        ("session_key", INT), ("date", TS), ("air_temperature", DBL), ("track_temperature", DBL),
        ("humidity", INT), ("wind_speed", DBL), ("wind_direction", INT), ("rainfall", DBL),
    ),
    "location": _schema(
        ("driver_number", INT), ("session_key", INT), ("date", TS), ("x", DBL), ("y", DBL), ("z", DBL),
    ),
    "race_control": _schema(
        ("driver_number", INT), ("session_key", INT), ("date", TS), ("category", STR), ("flag", STR),
        ("message", STR), ("scope", STR),
    ),
    "team_radio": _schema(
        ("driver_number", INT), ("session_key", INT), ("date", TS), ("recording_url", STR),
    ),
}

# Resume ledger of finished (session, driver) pairs: CSV without header.
LEDGER = _schema(("session_key", INT), ("driver_number", INT))


def columns(table: str) -> list[str]:
    return RAW[table].fieldNames()
