"""Raw timing tables derived from the benchmark parquet tables.

The benchmark data holds no motorsport tables, so every raw table is a
deterministic projection of whole driver tables (position, intervals and
weather take the event types among them, so together they hold most events),
and grows with the scale factor; sessions and meetings are 25 and 5 rows:

* sessions   <- nation x region       (one session per nation, one day each; one of 2.5 hours, one of none)
* meetings   <- region                (one meeting per region; six columns absent in the landing shape)
* drivers    <- customer              (customer k drives car k div 25 + 1 in session k mod 25)
* laps       <- customer x 24 laps    (one-hour laps, some without duration)
* stints     <- customer x 3 stints
* car_data   <- lineitem              (order k div 10 is the customer/driver; some rows are of the
                                      last car, which is entered in few sessions)
* pit        <- orders                (o_custkey is the driver)
* position   <- events view/click     (user_id*10 + event_id mod 10 is the driver,
* intervals  <- events error/purchase  the event time is moved to the session day)
* weather    <- events signup
* location   <- events
* race_control <- events
* team_radio <- pages

Each mapping is one SQL text that runs unchanged in Spark SQL and in DuckDB
(the test oracle): ``{table}`` marks a driver table and ``@GEN(a, b)`` an
integer range generator (``explode(sequence)`` in Spark, ``unnest(
generate_series)`` in DuckDB).
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from raceline import schemas
from raceline.operators.conform import conform_fill, nan_to_null_all
from raceline.session import prepare
from raceline.sources.parquet import read_table

# Sessions ending on or before this instant count as loaded by an earlier run
# of the incremental loaders (the first ten session days).
LOADED_CUTOFF = "2024-01-11 00:00:00"

_DAY0 = "TIMESTAMP '2024-01-01 00:00:00'"
_EVENT_KEY = "(SELECT *, user_id * 10 + event_id % 10 AS k FROM {events}) e"
_EVENT_DRIVER = "CAST(floor(k / 25) + 1 AS INT)"
_EVENT_SESSION = "CAST(k % 25 AS INT)"
_EVENT_DATE = "ts + (CAST(k % 25 AS INT) + 1 - day(ts)) * INTERVAL '1' DAY"

LANDING_SQL: dict[str, str] = {
    "sessions": f"""
SELECT CAST(n_nationkey AS INT) AS session_key, CAST(100 + n_regionkey AS INT) AS meeting_key,
  CASE WHEN n_nationkey % 3 = 0 THEN 'Race' WHEN n_nationkey % 3 = 1 THEN 'Qualifying'
       WHEN n_nationkey % 6 = 5 THEN 'Sprint' ELSE 'Practice 1' END AS session_name,
  CASE WHEN n_nationkey % 3 = 0 THEN 'Race' WHEN n_nationkey % 3 = 1 THEN 'Qualifying'
       WHEN n_nationkey % 6 = 5 THEN 'Race' ELSE 'Practice' END AS session_type,
  {_DAY0} + n_nationkey * INTERVAL '1' DAY AS date_start,
  CASE n_nationkey WHEN 13 THEN {_DAY0} + 13 * INTERVAL '1' DAY + 150 * INTERVAL '1' MINUTE
       WHEN 16 THEN {_DAY0} + 16 * INTERVAL '1' DAY
       ELSE {_DAY0} + (n_nationkey + 1) * INTERVAL '1' DAY END AS date_end,
  n_name AS location, r_name AS country_name, CAST(2024 AS INT) AS year,
  concat('C', CAST(n_nationkey % 8 AS STRING)) AS circuit_short_name
FROM {{nation}} JOIN {{region}} ON n_regionkey = r_regionkey""",
    "meetings": f"""
SELECT CAST(100 + r_regionkey AS INT) AS meeting_key, concat(r_name, ' GP') AS meeting_name,
  concat('OFFICIAL ', r_name, ' GP 2024') AS meeting_official_name, r_name AS country_name,
  concat('C', CAST(r_regionkey AS STRING)) AS circuit_short_name,
  {_DAY0} + r_regionkey * INTERVAL '5' DAY AS date_start, CAST(2024 AS INT) AS year
FROM {{region}}""",
    "drivers": """
SELECT CAST(floor(c_custkey / 25) + 1 AS INT) AS driver_number, CAST(c_custkey % 25 AS INT) AS session_key,
  c_name AS broadcast_name, c_name AS full_name,
  CASE WHEN c_custkey % 7 = 3 THEN NULL ELSE concat('D', CAST(c_custkey AS STRING)) END AS name_acronym,
  c_mktsegment AS team_name, substr(c_mktsegment, 1, 6) AS team_colour, c_mktsegment AS first_name,
  c_name AS last_name, CAST(NULL AS STRING) AS headshot_url, 'XXX' AS country_code
FROM {customer}""",
    "laps": f"""
SELECT CAST(100 + n_regionkey AS INT) AS meeting_key, session_key, driver_number, CAST(lap AS INT) AS lap_number,
  {_DAY0} + session_key * INTERVAL '1' DAY + (lap - 1) * INTERVAL '1' HOUR + INTERVAL '0.25' SECOND AS date_start,
  CAST(1200 + (c_custkey % 40) * 0.5 AS DOUBLE) AS duration_sector_1,
  CAST(1195.25 + lap * 0.25 AS DOUBLE) AS duration_sector_2,
  CASE WHEN lap = 24 THEN CAST(NULL AS DOUBLE) ELSE CAST(1190 AS DOUBLE) END AS duration_sector_3,
  CASE WHEN (c_custkey + 1 + lap) % 13 = 0 THEN CAST(NULL AS DOUBLE)
       ELSE CAST(3590 + ((c_custkey * 7 + lap * 3) % 40) * 0.25 AS DOUBLE) END AS lap_duration,
  lap IN (9, 17) AS is_pit_out_lap, CAST(280 + c_custkey % 7 AS INT) AS i1_speed,
  CAST(290 AS INT) AS i2_speed, CAST(300 + lap % 5 AS INT) AS st_speed
FROM (SELECT c_custkey, CAST(floor(c_custkey / 25) + 1 AS INT) AS driver_number,
             CAST(c_custkey % 25 AS INT) AS session_key, @GEN(1, 24) AS lap FROM {{customer}}) g
JOIN {{nation}} ON n_nationkey = session_key""",
    "stints": """
SELECT driver_number, session_key, CAST(st AS INT) AS stint_number,
  CASE WHEN (c_custkey + st) % 11 = 0 THEN NULL WHEN (c_custkey + st) % 3 = 0 THEN 'SOFT'
       WHEN (c_custkey + st) % 3 = 1 THEN 'MEDIUM' ELSE 'HARD' END AS compound,
  CAST(8 * (st - 1) + 1 AS INT) AS lap_start, CAST(8 * st - c_custkey % 2 AS INT) AS lap_end,
  CAST(c_custkey * st % 5 AS INT) AS tyre_age_at_start
FROM (SELECT c_custkey, CAST(floor(c_custkey / 25) + 1 AS INT) AS driver_number,
             CAST(c_custkey % 25 AS INT) AS session_key, @GEN(1, 3) AS st FROM {customer}) g""",
    "car_data": f"""
SELECT CASE WHEN l_linenumber = 3 AND l_returnflag = 'R'
            THEN (SELECT CAST(floor(max(c_custkey) / 25) + 1 AS INT) FROM {{customer}})
            ELSE CAST(floor(k / 25) + 1 AS INT) END AS driver_number, CAST(k % 25 AS INT) AS session_key,
  {_DAY0} + CAST(k % 25 AS INT) * INTERVAL '1' DAY
    + ((l_linenumber - 1) * 10800 + (l_partkey * 37 + l_suppkey) % 10800) * INTERVAL '1' SECOND
    + (l_orderkey % 1000) * INTERVAL '0.001' SECOND AS date,
  CAST(l_quantity * 6 AS INT) AS speed, CAST(l_partkey % 12000 AS INT) AS rpm,
  CAST(l_linenumber * 14 AS INT) AS throttle, CASE WHEN l_returnflag = 'R' THEN 100 ELSE 0 END AS brake,
  CAST(l_linenumber AS INT) AS n_gear, CAST(l_suppkey % 14 AS INT) AS drs
FROM (SELECT *, CAST(floor(l_orderkey / 10) AS BIGINT) AS k FROM {{lineitem}}) li""",
    "pit": f"""
SELECT CAST(floor(o_custkey / 25) + 1 AS INT) AS driver_number, CAST(o_custkey % 25 AS INT) AS session_key,
  {_DAY0} + CAST(o_custkey % 25 AS INT) * INTERVAL '1' DAY + (o_orderkey % 86400) * INTERVAL '1' SECOND AS date,
  CAST(o_orderkey % 24 + 1 AS INT) AS lap_number,
  CASE WHEN o_orderstatus = 'P' THEN CAST(NULL AS DOUBLE) ELSE o_totalprice / 10000 END AS pit_duration
FROM {{orders}}""",
    "position": f"""
SELECT {_EVENT_DRIVER} AS driver_number, {_EVENT_SESSION} AS session_key, {_EVENT_DATE} AS date,
  CAST(floor(value) AS INT) % 20 + 1 AS `position`
FROM {_EVENT_KEY} WHERE event_type IN ('view', 'click')""",
    "intervals": f"""
SELECT {_EVENT_DRIVER} AS driver_number, {_EVENT_SESSION} AS session_key, {_EVENT_DATE} AS date,
  CASE WHEN event_id % 11 = 0 THEN 'None' WHEN event_id % 13 = 0 THEN '+1 LAP' WHEN event_id % 17 = 0 THEN NULL
       ELSE CAST(CAST(value / 10 AS DECIMAL(12, 3)) AS STRING) END AS gap_to_leader,
  CASE WHEN event_id % 19 = 0 THEN 'None' WHEN event_id % 23 = 0 THEN '+2 LAPS' WHEN event_id % 7 = 0 THEN NULL
       ELSE CAST(CAST(value / 100 AS DECIMAL(12, 4)) AS STRING) END AS `interval`
FROM {_EVENT_KEY} WHERE event_type IN ('error', 'purchase')""",
    "weather": f"""
SELECT {_EVENT_SESSION} AS session_key, {_EVENT_DATE} AS date, value / 5 AS air_temperature,
  CASE WHEN event_id % 41 = 0 THEN CAST('NaN' AS DOUBLE) ELSE value / 2 END AS track_temperature, CAST(floor(value) AS INT) % 101 AS humidity, value / 100 AS wind_speed,
  CAST(event_id % 360 AS INT) AS wind_direction,
  CASE WHEN event_id % 50 = 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS rainfall
FROM {_EVENT_KEY} WHERE event_type = 'signup'""",
    "location": f"""
SELECT {_EVENT_DRIVER} AS driver_number, {_EVENT_SESSION} AS session_key, {_EVENT_DATE} AS date,
  floor(value / 50) * 1.0E0 AS x, CAST(event_id % 4 AS DOUBLE) AS y,
  CASE WHEN user_id % 7 = 0 THEN CAST(NULL AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS z
FROM {_EVENT_KEY}""",
    "race_control": f"""
SELECT CASE WHEN event_id % 3 = 0 THEN NULL ELSE {_EVENT_DRIVER} END AS driver_number,
  {_EVENT_SESSION} AS session_key, {_EVENT_DATE} AS date, event_type AS category,
  CASE WHEN event_id % 2 = 0 THEN 'YELLOW' END AS flag, props AS message, 'Track' AS scope
FROM {_EVENT_KEY}""",
    "team_radio": f"""
SELECT CASE WHEN page_id % 9 = 0 THEN NULL ELSE CAST(floor(page_id / 25) + 1 AS INT) END AS driver_number,
  CAST(page_id % 25 AS INT) AS session_key,
  {_DAY0} + CAST(page_id % 25 AS INT) * INTERVAL '1' DAY + (page_id % 86400) * INTERVAL '1' SECOND AS date,
  url AS recording_url
FROM {{pages}}""",
}

_GEN = re.compile(r"@GEN\((\d+), (\d+)\)")
_TABLE = re.compile(r"\{(\w+)\}")


def driver_tables(name: str) -> list[str]:
    """Benchmark tables read by the mapping of raw table ``name``."""
    return sorted(set(_TABLE.findall(LANDING_SQL[name])))


def spark_text(name: str) -> str:
    return _GEN.sub(r"explode(sequence(\1, \2))", LANDING_SQL[name])


def duckdb_text(name: str) -> str:
    text = _GEN.sub(r"unnest(generate_series(\1, \2))", LANDING_SQL[name])
    return _TABLE.sub(r"\1", text).replace("`", '"')


def _as_instant(df: DataFrame) -> DataFrame:
    """Parquet timestamps without zone read as TIMESTAMP_NTZ; the raw tables
    hold zoned instants (UTC session time)."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast(TimestampType()).alias(f.name)
            if isinstance(f.dataType, TimestampNTZType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def landing(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as the REST payloads deliver it (meetings lack six columns)."""
    prepare(spark)
    frames = {t: read_table(spark, sf_dir, t) for t in driver_tables(name)}
    return _as_instant(spark.sql(spark_text(name), **frames))


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The raw warehouse table: landing shape conformed to the fixed DDL, NaN as NULL."""
    return nan_to_null_all(conform_fill(landing(spark, sf_dir, name), schemas.RAW[name]))


class RawTables(Mapping[str, DataFrame]):
    """Lazy mapping name -> raw DataFrame over one benchmark directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in schemas.RAW:
            raise KeyError(name)
        if name not in self._cache:
            self._cache[name] = raw(self.spark, self.sf_dir, name)
        return self._cache[name]

    def __iter__(self) -> Iterator[str]:
        return iter(schemas.RAW)

    def __len__(self) -> int:
        return len(schemas.RAW)


def raw_tables(spark: SparkSession, sf_dir: str) -> RawTables:
    return RawTables(spark, sf_dir)


def loaded_before_cutoff(sessions: DataFrame) -> DataFrame:
    """Session keys an earlier incremental run has already loaded."""
    return sessions.filter(F.col("date_end") <= F.lit(LOADED_CUTOFF).cast("timestamp")).select("session_key")
