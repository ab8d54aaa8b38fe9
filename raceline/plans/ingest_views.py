"""Registered runs of the ingestion operators (G*) and loaders (D*) over the
landing derived from the benchmark tables.

Setting of every run: the landing holds the payload rows of *all* sessions;
an earlier run has already loaded the sessions that ended before
``fixtures.LOADED_CUTOFF`` (that is the target, or the ledger); the resumable
location load additionally has a ledger up to ``LEDGER_CUTOFF`` and a
deny-list of the already loaded sessions. Scratch data (landing JSON, ledger
CSV, appended tables) goes under the session's checkpoint folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from raceline import schemas
from raceline.operators import conform, dedup, incremental, pairs, sessions as sel
from raceline.plans import loaders
from raceline.session import checkpoint_dir
from raceline.sources import fixtures, landing, ledger

LEDGER_CUTOFF = "2024-01-16 00:00:00"


def _scratch(spark: SparkSession, what: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/raceline-{what}-{uuid.uuid4().hex}"


class Setting:
    """Landing, raw tables, targets and ledgers of one benchmark directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.raw = fixtures.raw_tables(spark, sf_dir)

    def landing(self, name: str) -> DataFrame:
        return fixtures.landing(self.spark, self.sf_dir, name)

    @property
    def sessions(self) -> DataFrame:
        return self.raw["sessions"]

    def loaded_sessions(self, cutoff: str = fixtures.LOADED_CUTOFF) -> DataFrame:
        return self.sessions.filter(F.col("date_end") <= F.lit(cutoff).cast("timestamp")).select("session_key")

    def target(self, name: str) -> DataFrame:
        return self.raw[name].join(self.loaded_sessions(), "session_key", "left_semi")

    def ledger(self, done_pairs: DataFrame) -> DataFrame:
        """Write the done pairs as a header-less CSV ledger and read it back."""
        path = _scratch(self.spark, "ledger")
        ledger.append_ledger(done_pairs, path)
        return ledger.read_ledger(self.spark, path)

    def car_ledger(self) -> DataFrame:
        chosen = sel.sessions_one_type(self.sessions, sel.RACE_TYPES).join(self.loaded_sessions(), "session_key", "left_semi")
        return self.ledger(pairs.session_driver_pairs(chosen, self.raw["drivers"], self.raw["car_data"]))

    def location_ledger(self, cutoff: str = fixtures.LOADED_CUTOFF) -> DataFrame:
        done = pairs.session_driver_roster(
            sel.sessions_by_type(self.sessions, check_key=False).join(self.loaded_sessions(cutoff), "session_key", "left_semi"),
            self.raw["drivers"],
        )
        return self.ledger(done)


#: Landed lines that can't be read: a truncated object, and a text where a number belongs.
UNREADABLE = ('{"session_key": 1, "driver_number": 1, "da', '{"session_key": "x", "driver_number": 1}')


def _objects(rows: DataFrame, lacks: tuple[str, F.Column] | None = None) -> F.Column:
    """Rows as JSON objects, nulls written out; ``lacks``: a field, and the
    rows whose objects don't have it."""
    options = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}

    def text(columns: list[str]) -> F.Column:
        return F.to_json(F.struct(*columns), options)

    if lacks is None:
        return text(rows.columns)
    field, where = lacks
    return F.when(F.coalesce(where, F.lit(False)), text([c for c in rows.columns if c != field])).otherwise(text(rows.columns))


def _land(s: Setting, payloads: DataFrame, table: str) -> DataFrame:
    """Payload texts written to the landing, one a line, and read back."""
    path = _scratch(s.spark, "landing")
    payloads.write.text(path)
    return landing.read_landing(s.spark, path, schemas.RAW[table])


def _extra(s: Setting, *texts: str) -> DataFrame:
    return s.spark.range(1).select(F.explode(F.array(*map(F.lit, texts))).alias("value"))


def pit_landing(s: Setting) -> DataFrame:
    """Pit payloads as arrays (one per session and car; single objects for
    every third car), plus empty arrays, one ``{"detail": ...}`` envelope per
    session the endpoint has no data for, an empty object and two lines that
    can't be read."""
    rows = s.landing("pit")
    objects = rows.select(*ledger.PAIR, _objects(rows).alias("o"))
    single = F.coalesce(F.col("driver_number") % 3 == 0, F.lit(False))
    arrays = objects.where(~single).groupBy(*ledger.PAIR).agg(F.concat(F.lit("["), F.array_join(F.collect_list("o"), ", "), F.lit("]")).alias("value"))
    envelopes = s.sessions.filter(~F.col("session_type").isin(*sel.RACE_TYPES)).select(
        F.to_json(F.struct(F.concat(F.lit("No results found for session "), F.col("session_key").cast("string")).alias("detail"))).alias("value")
    )
    payloads = arrays.select("value").unionByName(objects.where(single).select(F.col("o").alias("value"))).unionByName(envelopes)
    return _land(s, payloads.unionByName(_extra(s, "[]", " [ ] ", "{}", *UNREADABLE)), "pit")


def read_landing_view(s: Setting) -> DataFrame:
    """The landed pit rows, and a row of nulls for each envelope, empty
    object and unreadable line, which the reader keeps and marks."""
    rows = pit_landing(s)
    return rows.select(*schemas.columns("pit"), landing.DETAIL, F.col(landing.CORRUPT).isNotNull().alias("unreadable"))


def drop_error_envelopes_view(s: Setting) -> DataFrame:
    return landing.drop_error_envelopes(pit_landing(s)).drop(landing.FIELDS)


def landed_again(s: Setting, table: str, **changed: F.Column) -> DataFrame:
    """The landing of a table with every tenth session's (weather, sessions)
    or car's rows once more, with another value outside the dedup key."""
    rows = s.landing(table)
    tenth = F.col("session_key" if table in ("weather", "sessions") else "driver_number") % 10 == 0
    return rows.unionByName(rows.where(tenth).withColumns(changed))


def _later() -> F.Column:
    return F.expr("date + INTERVAL 1 HOUR")


#: Payloads of these cars lack a column in the registered landings.
LACKS_FLAG, LACKS_Z = 5, 6


def conform_require_view(s: Setting) -> DataFrame:
    rows = s.landing("race_control")
    lines = rows.select(_objects(rows, ("flag", F.col("driver_number") % LACKS_FLAG == 0)).alias("value"))
    return conform.conform_require(_land(s, lines, "race_control"), schemas.RAW["race_control"], schemas.columns("race_control"), ledger.PAIR)


def location_landing(s: Setting) -> DataFrame:
    rows = s.landing("location")
    lines = rows.select(_objects(rows, ("z", F.col("driver_number") % LACKS_Z == 0)).alias("value"))
    return _land(s, lines.unionByName(_extra(s, *UNREADABLE)), "location")


def hour_chunks_view(s: Setting) -> DataFrame:
    chosen = sel.sessions_one_type(s.sessions, sel.RACE_TYPES).select("session_key", "date_start", "date_end")
    return pairs.hour_chunks(chosen)


def chunk_filter_view(s: Setting) -> DataFrame:
    chosen = sel.sessions_one_type(s.sessions, sel.RACE_TYPES)
    work = pairs.session_driver_pairs(chosen, s.raw["drivers"], s.raw["car_data"])
    return pairs.chunk_filter(s.raw["car_data"], chosen, work)


def ledger_skip_view(s: Setting) -> DataFrame:
    work = pairs.session_driver_pairs(sel.sessions_one_type(s.sessions, sel.RACE_TYPES), s.raw["drivers"], s.raw["car_data"])
    return ledger.ledger_skip(work, s.car_ledger())


def append_table_view(s: Setting) -> DataFrame:
    path = _scratch(s.spark, "table")
    incremental.append_table(s.target("pit"), path)
    incremental.append_table(incremental.anti_by_session(s.raw["pit"], s.target("pit")), path)
    return incremental.read_table(s.spark, path, schemas.RAW["pit"])


def load_metrics_view(s: Setting) -> DataFrame:
    return loaders.location_metrics(location_landing(s), s.location_ledger(), s.sessions, s.raw["drivers"])


def parse_iso_ts_view(s: Setting) -> DataFrame:
    rc = s.raw["race_control"]
    iso = F.date_format("date", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return rc.select("session_key", "driver_number", landing.parse_iso_ts(iso).alias("date"))


VIEWS = {
    # ingestion building blocks
    "read_landing": read_landing_view,
    "drop_error_envelopes": drop_error_envelopes_view,
    "conform_fill": lambda s: conform.conform_fill(s.landing("meetings"), schemas.RAW["meetings"]),
    "conform_keep": lambda s: conform.conform_keep(s.landing("meetings"), schemas.RAW["meetings"], "meeting_key"),
    "conform_require": conform_require_view,
    "sessions_by_type": lambda s: sel.sessions_by_type(s.sessions),
    "sessions_one_type": lambda s: sel.sessions_one_type(s.sessions, ("Race",)),
    "sessions_by_name": lambda s: sel.sessions_by_name(s.sessions),
    "session_limit": lambda s: sel.session_limit(sel.sessions_by_name(s.sessions), 5),
    "skip_sessions": lambda s: sel.skip_sessions(sel.sessions_by_type(s.sessions, check_key=False), s.loaded_sessions()),
    "dedup_keep_first": lambda s: dedup.dedup_keep_first(s.raw["pit"], loaders.DEDUP_KEYS["pit"]),
    "anti_by_key": lambda s: incremental.anti_by_key(s.raw["drivers"], s.target("drivers"), ["driver_number", "session_key"]),
    "anti_by_session": lambda s: incremental.anti_by_session(s.raw["laps"], s.target("laps")),
    "anti_by_pair": lambda s: incremental.anti_by_pair(s.raw["location"], s.target("location")),
    "anti_by_triple": lambda s: incremental.anti_by_triple(
        s.raw["team_radio"], s.target("team_radio"), loaders.DEDUP_KEYS["team_radio"]
    ),
    "session_driver_pairs": lambda s: pairs.session_driver_pairs(
        sel.sessions_one_type(s.sessions, sel.RACE_TYPES), s.raw["drivers"], s.raw["car_data"]
    ),
    "session_driver_roster": lambda s: pairs.session_driver_roster(
        sel.sessions_by_type(s.sessions, check_key=False), s.raw["drivers"]
    ),
    "hour_chunks": hour_chunks_view,
    "chunk_filter": chunk_filter_view,
    "ledger_skip": ledger_skip_view,
    "nan_to_null": lambda s: conform.nan_to_null_all(s.landing("weather")),
    "stringify": lambda s: s.landing("intervals").select(
        "driver_number", "session_key", "date",
        landing.stringify("gap_to_leader").alias("gap_to_leader"), landing.stringify("interval").alias("interval"),
    ),
    "append_table": append_table_view,
    "load_metrics": load_metrics_view,
    "parse_iso_ts": parse_iso_ts_view,
    # dataset loaders
    "load_drivers": lambda s: loaders.load_drivers(s.landing("drivers"), s.target("drivers")),
    "load_laps": lambda s: loaders.load_laps(s.landing("laps"), s.target("laps"), s.sessions),
    "load_car_data": lambda s: loaders.load_car_data(s.landing("car_data"), s.car_ledger(), s.sessions, s.raw["drivers"]),
    "load_intervals": lambda s: loaders.load_intervals(s.landing("intervals"), s.target("intervals"), s.sessions),
    "load_location": lambda s: loaders.load_location(
        location_landing(s), s.target("location"), s.sessions, s.raw["drivers"]
    ),
    "load_location_resume": lambda s: loaders.load_location_resume(
        location_landing(s), s.location_ledger(LEDGER_CUTOFF), s.sessions, s.raw["drivers"], s.loaded_sessions()
    ),
    "load_meetings": lambda s: loaders.load_meetings(
        s.landing("meetings"),
        s.raw["meetings"].filter(F.col("date_start") < F.lit(fixtures.LOADED_CUTOFF).cast("timestamp")),
    ),
    "load_pit": lambda s: loaders.load_pit(landed_again(s, "pit"), s.target("pit"), s.sessions),
    "load_position": lambda s: loaders.load_position(s.landing("position"), s.target("position"), s.sessions),
    "load_race_control": lambda s: loaders.load_race_control(landed_again(s, "race_control", date=_later()), s.target("race_control"), s.sessions),
    "load_sessions": lambda s: loaders.load_sessions(landed_again(s, "sessions", year=F.expr("year + 1")), s.target("sessions")),
    "load_stints": lambda s: loaders.load_stints(landed_again(s, "stints", lap_end=F.expr("lap_end + 1")), s.target("stints"), s.sessions),
    "load_team_radio": lambda s: loaders.load_team_radio(landed_again(s, "team_radio", date=_later()), s.target("team_radio"), s.sessions),
    "load_weather": lambda s: loaders.load_weather(landed_again(s, "weather", humidity=F.expr("humidity + 1")), s.target("weather"), s.sessions),
}


def view_query(name: str):
    fn = VIEWS[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Setting(spark, sf_dir))

    run.__name__ = name
    return run
