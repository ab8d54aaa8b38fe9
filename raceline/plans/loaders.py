"""Dataset loaders: landed payload rows -> the new rows to append.

Each loader is one lazy DataFrame plan over the whole landing (one Spark job
per dataset instead of one request loop per session):

    load_<t>(landing, target, sessions, ...) -> new rows in the table's DDL shape

``landing`` is the landed payload rows (possibly with ``detail`` envelopes
and missing columns), ``target`` the rows already in the table (``None`` =
empty table), ``sessions`` the raw sessions table used to choose what the
loader asks for. ``run_load`` publishes the result as one load
(``sources.manifest``); running a loader again with the table as target yields
no rows, and a load that was cut off leaves none.

Of rows that agree in a dedup key the first is kept: by payload order if the
landing carries it (``read_landing(..., origin=True)``), else by date and the
other columns.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from raceline import schemas
from raceline.session import checkpoint_dir
from raceline.operators.conform import conform_fill, conform_keep, conform_require, nan_to_null_all
from raceline.operators.dedup import dedup_keep_first
from raceline.operators.incremental import anti_by_key, anti_by_pair, anti_by_session, anti_by_triple
from raceline.operators.pairs import chunk_filter, landed_of, session_driver_pairs, session_driver_roster
from raceline.operators.sessions import (
    sessions_by_name,
    sessions_by_type,
    sessions_one_type,
    session_limit,
    skip_sessions,
)
from raceline.sources.landing import CORRUPT, DETAIL, FIELDS, ORIGIN, drop_error_envelopes, stringify
from raceline.sources.ledger import PAIR, append_ledger, ledger_skip, read_ledger
from raceline.sources.manifest import adopt, new_load_id, publish_load, published_loads, read_may_hold, read_published
from raceline.sources.payloads import answered, tiled
from raceline.sources.rejects import store_rejects

# The dedup keys of the loaders (first row kept).
DEDUP_KEYS: dict[str, list[str]] = {
    "pit": ["driver_number", "session_key", "lap_number", "pit_duration"],
    "stints": ["driver_number", "session_key", "stint_number", "compound", "lap_start"],
    "race_control": ["driver_number", "session_key", "category", "flag", "message", "scope"],
    "team_radio": ["driver_number", "session_key", "recording_url"],
    "weather": ["session_key", "date"],
    "location": ["driver_number", "session_key", "x", "y", "z"],
    "sessions": ["session_key"],
}


def _clean(landing: DataFrame) -> DataFrame:
    return drop_error_envelopes(landing) if DETAIL in landing.columns else landing


def _requested(landing: DataFrame, sessions: DataFrame | None) -> DataFrame:
    """Only the payloads of the sessions the loader asks for."""
    if sessions is None:
        return landing
    return landing.join(sessions.select("session_key").distinct(), "session_key", "left_semi")


def load_drivers(landing: DataFrame, target: DataFrame | None = None, keys: Sequence[str] = ("driver_number", "session_key")) -> DataFrame:
    """Drivers not yet known. Default key (car, session); ``keys=
    ["driver_number"]`` reproduces the car-number-only skip, under which a
    known car never gets rows for a new session."""
    rows = conform_fill(_clean(landing), schemas.RAW["drivers"])
    return nan_to_null_all(anti_by_key(rows, target, list(keys)))


def _by_session(table: str, landing: DataFrame, target: DataFrame | None, sessions: DataFrame | None, dedup: bool) -> DataFrame:
    rows = _conformed(_clean(_requested(landing, sessions)), table)
    rows = anti_by_session(rows, target)
    if dedup:
        rows = _first_of_each(rows, table)
    return nan_to_null_all(rows.drop(ORIGIN))


def _conformed(rows: DataFrame, table: str) -> DataFrame:
    """The rows in the table's shape, and their origin if they have one."""
    origin = [rows.schema[ORIGIN]] if ORIGIN in rows.columns else []
    return conform_fill(rows, StructType([*schemas.RAW[table].fields, *origin]))


def _first_of_each(rows: DataFrame, table: str) -> DataFrame:
    return dedup_keep_first(rows, DEDUP_KEYS[table], [ORIGIN] if ORIGIN in rows.columns else None)


def load_laps(landing: DataFrame, target: DataFrame | None = None, sessions: DataFrame | None = None) -> DataFrame:
    """Laps of Race/Qualifying sessions (no key check) not loaded yet."""
    chosen = sessions_by_type(sessions, check_key=False) if sessions is not None else None
    return _by_session("laps", landing, target, chosen, dedup=False)


def load_intervals(landing: DataFrame, target: DataFrame | None = None, sessions: DataFrame | None = None) -> DataFrame:
    """Intervals of sessions named Qualifying/Race/Sprint; gap values of
    mixed number/text kept as text."""
    chosen = sessions_by_name(sessions) if sessions is not None else None
    rows = _requested(landing, chosen)
    rows = conform_fill(_clean(rows), schemas.RAW["intervals"])
    rows = rows.withColumn("gap_to_leader", stringify("gap_to_leader")).withColumn("interval", stringify("interval"))
    return nan_to_null_all(anti_by_session(rows, target))


def load_position(landing: DataFrame, target: DataFrame | None = None, sessions: DataFrame | None = None) -> DataFrame:
    chosen = sessions_by_type(sessions) if sessions is not None else None
    return _by_session("position", landing, target, chosen, dedup=False)


def load_pit(landing: DataFrame, target: DataFrame | None = None, sessions: DataFrame | None = None) -> DataFrame:
    chosen = sessions_by_type(sessions) if sessions is not None else None
    return _by_session("pit", landing, target, chosen, dedup=True)


def load_race_control(landing: DataFrame, target: DataFrame | None = None, sessions: DataFrame | None = None) -> DataFrame:
    chosen = sessions_by_type(sessions) if sessions is not None else None
    return _by_session("race_control", landing, target, chosen, dedup=True)


def load_stints(landing: DataFrame, target: DataFrame | None = None, sessions: DataFrame | None = None) -> DataFrame:
    """Stints deduplicated on (car, session, stint, compound, lap_start): a
    later corrected lap_end of the same stint is dropped, not applied."""
    chosen = sessions_by_type(sessions) if sessions is not None else None
    return _by_session("stints", landing, target, chosen, dedup=True)


def load_weather(
    landing: DataFrame, target: DataFrame | None = None, sessions: DataFrame | None = None, limit: int | None = None
) -> DataFrame:
    """Weather (wind_direction and rainfall) of sessions by name token,
    optionally only the first ``limit`` sessions."""
    chosen = session_limit(sessions_by_name(sessions), limit) if sessions is not None else None
    return _by_session("weather", landing, target, chosen, dedup=True)


def load_meetings(landing: DataFrame, target: DataFrame | None = None) -> DataFrame:
    rows = conform_fill(_clean(landing), schemas.RAW["meetings"])
    return nan_to_null_all(anti_by_key(rows, target, ["meeting_key"]))


def load_sessions(landing: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """Sessions: keep the columns present (the key is mandatory), one row per
    key, only keys not in the target."""
    rows = _clean(landing)
    if ORIGIN in rows.columns:
        rows = _conformed(rows, "sessions")
    else:
        rows = conform_keep(rows, schemas.RAW["sessions"], "session_key")
    rows = _first_of_each(rows, "sessions").drop(ORIGIN)
    return nan_to_null_all(anti_by_key(rows, target, ["session_key"]))


def load_team_radio(landing: DataFrame, target: DataFrame | None = None, sessions: DataFrame | None = None) -> DataFrame:
    """Row-level skip on (car, session, url) with NULL equal to NULL, applied
    after the batch itself is deduplicated on the same key."""
    chosen = sessions_by_type(sessions) if sessions is not None else None
    rows = _conformed(_clean(_requested(landing, chosen)), "team_radio")
    rows = _first_of_each(rows, "team_radio").drop(ORIGIN)
    return nan_to_null_all(anti_by_triple(rows, target, DEDUP_KEYS["team_radio"]))


def _location_rows(landing: DataFrame, pairs: DataFrame) -> DataFrame:
    rows = _clean(landing).join(pairs, PAIR, "left_semi")
    rows = conform_require(rows, schemas.RAW["location"], schemas.columns("location"), PAIR)
    return dedup_keep_first(rows, DEDUP_KEYS["location"])


def load_location(
    landing: DataFrame, target: DataFrame | None, sessions: DataFrame, drivers: DataFrame
) -> DataFrame:
    """Location samples of the session rosters (Race/Qualifying), pairs
    already in the target skipped, payloads missing a required column
    dropped, duplicates on (car, session, x, y, z) removed (date ignored)."""
    pairs = session_driver_roster(sessions_by_type(sessions, check_key=False), drivers)
    pairs = anti_by_pair(pairs, target)
    return nan_to_null_all(_location_rows(landing, pairs))


def location_resume_pairs(
    sessions: DataFrame, drivers: DataFrame, ledger: DataFrame, deny: Iterable[int] | DataFrame = ()
) -> DataFrame:
    """Pairs the resumable location load still has to do."""
    chosen = skip_sessions(sessions_by_type(sessions, check_key=False), deny)
    return ledger_skip(session_driver_roster(chosen, drivers), ledger)


def load_location_resume(
    landing: DataFrame, ledger: DataFrame, sessions: DataFrame, drivers: DataFrame, deny: Iterable[int] | DataFrame = ()
) -> DataFrame:
    """As ``load_location`` with a static session deny-list and the resume
    ledger instead of the target."""
    pairs = location_resume_pairs(sessions, drivers, ledger, deny)
    return nan_to_null_all(_location_rows(landing, pairs))


def car_data_pairs(
    landing: DataFrame, sessions: DataFrame, drivers: DataFrame, ledger: DataFrame, types: Sequence[str] = ("Race", "Qualifying")
) -> DataFrame:
    return ledger_skip(session_driver_pairs(sessions_one_type(sessions, types), drivers, _clean(landing)), ledger)


def load_car_data(
    landing: DataFrame,
    ledger: DataFrame,
    sessions: DataFrame,
    drivers: DataFrame,
    types: Sequence[str] = ("Race", "Qualifying"),
    hours: int = 1,
) -> DataFrame:
    """Telemetry of the open (session, car) pairs, gathered per hour chunk of
    each session (``request_from <= date < request_to``)."""
    chosen = sessions_one_type(sessions, types)
    samples = conform_fill(_clean(landing), schemas.RAW["car_data"])
    pairs = ledger_skip(session_driver_pairs(chosen, drivers, samples), ledger)
    inside = chunk_filter(samples, chosen, pairs, hours)
    return nan_to_null_all(conform_fill(inside, schemas.RAW["car_data"]))


def _published_of(spark: SparkSession, path: str, table: str, pairs: DataFrame) -> DataFrame:
    """Published rows of the pairs' sessions (the table is stored by session)."""
    rows = read_published(spark, path, schemas.RAW[table])
    return rows.join(pairs.select("session_key").distinct(), "session_key", "left_semi")


def run_car_data_backfill(
    spark: SparkSession,
    landing: DataFrame,
    sessions: DataFrame,
    drivers: DataFrame,
    table_path: str,
    ledger_path: str,
    types: Sequence[str] = ("Race", "Qualifying"),
    partition_by: Sequence[str] = ("session_key",),
    registry: DataFrame | None = None,
    hours: int = 1,
) -> int:
    """Resumable telemetry backfill by hour chunk; returns the pairs that got
    rows.

    Landed chunks of the open pairs that have no published rows yet are
    published as one load. A pair goes to the ledger when its chunks tile its
    session: those answered according to ``registry`` (keys session_key,
    driver_number, request_from, request_to; also empty answers) and those
    with rows, landed or published before. A pair with a missing chunk stays
    open and gets that chunk's rows when it has landed, each row once.
    Without a registry an hour without any sample counts as missing."""
    checkpoint_dir(spark)
    chosen = sessions_one_type(sessions, types)
    samples = conform_fill(_clean(landing), schemas.RAW["car_data"])
    asked = session_driver_pairs(chosen, drivers, samples)
    if registry is not None:
        asked = asked.unionByName(landed_of(registry.select(*PAIR), chosen, drivers)).distinct()
    candidates = ledger_skip(asked, read_ledger(spark, ledger_path)).checkpoint(eager=True)

    bounds = ["request_from", "request_to"]
    held = chunk_filter(_published_of(spark, table_path, "car_data", candidates), chosen, candidates, hours)
    held = held.select(*PAIR, *bounds).distinct().checkpoint(eager=True)
    landed = chunk_filter(samples, chosen, candidates, hours)
    fresh = landed.join(held.select(*PAIR, "request_from"), [*PAIR, "request_from"], "left_anti")
    load_id = new_load_id()
    publish_load(nan_to_null_all(conform_fill(fresh, schemas.RAW["car_data"])), table_path, load_id, partition_by)

    chunks = landed.select(*PAIR, *bounds).distinct().unionByName(held)
    if registry is not None:
        told = answered(registry, [*PAIR, *bounds])
        chunks = chunks.unionByName(told.select(*PAIR, *(F.col(c).cast("timestamp").alias(c) for c in bounds)))
    cut = [F.date_trunc("second", c).alias(c) for c in ("date_start", "date_end")]
    spans = candidates.join(chosen.select("session_key", *cut).dropDuplicates(["session_key"]), "session_key")
    append_ledger(tiled(chunks, spans, PAIR, *bounds, "date_start", "date_end"), ledger_path)
    return _rows_of_load(spark, table_path, "car_data", load_id).select(*PAIR).distinct().count()


def _rows_of_load(spark: SparkSession, path: str, table: str, load_id: str) -> DataFrame:
    """Rows of one published load."""
    if not published_loads(spark, path).get(load_id):
        return spark.createDataFrame([], schemas.RAW[table])
    return spark.read.schema(schemas.RAW[table]).parquet(f"{path}/load_id={load_id}")


def run_location_backfill(
    spark: SparkSession,
    landing: DataFrame,
    sessions: DataFrame,
    drivers: DataFrame,
    table_path: str,
    ledger_path: str,
    deny: Iterable[int] | DataFrame = (),
    partition_by: Sequence[str] = ("session_key",),
    registry: DataFrame | None = None,
) -> int:
    """Resumable location load; returns the pairs that were loaded and closed.

    A pair is done when its payload has landed: when ``registry`` (keys
    session_key, driver_number) has an answer for it, which may be empty, an
    error envelope or without a required column, or when it has landed rows.
    Any other pair of the roster stays open. Pairs that have published rows (a
    run that died before the ledger) only go to the ledger."""
    checkpoint_dir(spark)
    todo = location_resume_pairs(sessions, drivers, read_ledger(spark, ledger_path), deny)
    readable = landing.where(F.col(CORRUPT).isNull()) if CORRUPT in landing.columns else landing
    there = readable.select(*PAIR).distinct()
    if registry is not None:
        there = answered(registry, PAIR).unionByName(there).distinct()
    candidates = todo.join(there, PAIR, "left_semi").checkpoint(eager=True)
    present = _published_of(spark, table_path, "location", candidates).select(*PAIR).distinct()
    open_pairs = anti_by_pair(candidates, present).checkpoint(eager=True)
    publish_load(nan_to_null_all(_location_rows(landing, open_pairs)), table_path, new_load_id(), partition_by)
    append_ledger(candidates, ledger_path)
    return open_pairs.count()


#: The tables with many rows per session are stored by session.
PARTITIONED = {"car_data", "location", "position", "intervals"}

#: What a loader skips by: the key columns of what its table already holds.
SKIP_KEYS: dict[str, list[str]] = {
    "drivers": ["driver_number", "session_key"],
    "meetings": ["meeting_key"],
    "sessions": ["session_key"],
    "team_radio": DEDUP_KEYS["team_radio"],
    "location": PAIR,
    "car_data": PAIR,
} | {t: ["session_key"] for t in ("laps", "intervals", "position", "pit", "race_control", "stints", "weather")}


def target_for(landing: DataFrame, table_path: str) -> DataFrame:
    """The stored rows that a loader's skip of this landing has to know: of
    the table's loads only those are opened that may hold a landed key. The
    loader compares the keys exactly, so its result is that over the whole
    table."""
    table = table_path.rstrip("/").rsplit("/", 1)[-1]
    return read_may_hold(landing.sparkSession, table_path, schemas.RAW[table], landing, SKIP_KEYS[table])


def run_load(
    new_rows: DataFrame, table_path: str, partition_by: Sequence[str] | None = None, landing: DataFrame | None = None, reject_path: str | None = None
) -> int:
    """Publish a loader result as one load of its table, by default by
    session_key if the path names one of the large per-session tables; returns
    its rows. A run that is cut off leaves no rows, so the session or key
    skips of the next run don't pass over what it had not written. Plain files
    that the table already has become its first load. A sketch of the skip keys is
    written with the load (``target_for``). With ``landing`` and
    ``reject_path`` the landed objects that could not be read are stored
    there, each once."""
    table = table_path.rstrip("/").rsplit("/", 1)[-1]
    if partition_by is None:
        partition_by = ("session_key",) if table in PARTITIONED else ()
    adopt(new_rows.sparkSession, table_path, new_rows.schema, partition_by)
    keys = SKIP_KEYS.get(table, ())
    rows = publish_load(new_rows, table_path, new_load_id(), partition_by, sketch=keys if set(keys) <= set(new_rows.columns) else ())
    if landing is not None and reject_path:
        store_rejects(landing, reject_path)
    return rows


def location_metrics(landing: DataFrame, ledger: DataFrame, sessions: DataFrame, drivers: DataFrame, deny=()) -> DataFrame:
    """Counts of the resumable location load in one pass over the landing:
    landed rows, rows that could not be read, rows skipped (pair done, not
    requested, or payload without a required column), duplicate rows, rows to
    insert, and the (session, car) pairs attempted and skipped as already in
    the ledger.

    The landed rows are grouped by pair and dedup key with the fields that
    they have, then by pair, then counted; the pair lists are stacked as
    tagged rows under the same last aggregate."""
    roster = session_driver_roster(skip_sessions(sessions_by_type(sessions, check_key=False), deny), drivers)
    open_pairs = ledger_skip(roster, ledger)
    ledgered = roster.join(ledger.select(*PAIR).distinct(), [roster[k].eqNullSafe(ledger[k]) for k in PAIR], "left_semi")
    failed = F.col(CORRUPT).isNotNull() if CORRUPT in landing.columns else F.lit(False)
    usable = ~failed & (F.col(DETAIL).isNull() if DETAIL in landing.columns else F.lit(True))
    required = schemas.columns("location")

    def has(c: str) -> F.Column:
        return F.array_contains(FIELDS, c) if FIELDS in landing.columns else F.lit(c in landing.columns)

    rows = conform_fill(landing.withColumns({"__failed": failed, "__usable": usable} | {f"__has_{c}": has(c) for c in required}), StructType([
        *schemas.RAW["location"].fields, *[StructField(c, BooleanType()) for c in ("__failed", "__usable", *[f"__has_{c}" for c in required])]
    ]))
    flags = [F.max(f"__has_{c}").alias(f"__has_{c}") for c in required]
    by_key = rows.groupBy("__failed", "__usable", *DEDUP_KEYS["location"]).agg(F.count(F.lit(1)).alias("__n"), *flags)
    by_pair = by_key.groupBy("__failed", "__usable", *PAIR).agg(
        F.sum("__n").alias("__n"), F.count(F.lit(1)).alias("__groups"), *flags
    )
    known = open_pairs.withColumn("__open", F.lit(True))
    complete = F.expr(" AND ".join(f"`__has_{c}`" for c in required))
    kept = F.coalesce(F.col("__usable") & F.col("__open") & complete, F.lit(False))
    counted = by_pair.join(known, PAIR, "left").select(
        F.when(F.col("__failed"), "failed").when(F.col("__usable"), "rows").otherwise("none").alias("__kind"), kept.alias("__kept"), "__n", "__groups"
    )

    def tagged(pairs: DataFrame, kind: str) -> DataFrame:
        one = F.lit(1).cast("long")
        return pairs.select(F.lit(kind).alias("__kind"), F.lit(True).alias("__kept"), one.alias("__n"), one.alias("__groups"))

    def total(kind: str, value: str = "__n", only_kept: bool = False) -> F.Column:
        cond = F.col("__kind") == kind
        return F.coalesce(F.sum(F.when(cond & F.col("__kept") if only_kept else cond, F.col(value))), F.lit(0)).cast("long")

    counts = counted.unionByName(tagged(open_pairs, "open")).unionByName(tagged(ledgered, "ledgered")).agg(
        total("rows").alias("landed_rows"),
        total("failed").alias("failed_rows"),
        total("rows", only_kept=True).alias("__after_skip"),
        total("rows", "__groups", only_kept=True).alias("inserted_rows"),
        total("open").alias("pairs_attempted"),
        total("ledgered").alias("pairs_skipped"),
    )
    return counts.select(
        "landed_rows",
        "failed_rows",
        (F.col("landed_rows") - F.col("__after_skip")).alias("skipped_rows"),
        (F.col("__after_skip") - F.col("inserted_rows")).alias("duplicate_rows"),
        "inserted_rows", "pairs_attempted", "pairs_skipped",
    )


LOADERS = {
    "load_drivers": load_drivers,
    "load_laps": load_laps,
    "load_car_data": load_car_data,
    "load_intervals": load_intervals,
    "load_location": load_location,
    "load_location_resume": load_location_resume,
    "load_meetings": load_meetings,
    "load_pit": load_pit,
    "load_position": load_position,
    "load_race_control": load_race_control,
    "load_sessions": load_sessions,
    "load_stints": load_stints,
    "load_team_radio": load_team_radio,
    "load_weather": load_weather,
}
