"""(session, driver) work units and hour chunks of the telemetry backfill."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


PAIR = ["session_key", "driver_number"]


def session_driver_roster(sessions: DataFrame, drivers: DataFrame) -> DataFrame:
    """Drivers entered in each selected session (NULL car numbers dropped):
    an equi join on session_key."""
    entries = drivers.select("session_key", "driver_number").filter(F.col("driver_number").isNotNull())
    return sessions.select("session_key").distinct().join(entries, "session_key", "inner").select(*PAIR).distinct()


def landed_of(landed: DataFrame, sessions: DataFrame, drivers: DataFrame) -> DataFrame:
    """Landed rows of the selected sessions and of cars known from any
    session: two semi joins, as the loaders ask for every known car in every
    session and payloads without rows bring nothing."""
    known = drivers.select("driver_number").filter(F.col("driver_number").isNotNull()).distinct()
    chosen = sessions.select("session_key").distinct()
    return landed.join(chosen, "session_key", "left_semi").join(known, "driver_number", "left_semi")


def session_driver_pairs(sessions: DataFrame, drivers: DataFrame, landed: DataFrame) -> DataFrame:
    """Work units of the telemetry backfill: the (session, car) pairs that
    have landed rows, of the selected sessions and all known cars. (No table
    of sessions x cars is built.)"""
    return landed_of(landed.select(*PAIR), sessions, drivers).select(*PAIR).distinct()


def hour_chunks(sessions: DataFrame, start: str = "date_start", end: str = "date_end", hours: int = 1) -> DataFrame:
    """Split ``[start, end)`` into ``hours``-long pieces starting at ``start``;
    the last piece is clipped to ``end``; nothing when ``start >= end``.
    ``request_from`` / ``request_to`` are the bounds cut to whole seconds, as
    the request text carries them."""
    step = F.make_dt_interval(F.lit(0), F.lit(hours))
    valid = sessions.filter(F.col(start).isNotNull() & F.col(end).isNotNull() & (F.col(start) < F.col(end)))
    last_instant = F.col(end) - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(0.000001))
    chunks = valid.withColumn("chunk_start", F.explode(F.sequence(F.col(start), last_instant, step)))
    chunks = chunks.withColumn("chunk_end", F.least(F.col("chunk_start") + step, F.col(end)))
    return chunks.withColumn("request_from", F.date_trunc("second", "chunk_start")).withColumn(
        "request_to", F.date_trunc("second", "chunk_end")
    )


def chunk_filter(samples: DataFrame, sessions: DataFrame, pairs: DataFrame, hours: int = 1) -> DataFrame:
    """Samples of the given (session, driver) pairs as the hour-chunked
    requests return them: per chunk ``request_from <= date < request_to``,
    labelled with their chunk.

    Consecutive chunks share their bounds and the request bounds are the
    chunk bounds cut to whole seconds, so the requests of a session tile
    ``[trunc(start), trunc(end))`` on a whole-hour grid: a sample's chunk is
    ``floor((date - trunc(start)) / hours)``. That makes the filter an equi
    join with the sessions plus a semi join with the pairs; no table of
    pairs x chunks is built.
    """
    step = F.make_dt_interval(F.lit(0), F.lit(hours))
    spans = sessions.select("session_key", "date_start", "date_end").filter(
        F.col("date_start").isNotNull() & F.col("date_end").isNotNull() & (F.col("date_start") < F.col("date_end"))
    )
    rows = samples.join(pairs.select(*PAIR), PAIR, "left_semi").join(spans, "session_key", "inner")
    base = F.date_trunc("second", "date_start")
    width = F.lit(hours * 3_600_000_000)
    offset = F.unix_micros("date") - F.unix_micros(base)
    index = ((offset - F.pmod(offset, width)) / width).cast("int")
    inside = rows.filter((F.col("date") >= base) & (F.col("date") < F.date_trunc("second", "date_end")))
    chunk_start = F.col("date_start") + step * index
    labelled = inside.withColumn("chunk_start", chunk_start)
    labelled = labelled.withColumn("request_from", F.date_trunc("second", "chunk_start")).withColumn(
        "request_to", F.date_trunc("second", F.least(F.col("chunk_start") + step, F.col("date_end")))
    )
    return labelled.drop("date_start", "date_end")
