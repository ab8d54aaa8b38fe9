"""Incremental loading: skip what the target already holds, append the rest.

All skips are anti joins against the *distinct keys* of the target, so the
target side shrinks to its key set before any shuffle (and is broadcast by
AQE when that key set is measured small).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raceline.sources.manifest import publish_load, read_published, read_table  # noqa: F401


def anti_by_key(df: DataFrame, target: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not in the target. NULL keys never match, so they
    are kept (as the loaders' membership test keeps them)."""
    if target is None:
        return df
    known = target.select(*keys).distinct()
    return df.join(known, list(keys), "left_anti")


def anti_by_session(df: DataFrame, target: DataFrame | None) -> DataFrame:
    """Skip every session that already has any row in the target. A session
    has many rows, so a shuffle by session would send ``df`` to a few tasks:
    the target's session keys, a few rows, are sent to those of ``df``."""
    if target is None:
        return df
    return df.join(F.broadcast(target.select("session_key").distinct()), ["session_key"], "left_anti")


def anti_by_pair(df: DataFrame, target: DataFrame | None) -> DataFrame:
    """Skip (session, driver) pairs already in the target."""
    return anti_by_key(df, target, ["session_key", "driver_number"])


def anti_by_triple(df: DataFrame, target: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Row-level skip on a NULL-safe key (``None`` equals ``None``)."""
    if target is None:
        return df
    known = target.select(*keys).distinct()
    cond = [df[k].eqNullSafe(known[k]) for k in keys]
    return df.join(known, cond, "left_anti")


def append_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Create-if-absent and append, plainly. A failed write job leaves no rows,
    but a driver lost in the middle of the job's commit can leave part of its
    files: the loaders publish their loads instead (``sources.manifest``)."""
    writer = df.write.mode("append").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def load_metrics(landing: DataFrame, kept: DataFrame, deduped: DataFrame, new_rows: DataFrame) -> DataFrame:
    """One-row report of a load: landed rows, rows skipped as already loaded,
    duplicates removed and rows to insert. The four frames are tagged and
    counted in one distributed aggregate (partial counts per task)."""
    stages = [("landed", landing), ("kept", kept), ("deduped", deduped), ("inserted", new_rows)]
    tagged = None
    for tag, df in stages:
        part = df.select(F.lit(tag).alias("stage"))
        tagged = part if tagged is None else tagged.unionByName(part)

    def n(tag: str) -> F.Column:
        return F.sum(F.when(F.col("stage") == tag, 1).otherwise(0)).cast("long")

    counts = tagged.agg(n("landed").alias("l"), n("kept").alias("k"), n("deduped").alias("d"), n("inserted").alias("i"))
    return counts.select(
        F.col("l").alias("landed_rows"),
        (F.col("l") - F.col("k")).alias("skipped_rows"),
        (F.col("k") - F.col("d")).alias("duplicate_rows"),
        F.col("i").alias("inserted_rows"),
    )
