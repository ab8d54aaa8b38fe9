"""Keep-first deduplication on a column subset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_keep_first(df: DataFrame, subset: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """One row per distinct ``subset`` (NULL equals NULL): the first row by
    ``order`` (default ``date`` when present, then every other column), each
    ascending with NULLs first.

    Written as a grouped ``min`` over a struct of the ordering columns, not
    as a window: the aggregate is partial on the map side, so a key that
    holds a third of all rows is collapsed inside each task before the
    shuffle instead of being sorted in one task.
    """
    rest = [c for c in df.columns if c not in subset]
    if order is None:
        order = (["date"] if "date" in rest else []) + [c for c in rest if c != "date"]
    order = [c for c in order if c in rest] + [c for c in rest if c not in order]
    if not rest:
        return df.dropDuplicates(list(subset))
    first = F.min(F.struct(*[F.col(f"`{c}`").alias(c) for c in order])).alias("__first")
    kept = df.groupBy(*[F.col(f"`{c}`") for c in subset]).agg(first)
    return kept.select(*[F.col(f"`{c}`") if c in subset else F.col(f"__first.`{c}`").alias(c) for c in df.columns])
