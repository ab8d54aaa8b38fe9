"""The payload registry: what was landed for each request, rows or not.

An empty answer, an error envelope and an answer that never came all bring no
row. Landed payloads tell them apart: the landing is stored by request, as
``<landing>/session_key=7/driver_number=44/<file>`` (for telemetry with
``request_from=.../request_to=...`` below), so every payload has its request
key from the path, also an empty one.

``payload_registry`` has a row per payload with its key, status and counts.
The backfills close work units from it: a unit without a payload stays open.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from raceline.sources.landing import CORRUPT, DETAIL, FIELDS, ORIGIN, read_landing

#: What a payload can be (fixed values): rows; no rows; an error envelope; rows
#: of which none has a required column; not readable as a whole or in part.
ROWS, EMPTY, ERROR, LACKING, REJECTED = "rows", "empty", "error", "lacking", "rejected"
#: A request is answered by all but an unreadable payload, which is fetched or mended again.
ANSWERED = (ROWS, EMPTY, ERROR, LACKING)


def payload_registry(landed: DataFrame, keys: Sequence[str], required: Sequence[str] = ()) -> DataFrame:
    """``keys``, ``payload`` (file, block, line), ``status``, ``n_rows`` and
    ``n_rejected`` per payload of what ``read_landing`` returned with
    ``origin`` and the request ``keys``.

    The counts are grouped sums, partial on the map side; a payload's rows
    are not brought together."""
    payload = F.struct(*(F.col(f"{ORIGIN}.{c}").alias(c) for c in ("file", "block", "line")))
    rejected = F.col(CORRUPT).isNotNull()
    is_error = ~rejected & F.col(DETAIL).isNotNull()
    is_row = ~rejected & F.col(DETAIL).isNull() & (F.size(FIELDS) > 0)
    has = [F.max(F.when(is_row, F.array_contains(FIELDS, c))).alias(f"__has_{c}") for c in required]

    def count(which: Column) -> Column:
        return F.count(F.when(which, 1))

    found = landed.groupBy(*keys, payload.alias("payload")).agg(
        count(is_row).alias("n_rows"), count(rejected).alias("n_rejected"), count(is_error).alias("__errors"), *has
    )
    complete = F.lit(True)
    for c in required:
        complete = complete & F.coalesce(F.col(f"__has_{c}"), F.lit(False))
    status = (
        F.when(F.col("n_rejected") > 0, REJECTED)
        .when((F.col("n_rows") > 0) & complete, ROWS)
        .when(F.col("n_rows") > 0, LACKING)
        .when(F.col("__errors") > 0, ERROR)
        .otherwise(EMPTY)
    )
    return found.select(*keys, "payload", status.alias("status"), "n_rows", "n_rejected")


def read_registered(
    spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], required: Sequence[str] = (), multi_line: bool = False
) -> tuple[DataFrame, DataFrame]:
    """The landed rows below a landing stored by request, and their registry."""
    landed = read_landing(spark, path, schema, multi_line, origin=True, keys=keys)
    rows = landed.where(F.col(FIELDS).isNotNull() | F.col(CORRUPT).isNotNull())
    return rows, payload_registry(landed, keys, required)


def answered(registry: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of the requests that have an answer."""
    return registry.where(F.col("status").isin(*ANSWERED)).select(*keys).distinct()


def failed(registry: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of the requests whose only payloads can't be read."""
    bad = registry.where(F.col("status") == REJECTED).select(*keys).distinct()
    return bad.join(answered(registry, keys), list(keys), "left_anti")


def tiled(intervals: DataFrame, spans: DataFrame, keys: Sequence[str], lo: str, hi: str, start: str, end: str) -> DataFrame:
    """The ``keys`` whose ``[lo, hi)`` intervals cover their ``[start, end)``
    without a gap; a span that is empty or has a null end is covered.

    Islands by running maximum: sorted by ``lo``, an interval that begins
    after everything before it ended leaves a gap. A key has a row per
    request, a few dozen."""
    spans = spans.select(*keys, F.col(start).alias("__start"), F.col(end).alias("__end"))
    inside = intervals.join(spans, list(keys)).where((F.col(hi) > F.col("__start")) & (F.col(lo) < F.col("__end")))
    order = Window.partitionBy(*keys).orderBy(lo, hi).rowsBetween(Window.unboundedPreceding, -1)
    reached = F.greatest(F.col("__start"), F.max(hi).over(order))
    gaps = inside.select(*keys, hi, "__end", (F.col(lo) > F.coalesce(reached, F.col("__start"))).alias("__gap"))
    whole = gaps.groupBy(*keys).agg(F.max("__gap").alias("__gap"), F.max(hi).alias("__last"), F.max("__end").alias("__end"))
    covered = whole.where(~F.col("__gap") & (F.col("__last") >= F.col("__end"))).select(*keys)
    nothing_asked = spans.where(~F.coalesce(F.col("__start") < F.col("__end"), F.lit(False))).select(*keys)
    return covered.unionByName(nothing_asked).distinct()
