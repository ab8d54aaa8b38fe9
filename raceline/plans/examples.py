"""The two starter models: a UNION ALL materialised as a table and a filter
over it, plus the generic tests declared on their ``id`` column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raceline.operators.quality import check_not_null, check_unique
from raceline.plans.staging import Raw


def example_union(raw: Raw) -> DataFrame:
    """UNION ALL of two id columns: car numbers of the driver table and of
    race-control messages (which include NULL = track-wide messages)."""
    drivers = raw["drivers"].select(F.col("driver_number").cast("int").alias("id"))
    messages = raw["race_control"].select(F.col("driver_number").alias("id"))
    return drivers.unionByName(messages)


def example_filter(raw: Raw) -> DataFrame:
    return example_union(raw).filter(F.col("id") == 1)


def example_unique(raw: Raw) -> DataFrame:
    return check_unique(example_union(raw), "id")


def example_not_null(raw: Raw) -> DataFrame:
    return check_not_null(example_union(raw), "id")


MODELS = {
    "example_union": example_union,
    "example_filter": example_filter,
    "check_unique": example_unique,
    "check_not_null": example_not_null,
}
