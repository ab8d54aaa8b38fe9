"""Generic data tests: each returns the offending rows (empty = pass)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Non-NULL values of ``column`` that occur more than once, with counts.
    A grouped count with map-side partial aggregation: a value held by a third
    of all rows is combined per task before the shuffle."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("unique_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` is NULL (the column only)."""
    return df.filter(F.col(column).isNull()).select(column)
