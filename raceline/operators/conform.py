"""Column conforming of landed payloads to the fixed table DDL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

from raceline.functions.columns import nan_to_null
from raceline.sources.landing import FIELDS


def conform_fill(df: DataFrame, schema: StructType) -> DataFrame:
    """Missing expected columns become NULL, extra columns are dropped and the
    column order is the DDL order; every column is cast to its DDL type."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def conform_keep(df: DataFrame, schema: StructType, key: str) -> DataFrame:
    """Keep only the expected columns the payload has (DDL order); a payload
    without the key column is rejected."""
    if key not in df.columns:
        raise ValueError(f"payload has no key column {key!r}")
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields if f.name in df.columns])


def conform_require(df: DataFrame, schema: StructType, required: Sequence[str], payload_keys: Sequence[str]) -> DataFrame:
    """Conform like ``conform_fill``, then drop every payload (rows sharing
    ``payload_keys``) that lacks a required column.

    A column is there if an object of the payload has the field, whatever its
    value; ``_fields`` (from the landing reader) says so. Rows that were not
    read from JSON text have the columns of their DataFrame. The test is a
    grouped aggregate (partial on the map side), not a collect of the payload."""
    conformed = conform_fill(df, schema)
    if FIELDS not in df.columns:
        return conformed if set(required) <= set(df.columns) else conformed.where(F.lit(False))
    present = df.groupBy(*payload_keys).agg(*[F.max(F.array_contains(FIELDS, c)).alias(f"__has_{c}") for c in required])
    complete = present.where(F.expr(" AND ".join(f"`__has_{c}`" for c in required))).select(*payload_keys)
    return conformed.join(complete, [conformed[k].eqNullSafe(complete[k]) for k in payload_keys], "left_semi")


def nan_to_null_all(df: DataFrame) -> DataFrame:
    """NaN -> NULL on every floating-point column (before insert)."""
    return df.select(
        *[
            nan_to_null(F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, (DoubleType, FloatType))
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )
