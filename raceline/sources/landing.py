"""Landed REST payloads (JSON) -> rows.

A payload is a JSON array of flat objects, a single object, or an error
envelope ``{"detail": "..."}``. Landing files are read with an explicit
schema (never inferred). Every row carries the field names that its object
has (``_fields``), so a field that is absent and one that is null can be told
apart, and every object that can't be read as the schema says becomes a row
with its text in ``_corrupt_record``: nothing that was landed vanishes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

DETAIL, FIELDS, CORRUPT, ORIGIN = "detail", "_fields", "_corrupt_record", "_origin"


def landing_schema(schema: StructType) -> StructType:
    """The table schema plus the error-envelope and reject fields."""
    added = [StructField(c, StringType(), True) for c in (DETAIL, CORRUPT) if c not in schema.fieldNames()]
    return StructType([*schema.fields, *added])


def read_landing(
    spark: SparkSession, path: str, schema: StructType, multi_line: bool = False, origin: bool = False, keys: Sequence[str] = ()
) -> DataFrame:
    """Scan landed payloads: one per line (splittable, so large landings are
    read in parallel), or with ``multi_line=True`` one per file. Arrays give a
    row per object, empty arrays none. Timestamps in ISO-8601 parse on read.
    Columns: the schema's, ``detail``, ``_corrupt_record`` and ``_fields``.

    With ``origin`` also ``_origin``: file, block, line and index of the object
    in its payload, which sort as the payloads were landed (lines of a task
    are numbered in order, and a block is read by one task); an empty payload
    then gives a row of nulls with its origin, whose ``_fields`` is null.
    ``keys`` are columns of the landing's folder names; they go before a field
    of the same name."""
    text = spark.read.text(path, wholetext=multi_line)
    kept = list(keys)
    if origin:
        text = text.withColumn(ORIGIN, F.struct(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")
        ))
        kept.append(ORIGIN)
    payloads = text.select(*kept, F.trim(F.regexp_replace("value", r"^\s+|\s+$", "")).alias("payload"))
    as_array = F.when(F.col("payload").startswith("["), F.col("payload")).otherwise(F.concat(F.lit("["), F.col("payload"), F.lit("]")))
    objects = F.from_json(as_array, "array<string>")
    whole = F.array(F.struct(F.lit(None).cast("string").alias("object"), F.col("payload").alias("reject")))
    each = F.transform(objects, lambda o: F.struct(o.alias("object"), F.when(o.isNull(), F.lit("null")).alias("reject")))
    every = F.when(objects.isNull(), whole).otherwise(each)
    filled = payloads.where("payload <> ''")
    if origin:
        found = filled.select(*kept, F.posexplode_outer(every).alias("__at", "x")).select(*kept, "__at", "x.*")
        found = found.withColumn(ORIGIN, F.struct(f"{ORIGIN}.file", f"{ORIGIN}.block", f"{ORIGIN}.line", F.col("__at").alias("index")))
    else:
        found = filled.select(*kept, F.explode(every).alias("x")).select(*kept, "x.*")
    fields = landing_schema(schema)
    row = F.from_json("object", fields, {"columnNameOfCorruptRecord": CORRUPT, "mode": "PERMISSIVE"})
    rows = found.select(*kept, "reject", F.json_object_keys("object").alias(FIELDS), row.alias("r"))
    columns = [F.col(c) for c in kept if c not in fields.fieldNames()]
    columns += [F.col(c).cast(fields[c].dataType) if c in keys else F.col(f"r.`{c}`").alias(c) for c in fields.fieldNames() if c != CORRUPT]
    return rows.select(*columns, F.coalesce("reject", f"r.{CORRUPT}").alias(CORRUPT), FIELDS)


def rejected(df: DataFrame) -> DataFrame:
    """Texts of the landed objects that can't be read (cut off, or with a
    value of another type): to be stored and counted."""
    return df.where(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def drop_error_envelopes(df: DataFrame) -> DataFrame:
    """The data rows: without ``{"detail": ...}`` envelopes, empty objects and
    what ``rejected`` returns. ``_fields`` and ``_origin`` stay, ``detail``
    goes."""
    extra = [c for c in (FIELDS, ORIGIN) if c in df.columns]
    data_cols = [c for c in df.columns if c not in (DETAIL, CORRUPT, *extra)]
    kept = df
    for mark in (CORRUPT, DETAIL):
        if mark in df.columns:
            kept = kept.where(F.col(mark).isNull())
    if FIELDS in df.columns:
        kept = kept.where(F.size(FIELDS) > 0)
    else:  # rows that were not read from JSON text
        any_value = F.lit(False)
        for c in data_cols:
            any_value = any_value | F.col(f"`{c}`").isNotNull()
        kept = kept.where(any_value)
    return kept.select(*[F.col(f"`{c}`") for c in data_cols], *extra)


def write_landing(df: DataFrame, path: str) -> None:
    """Land rows as JSON Lines (ISO-8601 UTC timestamps)."""
    df.write.mode("overwrite").option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(path)


def parse_iso_ts(col: Column | str) -> Column:
    """ISO-8601 text with ``Z`` or an offset -> timestamp (UTC session)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.to_timestamp(c)


def stringify(col: Column | str) -> Column:
    """Numbers and text of one field -> text; NULL stays NULL."""
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("string")
