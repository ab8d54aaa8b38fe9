"""The reject store: landed objects that could not be read, each once.

A reject is known by the digest of its text, so a rerun over the same landing
adds nothing. ``replay`` reads the stored texts again, with the schema as it
is now or after ``mend`` has changed the texts, as landed rows that go to a
loader like any others; the loaders' own skips keep them from coming twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from raceline.sources.landing import CORRUPT, FIELDS, landing_schema, rejected
from raceline.sources.manifest import new_load_id, publish_load, read_published

SCHEMA = StructType([StructField("reject_id", StringType()), StructField("payload", StringType())])


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """``reject_id`` (SHA-256 of the text) and ``payload``."""
    return read_published(spark, path, SCHEMA)


def store_rejects(landing: DataFrame, path: str) -> int:
    """Store the rejects of a landing that the store does not have yet;
    returns how many these are."""
    texts = rejected(landing).select(F.sha2(CORRUPT, 256).alias("reject_id"), F.col(CORRUPT).alias("payload"))
    known = read_rejects(landing.sparkSession, path).select("reject_id")
    return publish_load(texts.dropDuplicates(["reject_id"]).join(known, "reject_id", "left_anti"), path, new_load_id())


def replay(spark: SparkSession, path: str, schema: StructType, mend: Callable[[Column], Column] | None = None) -> DataFrame:
    """The stored rejects as landed rows (columns as ``read_landing``'s): those
    that still can't be read have their text in ``_corrupt_record``."""
    text = F.col("payload") if mend is None else mend(F.col("payload"))
    fields = landing_schema(schema)
    row = F.from_json("text", fields, {"columnNameOfCorruptRecord": CORRUPT, "mode": "PERMISSIVE"})
    read = read_rejects(spark, path).select(text.alias("text")).select(row.alias("r"), F.json_object_keys("text").alias(FIELDS), "text")
    columns = [F.col(f"r.`{c}`").alias(c) for c in fields.fieldNames() if c != CORRUPT]
    unread = F.when(F.col(FIELDS).isNull(), F.col("text")).otherwise(F.col(f"r.{CORRUPT}"))
    return read.select(*columns, unread.alias(CORRUPT), FIELDS)
