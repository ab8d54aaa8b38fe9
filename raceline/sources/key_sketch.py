"""Key sketches: which loads of a table may hold given keys.

Beside a load's rows stands a Bloom filter of its skip keys, as a small table
``<table>.keys/load_id=<id>`` of (word, bits): a key's hash names one 64-bit
word of the filter and four bits in it. Words without a key have no row, so the
table grows with the distinct keys of its load, and it is built and asked by
groupings and joins; no filter passes through the driver.

A filter never denies a key that its load holds (NULLs are hashed like a
value), so a skip that reads only the loads named here, and compares keys
exactly afterwards, gives what a skip over the whole table gives.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

_WORDS = StructType([StructField("word", LongType()), StructField("bits", LongType())])

#: Bits of a filter for each row of its load; bits that a key sets in its word.
BITS_PER_ROW, BITS_PER_KEY = 16, 4


def levels_for(rows: int) -> int:
    """Binary logarithm of the words of a filter for a load of ``rows`` rows."""
    return max(0, math.ceil(math.log2(max(1, rows * BITS_PER_ROW / 64))))


def _hash(keys: Sequence[Column]) -> Column:
    """Of the values and of which of them are NULL."""
    return F.xxhash64(*keys, *(k.isNull() for k in keys))


def _bits(h: Column) -> Column:
    """Four bits of a word, from the upper half of the hash."""
    out = F.lit(0).cast("long")
    for i in range(BITS_PER_KEY):
        place = F.shiftrightunsigned(h, 64 - 6 * (i + 1)).bitwiseAND(F.lit(63)).cast("int")
        out = out.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return out


def write_sketch(rows: DataFrame, keys: Sequence[str], level: int, path: str) -> None:
    """The filter of a load's keys; ``level`` from ``levels_for``."""
    h = rows.select(_hash([F.col(k) for k in keys]).alias("h"))
    mask = F.lit((1 << level) - 1).cast("long")
    words = h.select(F.col("h").bitwiseAND(mask).alias("word"), _bits(F.col("h")).alias("bits"))
    words.groupBy("word").agg(F.bit_or("bits").alias("bits")).write.mode("errorifexists").parquet(path)


def loads_that_may_hold(
    spark: SparkSession, candidates: DataFrame, keys: Sequence[str], schema: StructType, sketches: Mapping[str, tuple[int, str]]
) -> set[str]:
    """Of the loads with a sketch (id -> level, path) those that may hold one
    of the candidates' keys. A candidate key is looked up once per filter size,
    not once per load."""
    if not sketches:
        return set()
    # NULL and absent values are one; types are those of the table.
    h = candidates.select(*(F.col(k).cast(schema[k].dataType).alias(k) for k in keys)).select(_hash([F.col(k) for k in keys]).alias("h")).distinct()
    by_level: dict[int, list[str]] = {}
    for load_id, (level, _) in sketches.items():
        by_level.setdefault(level, []).append(load_id)
    found = None
    for level, ids in sorted(by_level.items()):
        folders = [sketches[i][1] for i in ids]
        base = folders[0].rsplit("/", 1)[0]
        name = folders[0].rsplit("/", 1)[1].split("=")[0]
        stored = spark.read.schema(StructType([*_WORDS.fields, StructField(name, StringType())])).option("basePath", base).parquet(*folders)
        asked = h.select(F.col("h").bitwiseAND(F.lit((1 << level) - 1).cast("long")).alias("word"), _bits(F.col("h")).alias("asked"))
        hit = stored.join(asked, "word").where(F.col("bits").bitwiseAND(F.col("asked")) == F.col("asked")).select(F.col(name).alias("id"))
        found = hit if found is None else found.unionByName(hit)
    return {r["id"] for r in found.distinct().collect()}  # ids of loads, as in the manifest
