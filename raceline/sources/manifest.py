"""Published loads: tables whose rows appear all at once.

A load is written to a folder of its own, ``<table>/load_id=<id>``, and then
named by one line in ``<table>.published``. Readers open the folders that are
named there and nothing else, so a load that was cut off at any point, also in
the middle of its commit, has no rows for anybody, and the next run loads them
anew. One line is one file that is renamed into place: it is there or it is not.

A line can also name loads that it replaces. ``compact`` writes all published
rows as one load that replaces the others, so the folders that a reader opens
don't grow with the number of runs; ``vacuum`` deletes what no line names.

A line can say that a sketch of its load's keys stands beside the rows
(``sources.key_sketch``): ``read_may_hold`` opens only the loads that may hold
one of the given keys.

One run at a time loads a table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from raceline.sources.key_sketch import levels_for, loads_that_may_hold, write_sketch

#: Name of the folder level that holds a load.
LOAD_ID = "load_id"

_NAMES = ArrayType(StringType())
_ENTRY = StructType(
    [StructField(LOAD_ID, StringType()), StructField("rows", LongType()), StructField("layout", _NAMES), StructField("replaces", _NAMES),
     StructField("sketch", _NAMES), StructField("level", IntegerType())]
)


def _missing(exc: Exception) -> bool:
    return getattr(exc, "getCondition", lambda: None)() == "PATH_NOT_FOUND"


def read_table(spark: SparkSession, path: str, schema, fmt: str = "parquet") -> DataFrame:
    """Read an appended table; an absent table reads as empty."""
    try:
        return spark.read.format(fmt).schema(schema).load(path)
    except Exception as exc:
        if _missing(exc):
            return spark.createDataFrame([], schema)
        raise


def new_load_id() -> str:
    return uuid.uuid4().hex


def _entries(spark: SparkSession, path: str) -> list | None:
    """The lines of a table's manifest (a few short ones a run); None: the
    table has none."""
    try:
        return spark.read.schema(_ENTRY).json(f"{path}.published").collect()
    except Exception as exc:
        if _missing(exc):
            return None
        raise


def _counting(spark: SparkSession, path: str) -> list:
    entries = _entries(spark, path) or []
    replaced = {old for e in entries for old in e.replaces}
    return [e for e in entries if e.load_id not in replaced]


def published_loads(spark: SparkSession, path: str) -> dict[str, int]:
    """Ids of the loads that count, with their rows."""
    return {e.load_id: e.rows for e in _counting(spark, path)}


def is_managed(spark: SparkSession, path: str) -> bool:
    return _entries(spark, path) is not None


def _sketch_path(path: str, load_id: str) -> str:
    return f"{path}.keys/{LOAD_ID}={load_id}"


def publish_load(
    df: DataFrame, path: str, load_id: str, partition_by: Sequence[str] = (), replaces: Sequence[str] = (), sketch: Sequence[str] = ()
) -> int:
    """Write rows as a load and publish it. Returns its rows, which are
    counted by the write itself. ``sketch``: columns whose values a sketch
    beside the load tells; it is whole before the load is named."""
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{path}/{LOAD_ID}={load_id}")
    rows = seen.get["rows"]
    level = levels_for(rows) if sketch and rows else None
    if level is not None:
        written = df.sparkSession.read.schema(df.schema).option("basePath", path).parquet(f"{path}/{LOAD_ID}={load_id}")
        write_sketch(written, sorted(sketch), level, _sketch_path(path, load_id))
    publish_line(df.sparkSession, path, load_id, rows, partition_by, replaces, sketch, level)
    return rows


def publish_line(
    spark: SparkSession, path: str, load_id: str, rows: int, layout: Sequence[str] = (), replaces: Sequence[str] = (),
    sketch: Sequence[str] = (), level: int | None = None,
) -> None:
    """Name a load that is written as a whole."""

    def names(values: Sequence[str]) -> Column:
        return F.array(*map(F.lit, values)).cast("array<string>")

    line = spark.range(1).select(
        F.lit(load_id).alias(LOAD_ID), F.lit(rows).cast("long").alias("rows"), names(layout).alias("layout"), names(replaces).alias("replaces"),
        names(sketch).alias("sketch"), F.lit(level).cast("int").alias("level"),
    )
    line.coalesce(1).write.mode("append").json(f"{path}.published")


def read_published(spark: SparkSession, path: str, schema, only: Callable[[str], bool] | None = None) -> DataFrame:
    """Rows of the published loads (``only``: of those whose id it accepts);
    an absent table reads as empty. Loads of one folder layout are one scan."""
    scans: dict[tuple[str, ...], list[str]] = {}
    for e in _counting(spark, path):
        if e.rows and (only is None or only(e.load_id)):
            scans.setdefault(tuple(e.layout), []).append(f"{path}/{LOAD_ID}={e.load_id}")
    out = None
    for folders in scans.values():
        rows = spark.read.schema(schema).option("basePath", path).parquet(*folders).select(*schema.fieldNames())
        out = rows if out is None else out.unionByName(rows)
    return spark.createDataFrame([], schema) if out is None else out


def read_may_hold(spark: SparkSession, path: str, schema, candidates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the published loads that may hold one of the candidates' keys:
    those whose sketch does not rule all of them out, and those without a
    sketch of these columns. A table of plain files, and candidates that lack
    a key column, give all rows. Finding the loads runs a job over the
    candidates' distinct keys and the sketches."""
    if not is_managed(spark, path):
        return read_stored(spark, path, schema)
    if set(keys) - set(candidates.columns):
        return read_published(spark, path, schema)
    told = {e.load_id: (e.level, _sketch_path(path, e.load_id)) for e in _counting(spark, path) if e.level is not None and sorted(e.sketch) == sorted(keys)}
    hits = loads_that_may_hold(spark, candidates, sorted(keys), schema, told)
    return read_published(spark, path, schema, lambda load_id: load_id not in told or load_id in hits)


def read_stored(spark: SparkSession, path: str, schema, fmt: str = "parquet") -> DataFrame:
    """A stored table: its published loads, or, for a folder that never had a
    load, the plain files in it. The load folders of a table without any line
    are cut-off loads and don't count."""
    if fmt == "parquet" and is_managed(spark, path):
        return read_published(spark, path, schema)
    plain = read_table(spark, path, StructType([*schema.fields, StructField(LOAD_ID, StringType())]), fmt)
    return plain.where(F.col(LOAD_ID).isNull()).select(*schema.fieldNames())


def adopt(spark: SparkSession, path: str, schema, partition_by: Sequence[str] = ()) -> None:
    """Publish the plain files of a table as its first load, so that loads can
    follow. Does nothing for a table that has a manifest or no rows."""
    if not is_managed(spark, path):
        plain = read_stored(spark, path, schema)
        if not plain.isEmpty():
            publish_load(plain, path, new_load_id(), partition_by)


def compact(spark: SparkSession, path: str, schema, partition_by: Sequence[str] = (), keep: int = 1) -> bool:
    """Make one load of all, if there are more than ``keep``."""
    held = published_loads(spark, path)
    if len(held) <= keep:
        return False
    rows = read_published(spark, path, schema)
    sketches = {tuple(e.sketch or ()) for e in _counting(spark, path)}
    if partition_by:
        rows = rows.repartition(*partition_by)  # one file a folder, or as many as AQE cuts a large one into
    publish_load(rows, path, new_load_id(), partition_by, replaces=list(held), sketch=sketches.pop() if len(sketches) == 1 else ())
    return True


def vacuum(spark: SparkSession, path: str) -> list[str]:
    """Delete the folders and sketches of loads that don't count (cut off or
    replaced); returns their ids. Not while a load runs or a reader of an older state does."""
    held = published_loads(spark, path)
    hadoop = spark._jvm.org.apache.hadoop.fs
    gone = []
    for root in (path, f"{path}.keys"):
        folder = hadoop.Path(root)
        fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        for status in fs.listStatus(folder) if fs.exists(folder) else []:
            name = status.getPath().getName()
            if name.startswith(f"{LOAD_ID}=") and name.removeprefix(f"{LOAD_ID}=") not in held:
                fs.delete(status.getPath(), True)
                gone.append(name.removeprefix(f"{LOAD_ID}="))
    return sorted(set(gone))
