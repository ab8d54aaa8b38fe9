"""Helpers shared by the operators: table reads, scratch tables in the shared
checkpoint folder, the word definition."""

from __future__ import annotations

import math
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

import raceline
from raceline.session import checkpoint_dir

#: A word is a maximal run of anything but ASCII white space (fixed value).
WORD = "[^\\x20\\x09-\\x0D]+"


def ship_package(spark: SparkSession) -> None:
    """Hand the package to the Python workers (once per session), unless they
    find it by PYTHONPATH."""
    root = Path(raceline.__file__).resolve().parent.parent
    context = spark.sparkContext
    if str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or hasattr(context, "_raceline_shipped"):
        return
    archive = f"{tempfile.mkdtemp(prefix='raceline-code-')}/raceline.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted((root / "raceline").rglob("*.py")):
            out.write(source, source.relative_to(root))
    context.addPyFile(archive)
    context._raceline_shipped = archive


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def pieces(total: int, each: int) -> int:
    """How many pieces of about ``each`` rows ``total`` rows make; at least one."""
    return max(1, math.ceil(total / each))


class Scratch:
    """Tables of one operator run, as Parquet below the session's shared
    checkpoint folder. A written table cuts the lineage: a lost executor's
    tasks read it again instead of recomputing what stands before it.

    ``drop`` deletes a table that no later step reads. What the returned
    DataFrame still reads stays until the folder is cleaned."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/raceline-llm/{name}-{uuid.uuid4().hex}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def grouped(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """The groups of rows that stand together by ``keys`` in a stream of
    batches (partitions sorted by the keys), one table each. Only the current
    group and batch are held."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        columns = [np.asarray(b.column(b.schema.get_field_index(k))) for k in keys]
        new = np.zeros(b.num_rows, bool)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        starts = [0, *np.flatnonzero(new).tolist(), b.num_rows]
        for i, (start, end) in enumerate(zip(starts, starts[1:])):
            part = b.slice(start, end - start)
            if i == 0 and held and all(held[-1].column(k)[-1] == part.column(k)[0] for k in keys):
                held.append(part)
                continue
            if held:
                yield pa.Table.from_batches(held)
            held = [part]
    if held:
        yield pa.Table.from_batches(held)


def slabs(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """Whole groups of rows by ``keys`` in a stream of sorted batches, as many
    at once as a batch holds. Only a batch and the group that it breaks off in
    are held."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        same = np.ones(b.num_rows, bool)  # rows of the last group
        for k in keys:
            c = b.column(k)
            same &= np.asarray(c) == c[-1].as_py()
        cut = b.num_rows - int(np.argmin(same[::-1])) if not same.all() else 0
        if cut or (held and any(held[-1].column(k)[-1] != b.column(k)[0] for k in keys)):
            if held or cut:
                yield pa.Table.from_batches([*held, b.slice(0, cut)])
            held = [b.slice(cut)]
        else:
            held.append(b)
    if held:
        yield pa.Table.from_batches(held)
