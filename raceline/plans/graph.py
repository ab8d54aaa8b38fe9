"""The model graph: models that several others read are written once per run.

Model functions call each other with the raw tables. Called with a
``ModelRun`` instead, a model that the run has written already reads its table,
and every call is noted, which gives the edges of the graph. ``build_models``
finds the models that have several readers, writes them in dependency order,
then the models asked for, all into one folder of the run, and names that
folder last. Readers go by the name: a run that dies leaves the version before
it as it was.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from raceline.sources.manifest import LOAD_ID, new_load_id, publish_line, published_loads


class ModelRun(Mapping[str, DataFrame]):
    """Raw tables, the models that are written so far (``built``) and the
    calls between models: ``readers[m]`` is who has called ``m``, ``order``
    the models in dependency order."""

    def __init__(self, raw: Mapping[str, DataFrame]):
        self.raw = raw
        self.built: dict[str, DataFrame] = {}
        self.readers: dict[str, set[str]] = {}
        self.order: list[str] = []
        self._open: list[str] = [""]

    def __getitem__(self, name: str) -> DataFrame:
        return self.raw[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self.raw)

    def __len__(self) -> int:
        return len(self.raw)

    def call(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        self.readers.setdefault(name, set()).add(self._open[-1])
        if name in self.built:
            return self.built[name]
        self._open.append(name)
        try:
            df = make()
        finally:
            self._open.pop()
        if name not in self.order:
            self.order.append(name)
        return df


def model(fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Marks a model function, a node of the graph. With options the function
    is called as it is."""

    @wraps(fn)
    def node(raw: Mapping[str, DataFrame], *args, **options) -> DataFrame:
        if isinstance(raw, ModelRun) and not args and not options:
            return raw.call(fn.__name__, lambda: fn(raw))
        return fn(raw, *args, **options)

    return node


def shared_models(models: Mapping[str, Callable], names: Iterable[str], raw: Mapping[str, DataFrame]) -> list[str]:
    """The models that at least two models of a run for ``names`` read, in
    dependency order. Only plans are built."""
    trace = ModelRun(raw)
    for name in names:
        models[name](trace)
    return [m for m in trace.order if len(trace.readers[m] - {""}) > 1 and m in models]


def build_models(
    spark: SparkSession, models: Mapping[str, Callable], names: Iterable[str], raw: Mapping[str, DataFrame], root: str, partition_by: Mapping[str, Iterable[str]] | None = None
) -> list[str]:
    """Write ``names`` and the models that several of them read below
    ``root``, each once, and make this the current version; returns the
    models written, in order."""
    names, run_id = list(dict.fromkeys(names)), new_load_id()
    shared = shared_models(models, names, raw)
    run = ModelRun(raw)
    written = list(dict.fromkeys([*shared, *names]))
    for name in written:
        df = models[name](run)
        writer = df.write.mode("errorifexists")
        if partition_by and partition_by.get(name):
            writer = writer.partitionBy(*partition_by[name])
        path = f"{root}/{LOAD_ID}={run_id}/{name}"
        writer.parquet(path)
        run.built[name] = spark.read.schema(df.schema).parquet(path)
    publish_line(spark, root, run_id, len(written), replaces=list(published_loads(spark, root)))
    return written


def read_model(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A model's table in the current version."""
    current = list(published_loads(spark, root))
    if not current:
        raise FileNotFoundError(f"{root} has no finished run")
    return spark.read.parquet(f"{root}/{LOAD_ID}={current[-1]}/{name}")
