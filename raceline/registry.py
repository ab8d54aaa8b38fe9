"""Query registry: key -> callable(spark, sf_dir) -> DataFrame, and the
matching DuckDB oracle statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from raceline import oracle
from raceline.plans import examples, ingest_views, intermediate, marts, staging
from raceline.sources.fixtures import raw_tables

Query = Callable[[SparkSession, str], DataFrame]

MODEL_FUNCTIONS = {**staging.MODELS, **intermediate.MODELS, **marts.MODELS, **examples.MODELS}


def _over_raw(fn) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(raw_tables(spark, sf_dir))

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {name: _over_raw(fn) for name, fn in MODEL_FUNCTIONS.items()}
    out.update({name: ingest_views.view_query(name) for name in ingest_views.VIEWS})
    return out


def oracle_sql() -> dict[str, str]:
    return {name: oracle.oracle(name) for name in queries() if name in oracle.MODELS}
