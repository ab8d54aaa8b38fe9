"""Materialisation of the models: named views and written tables.

``register_views`` publishes every model (and the raw tables) as a temporary
view under its model name, so SQL users query ``final_race_leaderboard`` or
``stg_laps`` by name exactly as they did against the warehouse; the views
are lazy, each query is planned end to end by Catalyst. ``materialize`` writes
one model as a table and ``build_tables`` the model graph (``plans.graph``):
in both the new version is named last, and the one before it stays readable
until then.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from raceline.plans import examples, intermediate, marts, staging
from raceline.plans.graph import build_models
from raceline.sources.manifest import new_load_id, publish_load, published_loads

MODELS = {**staging.MODELS, **intermediate.MODELS, **marts.MODELS, "example_union": examples.example_union,
          "example_filter": examples.example_filter}


def register_views(
    spark: SparkSession, raw: Mapping[str, DataFrame], names: Iterable[str] | None = None, raw_prefix: str = "raw_"
) -> list[str]:
    """Create or replace a temporary view per model (and ``raw_<table>`` per
    raw table); returns the view names."""
    created = []
    for table, df in raw.items():
        df.createOrReplaceTempView(f"{raw_prefix}{table}")
        created.append(f"{raw_prefix}{table}")
    for name in names or MODELS:
        MODELS[name](raw).createOrReplaceTempView(name)
        created.append(name)
    return created


def materialize(df: DataFrame, path: str, partition_by: Iterable[str] = ()) -> int:
    """Write a model as a table, a new version in place of the one before;
    returns its rows. ``manifest.read_published`` reads the current version,
    ``manifest.vacuum`` deletes the older ones."""
    old = list(published_loads(df.sparkSession, path))
    return publish_load(df, path, new_load_id(), list(partition_by), replaces=old)


def build_tables(spark: SparkSession, raw: Mapping[str, DataFrame], root: str, names: Iterable[str] | None = None) -> list[str]:
    """Write models (default: all marts) and what several of them read;
    ``graph.read_model`` reads them."""
    return build_models(spark, {**MODELS, "lap_position_samples": intermediate.lap_position_samples}, names or marts.MODELS, raw, root)
