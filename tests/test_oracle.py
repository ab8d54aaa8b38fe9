"""Every registered query against its DuckDB oracle (sf0.001), plus the
driver's smoke entry."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from raceline import registry
from tests.oracle_check import compare, duck_connection

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SMOKE)


def test_every_query_has_an_oracle():
    assert set(registry.queries()) == set(registry.oracle_sql()) <= set(entry.queries())
    assert len(registry.queries()) == 70


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_oracle(spark, duck, name):
    result = compare(spark, name, SMOKE, duck)
    assert result.get("match"), result


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[:4] == ["session_key", "driver_number", "driver_name", "position"]
    assert df.count() > 0


@pytest.mark.parametrize("name", ["int_lap_position", "int_tyre_stints_weather", "final_historical_analysis",
                                  "final_race_leaderboard", "chunk_filter", "load_location", "dedup_keep_first"])
def test_shuffle_join_plans_match_oracle(spark, duck, name):
    """The cluster-scale plan shape: no broadcast, every join shuffles."""
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        result = compare(spark, name, SMOKE, duck)
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert result.get("match"), result
