"""Plan properties of the registered queries (the claims of PLANS.md)."""

from __future__ import annotations

import contextlib
import io

import pytest

import __spark_entry__ as entry
from raceline import registry

SMOKE = "/root/testdata/sf0.001"
FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "MapInPandas")


def _plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_no_python_no_cartesian(spark, name):
    plan = _plan(entry.queries()[name](spark, SMOKE))
    assert not [op for op in FORBIDDEN if op in plan], name


def test_telemetry_streams_through_broadcast_dimensions(spark):
    plan = _plan(entry.queries()["final_car"](spark, SMOKE))
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_scans_read_only_used_columns(spark):
    plan = _plan(entry.queries()["stg_car_data"](spark, SMOKE))
    schema = [line for line in plan.splitlines() if line.strip().startswith("ReadSchema")][0]
    assert "l_extendedprice" not in schema and "l_shipdate" not in schema
