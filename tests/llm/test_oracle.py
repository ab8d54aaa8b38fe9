"""The queries that SQL can express against their DuckDB text."""

from __future__ import annotations

import pytest

from raceline.llm import queries
from tests.oracle_check import compare, duck_connection


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_oracle(spark, sf, name):
    result = compare(spark, name, sf, duck_connection(sf))
    assert result.get("match"), result
