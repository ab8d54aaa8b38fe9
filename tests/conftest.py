from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from raceline import schemas  # noqa: E402
from raceline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="raceline-test-")
    session = build_session(
        "local[4]",
        app_name="raceline-tests",
        shuffle_partitions=8,
        conf={"spark.checkpoint.dir": f"{scratch}/ckpt", "spark.local.dir": scratch},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


def ts(text: str) -> dt.datetime:
    """Naive UTC instant (the session time zone is UTC)."""
    return dt.datetime.fromisoformat(text)


def frame(spark, table: str, rows: list[dict]):
    """A raw table from dicts; absent fields are NULL."""
    names = schemas.columns(table)
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schemas.RAW[table])


def raw_of(spark, **tables):
    """A full raw mapping: given tables from dicts, all others empty."""
    return {name: frame(spark, name, tables.get(name, [])) for name in schemas.RAW}
