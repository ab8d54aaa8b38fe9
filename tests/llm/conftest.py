from __future__ import annotations

import os

import pytest

SF = "/root/testdata/sf0.001"

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows, extra: dict | None = None):
    """Documents from (doc_id, text[, source]); ``extra``: constant columns."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, DOCS)
    from pyspark.sql import functions as F

    for name, value in (extra or {}).items():
        df = df.withColumn(name, F.lit(value))
    return df


#: Columns whose names the operators use themselves.
CLASHING = {
    "key": 1, "size": "x", "source_size": 2, "target": "t", "copies": 3, "taken": 4, "score": 0.1, "predicted": 7, "n_lines": 1,
    "n_removed": "y", "removed": 1, "unit": 2, "rank": 3, "node": 4, "n": 5, "block": 6, "row": 7, "text_key": 8, "__key": 9, "bucket": 1,
}

#: Nulls, empty and blank texts, ties and repeated rows, a very long text.
ODD = [
    (None, "a text without an id that has some words"),
    (1, None),
    (2, ""),
    (3, "  \n\t "),
    (4, "same words in both of these rows here"),
    (4, "same words in both of these rows here"),
    (5, "same words in both of these rows here", None),
    (6, "long " * 60_000),
    (7, "x" * 200_000),
    (8, "one"),
]


@pytest.fixture(scope="session")
def odd(spark):
    return documents(spark, ODD)


@pytest.fixture(scope="session")
def odd_clashing(spark):
    return documents(spark, ODD, CLASHING)


@pytest.fixture(scope="session")
def empty(spark):
    return documents(spark, [])


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    return SF
