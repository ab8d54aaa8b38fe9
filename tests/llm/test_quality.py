from __future__ import annotations

import zlib

import numpy as np

from raceline.llm import quality, queries
from tests.llm.conftest import documents


def test_discriminant_equals_densities():
    """The margin is the difference of the two log-densities."""
    rng = np.random.default_rng(0)
    d = len(quality.FEATURES)
    covs = [np.cov(rng.standard_normal((d, 60))) for _ in range(2)]
    means = [rng.standard_normal(d) for _ in range(2)]
    factors = [np.linalg.cholesky(c) for c in covs]
    model = quality.Discriminant(
        np.zeros(d), np.ones(d), 50.0, tuple(means), tuple(map(np.linalg.inv, factors)), tuple(-np.log(np.diag(f)).sum() for f in factors), 1.0
    )
    x = rng.standard_normal((5, d))
    x[:, 0] = np.log1p([1e9] * 5)  # very long texts count whole
    log = [-0.5 * np.linalg.slogdet(c)[1] - 0.5 * np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m) for m, c in zip(means, covs)]
    assert np.allclose(model.margin(x), log[1] - log[0], rtol=1e-4)


def test_features():
    assert (quality.features("") == 0).all() and (quality.features(" \n") == 0).all()
    long = quality.features("word " * 100_000 + "x" * 100_000)
    assert np.isfinite(long).all()


def test_held_out_accuracy_and_what_is_seen(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = {r["doc_id"]: r for r in quality.quality_scores(docs, labels).collect()}
    assert len(got) == docs.count()
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
    unseen = [i for i in truth if got[i]["held_out"]]
    assert np.mean([got[i]["predicted"] == truth[i] for i in unseen]) > 0.95
    # other labels of held-out rows, and other ids, languages and sources, change nothing
    flipped = labels.withColumn("quality", quality.F.when(quality.held_out(), 1 - quality.F.col("quality")).otherwise(quality.F.col("quality")))
    again = quality.quality_scores(docs.withColumn("lang", quality.F.lit("?")).withColumn("source", quality.F.lit(None)), flipped)
    assert {r["doc_id"]: round(r["score"], 9) for r in again.collect()} == {i: round(r["score"], 9) for i, r in got.items()}


def test_odd_rows(spark, odd, odd_clashing, empty):
    labels = spark.createDataFrame([(4, 1), (6, 0), (7, 0), (8, 1), (None, 1), (5, None), (2, 0), (2, 1)], "doc_id long, quality int")
    got = quality.quality_scores(odd, labels)
    assert got.count() == 10 and got.where("score is null or score < 0 or score > 1").count() == 0
    rows = quality.quality_rows(odd_clashing, labels)
    assert rows.count() == 10 and sorted(rows.columns) == sorted(odd_clashing.columns)
    assert quality.quality_scores(empty, labels).count() == 0
    no_labels = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in quality.quality_scores(odd, no_labels).collect()} == {0.5}


def test_rows_and_scores_agree(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    by_id = {r["doc_id"]: r["predicted"] for r in queries.op4_quality_classifier(spark, sf).collect()}
    assert {r["doc_id"]: r["predicted"] for r in quality.quality_rows(docs, labels).collect()} == by_id


def test_empty_text_is_scored(spark):
    docs = documents(spark, [(i, f"Some words, number {i}. And more of them.") for i in range(20)] + [(100 + i, "### $$$ %%% &&& " * (i + 1)) for i in range(20)] + [(500, "")])
    labels = spark.createDataFrame([(i, 1) for i in range(20)] + [(100 + i, 0) for i in range(20)], "doc_id long, quality int")
    got = {r["doc_id"]: r["predicted"] for r in quality.quality_scores(docs, labels).collect()}
    assert 500 in got and all(got[i] == 1 for i in range(20)) and not any(got[100 + i] for i in range(5, 20))
