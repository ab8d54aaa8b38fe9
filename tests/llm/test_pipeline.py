from __future__ import annotations

from collections import Counter

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from raceline.llm import line_dedup, mixing, ngram_join, packing, quality  # noqa: E402
from raceline.llm.common import read  # noqa: E402
from tests.llm.conftest import CLASHING, ODD, documents  # noqa: E402
from tests.llm.test_line_dedup import cut_by_maximal_runs  # noqa: E402
from tests.llm.test_ngram_join import brute as brute_links  # noqa: E402


def rows(df):
    return Counter(tuple(r) for r in df.select("doc_id", "text", "source").collect())


def test_each_stage_on_its_own_input(spark, sf):
    docs = read(spark, sf, "documents")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality classifier", "line dedup", "n-gram Jaccard join", "source mixing", "best-fit packing"]

    kept = stages["quality classifier"](spark, docs, sf)
    scores = quality.quality_scores(docs, read(spark, sf, "labels")).where("predicted = 1")
    good = {r["doc_id"] for r in scores.collect()}
    assert rows(kept) == Counter({k: n for k, n in rows(docs).items() if k[0] in good})

    cut = stages["line dedup"](spark, docs, sf)
    texts = cut_by_maximal_runs([(r["doc_id"], r["text"]) for r in docs.collect() if r["text"] is not None], line_dedup.MIN_WORDS)
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert {r["doc_id"]: r["text"] for r in cut.collect()} == {i: t for i, t in texts.items() if t == before[i] or t.split()}

    alone = stages["n-gram Jaccard join"](spark, docs, sf)
    want = {i for i, n, c in brute_links([(r["doc_id"], r["text"]) for r in docs.collect()]) if n == 0 or i == c}
    assert rows(alone) == Counter({k: n for k, n in rows(docs).items() if k[0] in want})

    mixed = stages["source mixing"](spark, docs, sf)
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(docs).collect()}
    assert rows(mixed) == Counter({k: copies[k[0]] for k in rows(docs) if copies[k[0]]})

    for stage in list(stages.values())[:4]:
        assert stage(spark, docs, sf).columns == docs.columns
    packed = stages["best-fit packing"](spark, docs, sf)
    assert Counter(map(tuple, packed.drop("sequence_id", "offset").collect())) == Counter(map(tuple, packing.pack(docs).drop("sequence_id", "offset").collect()))


def test_stages_take_odd_rows(spark, sf):
    for extra in ({}, CLASHING):
        odd = documents(spark, ODD, extra)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, odd, sf)
            assert out.count() <= len(ODD) * (1 if name != "best-fit packing" else 40), name
            if name == "best-fit packing":  # a piece for every 2048 tokens that a document has begun
                per_doc = packing.pack(odd).groupBy("doc_id", "length").count().agg({"count": "sum"}).first()[0]
                assert out.count() == per_doc
    found = corpus_pipeline.keep_one_of_each_group(spark, documents(spark, ODD), sf).collect()
    # the repeated row and the copy under another id go
    assert sorted((r["doc_id"] for r in found), key=str) == [1, 2, 3, 4, 6, 7, 8, None]
    empty = documents(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf).count() == 0


def test_run(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    assert out.count() > 0 and {"doc_id", "sequence_id", "offset"} <= set(out.columns)
    assert ngram_join.SHINGLE_WORDS == 5
