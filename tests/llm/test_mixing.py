from __future__ import annotations

import random
from collections import defaultdict

from pyspark.sql import functions as F

from raceline.llm import mixing, queries
from tests.llm.conftest import documents


def fill(sizes: dict, weights=(1, 2, 3), most=3.0):
    """Targets by resharing until none is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total >= most * sizes[s]]
        if not over:
            return target | {s: left * weight[s] / total for s in open_}
        for s in over:
            target[s] = most * sizes[s]
        left -= sum(target[s] for s in over)
        open_ -= set(over)
    return target


def test_targets_reshare_the_excess(spark):
    sizes = {"a": 1000, "b": 10, "c": 3, "d": 400, None: 7, "é": 0}
    rows = spark.createDataFrame([(s, n, 1) for s, n in sizes.items()], "source string, size long, n_rows long")
    got = {r["source"]: r["target"] for r in mixing.targets(rows).collect()}
    want = fill(sizes)
    assert got.keys() == want.keys()
    for s in want:
        assert abs(got[s] - want[s]) < 1e-6


def test_targets_of_tied_sources(spark):
    for sizes in ({f"s{i}": 100 for i in range(6)}, {f"s{i:03}": 20 for i in range(300)}, {"a": 10, "b": 20, "c": 30, "d": 1, "e": 2, "f": 3}):
        rows = spark.createDataFrame([(s, n, 1) for s, n in sizes.items()], "source string, size long, n_rows long")
        got = {r["source"]: r["target"] for r in mixing.targets(rows).collect()}
        want = fill(sizes)
        assert abs(sum(got.values()) - sum(sizes.values())) < 1e-6
        assert all(abs(got[s] - want[s]) < 1e-6 for s in want)


def check(rows, sizes_of):
    by_source = defaultdict(list)
    for r in rows:
        assert r["size"] == sizes_of(r) and r["taken"] % max(1, r["size"]) == 0 and 0 <= r["taken"] <= 3 * r["size"]
        by_source[r["source"]].append(r)
    want = fill({s: sum(r["size"] for r in v) for s, v in by_source.items()})
    for s, v in by_source.items():
        assert abs(v[0]["target"] - want[s]) < 1e-6 * max(1, want[s])
        assert v[0]["source_size"] == sum(r["size"] for r in v)
        each = want[s] / max(1, v[0]["source_size"])
        for r in v:  # copies are the expected number rounded down or up
            if r["size"]:
                assert int(each + 1e-9) <= r["taken"] // r["size"] <= int(each + 1 - 1e-9)
        assert abs(sum(r["taken"] for r in v) - want[s]) <= max(r["size"] for r in v)
    return by_source, want


def test_mix_meets_targets_and_reruns_agree(spark):
    random.seed(5)
    rows = [(i, "w " * int(random.lognormvariate(4, 1)), random.choice(["x", "x", "x", "y", "z", None])) for i in range(1500)]
    docs = documents(spark, rows)
    got = mixing.mix(docs).collect()
    by_source, want = check(got, lambda r: len(rows[r["doc_id"]][1].split()))
    for s, v in by_source.items():
        assert abs(sum(r["taken"] for r in v) / want[s] - 1) < 0.01
    again = mixing.mix(docs.repartition(7)).collect()
    assert {(r["doc_id"], r["taken"]) for r in got} == {(r["doc_id"], r["taken"]) for r in again}


def test_levels_of_the_tree(spark, monkeypatch):
    monkeypatch.setattr(mixing, "FAN_IN", 5)
    rows = [(i, "w " * (1 + i % 40), "xy"[i % 7 == 0]) for i in range(700)]
    check(mixing.mix(documents(spark, rows)).collect(), lambda r: len(rows[r["doc_id"]][1].split()))


def test_copies_have_the_expected_frequency(spark):
    docs = documents(spark, [(i, "w " * (1 + i % 5), "ab"[i % 2]) for i in range(40)])
    total = 0
    for seed in range(6):
        total += mixing.mix(docs, seed=seed).where("source = 'a'").agg(F.sum("copies")).first()[0]
    assert abs(total / 6 / 20 - 2 / 3) < 0.12


def test_copies_of_each_document_over_many_seeds(spark):
    """Equal sizes, a tenth of a copy each: 3 sigma over 200 drawings, by
    quarters of the ids and for the documents one by one."""
    unit = F.struct(F.lit(10).cast("long").alias("size"), F.col("id").alias("doc_id"), F.lit(10).cast("long").alias("words"), F.lit(0.1).alias("p"))
    blocks = spark.range(20).select(unit.alias("unit")).agg(F.sort_array(F.collect_list("unit"), asc=False).alias("units")).cache()
    taken = [0] * 20
    for seed in range(200):
        out = blocks.select(mixing._settled(F.col("units"), "bigint", seed).alias("out")).select("out.*").first()
        for d in out["done"]:
            taken[d["doc_id"]] += d["x"]
        taken[out["carry"]["doc_id"]] += round(out["carry"]["p"])
    assert sum(taken) == 400  # two copies in each drawing
    for q in range(4):
        assert abs(sum(taken[5 * q : 5 * q + 5]) / 1000 - 0.1) < 3 * (0.1 * 0.9 / 1000) ** 0.5
    assert all(abs(n / 200 - 0.1) < 4 * (0.1 * 0.9 / 200) ** 0.5 for n in taken)


def test_odd_rows(spark, odd, odd_clashing, empty):
    got = mixing.mix(odd).collect()
    assert len(got) == 10
    assert {r["doc_id"]: r["size"] for r in got}[6] == 60_000 and all(r["taken"] == 0 for r in got if r["size"] == 0)
    assert len({r["taken"] for r in got if r["doc_id"] == 4}) == 1
    check(got, lambda r: len((r["text"] or "").split()))
    assert sorted(mixing.mix(odd_clashing).columns) == sorted({*odd_clashing.columns, "size", "source_size", "target", "copies", "taken"})
    assert {(r["doc_id"], r["taken"]) for r in mixing.mix(odd_clashing).collect()} == {(r["doc_id"], r["taken"]) for r in got}
    assert mixing.mix(empty).count() == 0
    only_blank = documents(spark, [(1, ""), (2, None)])
    assert [r["taken"] for r in mixing.mix(only_blank).collect()] == [0, 0]
    assert mixing.mixed_rows(mixing.mix(odd)).count() == sum(r["copies"] for r in got)


def test_query(spark, sf):
    rows = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in queries.op2_source_mixing(spark, sf).collect():
        assert r["size"] == len((rows[r["doc_id"]]["text"] or "").encode().split())
