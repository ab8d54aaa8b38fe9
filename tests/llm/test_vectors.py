from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from raceline.llm import binary_codes, neighbour_graph, queries

VECTORS = "vec_id long, embedding array<float>, label int"
ODD = [
    (1, None, 0), (2, [], 0), (3, [0.0, 0.0, 0.0], 0), (4, [1.0, None, 0.0], 0), (5, [float("nan"), 1.0, 0.0], 0), (6, [float("inf"), 1.0, 0.0], 0),
    (7, [1.0, 0.0, 0.0], 0), (8, [2.0, 0.0, 0.0], 0), (9, [1.0, 0.0, 0.0], 1), (9, [1.0, 0.0, 0.0], 1), (20, [0.0, 1.0, 0.0], 2),
    (None, [0.0, 1.0, 0.1], 2), (11, [1.0, 0.0], 2), (40, [0.0, 0.0, -1.0], None),
]


def brute_links(rows, threshold=0.9):
    good = [i for i, (_, v, *_) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = {i: set() for i in range(len(rows))}
    for a in good:
        for b in good:
            x, y = (np.asarray(rows[k][1], np.float32).astype(float) for k in (a, b))
            if a != b and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                links[a].add(b)
    out = []
    for i, row in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        ids = [rows[k][0] for k in seen if rows[k][0] is not None]
        least = min(ids) if ids else None
        out.append((row[0], len(links[i]), least, row[0] is not None and row[0] == least))
    return sorted(out, key=str)


def clustered(seed, n=600, dim=32):
    rng = np.random.default_rng(seed)
    centers = rng.standard_normal((25, dim))
    x = np.where(rng.random((n, 1)) < 0.5, centers[rng.integers(0, 25, n)] + rng.standard_normal((n, dim)) * rng.choice([0.01, 0.1, 0.25, 0.4], (n, 1)), rng.standard_normal((n, dim)))
    x[5] = x[3]
    return [(i, [float(v) for v in np.float32(row)], 0) for i, row in enumerate(x)]


@pytest.mark.parametrize("piece", [2000, 40])
def test_near_duplicates_against_brute_force(spark, monkeypatch, piece):
    monkeypatch.setattr(binary_codes, "PIECE", piece)
    rows = clustered(1)
    got = sorted((tuple(r) for r in binary_codes.near_duplicates(spark.createDataFrame(rows, VECTORS)).collect()), key=str)
    want = brute_links(rows)
    found, all_ = sum(r[1] for r in got), sum(r[1] for r in want)
    assert all(g[0] == w[0] and g[1] <= w[1] for g, w in zip(got, want)) and found >= 0.995 * all_
    if found == all_:
        assert got == want


def test_near_duplicates_of_odd_rows(spark):
    got = binary_codes.near_duplicates(spark.createDataFrame(ODD, VECTORS)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_links(ODD)
    clashing = spark.createDataFrame(ODD, VECTORS).withColumns({c: F.lit(1) for c in ("node", "id", "dim", "copies", "keys", "code", "n_links", "links")})
    assert sorted((tuple(r) for r in binary_codes.near_duplicates(clashing).collect()), key=str) == brute_links(ODD)
    assert binary_codes.near_duplicates(spark.createDataFrame([], VECTORS)).count() == 0


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(3)
    dim, n = 64, 4000
    x = rng.standard_normal((n, dim))
    y = x * 0.8 + rng.standard_normal((n, dim)) * 0.6
    x, y = (v / np.linalg.norm(v, axis=1)[:, None] for v in (x, y))
    code, factor = binary_codes.encode(x)
    turned = (y @ binary_codes.rotation(dim, 0).T).astype(np.float32)
    error = binary_codes.upper_bounds(code, factor, turned, 0.0) - np.einsum("ij,ij->i", x, y)
    assert abs(error.mean()) < 0.01
    assert (binary_codes.upper_bounds(code, factor, turned, 4.0) >= np.einsum("ij,ij->i", x, y)).mean() > 0.999


def test_sketches_never_rule_out_more_than_the_codes():
    rng = np.random.default_rng(5)
    for dim in (1, 5, 64):
        x, y = (v / np.linalg.norm(v, axis=1)[:, None] for v in rng.standard_normal((2, 500, dim)))
        code, factor, turned, rest = binary_codes.read_sketches(binary_codes.sketch(y), dim)
        exact = y @ binary_codes.rotation(dim, 0).T
        assert np.allclose(np.linalg.norm(turned - exact, axis=1), rest, atol=1e-5)
        own, f = binary_codes.encode(x)
        assert (code == binary_codes.encode(y)[0]).all() and np.allclose(factor, binary_codes.encode(y)[1])
        plain = binary_codes.upper_bounds(own, f, exact.astype(np.float32), 4.0)
        assert (binary_codes.upper_bounds(own, f, turned, 4.0) + rest / f >= plain - 1e-5).all()


def test_near_duplicates_just_above_the_threshold(spark):
    """Half of 4,000 vectors have a partner at a cosine of 0.9 to 0.92."""
    rng = np.random.default_rng(11)
    x = rng.standard_normal((3000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    other = rng.standard_normal((1000, 64))
    other -= np.einsum("ij,ij->i", other, x[:1000])[:, None] * x[:1000]
    other /= np.linalg.norm(other, axis=1)[:, None]
    cos = rng.uniform(0.9001, 0.92, 1000)[:, None]
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([x, cos * x[:1000] + np.sqrt(1 - cos**2) * other]))]
    got = {r["vec_id"]: r for r in binary_codes.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert sum(got[3000 + i]["component_id"] == i for i in range(1000)) >= 990
    assert all(got[i]["n_links"] == 0 for i in range(1000, 3000))


def brute_nearest(rows, asks, top):
    good = {}
    for i, v, *_ in rows:
        if v and len(v) == 3 and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[(i, tuple(v))] = np.asarray(v, np.float32).astype(float)
    out = []
    for (q, v), x in good.items():
        if q is not None and asks(q):
            hits = sorted((-float(x @ y), i is not None, i or 0, i) for (i, w), y in good.items() if (i, w) != (q, v))[:top]
            out += [(q, k + 1, h[3], -h[0]) for k, h in enumerate(hits)]
    return sorted(out, key=str)


def test_nearest_of_odd_rows(spark):
    df = spark.createDataFrame(ODD, VECTORS)
    for frame in (df, df.withColumns({c: F.lit(1) for c in ("node", "id", "v", "asks", "dim", "rank", "score", "block", "vec")})):
        got = neighbour_graph.nearest(frame, F.col("vec_id") % 20 == 0, top=3).collect()
        assert sorted((tuple(r) for r in got), key=str) == brute_nearest(ODD, lambda q: q % 20 == 0, 3)
    none = neighbour_graph.nearest(spark.createDataFrame([], VECTORS), F.col("vec_id") % 20 == 0)
    assert none.count() == 0 and none.columns == ["query_id", "rank", "vec_id", "score"]


def test_nearest_recall(spark, monkeypatch):
    monkeypatch.setattr(neighbour_graph, "BLOCK", 300)
    monkeypatch.setattr(neighbour_graph, "HOME", 200)
    monkeypatch.setattr(neighbour_graph, "LEAF", 60)
    rows = clustered(2, n=1500)
    got = neighbour_graph.nearest(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 20 == 0).collect()
    x = np.array([r[1] for r in rows], np.float32).astype(float)
    lists = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        lists.setdefault(r["query_id"], []).append(r["vec_id"])
        assert abs(r["score"] - x[r["query_id"]] @ x[r["vec_id"]]) < 1e-12 and r["vec_id"] != r["query_id"]
    recall = []
    for q in range(0, 1500, 20):
        sims = x @ x[q]
        sims[q] = -np.inf
        recall.append(len(set(np.lexsort((np.arange(1500), -sims))[:20]) & set(lists[q])) / 20)
        assert len(lists[q]) == 20
    assert np.mean(recall) > 0.95


def test_descent_goes_on_until_it_settles(spark, monkeypatch):
    monkeypatch.setattr(neighbour_graph, "BLOCK", 1000)
    monkeypatch.setattr(neighbour_graph, "LEAF", 20)
    x = np.random.default_rng(6).standard_normal((3000, 32)).astype("<f2")
    nodes = spark.createDataFrame([(i, bytearray(v.tobytes()), 1.0) for i, v in enumerate(x)], "node long, vec binary, norm double")
    graph = neighbour_graph.build_graph(nodes, 32, neighbour_graph.Scratch(spark, "settle"), k=15, tables=2).collect()
    sims = x.astype(np.float32) @ x.astype(np.float32).T
    np.fill_diagonal(sims, -np.inf)
    best = np.argsort(-sims, axis=1)[:, :15]
    assert np.mean([len(set(best[r["node"]]) & set(r["ids"])) / 15 for r in graph]) > 0.9
    assert neighbour_graph.grown_beam(120, 10_000) == 120 and neighbour_graph.grown_beam(120, 160_000) == 240


def test_copies_give_the_smallest_ids(spark):
    rng = np.random.default_rng(8)
    x = rng.standard_normal((900, 16)).astype(np.float32)
    x[rng.permutation(900)[:300]] = 3 * x[0] / np.linalg.norm(x[0])  # more copies than a beam holds
    rows = [(i, [float(v) for v in row], 0) for i, row in enumerate(x)]
    got = {}
    for r in neighbour_graph.nearest(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    x = x.astype(float)
    same = np.unique(x, axis=0, return_inverse=True)[1].ravel()
    hit = {}
    for q in range(0, 900, 20):
        sims = np.round(x @ x[q], 9)
        sims[q] = -np.inf
        want = np.lexsort((np.arange(900), -sims))[:20].tolist()
        hit.setdefault(np.count_nonzero(same == same[q]) > 1, []).append(len(set(want) & {i for _, i in got[q]}) / 20)
    assert set(hit) == {False, True} and min(hit[True]) == 1 and np.mean(hit[False]) > 0.95


@pytest.mark.parametrize("case", ["outlier", "spread"])
def test_recall_with_mixed_norms(spark, monkeypatch, case):
    monkeypatch.setattr(neighbour_graph, "BLOCK", 400)
    monkeypatch.setattr(neighbour_graph, "LEAF", 60)
    rng = np.random.default_rng(10)
    x = rng.standard_normal((1500, 16)).astype(np.float32)
    if case == "outlier":
        x[7] *= 1e12
    else:
        x *= (10 ** rng.uniform(-15, 15, (1500, 1))).astype(np.float32)
    rows = [(i, [float(v) for v in row], 0) for i, row in enumerate(x)]
    got = {}
    for r in neighbour_graph.nearest(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    x = x.astype(float)
    recall = []
    for q in range(0, 1500, 20):
        sims = x @ x[q]
        sims[q] = -np.inf
        recall.append(len(set(np.argsort(-sims)[:20].tolist()) & got[q]) / 20)
    assert np.mean(recall) > 0.95


def test_queries(spark, sf):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = sorted((tuple(r) for r in queries.op10_embedding_near_dedup(spark, sf).select("vec_id", "n_links", "component_id", "kept").collect()), key=str)
    assert got == brute_links(rows)


def test_walk_makes_rows_only_of_what_it_looks_at(spark, monkeypatch):
    looks = []

    class Noted(neighbour_graph.Scratch):
        def write(self, df, name):
            out = super().write(df, name)
            if name.startswith("walk"):
                looks.append({r["query"]: (r["next"], dict(zip(r["ids"], zip(r["sims"], r["done"])))) for r in out.collect()})
            return out

    monkeypatch.setattr(neighbour_graph, "Scratch", Noted)
    x = np.random.default_rng(3).standard_normal((700, 12))
    rows = [(i, [float(v) for v in row], 0) for i, row in enumerate(x)]
    got = neighbour_graph.nearest(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 100 == 0, top=5, k=12, beam=30).collect()
    assert len(got) == 7 * 5 and len(looks) > 3 and not any(n for n, _ in looks[-1].values())
    for query in looks[0]:
        seen = [i for state in looks for i in state[query][0]]
        assert len(seen) == len(set(seen)) and all(d for _, d in looks[-1][query][1].values())
        for following, known in (state[query] for state in looks):
            assert sorted(following) == sorted(i for i, (_, d) in known.items() if not d)
