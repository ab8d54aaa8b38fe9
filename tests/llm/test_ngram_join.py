from __future__ import annotations

import random

import numpy as np
import pytest

from raceline.llm import components, ngram_join
from raceline.llm.common import Scratch
from tests.llm.conftest import documents


def sets_of(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    sets = [(i, sets_of(t)) for i, t in rows]
    label = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                old, new = label[a], label[b]
                label = [new if v == old else v for v in label]
    least = {}
    for v, (i, x) in zip(label, sets):
        if i is not None:
            least[v] = min(least.get(v, i), i)
    return sorted(((i, len(x), least.get(v) if x else i) for v, (i, x) in zip(label, sets)), key=str)


def near_copies(seed, n=60):
    random.seed(seed)
    base = [[f"w{random.randint(0, 400)}" for _ in range(random.choice([8, 60, 150]))] for _ in range(8)]
    common = [f"c{i}" for i in range(40)]
    rows = []
    for i in range(n):
        words = list(random.choice(base))
        for _ in range(random.choice([0, 0, 1, 2, 4, 8])):
            words[random.randrange(len(words))] = f"n{random.randint(0, 30)}"
        if random.random() < 0.3:
            words += common
        if random.random() < 0.2:
            words = words[: random.randint(1, len(words))]
        rows.append((i, " ".join(w.upper() if random.random() < 0.05 else w for w in words)))
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_equals_brute_force(spark, monkeypatch, small):
    if small:  # many blocks and dealt prefix shingles
        monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", 400)
        monkeypatch.setattr(ngram_join, "RUN_NODES", 3)
    rows = near_copies(2 + small) + [(100, None), (101, ""), (102, "a b c"), (103, "A  b\nc"), (104, " \t")]
    got = ngram_join.similar_documents(documents(spark, rows)).drop("text_key").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


@pytest.mark.parametrize("seed", range(4))
def test_block_links_find_every_component(seed):
    rows = near_copies(seed)
    classes = np.zeros(1024, np.uint16)
    sets = {}
    for i, t in rows:
        h = ngram_join.shingles(t)
        sets.setdefault(ngram_join.set_digest(h), ngram_join.ordered_keys(h, classes))
    nodes = np.array(list(sets))
    links = ngram_join.block_links(nodes, list(sets.values()), np.zeros(len(nodes), int))
    label = {n: n for n in sets}

    def root(n):
        while label[n] != n:
            n = label[n]
        return n

    for a, b in links:
        assert root(a) != root(b)  # a forest
        label[root(a)] = root(b)
    by_text = [root(ngram_join.set_digest(ngram_join.shingles(t))) for _, t in rows]
    want = [c for _, _, c in sorted(brute(rows), key=lambda r: r[0])]
    assert len({(a, b) for a, b in zip(by_text, want)}) == len(set(by_text)) == len(set(want))


def test_suffix_bound_is_an_upper_bound():
    random.seed(0)
    for _ in range(300):
        x, y = (np.array(sorted(random.sample(range(60), random.randint(0, 40)))) for _ in range(2))
        assert ngram_join.suffix_bound(x, y) >= len(np.intersect1d(x, y))


@pytest.mark.parametrize("two_sides", [False, True])
def test_bitmaps_keep_every_similar_set(two_sides):
    for seed in range(4):
        texts = [t for _, t in near_copies(seed, 90)]
        found = [ngram_join.shingles(t) for t in texts]
        side = np.arange(len(texts)) % 2 if two_sides else np.zeros(len(texts), int)
        kept = ngram_join.may_link(np.array([len(h) for h in found]), [ngram_join.bitmap(h) for h in found], side)
        assert not kept.all()
        for a in range(len(texts)):
            for b in range(a):
                x, y = sets_of(texts[a]), sets_of(texts[b])
                if 100 * len(x & y) >= 80 * len(x | y) and (not two_sides or side[a] != side[b]):
                    assert kept[a] and kept[b]


def test_odd_rows(spark, odd, odd_clashing, empty):
    got = ngram_join.similar_documents(odd).drop("text_key").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute([(r["doc_id"], r["text"]) for r in odd.collect()])
    assert ngram_join.similar_documents(odd_clashing).drop("text_key").count() == 10
    assert ngram_join.similar_documents(empty).count() == 0


def test_components(spark):
    random.seed(4)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 540)] + [(7, 7), (1, 2), (2, 1)]
    edges += [(random.randint(1000, 1100), random.randint(1000, 1100)) for _ in range(70)]
    label = {}

    def root(n):
        label.setdefault(n, n)
        while label[n] != n:
            n = label[n]
        return n

    for a, b in edges:
        x, y = root(a), root(b)
        label[max(x, y)] = min(x, y)
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["root"] for r in components.connected_components(df, Scratch(spark, "t")).collect()}
    assert got == {n: root(n) for e in edges if e[0] != e[1] for n in e}
    none = spark.createDataFrame([], "a long, b long")
    assert components.connected_components(none, Scratch(spark, "t")).count() == 0
