from __future__ import annotations

import random
import re
import zlib
from collections import Counter

from raceline.llm import spelling_variants as sv
from raceline.llm.common import Scratch
from tests.llm.conftest import ODD, documents


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(docs):
    counts = Counter()
    for key, text in docs:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", lower):
            h = zlib.crc32(f"{'null' if key is None else key}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    forms, n_near = {}, {}
    for w in words:
        others = [x for x in words if near(w, x)]
        n_near[w] = len(others)
        best = min(others, key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= 2 * words[w]:
            forms[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in forms:
            root = forms[root]
        out.append((w, forms.get(w), root, n, n_near[w], words[forms[w]] if w in forms else None))
    return sorted(out, key=str)


def test_equals_brute_force(spark):
    random.seed(6)
    stems = ["colour", "color", "aaaaa", "aaaaaa", "Ärger", "ärgern", "theatre", "theater", "ÿÿÿÿÿ", "abcde", "abcdef"]

    def damaged():
        w = list(random.choices(stems, weights=range(len(stems), 0, -1))[0])
        for _ in range(random.choice([0, 0, 0, 1, 1, 2])):
            i = random.randrange(len(w))
            random.choice([lambda: w.insert(i, random.choice("aé")), lambda: w.pop(i), lambda: w.__setitem__(i, random.choice("abÄ"))])()
        return "".join(w)

    docs = [(i, random.choice([" ", "7", "\n", "ŋ"]).join(damaged() for _ in range(random.randint(1, 120)))) for i in range(120)]
    docs += [(None, docs[3][1]), (5, docs[5][1]), (500, "COLOUR Colour " * 300)]
    got = sv.variants(documents(spark, docs).repartition(5)).collect()
    want = brute(docs)
    assert sum(r[4] > 0 for r in want) > 50 and sum(r[1] is not None and r[1] != r[2] for r in want) > 3
    assert sorted(map(tuple, got), key=str) == want


def test_nodes_name_prefixes(spark):
    random.seed(7)
    words = sorted({"".join(random.choices("abé", k=random.randint(1, 9))) for _ in range(700)} | {"a" * 2000, "a" * 1999 + "b"})
    df = spark.createDataFrame([(w,) for w in words], "word string").repartition(4)
    rows = sv.number_nodes(df, Scratch(spark, "test"), "nodes").collect()
    named = {}
    for r in rows:
        assert len(r.nodes) == len(r.word) + 1 and words[r.place] == r.word
        for i, node in enumerate(r.nodes):
            assert named.setdefault(node, r.word[:i]) == r.word[:i]
    assert len(named) == len(set(named.values())) == len({w[:i] for w in words for i in range(len(w) + 1)})


def test_odd_rows(spark, odd, odd_clashing, empty):
    want = brute([(r[0], r[1]) for r in ODD])
    for docs in (odd, odd_clashing):
        assert sorted(map(tuple, sv.variants(docs).collect()), key=str) == want
    assert sv.variants(empty).count() == 0
    runs = [(i, " ".join("k" * 50_000 + x for x in "abb")) for i in range(3)]
    assert sorted(map(tuple, sv.variants(documents(spark, runs)).collect()), key=str) == brute(runs)
