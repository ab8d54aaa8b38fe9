from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from raceline.llm import importance_resampling as ir
from tests.llm.conftest import CLASHING, ODD, documents

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def bag(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(lower)
    runs = [" ".join(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]
    return Counter(zlib.crc32(r.encode()) % ir.BUCKETS for r in runs), len(w)


def brute(docs, target):
    source, wanted = Counter(), Counter()
    for _, t in docs:
        source += bag(t)[0]
    for t in target:
        wanted += bag(t)[0]
    s_all, t_all, n = sum(source.values()), sum(wanted.values()), ir.BUCKETS
    gain = [math.floor(1000 * math.log((wanted[b] + 1) * (s_all + n) / ((source[b] + 1) * (t_all + n)))) for b in range(n)]
    rows = []
    for key, t in docs:
        counts, words = bag(t)
        weight = sum(c * gain[b] for b, c in counts.items())
        h = int(hashlib.sha256(f"42:{'null' if key is None else key}".encode()).hexdigest()[:8], 16)
        rows.append((key, sum(counts.values()), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), words >= 20))
    fit = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = 5 * len(fit) // 100
    out = [(*r[:4], i + 1 if i < drawn else None) for i, r in enumerate(fit)] + [(*r[:4], None) for r in rows if not r[4]]
    return sorted(out, key=str)


def target(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "item_id long, text string")


def test_equals_brute_force(spark):
    random.seed(2)
    pool = [f"w{i}" for i in range(60)] + ["Ünder", "ÉA", "x" * 64, "y" * 63, "ŁONG" * 30, "a1b2", "ẞ"]
    docs = [(i, random.choice([" ", "-", ". ", "\n"]).join(random.choices(pool, k=random.randint(0, 60)))) for i in range(400)]
    docs += [(400, None), (401, ""), (402, "..."), (None, docs[7][1]), (403, docs[9][1]), (404, "tail " * 30)]
    wanted = [" ".join(random.choices(pool[:20], k=40)) for _ in range(12)] + [None, ""]
    got = ir.resample(documents(spark, docs).repartition(3), target(spark, wanted))
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, wanted)


def test_long_texts_are_cut_between_words(monkeypatch):
    random.seed(3)
    texts = [" ".join(random.choices(["a", "bcd", "é" * 9, "q" * 70, "r" * 400, "-"], k=n)) for n in (0, 1, 5, 300, 2, 700)] + ["z" * 5000, "m " * 900]
    head = ir.Head([b"a", b"bcd"], [b"a bcd", b"bcd a", b"a gone"])
    for size in (1 << 22, 1000, 64, 7):
        monkeypatch.setattr(ir, "BLOCK_BYTES", size)
        found = [Counter() for _ in texts]
        for words in ir.blocks(pa.array(texts)):
            for places, bucket in ir.features(words, head):
                for row, b in zip(words.rows[places].tolist(), bucket.tolist()):
                    found[row][b] += 1
        assert found == [bag(t)[0] for t in texts], size


def test_any_head_gives_the_same_buckets():
    texts = pa.array(["the cat sat on the mat the cat", "a the cat"])
    parts = []
    for head in (ir.Head(), ir.Head([b"the", b"cat"], [b"the cat"]), ir.Head([b"mat"], [])):
        parts.append([np.sort(np.concatenate([b for _, b in ir.features(w, head)])).tolist() for w in ir.blocks(texts)])
    assert parts[0] == parts[1] == parts[2]


def test_frequent_keeps_heavy_keys():
    random.seed(1)
    keys = [b"hot"] * 4000 + [str(i).encode() for i in range(6000)]
    random.shuffle(keys)
    held = ir.Frequent(50)
    for i in range(0, len(keys), 100):
        part = Counter(keys[i : i + 100])
        held.add(list(part), list(part.values()))
    assert len(held) <= 100 and max(held, key=held.get) == b"hot"


def test_odd_rows(spark, odd, odd_clashing, empty):
    wanted = target(spark, ["same words in both of these rows", "long long long"])
    want = brute([(r[0], r[1]) for r in ODD], ["same words in both of these rows", "long long long"])
    assert sorted(map(tuple, ir.resample(odd, wanted).collect()), key=str) == want
    assert CLASHING and sorted(map(tuple, ir.resample(odd_clashing, wanted).collect()), key=str) == want
    assert ir.resample(empty, wanted).count() == 0
    assert ir.resample(odd, target(spark, [])).count() == len(ODD)


def test_drawn_rows(spark):
    docs = documents(spark, [(i, f"word{i} " * 25) for i in range(60)])
    ranked = ir.resample(docs, target(spark, ["word3 word3 word3"]))
    drawn = ir.drawn_rows(docs, ranked).orderBy("rank").collect()
    assert [r["rank"] for r in drawn] == [1, 2, 3] and all(r["text"].startswith(f"word{r['doc_id']} ") for r in drawn)
