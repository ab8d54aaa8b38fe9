from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from raceline.llm import packing, queries, token_counts
from tests.llm.conftest import documents


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


PARTS = "abcXYZ éÉñßüÀÿ×÷²½'s't 're <|endoftext|><|startoftext|> <| <|ENDOFTEXT|> İ K ſ ς Σ ́é 日本 \x1c \x1f \x85 \x00 0 9 !?. '' _ 'S 'LL ﬁ \U0001f600 ẞ ª º µ".split(" ")


def test_encoder_equals_the_library(library):
    enc = token_counts.ChunkEncoder("word_bpe_49k.json", max_entries=50)
    random.seed(3)
    for _ in range(3000):
        text = "".join(random.choice([*PARTS, " ", "\n", "\t", " ", " "]) for _ in range(random.randint(0, 20)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(enc.encode(text), "<u4").tolist() == ids, text


def library_counts(library, text):
    return [len(library.encode(text[:n], add_special_tokens=False).ids) for n in range(len(text) + 1)]


def test_prefix_counts_are_exact_at_every_prefix(library):
    count = token_counts.counter("word_bpe_49k.json")
    random.seed(4)
    texts = ["", "Some words, in Été; don't <|endoftext|> stop 123\n\n end  ", "they're we've I'll 'r", "日本語のテキストは空白なし、" * 8, "a\u0301e\u0323\u0302x", "aaaa" * 40]
    texts += ["".join(random.choice([*PARTS, " ", "\n"]) for _ in range(random.randint(0, 25))) for _ in range(300)]
    texts += ["".join(random.choice("etaoinshrdlu") for _ in range(150)) for _ in range(10)]
    texts += ["".join(random.choice("ABCDefghIJKL0123456789+/") for _ in range(150)) for _ in range(5)]
    for text in texts:
        assert count.text(text).tolist() == library_counts(library, text), text


@pytest.mark.parametrize("unit", ["internationalisation", "日本語のテキスト", "QmFzZTY0+/9", "x"])
def test_long_texts_without_white_space(library, unit):
    text = (unit * 200_000)[:200_000]
    count, enc = token_counts.counter("word_bpe_49k.json"), token_counts.encoder("word_bpe_49k.json")
    counts = count.text(text)
    assert counts[-1] == len(library.encode(text, add_special_tokens=False).ids)
    for n in (1, 999, 5_000, 123_457):
        assert counts[n] == len(library.encode(text[:n], add_special_tokens=False).ids)
    ends, at_ends = enc.prefix_counts(text.encode())
    fit = count.fitting_bytes(text.encode(), ends, at_ends, 2048)
    n = len(text.encode()[:fit].decode())
    assert counts[n] <= 2048 < counts[n + 1 :].min()


@pytest.mark.parametrize("unit", ["e\u0323\u0302a\u0301b", "\u1112\u1161\u11ab", "x\x85\x85y<|endoftext|>e\u0301"])
def test_long_texts_whose_characters_are_joined(library, unit):
    text = (unit * 30_000)[:60_000]
    counts = token_counts.counter("word_bpe_49k.json").text(text)
    assert counts[0] == 0 and counts[-1] == len(library.encode(text, add_special_tokens=False).ids)
    cuts = np.flatnonzero(counts < token_counts.NO_CUT)
    assert len(cuts) >= len(text) // len(unit)
    for n in [*cuts[:60], *cuts[1_000:1_010], cuts[-3]]:
        assert counts[n] == len(library.encode(text[:n], add_special_tokens=False).ids)


def test_counts(spark, library, odd, odd_clashing, empty):
    got = token_counts.token_counts(odd, (5, 2048))
    assert Counter(tuple(r) for r in got.select("doc_id", "n_bytes", "n_tokens").collect()) == Counter(
        (r["doc_id"], len((r["text"] or "").encode()), len(library.encode(r["text"] or "", add_special_tokens=False).ids)) for r in odd.collect()
    )
    assert token_counts.token_counts(odd_clashing).columns == got.columns
    assert token_counts.token_counts(empty).count() == 0
    small = documents(spark, [(0, "  one two, three-four's fivesix seven"), (1, "日本語のテキスト"), (2, None), (3, "a b"), (4, "  <|endoftext|>don'tdon't  ")])
    texts = {r["doc_id"]: r["text"] or "" for r in small.collect()}
    for r in token_counts.token_counts(small, (0, 1, 5, 2048)).collect():
        text = texts[r["doc_id"]]
        counts = library_counts(library, text)
        want = [len(text[: max(n for n, c in enumerate(counts) if c <= limit)].encode()) for limit in (0, 1, 5, 2048)]
        assert r["fit_bytes"] == want


def test_prefix_table_answers_without_the_text(spark, library, empty):
    text = "first second third"
    row = token_counts.prefix_table(documents(spark, [(1, text), (2, None)])).orderBy("doc_id").collect()
    counts = library_counts(library, text)
    assert [token_counts.count_at(row[0]["prefix_counts"], n) for n in range(len(text) + 1)] == counts
    assert token_counts.longest_within(row[0]["prefix_counts"], 1) == max(n for n, c in enumerate(counts) if c <= 1)
    assert token_counts.count_at(row[1]["prefix_counts"], 0) == 0 and len(row[1]["prefix_counts"]) == 4
    assert token_counts.prefix_table(empty).count() == 0


def naive_best_fit(lengths, capacity):
    bins = []
    for n in sorted(lengths, reverse=True):
        fits = [b for b in bins if b >= n]
        if fits:
            bins.remove(min(fits))
            bins.append(min(fits) - n)
        else:
            bins.append(capacity - n)
    return sorted(bins)


@pytest.mark.parametrize("seed", range(8))
def test_plan_is_best_fit_decreasing(seed):
    random.seed(seed)
    capacity = random.choice([7, 64, 100])
    lengths = [random.randint(1, capacity) for _ in range(random.randint(0, 300))]
    runs = packing.plan(dict(Counter(lengths)), capacity)
    fill, seen = defaultdict(list), Counter()
    for length, rank, bins, first, offset in runs:
        assert rank == seen[length]
        seen[length] += bins
        for b in range(first, first + bins):
            fill[b].append((offset, length))
    assert seen == Counter(lengths)
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(capacity - sum(n for _, n in p) for p in fill.values()) == naive_best_fit(lengths, capacity)


def check_packing(rows, texts, library, capacity):
    """Pieces, ids and places against the library."""
    place, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        place[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append(r)
    for parts in place.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    for doc_id, found in pieces.items():
        expected = Counter()
        for text in texts[doc_id]:
            ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
            for k in range(0, len(ids), capacity):
                part = ids[k : k + capacity]
                expected[k // capacity, k, len(part), zlib.crc32(np.asarray(part, "<u4").tobytes())] += 1
        assert Counter((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == expected


def test_pack(spark, library, odd, odd_clashing, empty):
    texts = defaultdict(list)
    for r in odd.collect():
        texts[r["doc_id"]].append(r["text"])
    got = packing.pack(odd, capacity=512)
    rows = got.collect()
    assert {r["doc_id"] for r in rows} == set(texts)
    check_packing(rows, texts, library, 512)
    assert packing.pack(odd_clashing, capacity=512).columns == got.columns
    assert packing.pack(empty).count() == 0


def test_sequences_hold_the_ids(spark, library):
    docs = documents(spark, [(i, "some words " * i) for i in range(30)])
    packed = packing.pack(docs, capacity=64, with_ids=True)
    total = sum(len(r["ids"]) for r in packing.sequences(packed).collect())
    assert total == 4 * sum(len(library.encode("some words " * i, add_special_tokens=False).ids) + 1 for i in range(30))


def test_queries(spark, library, sf):
    texts = defaultdict(list)
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        texts[r["doc_id"]].append(r["text"])
    rows = queries.op7_best_fit_packing(spark, sf).collect()
    check_packing(rows, texts, library, 2048)
    total = sum(r["length"] for r in rows)
    assert len({r["sequence_id"] for r in rows}) <= -(-total // 2048) + 1
    for r in queries.op8_token_counts(spark, sf).collect():
        n = len(library.encode(texts[r["doc_id"]][0] or "", add_special_tokens=False).ids)
        assert (r["n_tokens"], r["over_limit"]) == (n, n > 2048)
