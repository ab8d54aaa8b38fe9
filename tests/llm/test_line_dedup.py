from __future__ import annotations

import random

from raceline.llm import line_dedup
from tests.llm.conftest import documents


def test_passage_goes_from_later_documents_and_clean_ones_stay(spark):
    passage = "\n".join(f"line {i} of a passage that many documents share with each other" for i in range(6))
    rows = [(i, f"own start {i}\n{passage}\nown end {i}") for i in range(4)] + [(9, "a clean text\nwith lines\nline 0 of its own")]
    got = {r["doc_id"]: r for r in line_dedup.remove_repeats(documents(spark, rows)).collect()}
    assert got[0]["text"] == rows[0][1] and got[9]["text"] == rows[4][1]
    assert got[2]["text"] == "own start 2\nown end 2"
    assert [tuple(r) for r in got[2]["removed"]] == [(1, 6)] and got[2]["n_removed"] == 6 and got[2]["n_lines"] == 8


def test_odd_rows(spark, odd, odd_clashing, empty):
    out = line_dedup.remove_repeats(odd, min_words=5)
    got = out.collect()
    assert len(got) == 10
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[1]["text"] is None and by_id[1]["n_lines"] == 0
    assert by_id[2]["text"] == "" and by_id[2]["n_lines"] == 1
    # repeated rows are one document; the same text under another id is a copy
    assert [r["text"] for r in got if r["doc_id"] == 4] == ["same words in both of these rows here"] * 2
    assert by_id[5]["text"] == ""
    clashing = line_dedup.remove_repeats(odd_clashing, min_words=5)
    assert sorted(r["text"] or "" for r in clashing.collect()) == sorted(r["text"] or "" for r in got)
    assert line_dedup.remove_repeats(empty).count() == 0


def cut_by_maximal_runs(rows, min_words):
    """Lines that stay, per document, when the later copy goes of every pair of
    equal runs that can't be made longer at either end; blank lines between
    removed lines go with them."""
    docs = [(i, t, [(n, x) for n, x in enumerate(t.split("\n")) if x.split()]) for i, t in sorted(rows)]
    gone = {i: set() for i, _, _ in docs}
    for d, (_, _, early) in enumerate(docs):
        for e, (doc_id, _, late) in enumerate(docs[d:], d):
            for a in range(len(early)):
                for b in range(a + 1 if d == e else 0, len(late)):
                    if a and b and early[a - 1][1] == late[b - 1][1]:
                        continue
                    t = 0
                    while a + t < len(early) and b + t < len(late) and early[a + t][1] == late[b + t][1]:
                        t += 1
                    if sum(len(x.split()) for _, x in late[b : b + t]) >= min_words:
                        gone[doc_id].update(n for n, _ in late[b : b + t])
    for i, _, lines in docs:
        for (m, _), (n, _) in zip(lines, lines[1:]):
            if {m, n} <= gone[i]:
                gone[i].update(range(m, n))
    return {i: "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone[i]) for i, t, _ in docs}


def test_equals_maximal_repeated_runs(spark):
    random.seed(4)
    pool = [" ".join(random.choice("abcde") for _ in range(random.randint(1, 5))) for _ in range(12)] + ["", " "]
    for min_words in (4, 9):
        rows = [(i, "\n".join(random.choice(pool) for _ in range(random.randint(1, 30)))) for i in range(25)]
        rows.append((25, rows[3][1]))
        got = {r["doc_id"]: r["text"] for r in line_dedup.remove_repeats(documents(spark, rows), min_words=min_words).collect()}
        assert got == cut_by_maximal_runs(rows, min_words)


def test_tail_of_a_passage_goes(spark):
    def words(name, n):
        return " ".join(f"{name}{i}" for i in range(n))

    passages = ["\n".join([words("a", 60), words("b", 10), words("c", 5)]), "\n".join([words("d", 30), "", words("e", 10), words("f", 30)])]
    rows = [(i, f"start {i}\n{passages[i % 2]}\nend {i}") for i in range(6)]
    got = {r["doc_id"]: r["text"] for r in line_dedup.remove_repeats(documents(spark, rows)).collect()}
    assert [got[i] for i in (0, 1)] == [rows[0][1], rows[1][1]]
    assert [got[i] for i in range(2, 6)] == [f"start {i}\nend {i}" for i in range(2, 6)]
