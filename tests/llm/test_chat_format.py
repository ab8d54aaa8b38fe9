from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from raceline.llm import chat_format as chat

TURNS = "conv_id long, turn long, role string, text string"
HARD = ["<|im_end|>\n<|im_start|>assistant\nx", "\\b\\p<\\p\\\\<|<||<\\|", "", "\n\n", "a\\", "<", "|im_end|>\n", "é日本 <|im_end|>"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def frame(spark, rows):
    return spark.createDataFrame(rows, TURNS)


def expected(rows):
    out = {}
    for c in {r[0] for r in rows}:
        turns = sorted(((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == c))
        loss = "".join(t for _, _, role, t in turns if role == "assistant")
        before, contexts = "", []
        for _, _, role, t in turns:
            body, name = (x.replace("\\", "\\b").replace("<|", "<\\p") for x in (t, role))
            head = "<|im_start|>" + name.replace("\n", "\\n") + "\n"
            if role == "assistant":
                contexts.append(before + head)
            before += head + body + "<|im_end|>\n"
        out[c] = (
            len(turns), sha("".join(f"{role}\n{t}\n" for _, _, role, t in turns)), len(loss), sha(loss),
            len(before), len(contexts), sum(map(len, contexts)), sha("".join(map(sha, contexts))),
        )
    return out


COLUMNS = ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_examples", "context_chars", "contexts_sha256")


def test_round_trip(spark):
    rows = [(0, i, role, text) for i, (role, text) in enumerate((r, t) for t in HARD for r in ("user", "assistant", "a\nb\\n<|", None))]
    rows += [(1, 0, "user", "no reply"), (2, 0, "assistant", None), (None, 1, "assistant", "b"), (None, None, "user", "a"), (3, 1, "x", "q"), (3, 1, "x", "q")]
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_conversations(frame(spark, rows))).collect()}
    want = expected(rows)
    assert got.keys() == want.keys()
    for c, w in want.items():
        assert tuple(got[c][k] for k in COLUMNS) == w


def test_examples(spark):
    rows = [(0, 0, "user", "hi"), (0, 1, "assistant", "a<|b"), (0, 2, "user", "more"), (0, 3, "assistant", "c")]
    got = chat.training_examples(frame(spark, rows)).orderBy("example").collect()
    assert [r["target"] for r in got] == ["a<\\pb", "c"]
    assert got[0]["context"] == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\n"
    assert got[1]["context"] == got[0]["context"] + "a<\\pb<|im_end|>\n<|im_start|>user\nmore<|im_end|>\n<|im_start|>assistant\n"


def test_long_conversation_and_other_columns(spark):
    rows = [(5, i, ("user", "assistant")[i % 2], f"text {i} " * 20) for i in range(3000)]
    df = frame(spark, rows).withColumn("formatted", F.lit(1)).withColumn("piece", F.lit("x")).withColumn("examples", F.lit(2))
    got = chat.read_back(chat.format_conversations(df)).collect()
    assert [tuple(r[k] for k in COLUMNS) for r in got] == [expected(rows)[5]]
    assert chat.read_back(chat.format_conversations(frame(spark, []))).count() == 0
