from __future__ import annotations

import hashlib
import re

from raceline.llm import queries, secret_scan
from tests.llm.conftest import documents


def brute(text: str):
    """The base definition, as it is written down."""
    kinds = []
    assign = r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    kinds += [(m.start(), 0, "assign", m.end()) for m in re.finditer(assign, text) if len(m[2]) >= 6]
    kinds += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    kinds += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(k, s, e) for s, _, k, e in sorted(kinds)]


HARD = [
    "password=abcdef passwd: 'abcdefg' SECRET = \"a.b/c+d\" api_key:12345 apikey=123456",
    "token token=token=tokens token = = x password:password=secret123",
    "AKIA" + "A" * 16 + " AKIA" + "B" * 15 + " AKIAAKIA" + "9" * 20 + "é" + "AKIA" + "C" * 17,
    "0123456789abcdef01234567 0123456789abcdef0123456 " + "f" * 100 + " " + "a" * 24 + "G",
    "ſecret=abcdefgh toKen=abcdefgh éé token='" + "d" * 30 + "'",
    'cfg = {"api_key": "Zx9fQ2Lm71", "name": "bob"}',
    "",
]


def test_base_spans_equal_brute_force():
    for text in HARD:
        base, spans, _ = secret_scan.scan(text)
        assert base == brute(text)
        assert set(base) <= set(spans)


def test_pairs_and_constants():
    text = 'SEED = "q8Zt71LmPx04"\nlimit = 5\nDB_PASSPHRASE = SEED\nurl = "plain words here"\nauth: changeme\nconst pwd := "Ab9" + "xY7kQ2"\n'
    pairs = {s.name: [v for v, _, _ in s.literals()] for s in secret_scan.assignments(text)}
    assert pairs["DB_PASSPHRASE"] == ["q8Zt71LmPx04"]
    assert pairs["pwd"] == ["Ab9", "xY7kQ2"]
    _, spans, _ = secret_scan.scan(text)
    found = [text[s:e] for k, s, e in spans if k == "literal"]
    assert "q8Zt71LmPx04" in found and "changeme" not in found and "plain words here" not in found


def test_prose_has_no_spans():
    assert secret_scan.scan("The token was lost: nobody had the key, they said. See note: passwords matter.")[1] == []


def test_scan_of_hostile_texts_is_linear():
    for text in ("a" * 300_000 + "=", "a-" * 150_000, "=" * 200_000, "k=" * 100_000, "a='" + "\\" * 200_000, "x = a" + " + a" * 100_000):
        secret_scan.scan(text)


def literals(text):
    return [text[s:e] for k, s, e in secret_scan.scan(text)[1] if k == "literal"]


def test_every_part_counts():
    parts = [f"q{i:02}Zt7{i:02}LmP" for i in range(100)]
    assert literals("db_passphrase = " + " + ".join(f'"{p}"' for p in parts)) == parts
    short = ["Ab1", "xY7", "k!2", "Qz9"]
    assert literals("const credentials = " + " + ".join(f"'{p}'" for p in short)) == short
    assert literals("a = 'Ab1'\nb = a + 'xY7'\nc = 'k!2' + b + 'Qz9'\nmy_pwd = c\n") == ["Ab1", "xY7", "k!2", "Qz9"]
    assert literals("part = 'Ab1'\ntitle = part + ' of the house'\n") == []


def test_pass_phrases():
    assert literals('passphrase: "correct horse battery staple 93"') == ["correct horse battery staple 93"]
    assert literals('vault_pwd = "seven ships 41 sail north"') == ["seven ships 41 sail north"]
    assert literals('password: "please enter the new one twice"') == []


def test_long_chains_are_linear():
    import time

    chain = "salt = 'q8Zt71LmPx04' + salt\n"
    tokens = "token = \"q8Zt71LmPx04\"\n"
    for line in (chain, tokens, "k = k + k\n", "a.secret = b + 'x'\nb = a.secret\n"):
        text = line * (1_000_000 // len(line))
        start = time.process_time()
        secret_scan.scan(text)
        assert time.process_time() - start < 4, line


def test_mask():
    assert secret_scan.mask("ab token=abcdef cd", "assign:3:15,literal:9:15") == "ab [secret] cd"


def test_table(spark, odd, odd_clashing, empty):
    got = secret_scan.secret_spans(odd)
    assert got.count() == 10 and got.where("spans <> ''").count() == 0
    assert secret_scan.secret_spans(odd_clashing).columns == got.columns
    assert secret_scan.secret_spans(empty).count() == 0
    rows = {r["doc_id"]: r for r in secret_scan.secret_spans(documents(spark, list(enumerate(HARD)))).collect()}
    for i, text in enumerate(HARD):
        base = ",".join(f"{k}:{s}:{e}" for k, s, e in brute(text))
        assert rows[i]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert rows[i]["n_hex"] == sum(k == "hex" for k, _, _ in brute(text))


def test_query(spark, sf):
    got = {r["doc_id"]: r for r in queries.op1_secret_scan(spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        base = ",".join(f"{k}:{s}:{e}" for k, s, e in brute(r["text"] or ""))
        assert got[r["doc_id"]]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
