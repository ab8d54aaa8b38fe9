"""Secret scan by assignment-aware lexing.

Three base patterns find what looks like a secret by itself. On top of them
the text is lexed for assignments as source code and configuration files
write them (``name = "literal"``, ``name: literal``, ``"name": "literal"``,
``name := ...``, concatenations with ``+``). Constants are propagated: a name
on the right stands for what it was assigned before, so a harmless constant
that ends in a ``password`` is found where it was written. A literal is scored
by how sensitive its target name is and by how much it looks like a generated
value or a pass-phrase; a secret that is written in pieces is scored as the
joined value, too. Spans of kind ``literal`` are those that reach the threshold
and don't lie inside a base span.

Right sides refer to earlier ones, they don't copy them: the weights of the
names go back along the references once, last assignment first, and every
literal is scored once. The scan is linear in the text.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Span kinds in the order in which spans of equal start are listed (fixed values).
KINDS = ("assign", "access", "hex", "literal")

# Base patterns (fixed values).
ASSIGN = re.compile(r"(?ai)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a greedy run of 24 or more is the same match as a run that is then measured

# Any of these stands in a text that ASSIGN can match (lower case).
ASSIGN_WORDS = ("passw", "secret", "token", "api")
_HEX_CLASS = bytes(ord("h") if chr(i) in "0123456789abcdef" else ord(" ") for i in range(256))
_HEX_RUN = b"h" * 24

# Words of a target name and how sensitive they make it (fixed values).
NAME_WEIGHTS = {
    "password": 1.0,
    "passwd": 1.0,
    "passphrase": 1.0,
    "pwd": 1.0,
    "secret": 1.0,
    "token": 0.9,
    "apikey": 1.0,
    "credential": 0.9,
    "credentials": 0.9,
    "bearer": 0.8,
    "auth": 0.6,
    "key": 0.6,
    "signature": 0.5,
    "session": 0.4,
    "cookie": 0.4,
    "salt": 0.4,
}
# Literals that stand for a value rather than being one (fixed values).
PLACEHOLDERS = {"true", "false", "none", "null", "undefined", "changeme", "example", "placeholder", "redacted", "string", "required", "optional"}

# name, closing quote or bracket, operator. A name starts where no name
# character stands before it and is never given back, so the scan is linear.
TARGET = re.compile(r"(?a)(?<![A-Za-z0-9_.\-])([A-Za-z_][A-Za-z0-9_.\-]*+)[\"']?+\]?+[ \t]*+(?::=|=>|=(?![=~])|:(?![:/]))[ \t]*+")
ATOM = re.compile(
    r"""(?a)(?P<quote>["'`])(?P<text>(?:\\.|(?!(?P=quote))[^\\\n])*+)(?P=quote)|(?P<name>[A-Za-z_][A-Za-z0-9_.]*+)(?![A-Za-z0-9+/_=\-])|(?P<bare>[A-Za-z0-9+/_.=\-]+)"""
)
PLUS = re.compile(r"[ \t]*+\+[ \t]*+")
PHRASE = re.compile(r"[A-Za-z0-9]+(?:[ -][A-Za-z0-9]+){3,11}")
NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")


def name_weight(name: str) -> float:
    words = [w.lower() for w in NAME_WORD.findall(name)]
    joined = [a + b for a, b in zip(words, words[1:])]
    return max((NAME_WEIGHTS.get(w, 0.0) for w in (*words, *joined)), default=0.0)


def literal_weight(value: str) -> float:
    """0 to 1: length, spread of characters, mixture of classes."""
    low = value.lower()
    if len(value) < 6 or low in PLACEHOLDERS or low.startswith(("your", "xxx", "${", "<", "{{", "http")) or " " in value:
        return 0.0
    n = len(value)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    classes = sum(bool(re.search(p, value)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    return min(1.0, n / 16) * 0.3 + min(1.0, entropy / 3.5) * 0.4 + min(1.0, classes / 2) * 0.3


def phrase_weight(value: str, name: str) -> float:
    """A pass-phrase: four to twelve words of letters and digits under a name
    that says so, or under another pass name with a number among them."""
    if len(value) > 200 or not PHRASE.fullmatch(value):
        return 0.0
    words = {w.lower() for w in NAME_WORD.findall(name)}
    return 0.8 if words & {"passphrase", "phrase"} or (words & {"password", "passwd", "pwd", "secret"} and re.search("[0-9]", value)) else 0.0


@dataclass
class RightSide:
    """A target name, and its literals (value, start, end) and references to
    earlier right sides, in order. ``short``: the joined value, if it is at
    most JOINED characters long."""

    name: str
    parts: list[tuple[str, int, int] | RightSide] = field(default_factory=list)
    short: str | None = ""

    def literals(self) -> Iterator[tuple[str, int, int]]:
        """All literals, those of references included."""
        for p in self.parts:
            if isinstance(p, RightSide):
                yield from p.literals()
            else:
                yield p


#: Right sides up to so many characters are scored as one value and can be part
#: of another's joined value; a longer literal is scored by itself.
JOINED = 64


def assignments(text: str) -> Iterator[RightSide]:
    """The right sides of all assignments in order."""
    known: dict[str, RightSide] = {}
    at = 0
    while m := TARGET.search(text, at):
        at, side = m.end(), RightSide(m[1])
        while a := ATOM.match(text, at):
            ref = known.get(a["name"].rsplit(".", 1)[-1]) if a["name"] else None
            kind = a.lastgroup if not a["quote"] else "text"
            part = ref or (a[kind], a.start(kind), a.end(kind))
            side.parts.append(part)
            if side.short is not None:
                value = ref.short if ref else part[0]
                side.short = side.short + value if value is not None and len(side.short) + len(value) <= JOINED else None
            at = a.end()
            plus = PLUS.match(text, at)
            if not plus:
                break
            at = plus.end()
        if side.parts:
            known[m[1].rsplit(".", 1)[-1]] = side
            yield side


def sensitive(text: str, threshold: float) -> tuple[set[tuple[int, int]], float]:
    """Spans of the literals that reach the threshold, and the top score."""
    sides = list(assignments(text))
    weight = {id(s): (name_weight(s.name), s.name) for s in sides}
    whole: set[int] = set()  # right sides that are part of a secret as they are
    found: set[tuple[int, int]] = set()
    top = 0.0
    for s in reversed(sides):  # references go back, so a side has all its weight when its turn comes
        w, name = weight[id(s)]
        if w and len(s.parts) > 1:
            score = w * (literal_weight(s.short) if s.short is not None else 0.0)
            pieces = [p[0] for p in s.parts if not isinstance(p, RightSide)]
            if s.short is None and all(len(p) <= JOINED for p in pieces):  # many pieces, as one value
                score = w * literal_weight("".join(pieces))
            top = max(top, score)
            if score >= threshold:
                whole.add(id(s))
        for p in s.parts:
            if isinstance(p, RightSide):
                if w > weight[id(p)][0]:
                    weight[id(p)] = (w, name)
                if id(s) in whole and p.short is not None:
                    whole.add(id(p))
                continue
            value, start, end = p
            score = w * max(literal_weight(value), phrase_weight(value, name)) if w else 0.0
            top = max(top, score)
            if score >= threshold or (id(s) in whole and end > start):
                found.add((start, end))
    return found, top


def scan(text: str, threshold: float = 0.6) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]], float]:
    """Base spans, all spans (both sorted by start, then kind), top score."""
    base: list[tuple[str, int, int]] = []
    lexed = "=" in text or ":" in text
    if lexed and any(w in (low := text.lower()) for w in ASSIGN_WORDS):
        base += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        base += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    if _HEX_RUN in text.encode().translate(_HEX_CLASS):
        base += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    order = lambda x: (x[1], KINDS.index(x[0]), x[2])
    base.sort(key=order)
    found, top = sensitive(text, threshold) if lexed else (set(), 0.0)
    starts = [s for _, s, _ in base]
    reach = list(accumulate((e for _, _, e in base), max))  # furthest end of the spans that start so early

    def inside(start: int, end: int) -> bool:
        i = bisect_right(starts, start)
        return i > 0 and reach[i - 1] >= end

    more = [("literal", s, e) for s, e in found if not inside(s, e)]
    return base, sorted([*base, *more], key=order), top


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def secret_spans(docs: DataFrame, text: str = "text", key: str = "doc_id", threshold: float = 0.6) -> DataFrame:
    """``key``, ``n_assign``, ``n_access``, ``n_hex``, ``n_literal`` (long),
    ``base_sha256`` (digest of the base spans), ``spans`` (all spans as
    ``kind:start:end``, code points, end exclusive) and ``top_score``.

    Null texts are empty and have no spans. Texts are scanned whole. Repeated
    rows give repeated rows; other columns are not read."""
    table = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [scan(t.as_py(), threshold) for t in b.column(1)]
            counts = [Counter(k for k, _, _ in spans) for _, spans, _ in out]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    *(pa.array([c[k] for c in counts], pa.int64()) for k in KINDS),
                    pa.array([hashlib.sha256(joined(base).encode()).hexdigest() for base, _, _ in out], pa.string()),
                    pa.array([joined(spans) for _, spans, _ in out], pa.string()),
                    pa.array([top for _, _, top in out], pa.float64()),
                ],
                names=["key", "n_assign", "n_access", "n_hex", "n_literal", "base_sha256", "spans", "top_score"],
            )

    kind = table.schema["key"].dataType.simpleString()
    schema = f"key {kind}, n_assign bigint, n_access bigint, n_hex bigint, n_literal bigint, base_sha256 string, spans string, top_score double"
    return table.mapInArrow(run, schema).withColumnRenamed("key", key)


def mask(text: str, spans: str, mark: str = "[secret]") -> str:
    """The text with every span replaced by ``mark`` (overlaps merged)."""
    out, at = [], 0
    for start, end in sorted(tuple(map(int, s.split(":")[1:])) for s in spans.split(",") if s):
        if end > at:
            out += [text[at:start], mark] if start >= at else []
            at = end
    return "".join([*out, text[at:]])
