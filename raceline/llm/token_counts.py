"""Token counts by prefix dynamic programming.

A BPE vocabulary with word ends never merges across white space, so the token
count of a text obeys

    count(prefix up to the end of chunk i) = count(prefix up to chunk i-1) + tokens(chunk i)

where a chunk is a maximal run without ASCII white space. Inside a word of a
chunk the programme goes on character by character: the tokens of a prefix are
those of a shorter prefix and one last token, and of all vocabulary entries
that end there exactly one may follow the last token of the shorter prefix
(the two, put together, are split into the same two again). So every prefix
costs a few look-ups, in words of any length, and the counts of all prefixes
answer questions about truncation and budgets without encoding again. A cut
word is closed like a whole one, so a longer prefix may have fewer tokens.

The tokens of a chunk come from the tokenizers library itself and are kept in
a bounded table per worker, as words repeat. Special strings hold no white
space, so they are met inside a chunk and handled as the library does. Chunks
of ASCII and Latin-1 letters go straight to the library's BPE model, past its
normalizer and splitter, whose rules are plain for these characters.
"""

from __future__ import annotations

import json
import os
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD_BPE = "word_bpe_49k.json"
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_WHITE_BYTES = [b"\t", b"\n", b"\x0b", b"\x0c", b"\r", b" "]
_CHUNK = re.compile("[^\\x20\\x09-\\x0D]+")

# Splitter and byte alphabet of the vocabulary (fixed values of its format).
SPLIT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PLAIN = re.compile(r"[!-~\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+")
_PLAIN_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00DF-\u00F6\u00F8-\u00FF]+|[0-9]|[^a-z0-9\u00DF-\u00F6\u00F8-\u00FF]+")
_SHOWN = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
_BYTE_CHARS = {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in _SHOWN)}


class ChunkEncoder(dict):
    """Chunk (UTF-8 bytes) -> its token ids as little-endian unsigned 32-bit
    bytes. Long chunks are encoded each time. When the table holds
    ``max_entries`` it becomes the older generation, from which chunks that
    are met again move on, so a worker's memory is bounded."""

    def __init__(self, tokenizer: str, max_entries: int = 300_000, longest: int = 64):
        super().__init__()
        from tokenizers import Tokenizer

        if not os.path.exists(tokenizer):
            import public_tokenizers

            tokenizer = public_tokenizers.path(tokenizer)
        self.tokenizer = Tokenizer.from_file(tokenizer)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.max_entries, self.longest = max_entries, longest
        self.older: dict[bytes, bytes] = {}
        self.model = self.tokenizer.model
        steps = json.loads(self.tokenizer.to_str())
        splitters = (steps["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        normalizers = (steps["normalizer"] or {}).get("normalizers", [])
        self.special = [t["content"] for t in steps["added_tokens"]]
        self.plain = (
            [n["type"] for n in normalizers] == ["NFC", "Replace", "Lowercase"]
            and splitters[0].get("pattern") == {"Regex": SPLIT_PATTERN}
            and [s["type"] for s in splitters] == ["Split", "ByteLevel"]
        )

    def __missing__(self, chunk: bytes) -> bytes:
        packed = self.older.get(chunk)
        if packed is None:
            packed = self._encoded(chunk)
        if len(chunk) <= self.longest:
            if len(self) >= self.max_entries:
                self.older = dict(self)
                self.clear()
            self[chunk] = packed
        return packed

    def _encoded(self, chunk: bytes) -> bytes:
        text = chunk.decode()
        words = [text]
        if plain := self.plain and _PLAIN.fullmatch(text) and not any(s in text for s in self.special):
            words = _PLAIN_SPLIT.findall(text.lower())
        if len(words) > 1:
            return b"".join([self[w.encode()] for w in words])
        if plain:
            word = words[0] if chunk.isascii() else words[0].encode().decode("latin-1").translate(_BYTE_CHARS)
            ids = [t.id for t in self.model.tokenize(word)]
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return array("I", ids).tobytes() if sys.byteorder == "little" else np.asarray(ids, "<u4").tobytes()

    def chunks(self, text: bytes) -> list[bytes]:
        # Lower case here only saves entries; it must not make a special string.
        return (text if b"<" in text else text.lower()).split()

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.chunks(text.encode())))

    def prefix_counts(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Ends of the chunks (bytes) and the token count of each such prefix."""
        counts = np.cumsum(np.fromiter(map(len, map(self.__getitem__, self.chunks(text))), np.int64) // 4)
        white = _WHITE[np.frombuffer(text, np.uint8)]
        ends = np.flatnonzero(~white & np.append(white[1:], True)) + 1
        return ends, counts


#: Stands where a text is not to be cut.
NO_CUT = 2**31 - 1
#: Code points up to which a chunk that is not in NFC is encoded prefix by prefix.
WHOLE_PREFIXES = 256


def _joined(text: str) -> list[str]:
    """A text in parts that no normalizer joins: characters with the marks (and
    Hangul vowels and finals) that follow them, runs of white space."""
    parts: list[str] = []
    for c in text:
        mark = unicodedata.category(c)[0] == "M" or "\u1160" <= c <= "\u11ff"
        if parts and (mark or (c.isspace() and parts[-1][-1].isspace())):
            parts[-1] += c
        else:
            parts.append(c)
    return parts


class PrefixCounter:
    """Exact token counts of every prefix of a text, at each code point. The
    last count of each chunk is held against the library's. Where the
    normalizer joins characters (text not in NFC), short chunks are encoded
    prefix by prefix; in those of more than ``WHOLE_PREFIXES`` code points the
    places between joined characters are no cuts and hold ``NO_CUT``. Tables are
    emptied at ``max_entries``."""

    def __init__(self, enc: ChunkEncoder, max_entries: int = 100_000):
        model = json.loads(enc.tokenizer.to_str())["model"]
        close = model["end_of_word_suffix"]
        self.enc, self.max_entries = enc, max_entries
        self.ranks = {tuple(m.split(" ") if isinstance(m, str) else m): rank for rank, m in enumerate(model["merges"])}
        self.close = close
        self.closing = {t.removesuffix(close) for t in model["vocab"] if t.endswith(close)}
        self.open = {t for t in model["vocab"] if not t.endswith(close)}
        self.longest = max(map(len, self.closing | self.open))
        self.follows: dict[tuple[str, str, bool], bool] = {}
        self.chars: dict[str, str] = {}
        self.known: dict[str, np.ndarray] = {}
        self.special = re.compile("|".join(map(re.escape, enc.special)) or r"(?!)")

    def _may_follow(self, last: str, token: str, closed: bool) -> bool:
        """Whether ``last`` and ``token`` next to each other stay these two tokens."""
        key = (last, token, closed)
        if key not in self.follows:
            parts = [*last, *token]
            want = [last, token] if last else [token]
            if closed:
                parts[-1] += self.close
                want[-1] += self.close
            while len(parts) > 1:
                rank, i = min((self.ranks.get(pair, len(self.ranks)), i) for i, pair in enumerate(zip(parts, parts[1:])))
                if rank == len(self.ranks):
                    break
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            if len(self.follows) >= 4 * self.max_entries:
                self.follows.clear()
            self.follows[key] = parts == want
        return self.follows[key]

    def _word(self, word: str) -> list[int]:
        """Tokens of the first 0, 1, 2, ... symbols of a word, each closed."""
        last, before, counts = [""], [0], [0]
        for end in range(1, len(word) + 1):
            begins = range(max(0, end - self.longest), end)
            ending = [(b, word[b:end]) for b in begins]
            counts.append(next((before[b] + 1 for b, t in ending if t in self.closing and self._may_follow(last[b], t, True)), 0))
            b, token = next((b, t) for b, t in ending if t in self.open and self._may_follow(last[b], t, False))
            last.append(token)
            before.append(before[b] + 1)
        return counts

    def _char(self, c: str) -> str:
        if c not in self.chars:
            if len(self.chars) >= self.max_entries:
                self.chars.clear()
            self.chars[c] = self.enc.tokenizer.normalizer.normalize_str(c)
        return self.chars[c]

    def _total(self, text: str) -> int:
        return len(self.enc.tokenizer.encode(text, add_special_tokens=False).ids)

    def _programme(self, parts: list[str], text: str) -> np.ndarray | None:
        """Counts at the ends of ``parts`` of a text, if they are normalized
        each on its own and the last count is the library's."""
        chars = [self._char(c) for c in parts]
        normal = "".join(chars)
        if normal != self.enc.tokenizer.normalizer.normalize_str(text):
            return None
        at = np.zeros(len(normal) + 1, np.int64)
        done = end = 0
        for word, (start, stop) in self.enc.tokenizer.pre_tokenizer.pre_tokenize_str(normal):
            at[end : start + 1] = done
            counts = self._word(word)
            places = np.cumsum([len(c.encode()) for c in normal[start:stop]])
            at[start + 1 : stop + 1] = done + np.take(counts, places)
            if word in ("'re", "'ve", "'ll"):  # cut, it is a quote and a letter
                at[start + 2] = done + 2
            done, end = done + counts[-1], stop
        at[end:] = done
        return at[np.append(0, np.cumsum([len(c) for c in chars])).astype(np.int64)] if done == self._total(text) else None

    def _plain(self, text: str) -> np.ndarray:
        """Counts of the prefixes of a text without special strings."""
        counts = self._programme(list(text), text)
        if counts is not None:
            return counts
        if len(text) <= WHOLE_PREFIXES:
            return np.array([self._total(text[:n]) for n in range(len(text) + 1)])
        parts = _joined(text)
        counts = self._programme(parts, text)
        out = np.full(len(text) + 1, NO_CUT)
        out[0], out[-1] = 0, self._total(text)
        if counts is not None:
            out[np.append(0, np.cumsum([len(p) for p in parts]))] = counts
        return out

    def chunk(self, text: str) -> np.ndarray:
        """Counts of the first 0, 1, 2, ... code points of a chunk."""
        if text in self.known:
            return self.known[text]
        out = np.zeros(len(text) + 1, np.int64)
        at = done = 0
        for m in self.special.finditer(text):
            # A cut special string is text like any other.
            cut = self._plain(text[at : m.end() - 1])
            out[at : m.end()] = done + cut
            done += self._total(text[at : m.start()]) + 1
            at = m.end()
        out[at:] = done + self._plain(text[at:])
        out = np.minimum(out, NO_CUT)
        if len(text) <= self.enc.longest:
            if len(self.known) >= self.max_entries:
                self.known.clear()
            self.known[text] = out
        return out

    def text(self, text: str) -> np.ndarray:
        """Counts of the first 0, 1, 2, ... code points of a text."""
        out = np.zeros(len(text) + 1, np.int64)
        at = done = 0
        for m in _CHUNK.finditer(text):
            out[at : m.start()] = done
            out[m.start() : m.end() + 1] = np.minimum(done + self.chunk(m.group()), NO_CUT)
            at, done = m.end(), int(out[m.end()])
        out[at:] = done
        return out

    def fitting_bytes(self, data: bytes, ends: np.ndarray, counts: np.ndarray, limit: int) -> int:
        """Bytes of the longest prefix of a text with at most ``limit`` tokens,
        from the counts at its chunks' ends and those inside one chunk."""
        i = int(np.searchsorted(counts, limit, "right"))
        if i == len(counts):
            return len(data)
        start = max(data.rfind(b, 0, int(ends[i])) for b in _WHITE_BYTES) + 1
        chunk = data[start : int(ends[i])].decode()
        inside = self.chunk(chunk) + (int(counts[i - 1]) if i else 0)
        return start + len(chunk[: int(np.flatnonzero(inside <= limit)[-1])].encode())


_ENCODERS: dict[str, ChunkEncoder] = {}
_COUNTERS: dict[str, PrefixCounter] = {}


def encoder(tokenizer: str) -> ChunkEncoder:
    """The worker's encoder of a vocabulary (kept from task to task)."""
    if tokenizer not in _ENCODERS:
        _ENCODERS[tokenizer] = ChunkEncoder(tokenizer)
    return _ENCODERS[tokenizer]


def counter(tokenizer: str) -> PrefixCounter:
    """The worker's prefix counter of a vocabulary."""
    if tokenizer not in _COUNTERS:
        _COUNTERS[tokenizer] = PrefixCounter(encoder(tokenizer))
    return _COUNTERS[tokenizer]


def count_at(prefix_counts: bytes, n_chars: int) -> int:
    """Exact token count of the first ``n_chars`` code points, from a stored table."""
    return int(np.frombuffer(prefix_counts, "<i4")[n_chars])


def longest_within(prefix_counts: bytes, limit: int) -> int:
    """Code points of the longest prefix with at most ``limit`` tokens, from a
    stored table."""
    return int(np.flatnonzero(np.frombuffer(prefix_counts, "<i4") <= limit)[-1])


def prefix_table(docs: DataFrame, text: str = "text", key: str = "doc_id", tokenizer: str = WORD_BPE) -> DataFrame:
    """``key`` and ``prefix_counts`` (little-endian int32 array as binary): the
    stored dynamic programme of each text, the token counts of its first 0, 1,
    2, ... code points (``NO_CUT`` between characters of long chunks that the
    normalizer joins).

    Null and empty texts have the one count 0; texts of any length are counted
    whole; repeated rows give repeated rows; an empty table gives no rows;
    other columns are not read."""
    table = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer)
        for b in batches:
            counts = pa.array([count.text(t.as_py()).astype("<i4").tobytes() for t in b.column(1)], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), counts], names=["key", "counts"])

    kind = table.schema["key"].dataType.simpleString()
    out = table.mapInArrow(fill, f"key {kind}, counts binary")
    return out.select(F.col("key").alias(key), F.col("counts").alias("prefix_counts"))


def token_counts(
    docs: DataFrame, budgets: Sequence[int] = (2048,), text: str = "text", key: str = "doc_id", tokenizer: str = WORD_BPE
) -> DataFrame:
    """``key``, ``n_bytes``, ``n_tokens`` and ``fit_bytes`` (for each budget,
    the bytes of the longest prefix, cut at any code point, with at most
    that many tokens), read off the prefix counts of each text.

    Null texts count as empty: 0 bytes, 0 tokens. Very long texts, with or
    without white space, are counted whole. Repeated rows give repeated rows; an empty table
    gives no rows; other columns are not read."""
    table = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    limits = [int(b) for b in budgets]

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, count = encoder(tokenizer), counter(tokenizer)
        for b in batches:
            n_bytes, n_tokens, fits = [], [], []
            for t in b.column(1):
                data = t.as_py().encode()
                ends, counts = enc.prefix_counts(data)
                n_bytes.append(len(data))
                n_tokens.append(int(counts[-1]) if len(counts) else 0)
                fits.append([count.fitting_bytes(data, ends, counts, limit) for limit in limits])
            arrays = [pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()), pa.array(fits, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([b.column(0), *arrays], names=["key", "n_bytes", "n_tokens", "fit_bytes"])

    kind = table.schema["key"].dataType.simpleString()
    out = table.mapInArrow(answer, f"key {kind}, n_bytes bigint, n_tokens bigint, fit_bytes array<bigint>")
    return out.withColumnRenamed("key", key)
