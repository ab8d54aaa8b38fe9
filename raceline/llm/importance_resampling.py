"""Target-distribution importance resampling with a head-tail vocabulary.

Every text is a bag of features, all runs of 1 to 3 consecutive words, hashed
into buckets (CRC-32 of the joined bytes modulo the bucket number). A bucket's
gain is the log ratio of its smoothed share in the target texts and in all
documents; a document's weight is the sum of its features' gains, and the
highest weights plus Gumbel noise are drawn, which draws documents without
replacement in proportion to the ratio of the two distributions.

The hashing follows a head-tail vocabulary. One pass over all documents finds
the frequent words and the frequent word pairs (mergeable heavy-hitter
summaries of bounded size, one per task). Both are broadcast: a frequent word
with the exact CRC state after its bytes, a frequent pair with its state and
bucket. A feature made of them is a look-up; every other (tail) feature takes
its CRC directly, continued from the state of its first words over the bytes
of the last one. Both feed the same exact bucket totals. The head decides
only how a CRC is come by, never its value, so any head gives the same result.

CRC-32 is linear: the state after ``a + b`` is the state after ``a`` moved on
by ``len(b)`` zero bytes, xor the CRC of ``b``. Moving on is four look-ups per
state in a table per length, so whole blocks of words are hashed at once.
Texts are worked on in blocks of BLOCK_BYTES; a longer text is cut between
words and its last two words are carried over.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from raceline.llm.common import Scratch, shuffle_partitions
from raceline.llm.sql import LOWER, crc32_ctes

#: Fixed values of the contract.
BUCKETS, SEED, PERCENT, MIN_WORDS = 10_000, 42, 5, 20
#: Bounds of the broadcast head.
HEAD_WORDS, HEAD_PAIRS = 1 << 14, 1 << 15
#: Bytes of text worked on at once.
BLOCK_BYTES = 1 << 22
#: Words up to this many bytes are moved on by table.
LONGEST = 63

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def _moves() -> np.ndarray:
    """``[length, byte place, byte value]``: that byte of a CRC state, moved on by ``length`` zero bytes."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1).astype(np.uint32)
    now = np.arange(256, dtype=np.uint32)[None, :] << np.array([[0], [8], [16], [24]], np.uint32)
    out = [now]
    for _ in range(LONGEST + 1):
        now = step[now & 255] ^ (now >> 8)
        out.append(now)
    return np.ascontiguousarray(np.stack(out)).reshape(-1)


_MOVES = _moves()


def moved(state: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC states moved on by ``length`` (up to LONGEST + 1) zero bytes."""
    base = length.astype(np.int64) * 1024
    out = _MOVES[base + (state & 255)]
    for place in (1, 2, 3):
        out ^= _MOVES[base + (256 * place) + ((state >> np.uint32(8 * place)) & 255)]
    return out


@dataclass
class Head:
    """The broadcast head: words, their CRC states (alone and after a blank),
    pairs by word numbers (sorted) with their states and buckets."""

    words: list[bytes] = field(default_factory=list)
    pairs: list[bytes] = field(default_factory=list)
    buckets: int = BUCKETS

    def __post_init__(self) -> None:
        number = {w: i for i, w in enumerate(self.words)}
        self.value_set = pa.array(self.words, pa.large_binary())
        self.alone = np.array([zlib.crc32(w) for w in self.words], np.uint32)
        self.spaced = np.array([zlib.crc32(b" " + w) for w in self.words], np.uint32)
        rows = []
        for p in self.pairs:
            a, b = p.split(b" ")
            if a in number and b in number:
                rows.append((number[a] * HEAD_WORDS + number[b], zlib.crc32(p)))
        rows.sort()
        self.pair_keys = np.array([k for k, _ in rows], np.int64)
        self.pair_states = np.array([c for _, c in rows], np.uint32)
        self.pair_buckets = self.pair_states % np.uint32(self.buckets)


@dataclass
class Words:
    """The words of a block: Arrow binaries, lengths, row numbers, ends in the
    block's bytes, and how many at the start are carried over from the block
    before."""

    tokens: pa.Array
    lengths: np.ndarray
    rows: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    carried: int = 0


def words_of(data: np.ndarray, bounds: np.ndarray) -> Words:
    """``data``: UTF-8 bytes of texts that stand one after the other; text i
    has the bytes ``bounds[i]`` to ``bounds[i + 1]``."""
    inside = _IN_WORD[data]
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    cuts = bounds[(bounds > 0) & (bounds < len(data))]
    starts[cuts] |= inside[cuts]
    ends[cuts - 1] |= inside[cuts - 1]
    first, last = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    lengths = last - first
    places = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    packed = np.ascontiguousarray(_LOWER[data[inside]])
    tokens = pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(places), pa.py_buffer(packed)])
    return Words(tokens, lengths, np.searchsorted(bounds, first, "right") - 1, first, last)


def blocks(texts: pa.Array) -> Iterator[Words]:
    """The words of the texts, in blocks of about BLOCK_BYTES. Rows are
    numbered as in ``texts``; a text that is longer than a block comes in
    several, each with the last two words before it as carried ones."""
    flat = texts.cast(pa.large_binary())
    n = len(flat)
    bounds = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset : flat.offset + n + 1]
    data = np.frombuffer(flat.buffers()[2], np.uint8) if flat.buffers()[2] is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(bounds, bounds[at] + BLOCK_BYTES, "right")) - 1)
        if bounds[end] - bounds[at] <= 2 * BLOCK_BYTES:
            words = words_of(data[bounds[at] : bounds[end]], bounds[at : end + 1] - bounds[at])
            words.rows = words.rows + at
            yield words
        else:
            for words in _long(data[bounds[at] : bounds[end]]):
                words.rows = words.rows + at
                yield words
        at = end


def _long(data: np.ndarray) -> Iterator[Words]:
    start = done = 0
    while done < len(data):
        end = min(done + BLOCK_BYTES, len(data))
        while end < len(data) and _IN_WORD[data[end]]:  # to the end of the word
            outside = np.flatnonzero(~_IN_WORD[data[end : end + BLOCK_BYTES]])
            end = end + int(outside[0]) if len(outside) else min(end + BLOCK_BYTES, len(data))
        words = words_of(data[start:end], np.array([0, end - start]))
        words.carried = int((words.ends + start <= done).sum())
        done = end
        if len(words.starts):
            start = start + int(words.starts[max(0, len(words.starts) - 2)])
        else:
            start = end
        yield words


def features(words: Words, head: Head) -> list[tuple[np.ndarray, np.ndarray]]:
    """For runs of 1, 2 and 3 words: the places of their last words in the
    block and their buckets."""
    n = len(words.lengths)
    number = pc.index_in(words.tokens, head.value_set).fill_null(-1).to_numpy(zero_copy_only=False) if len(head.words) else np.full(n, -1)
    in_head = number >= 0
    alone, spaced = np.zeros(n, np.uint32), np.zeros(n, np.uint32)
    alone[in_head], spaced[in_head] = head.alone[number[in_head]], head.spaced[number[in_head]]
    tail = np.flatnonzero(~in_head)
    if len(tail):
        coded = words.tokens.take(pa.array(tail)).dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        codes = coded.indices.to_numpy()
        alone[tail] = np.array([zlib.crc32(w) for w in distinct], np.uint32)[codes]
        spaced[tail] = np.array([zlib.crc32(b" " + w) for w in distinct], np.uint32)[codes]
    new = np.arange(n) >= words.carried
    buckets = np.uint32(head.buckets)

    def longer(before: np.ndarray, places: np.ndarray) -> np.ndarray:
        """States of runs: ``before`` and the word at each place after it."""
        size = words.lengths[places] + 1
        out = moved(before, np.minimum(size, LONGEST + 1)) ^ spaced[places]
        for i in np.flatnonzero(size > LONGEST + 1):
            out[i] = zlib.crc32(b" " + words.tokens[int(places[i])].as_py(), int(before[i]))
        return out

    ones = np.flatnonzero(new)
    out = [(ones, alone[ones] % buckets)]
    twos = np.flatnonzero(words.rows[1:] == words.rows[:-1]) + 1
    states, bucket = np.zeros(n, np.uint32), np.zeros(n, np.uint32)
    key = number[twos - 1].astype(np.int64) * HEAD_WORDS + number[twos]
    known = in_head[twos - 1] & in_head[twos]
    if len(head.pair_keys):
        found = np.minimum(np.searchsorted(head.pair_keys, key), len(head.pair_keys) - 1)
        known &= head.pair_keys[found] == key
        states[twos[known]], bucket[twos[known]] = head.pair_states[found[known]], head.pair_buckets[found[known]]
    else:
        known[:] = False
    rare = twos[~known]
    states[rare] = longer(alone[rare - 1], rare)
    bucket[rare] = states[rare] % buckets
    shown = twos[new[twos]]
    out.append((shown, bucket[shown]))
    threes = np.flatnonzero((words.rows[2:] == words.rows[:-2]) & new[2:]) + 2
    out.append((threes, longer(states[threes - 1], threes) % buckets))
    return out


class Frequent(dict):
    """Heavy hitters: counts of at most ``size`` keys; a key with more than
    1 / size of all occurrences is never lost (Misra and Gries)."""

    def __init__(self, size: int):
        super().__init__()
        self.size = size

    def add(self, keys: list[bytes], counts: list[int]) -> None:
        for k, c in zip(keys, counts):
            self[k] = self.get(k, 0) + c
        if len(self) > 2 * self.size:
            floor = sorted(self.values(), reverse=True)[self.size]
            kept = {k: c - floor for k, c in self.items() if c > floor}
            self.clear()
            self.update(kept)


def frequent_parts(words: Words, most: int) -> tuple[list[bytes], list[int], list[bytes], list[int]]:
    """The block's words and its ``most`` most frequent pairs, with counts."""
    coded = words.tokens.dictionary_encode()
    codes, names = coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()
    same = (words.rows[1:] == words.rows[:-1]) & (np.arange(1, len(codes)) >= words.carried)
    keys, counts = np.unique((codes[:-1] * len(names) + codes[1:])[same], return_counts=True)
    if len(keys) > most:
        top = np.argpartition(-counts, most)
        counts = counts - counts[top[most]]
        keys, counts = keys[counts > 0], counts[counts > 0]
    pairs = [names[a] + b" " + names[b] for a, b in zip((keys // len(names)).tolist(), (keys % len(names)).tolist())] if len(names) else []
    n_words = np.bincount(codes[words.carried :], minlength=len(names)).tolist()
    return names, n_words, pairs, counts.tolist()


def find_head(texts: DataFrame, n_words: int = HEAD_WORDS, n_pairs: int = HEAD_PAIRS, buckets: int = BUCKETS) -> Head:
    """Frequent words and pairs of all texts (column ``text``). Words that are
    longer than LONGEST bytes stay in the tail."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        singles, doubles = Frequent(n_words), Frequent(n_pairs)
        for b in batches:
            for words in blocks(b.column(0)):
                if len(words.lengths):
                    w, wn, p, pn = frequent_parts(words, n_pairs)
                    singles.add(w, wn)
                    doubles.add(p, pn)
        for kind, found in ((1, singles), (2, doubles)):
            rows = [(k, c) for k, c in found.items() if c > 1 and len(k) <= kind * LONGEST]
            yield pa.RecordBatch.from_arrays(
                [pa.array([kind] * len(rows), pa.int32()), pa.array([k for k, _ in rows], pa.binary()), pa.array([c for _, c in rows], pa.int64())],
                names=["kind", "part", "n"],
            )

    parts = texts.select(F.coalesce(F.col("text"), F.lit("")).alias("text")).mapInArrow(run, "kind int, part binary, n bigint")
    summed = parts.groupBy("kind", "part").agg(F.sum("n").alias("n"))

    def top(kind: int, most: int) -> list[bytes]:
        return [bytes(r.part) for r in summed.where(F.col("kind") == kind).orderBy(F.desc("n"), "part").limit(most).select("part").collect()]

    summed = Scratch(texts.sparkSession, "resample-head").write(summed, "parts")
    return Head(top(1, n_words), top(2, n_pairs), buckets)


def bucket_totals(texts: DataFrame, head: Head) -> np.ndarray:
    """How many features of all texts (column ``text``) each bucket holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(head.buckets, np.int64)
        for b in batches:
            for words in blocks(b.column(0)):
                for _, bucket in features(words, head):
                    totals += np.bincount(bucket, minlength=head.buckets)
        held = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(totals[held], pa.int64())], names=["bucket", "n"])

    counted = texts.select(F.coalesce(F.col("text"), F.lit("")).alias("text")).mapInArrow(run, "bucket int, n bigint")
    out = np.zeros(head.buckets, np.int64)
    for r in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most one row per bucket
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the smoothed share in the target over that in the source) per bucket."""
    n, s, t = len(source), int(source.sum()), int(target.sum())
    ratios = (float((b + 1) * (s + n)) / float((a + 1) * (t + n)) for a, b in zip(source.tolist(), target.tolist()))
    return np.array([math.floor(1000.0 * math.log(r)) for r in ratios], np.int64)


def weights(docs: DataFrame, gain: np.ndarray, head: Head) -> DataFrame:
    """``key``, ``n_words``, ``n_features`` and ``weight`` of every row of
    (key, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_words, total = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int64)
            for words in blocks(b.column(1)):
                by_word = np.zeros(len(words.lengths), np.int64)
                for places, bucket in features(words, head):
                    by_word[places] += gain[bucket]
                rows, first = np.unique(words.rows, return_index=True)
                if len(rows):
                    total[rows] += np.add.reduceat(by_word, first)
                n_words += np.bincount(words.rows[words.carried :], minlength=b.num_rows)
            n_features = n_words + np.maximum(n_words - 1, 0) + np.maximum(n_words - 2, 0)
            arrays = [b.column(0), *(pa.array(x, pa.int64()) for x in (n_words, n_features, total))]
            yield pa.RecordBatch.from_arrays(arrays, names=["key", "n_words", "n_features", "weight"])

    kind = docs.schema["key"].dataType.simpleString()
    return docs.mapInArrow(run, f"key {kind}, n_words bigint, n_features bigint, weight bigint")


def gumbel(key: Column, seed: int) -> Column:
    """floor(1000 x Gumbel noise) from the hash of seed and key (null: ``null``)."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000.0 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(
    docs: DataFrame,
    target: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    seed: int = SEED,
    buckets: int = BUCKETS,
) -> DataFrame:
    """``key``, ``n_features``, ``weight``, ``score`` and ``rank`` (1, 2, ...
    of the drawn rows by score, ties to the smaller key; else null) of every
    row of ``docs``; ``target`` has a column of the same ``text`` name.

    Null and empty texts have no features, weight 0, and are not drawn. Texts
    of any length are hashed whole. A null key hashes as ``null`` and comes
    last among ties; repeated rows have one score and consecutive ranks. An
    empty target gives every bucket the same small share; an empty table
    gives no rows. Other columns are not read.

    Ranks come from ranges of the score order: each range is sorted by
    itself and starts after the rows of the ranges before it, so no task
    holds more than its range."""
    scratch = Scratch(docs.sparkSession, "resample")
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    head = find_head(rows, buckets=buckets)
    gain = gains(bucket_totals(rows, head), bucket_totals(target.select(F.col(text).alias("text")), head))
    scored = weights(rows, gain, head).withColumn("score", F.col("weight") + gumbel(F.col("key"), seed))
    scored = scratch.write(scored.withColumn("tie", F.monotonically_increasing_id()), "scored")

    fit = scored.where(F.col("n_words") >= min_words)
    order = [F.col("score").desc(), F.col("key").asc_nulls_last(), F.col("n_features"), F.col("weight"), F.col("tie")]
    ranges = fit.repartitionByRange(shuffle_partitions(docs.sparkSession), *order).sortWithinPartitions(*order)
    ranges = scratch.write(ranges.withColumn("part", F.spark_partition_id()), "ranges")
    sizes = sorted((r.part, r.n) for r in ranges.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect())  # a row per range
    drawn = percent * sum(n for _, n in sizes) // 100
    starts, before = [], 0
    for part, n in sizes:
        starts.append((part, before))
        before += n
    offsets = docs.sparkSession.createDataFrame(starts, "part int, before bigint")
    placed = ranges.join(F.broadcast(offsets), "part")

    from pyspark.sql import Window

    place = F.col("before") + F.row_number().over(Window.partitionBy("part").orderBy(*order))
    columns = ["key", "n_features", "weight", "score"]
    near = placed.where(F.col("before") < drawn).withColumn("place", place)
    none = F.lit(None).cast("long").alias("rank")
    out = near.select(*columns, F.when(F.col("place") <= drawn, F.col("place")).cast("long").alias("rank"))
    out = out.unionByName(placed.where(F.col("before") >= drawn).select(*columns, none))
    out = out.unionByName(scored.where(F.col("n_words") < min_words).select(*columns, none))
    return out.withColumnRenamed("key", key)


def drawn_rows(docs: DataFrame, ranked: DataFrame, key: str = "doc_id") -> DataFrame:
    """The drawn documents themselves, with their ``rank`` (keys are unique)."""
    drawn = ranked.where("rank IS NOT NULL").select(F.col(key).alias("__key"), F.col("rank").alias("__rank"))
    joined = docs.join(drawn, docs[key].eqNullSafe(drawn["__key"]))
    return joined.select(*(docs[c] for c in docs.columns if c != "rank"), F.col("__rank").alias("rank"))


_WORDS = "regexp_extract_all(" + LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE_SQL = f"""
WITH RECURSIVE
doc_words AS (SELECT row_number() OVER () AS r, doc_id, w, len(w) AS m FROM (SELECT doc_id, {_WORDS} AS w FROM documents)),
target_words AS (SELECT w, len(w) AS m FROM (SELECT {_WORDS} AS w FROM benchmark)),
doc_features AS (
    SELECT r, array_to_string(w[i:i + k - 1], ' ') AS f, count(*) AS n
    FROM doc_words, unnest(range(1, m + 1)) AS a(i), unnest([1, 2, 3]) AS b(k) WHERE i + k - 1 <= m GROUP BY ALL
),
target_features AS (
    SELECT array_to_string(w[i:i + k - 1], ' ') AS f, count(*) AS n
    FROM target_words, unnest(range(1, m + 1)) AS a(i), unnest([1, 2, 3]) AS b(k) WHERE i + k - 1 <= m GROUP BY ALL
),
features AS (SELECT f FROM doc_features UNION SELECT f FROM target_features),
{crc32_ctes("features", "f")},
source_totals AS (SELECT crc % {BUCKETS} AS b, sum(n) AS s FROM doc_features JOIN crc32 ON s = f GROUP BY ALL),
target_totals AS (SELECT crc % {BUCKETS} AS b, sum(n) AS t FROM target_features JOIN crc32 ON s = f GROUP BY ALL),
gain AS (
    SELECT b, floor(1000 * ln(
        ((coalesce(t, 0) + 1) * (coalesce((SELECT sum(s) FROM source_totals), 0) + {BUCKETS}))::DOUBLE
        / ((coalesce(s, 0) + 1) * (coalesce((SELECT sum(t) FROM target_totals), 0) + {BUCKETS}))::DOUBLE))::BIGINT AS g
    FROM (SELECT range AS b FROM range({BUCKETS})) LEFT JOIN source_totals USING (b) LEFT JOIN target_totals USING (b)
),
weighed AS (
    SELECT r, sum(n * g)::BIGINT AS weight FROM doc_features JOIN crc32 ON s = f JOIN gain ON gain.b = crc % {BUCKETS} GROUP BY r
),
scored AS (
    SELECT doc_id, m, (m + greatest(m - 1, 0) + greatest(m - 2, 0))::BIGINT AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT + 0.5::DOUBLE)
            / 4294967296)))::BIGINT AS score
    FROM doc_words LEFT JOIN weighed USING (r)
),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY m >= {MIN_WORDS} ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS place,
        count(*) FILTER (m >= {MIN_WORDS}) OVER () AS fit
    FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN m >= {MIN_WORDS} AND place <= {PERCENT} * fit // 100 THEN place END AS rank FROM placed
"""
