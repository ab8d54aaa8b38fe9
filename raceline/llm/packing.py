"""Best-fit-decreasing packing of documents into fixed-size sequences.

Best fit decreasing treats pieces of equal length alike, and so open bins of
equal remaining capacity. The corpus therefore reaches the planner as a
histogram of piece lengths, at most ``capacity`` numbers however large the
corpus is. The planner runs best fit decreasing over it: a segment tree over
the remaining capacities holds how many bins are open at each, and its descent
finds the tightest bin that takes a length in O(log capacity); pieces of one
length go to bins of one remaining capacity by whole runs of bin numbers. The
result is exactly the packing of one global best fit decreasing, as a list of
runs whose number depends on the capacity alone. Each piece then finds its
place from its rank among the pieces of its length.
"""

from __future__ import annotations

import zlib
from collections import defaultdict, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from raceline.llm.common import Scratch, pieces
from raceline.llm.token_counts import WORD_BPE, encoder

#: Rows that one ranking task sorts, about.
RANK_ROWS = 8_000


class CapacityTree:
    """Segment tree over remaining capacities 0..capacity: how many bins are
    open at each. ``tightest(length)``: the smallest capacity >= length with
    an open bin, or None."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, remaining: int, bins: int) -> None:
        i = remaining + self.leaves
        while i:
            self.count[i] += bins
            i >>= 1

    def tightest(self, length: int) -> int | None:
        i = length + self.leaves
        if self.count[i]:
            return length
        while i > 1:  # up until a right sibling has bins, then down its left edge
            if i % 2 == 0 and self.count[i + 1]:
                i += 1
                while i < self.leaves:
                    i = 2 * i if self.count[2 * i] else 2 * i + 1
                return i - self.leaves
            i >>= 1
        return None


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best fit decreasing over a histogram of lengths: runs (length, first
    rank, bins, first bin, offset): the pieces of that length with ranks
    from ``first rank`` on go one each to ``bins`` bins from ``first bin`` on."""
    tree, runs, n_bins = CapacityTree(capacity), [], 0
    free: dict[int, deque] = defaultdict(deque)  # remaining capacity -> runs of bins

    def fill(first: int, bins: int, at: int, length: int, rank: int, each: int) -> int:
        """Put ``each`` pieces into every bin of a run with ``at`` left."""
        for k in range(each):
            runs.append((length, rank + k * bins, bins, first, capacity - at + k * length))
        free[at - each * length].append((first, bins))
        tree.add(at - each * length, bins)
        return rank + each * bins

    for length in sorted(histogram, reverse=True):
        rank, n = 0, histogram[length]
        while rank < n:
            at = tree.tightest(length)
            if at is None:  # open as many as the rest of this length needs
                at, number = capacity, -(-(n - rank) // (capacity // length))
                first, n_bins = n_bins, n_bins + number
            else:
                first, number = free[at].popleft()
                tree.add(at, -number)
            # A bin that took a piece is now tighter than the others, and so
            # takes pieces of this length until none fits.
            each = at // length
            full = min(number, (n - rank) // each)
            if full:
                rank = fill(first, full, at, length, rank, each)
            if full < number and rank < n:
                rank, full = fill(first + full, 1, at, length, rank, n - rank), full + 1
            if full < number:
                free[at].appendleft((first + full, number - full))
                tree.add(at, number - full)
    return runs


def cut(docs: DataFrame, capacity: int, text: str, key: str, tokenizer: str, end_id: int) -> DataFrame:
    """One row per piece: ``key, piece, start, length, ids_crc32, ids``."""
    table = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    last = np.asarray([end_id], "<u4").tobytes()

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for b in batches:
            row, number, ids = [], [], []
            for i, t in enumerate(b.column(1)):
                data = enc.encode(t.as_py()) + last
                for k in range(0, len(data), 4 * capacity):
                    row.append(i)
                    number.append(k // (4 * capacity))
                    ids.append(data[k : k + 4 * capacity])
            piece = np.asarray(number, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).take(pa.array(row, pa.int64())),
                    pa.array(piece.astype(np.int32)),
                    pa.array(piece * capacity),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                    pa.array(ids, pa.binary()),
                ],
                names=["key", "piece", "start", "length", "ids_crc32", "ids"],
            )

    kind = table.schema["key"].dataType.simpleString()
    schema = f"key {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, ids binary"
    return table.mapInArrow(tokenize, schema)


def pack(
    docs: DataFrame,
    capacity: int = 2048,
    text: str = "text",
    key: str = "doc_id",
    tokenizer: str = WORD_BPE,
    end_id: int = 0,
    with_ids: bool = False,
) -> DataFrame:
    """Pack every document (its token ids and ``end_id``) into sequences of
    at most ``capacity`` tokens. One row per piece: ``key``, ``piece``,
    ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``, and
    ``ids`` (little-endian unsigned 32-bit) if asked for.

    Only documents longer than the capacity are cut, into full pieces and one
    shorter rest. Null and empty texts are the end id alone. Repeated rows
    are packed once each. An empty table gives no rows. Other columns are
    not read."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "pack")
    cut_up = cut(docs, capacity, text, key, tokenizer, end_id)
    cut_up = scratch.write(cut_up if with_ids else cut_up.drop("ids"), "pieces")

    # Ranks within a length, without one task per length: pieces fall into
    # buckets by hash, are numbered inside (length, bucket), and start from
    # the number of pieces in the earlier buckets of their length.
    total = cut_up.count()
    salted = cut_up.withColumn("bucket", F.pmod(F.xxhash64("key", "piece", "ids_crc32"), F.lit(pieces(total, RANK_ROWS))))
    sizes = salted.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("length", "bucket").orderBy("key", "piece", "ids_crc32")
    ranked = salted.withColumn("rank", F.row_number().over(inside) - 1).join(first, ["length", "bucket"])

    # At most ``capacity`` rows.
    histogram = {r["length"]: r["n"] for r in cut_up.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = np.asarray(sorted(plan(histogram, capacity)), np.int64).reshape(-1, 5)
    places = spark.sparkContext.broadcast(runs)  # bounded by the capacity, not by the corpus

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = places.value
        stride = int(run[:, 1].max()) + 1 if len(run) else 1
        starts = run[:, 0] * stride + run[:, 1]
        for b in batches:
            length = np.asarray(b.column(b.schema.get_field_index("length")))
            rank = np.asarray(b.column(b.schema.get_field_index("rank")))
            # The last run of this length that starts at or before the rank.
            i = np.searchsorted(starts, length * stride + np.minimum(rank, stride - 1), "right") - 1
            added = [pa.array(run[i, 3] + rank - run[i, 1]), pa.array(run[i, 4])]
            kept = [n for n in b.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in kept), *added], names=[*kept, "sequence_id", "offset"])

    columns = ["key", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    to_place = ranked.select(*columns, (F.col("rank") + F.col("first")).cast("long").alias("rank"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in to_place.schema if f.name != "rank")
    out = to_place.mapInArrow(place, f"{kinds}, sequence_id bigint, offset bigint")
    return out.withColumnRenamed("key", key)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves, from ``pack(..., with_ids=True)``:
    ``sequence_id`` and ``ids`` (binary). A group is one sequence, which the
    capacity bounds."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b"").cast("binary"), lambda done, x: F.concat(done, x["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))
