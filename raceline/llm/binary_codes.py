"""Near-duplicate vectors by randomly rotated binary codes.

A unit vector is rotated at random and kept as the signs of its coordinates,
with one correction factor: the inner product of the vector with its own
signs. For another vector q the signs' inner product with q, divided by that
factor, estimates the inner product of the two vectors without bias, and its
error is below ``z sqrt((1 - f^2) / (f^2 (D - 1)))`` with a confidence that
``z`` sets. The rotated coordinates of q are rounded to a byte each, and the
length of what rounding leaves out widens the bound by as much as it can change
the estimate. A pair whose upper bound stays below the threshold is settled by
the estimate; every other pair is computed again exactly, in double precision.

Pairs come from tables of sign bits: two vectors meet in a table if they
agree in its bits. The number of bits follows the number of vectors, so that
a bucket holds a few unrelated vectors at any size; the number of tables
follows the bits, so that a pair at the threshold meets somewhere with the
probability asked for (one far above it, nearly always). A pair counts in the
first table that it meets in. Large buckets are cut into pieces, and the pieces
compared two by two, so no task holds a bucket.

Only sketches (signs, factors and bytes) go through the tables. A bucket's
members that may be linked to another one there are named, the vectors are
fetched for these alone, and their pairs are computed exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raceline.llm.common import Scratch, shuffle_partitions, slabs
from raceline.llm.components import connected_components

#: Vectors that a piece of a bucket holds, about.
PIECE = 2_000
#: Vectors of a bucket by chance, about.
BUCKET = 8


@lru_cache(maxsize=16)
def rotation(dim: int, number: int, seed: int = 10) -> np.ndarray:
    """A random orthogonal matrix (uniform: signs of R fixed)."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dim, number]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def tables_for(n: int, threshold: float, missed: float) -> tuple[int, int]:
    """Bits of a table and number of tables."""
    bits = min(24, max(4, math.ceil(math.log2(max(2, n) / BUCKET))))
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(missed) / math.log(1 - agree))


def bucket_keys(unit: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """(rows, tables) bucket numbers: each the signs of ``bits`` coordinates
    of one more rotation after the code's own."""
    dim = unit.shape[1]
    each = max(1, dim // bits)  # tables that one rotation gives
    weights = 1 << np.arange(min(bits, dim), dtype=np.int64)
    out = []
    for number in range(-(-tables // each)):
        signs = (unit @ rotation(dim, number + 1).T) > 0
        out += [signs[:, k * bits : k * bits + len(weights)] @ weights for k in range(each)]
    return np.stack(out[:tables], axis=1)


def encode(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sign bits (packed) and correction factors of unit vectors."""
    turned = unit @ rotation(unit.shape[1], 0).T
    return np.packbits(turned > 0, axis=1), np.abs(turned).sum(1) / math.sqrt(unit.shape[1])


def sketch(unit: np.ndarray) -> list[bytes]:
    """What goes through the tables for unit vectors: correction factor, step
    of the rounded coordinates, length of what rounding leaves out (single
    precision), packed signs, rotated coordinates as signed bytes."""
    packed, factor = encode(unit)
    turned = unit @ rotation(unit.shape[1], 0).T
    step = np.abs(turned).max(1) / 127
    low = np.rint(turned / step[:, None]).astype(np.int8)
    rest = np.linalg.norm(turned - low * step[:, None], axis=1)
    numbers = np.stack([factor, step, rest], axis=1).astype(np.float32)
    return [n.tobytes() + p.tobytes() + q.tobytes() for n, p, q in zip(numbers, packed, low)]


def read_sketches(sketches: list[bytes], dim: int) -> tuple[np.ndarray, ...]:
    """Signs (packed), factors, rounded rotated vectors and the length of
    what rounding left out."""
    raw = np.frombuffer(b"".join(sketches), np.uint8).reshape(len(sketches), -1)
    head, bits = 3 * 4, (dim + 7) // 8
    factor, step, rest = raw[:, :head].copy().view(np.float32).T
    low = raw[:, head + bits :].copy().view(np.int8)
    return raw[:, head : head + bits], factor, low * step[:, None], rest


def upper_bounds(code: np.ndarray, factor: np.ndarray, turned: np.ndarray, z: float) -> np.ndarray:
    """For rows of codes and of rotated unit vectors: estimated inner product
    plus its error bound."""
    dim = turned.shape[1]
    signs = np.unpackbits(code, axis=1, count=dim).astype(np.float32) * 2 - 1
    estimate = np.einsum("ij,ij->i", signs, turned) / (math.sqrt(dim) * factor)
    return estimate + z * np.sqrt(np.maximum(1 - factor**2, 0) / (factor**2 * max(1, dim - 1)))


def valid_vectors(vectors: DataFrame, embedding: str = "embedding"):
    """Condition: not null, not empty, all components finite numbers, not zero."""
    v = F.col(embedding)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _spanning(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index that each of n rows is joined to by the pairs (a, b)."""
    label = np.arange(n)
    while True:
        least = label.copy()
        np.minimum.at(least, a, label[b])
        np.minimum.at(least, b, label[a])
        least = least[least]
        if (least == label).all():
            return label
        label = least


def _column(rows: pa.Table, name: str) -> np.ndarray:
    return np.asarray(rows.column(name).combine_chunks())


def _pairs(rows: pa.Table, step: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of a slab that a bucket's pieces compare, at most
    ``step`` at once: both ends of one piece, or one end of each."""
    columns = [_column(rows, name) for name in ("table", "key", "first", "second")]
    group = np.cumsum(np.append(0, np.any([c[1:] != c[:-1] for c in columns], axis=0)))
    side, apart = _column(rows, "side"), columns[2] != columns[3]
    live = np.arange(len(group))
    for d in range(1, len(group)):
        live = live[live + d < len(group)]
        live = live[group[live] == group[live + d]]
        if not len(live):
            return
        pick = live[~apart[live] | (side[live] != side[live + d])]
        for k in range(0, len(pick), step):
            yield pick[k : k + step], pick[k : k + step] + d


def _at_once(dim: int) -> int:
    return max(1, 4_000_000 // max(dim, 1))


def _may_link(rows: pa.Table, threshold: float, z: float) -> np.ndarray:
    """Which rows of a slab of sketches have a partner in their bucket that
    the bound does not rule out."""
    dim = rows.column("dim")[0].as_py()
    code, factor, turned, rest = read_sketches(rows.column("sketch").to_pylist(), dim)
    found = np.zeros(len(code), bool)
    for i, j in _pairs(rows, _at_once(dim)):
        near = upper_bounds(code[i], factor[i], turned[j], z) + rest[j] / factor[i] >= threshold
        found[i[near]] = found[j[near]] = True
    return found


def _compare(rows: pa.Table, threshold: float, z: float, bits: int, tables: int) -> tuple[np.ndarray, ...]:
    """Links inside the buckets of a slab of vectors: indices a, b of the
    pairs with cosine >= threshold, and whether the pair counts in this table."""
    table, dim = _column(rows, "table"), rows.column("dim")[0].as_py()
    x = np.asarray(rows.column("embedding").combine_chunks().flatten()).astype(np.float64).reshape(len(table), dim)
    norm = np.linalg.norm(x, axis=1)
    unit = x / norm[:, None]
    code, factor = encode(unit)
    turned = (unit @ rotation(dim, 0).T).astype(np.float32)

    found_a, found_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    step = _at_once(dim)
    for i, j in _pairs(rows, step):
        near = upper_bounds(code[i], factor[i], turned[j], z) >= threshold
        i, j = i[near], j[near]
        exact = np.einsum("ij,ij->i", x[i], x[j]) / (norm[i] * norm[j])
        found_a.append(i[exact >= threshold])
        found_b.append(j[exact >= threshold])
    a, b = np.concatenate(found_a), np.concatenate(found_b)
    counts = np.ones(len(a), bool)
    if len(a):
        ends = np.unique(np.concatenate([a, b]))
        keys = bucket_keys(unit[ends], bits, tables)
        ia, ib = np.searchsorted(ends, a), np.searchsorted(ends, b)
        for k in range(0, len(a), step):
            s = slice(k, k + step)
            counts[s] = np.argmax(keys[ia[s]] == keys[ib[s]], axis=1) == table[a[s]]
    return a, b, counts


def _slabs_by_dim(batches: Iterator[pa.RecordBatch], group: tuple[str, ...]) -> Iterator[pa.Table]:
    """Slabs of whole groups whose vectors have one length."""
    for slab in slabs(batches, group):
        dims = _column(slab, "dim")
        for dim in np.unique(dims):
            yield slab.filter(pa.array(dims == dim))


def near_duplicates(
    vectors: DataFrame, threshold: float = 0.9, embedding: str = "embedding", key: str = "vec_id", missed: float = 0.002, z: float = 4.0
) -> DataFrame:
    """``key``, ``n_links`` (other rows with cosine >= ``threshold`` that were
    found), ``component_id`` (smallest id that is reachable) and ``kept``
    (the id is its component's). ``missed``: probability that a pair just at the
    threshold meets in no table; ``z``: width of the confidence bound.

    Vectors that are null, empty, zero or hold null or non-finite components
    link with nothing; so do vectors of different lengths with each other.
    Equal vectors are compared once, as one, and count as linked rows of their
    own. Repeated rows are rows of their own. A component's smallest id
    leaves null ids out. An empty table gives no rows."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "codes")
    rows = vectors.select(F.col(key).alias("id"), F.when(valid_vectors(vectors, embedding), F.col(embedding)).alias("embedding"))
    rows = rows.withColumn("node", F.when(F.col("embedding").isNotNull(), F.xxhash64("embedding", F.lit(10))))
    distinct = rows.where("node is not null").groupBy("node", "embedding").agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("least"))
    distinct = scratch.write(distinct.withColumn("dim", F.size("embedding")), "vectors")
    bits, tables = tables_for(distinct.count(), threshold, missed)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = np.asarray(b.column("dim"))
            for dim in np.unique(dims):
                part = b.filter(pa.array(dims == dim))
                x = np.asarray(part.column("embedding").flatten()).astype(np.float64).reshape(-1, dim)
                unit = x / np.linalg.norm(x, axis=1)[:, None]
                keys = pa.array(list(bucket_keys(unit, bits, tables)), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("node"), part.column("dim"), pa.array(sketch(unit), pa.binary()), keys], names=["node", "dim", "sketch", "keys"]
                )

    coded = distinct.select("node", "dim", "embedding").mapInArrow(code, "node bigint, dim int, sketch binary, keys array<bigint>")
    coded = scratch.write(coded, "codes")
    met = coded.select("node", "dim", "sketch", F.posexplode("keys").alias("table", "key"))
    bucket = ["dim", "table", "key"]
    sizes = coded.select("dim", F.posexplode("keys").alias("table", "key")).groupBy(*bucket).agg(F.count(F.lit(1)).alias("n"))
    large = scratch.write(sizes.where(F.col("n") > PIECE).select(*bucket, F.ceil(F.col("n") / F.lit(PIECE)).cast("long").alias("pieces")), "large")
    cut = met.join(large, bucket, "left") if large.head(1) else met.withColumn("pieces", F.lit(None).cast("long"))
    # A piece meets itself and every other piece of its bucket, each pair once.
    own = F.pmod(F.xxhash64("node", F.lit(11)), F.coalesce("pieces", F.lit(1)))
    cut = cut.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("pieces", F.lit(1)) - 1)))
    group = [*bucket, "first", "second"]
    cut = cut.select(
        *bucket,
        F.least("own", "other").alias("first"),
        F.greatest("own", "other").alias("second"),
        (F.col("own") > F.col("other")).cast("int").alias("side"),
        "node",
        "sketch",
    )

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slabs_by_dim(batches, tuple(group)):
            told = part.filter(pa.array(_may_link(part, threshold, z))).drop_columns(["sketch"])
            yield from told.to_batches()

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slabs_by_dim(batches, tuple(group)):
            a, b, counts = _compare(part, threshold, z, bits, tables)
            if not len(a):
                continue
            node, copies = _column(part, "node"), _column(part, "copies")
            n = len(node)
            links = np.bincount(a[counts], copies[b[counts]], n) + np.bincount(b[counts], copies[a[counts]], n)
            label = _spanning(n, a, b)
            told = np.unique(np.concatenate([a, b]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(node[told]), pa.array(node[label[told]]), pa.array(links[told].astype(np.int64))], names=["a", "b", "links"]
            )

    parts = shuffle_partitions(spark)
    together = lambda df: df.repartition(parts, *group).sortWithinPartitions(*group)
    named = together(cut).mapInArrow(pick, "dim int, table int, key bigint, first bigint, second bigint, side int, node bigint")
    # A node is in as many rows as buckets that may link it; no pair is written.
    fetched = scratch.write(named, "named").join(distinct.select("node", "copies", "embedding"), "node")
    found = together(fetched).mapInArrow(link, "a bigint, b bigint, links bigint")
    found = scratch.write(found, "links")
    scratch.drop("codes", "large", "named")
    roots = connected_components(found.select("a", "b"), scratch)
    counted = found.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))

    per_node = distinct.select("node", "copies", "least").join(counted, "node", "left").join(roots, "node", "left")
    per_node = per_node.withColumn("root", F.coalesce("root", "node"))
    smallest = per_node.groupBy("root").agg(F.min("least").alias("component"))
    per_node = per_node.join(smallest, "root").select(
        F.col("node").alias("known"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component"
    )
    out = rows.select("id", "node").join(per_node, F.col("node") == F.col("known"), "left")
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component"))
    return out.select(
        F.col("id").alias(key),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )


#: The same from all pairs (small tables).
ORACLE_SQL = r"""
WITH RECURSIVE good AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS x, b.vec_id AS y FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.9
), reach AS (
    SELECT vec_id, vec_id AS r FROM embeddings
    UNION
    SELECT reach.vec_id, links.y FROM reach JOIN links ON links.x = reach.r
), component AS (
    SELECT vec_id, min(r) AS component_id FROM reach GROUP BY vec_id
)
SELECT e.vec_id, (SELECT count(*) FROM links WHERE x = e.vec_id) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN component c ON c.vec_id = e.vec_id
"""
