"""N-gram Jaccard self-join by rare-first prefix filtering.

Two sets of word shingles with Jaccard similarity >= t share a shingle among
the first ``n - ceil(t n) + 1`` of each, if both are written in one common
order. Rare shingles first makes these prefixes selective. The order comes
from a count sketch over all documents: a fixed number of counters, each the
frequency of the shingles that hash to it, so a very frequent shingle is put
last however large the corpus is. Collisions only shift the order, which is
the same for all documents; the join stays exact.

1. Every document's set is hashed; documents with equal sets are one node.
2. The prefix shingles of all nodes are joined: a shingle that stands in one
   prefix only is gone after this shuffle. A shingle whose counter says that
   it may be in very many prefixes is dealt over several tasks.
3. Nodes gather in blocks by the prefix shingle that most others share, each
   of a bounded number of shingles. A node meets its own block and the nodes
   of other blocks that hold one of its prefix shingles. Bitmaps of the sets go
   there first; the text of a node that has a possible partner follows.
4. Inside a pair of blocks the prefix index, the length, positional and
   suffix filters leave pairs, each verified once by its exact intersection.
   A pair whose nodes are already linked through others needs no look; the
   pair of blocks reports a spanning forest of its links.
5. Connected components of these links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from raceline.llm.common import Scratch, grouped
from raceline.llm.components import connected_components

SHINGLE_WORDS = 5
#: Similarity as a fraction, exact in whole numbers.
SIMILAR = (80, 100)
#: Counters of the sketch (4 bytes each): the bound of what is broadcast.
COUNTERS = 1 << 20
#: Nodes of a shared prefix shingle that one task looks at, about.
RUN_NODES = 4_000
#: What a node counts besides its shingles, and the shingles that a block holds, about.
NODE_SHINGLES = 100
BLOCK_SHINGLES = 400_000

#: Bits of the filter of wanted texts (8 MB): the bound of what is broadcast with it.
FILTER_BITS = 1 << 26
FILTER_PARTS = 64

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class _WordHashes(dict):
    """Word -> 64-bit hash; bounded."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            if len(self) >= 1_000_000:
                self.clear()
            self[word] = h
        return h


_WORD_HASHES = _WordHashes()


def shingles(text: str, k: int = SHINGLE_WORDS) -> np.ndarray:
    """Distinct hashes of the k-word shingles, ascending. Fewer words make
    one shingle of the whole sequence; no words make none."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_WORD_HASHES.__getitem__, words), np.uint64, len(words))
    width = min(k, len(h))
    total = np.zeros(len(h) - width + 1, np.uint64)
    for i in range(width):
        total = total * _MULTIPLIER + h[i : len(h) - width + 1 + i]
    total ^= total >> np.uint64(31)
    total *= np.uint64(0xD6E8FEB86659FD93)
    total ^= total >> np.uint64(32)
    return np.unique(total)


def set_digest(hashes: np.ndarray) -> int:
    """Identity of a set, as a signed long."""
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(hashes.tobytes()))))


def ordered_keys(hashes: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """The set in the common order: keys ascend from rare to frequent. The
    upper 10 bits are the frequency class, the rest identifies the shingle."""
    rarity = classes[(hashes & np.uint64(len(classes) - 1)).astype(np.int64)].astype(np.uint64)
    return np.sort((rarity << np.uint64(54)) | (hashes >> np.uint64(10)))


def bitmap(hashes: np.ndarray) -> bytes:
    """One bit per shingle in a map of at least as many bits (a power of two,
    64 at least). Two maps of one size differ in no more bits than their sets
    in shingles; a map folds to half its size."""
    bits = np.zeros(max(64, 1 << max(0, len(hashes) - 1).bit_length()), np.uint8)
    bits[(hashes & np.uint64(len(bits) - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def may_link(n: np.ndarray, maps: list[bytes], side: np.ndarray) -> np.ndarray:
    """Which sets of a group can be similar to another one (of another side,
    if there are two): by length and by their bitmaps. Similar sets differ in
    at most (1 - t) / (1 + t) of their sizes' sum."""
    order = np.argsort(n, kind="stable")
    n, side = n[order], side[order]
    maps = [np.frombuffer(maps[i], np.uint64) for i in order]
    width = np.array([len(m) for m in maps])
    both = side.min() != side.max()
    low, high = SIMILAR
    found = np.zeros(len(n), bool)
    for w in np.unique(width):
        # Sets of this map size, and of twice the size folded, ascending.
        rows = np.flatnonzero((width == w) | (width == 2 * w))
        table = np.stack([maps[i] if width[i] == w else maps[i][:w] | maps[i][w:] for i in rows])
        size, own = n[rows], width[rows] == w
        for x in range(1, len(rows)):
            least = -(-low * int(size[x]) // high)
            first = int(np.searchsorted(size, least))
            fit = own[first:x].copy()
            if both:
                fit &= side[rows[first:x]] != side[rows[x]]
            y = first + np.flatnonzero(fit)
            if len(y):
                apart = np.bitwise_count(table[y] ^ table[x]).sum(1, dtype=np.int64)
                y = y[apart * (high + low) <= (high - low) * (size[y] + size[x])]
                if len(y):
                    found[rows[y]] = found[rows[x]] = True
    out = np.zeros(len(n), bool)
    out[order] = found
    return out


def needed(n: int) -> int:
    """Least size of a set that can be similar to one of n."""
    return -(-SIMILAR[0] * n // SIMILAR[1])


def prefix_length(n: int) -> int:
    return n - needed(n) + 1


def _first_pass(docs: DataFrame, text: str, scratch: Scratch) -> tuple[DataFrame, np.ndarray]:
    """Sets of all documents: ``doc_id``, ``text_key``, ``n``, ``node``,
    ``bits``; and the frequency class of each counter."""
    table = docs.select(
        F.col("doc_id"), text_key(F.col(text)).alias("text_key"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    parts = 64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, np.int64)
        names = ["doc_id", "text_key", "n", "node", "bits", "part", "counts"]
        kind = None
        for b in batches:
            kind, sizes, nodes, waiting = b.schema.field(0).type, [], [], []
            for t in b.column(2):
                h = shingles(t.as_py())
                sizes.append(len(h))
                nodes.append(set_digest(h))
                waiting.append(h)
            counts += np.bincount((np.concatenate(waiting) & np.uint64(COUNTERS - 1)).astype(np.int64), minlength=COUNTERS)
            bits = pa.array([bitmap(h) for h in waiting], pa.binary())
            none = pa.nulls(len(sizes), pa.int32()), pa.nulls(len(sizes), pa.binary())
            own = [b.column(0), b.column(1), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), bits]
            yield pa.RecordBatch.from_arrays([*own, *none], names=names)
        if kind is not None:
            packed = [x.astype("<i8").tobytes() for x in np.split(counts, parts)]
            gone = [pa.nulls(parts, t) for t in (kind, pa.int64(), pa.int64(), pa.int64(), pa.binary())]
            yield pa.RecordBatch.from_arrays([*gone, pa.array(range(parts), pa.int32()), pa.array(packed, pa.binary())], names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    both = scratch.write(
        table.mapInArrow(run, f"doc_id {kind}, text_key bigint, n bigint, node bigint, bits binary, part int, counts binary"), "sets"
    )

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py(), "<i8") for x in group.column("counts"))
        return pa.table({"part": group.column("part")[:1], "counts": pa.array([total.astype("<i8").tobytes()], pa.binary())})

    summed = both.where("part is not null").select("part", "counts").groupBy("part").applyInArrow(add, "part int, counts binary")
    counts = np.zeros(COUNTERS, np.int64)
    for r in summed.collect():  # ``parts`` rows, COUNTERS numbers
        counts.reshape(parts, -1)[r["part"]] = np.frombuffer(r["counts"], "<i8")
    classes = np.minimum(16 * np.log2(counts + 1), 1023).astype(np.uint16)
    return both.where("part is null").select("doc_id", "text_key", "n", "node", "bits"), classes


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")), F.lit(5))


def _shared_prefixes(docs: DataFrame, text: str, classes, spark: SparkSession) -> DataFrame:
    """``node``, ``n``, ``token``, ``run``: the prefix shingles that stand in
    at least two nodes; ``run``: how many nodes one task saw there."""
    table = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rarity, seen = classes.value, set()
        for b in batches:
            tokens, nodes, sizes = [], [], []
            for t in b.column(0):
                h = shingles(t.as_py())
                node = set_digest(h)
                if len(h) == 0 or node in seen:
                    continue
                if len(seen) < 200_000:  # copies in one task are told once; later ones merge after the shuffle
                    seen.add(node)
                prefix = ordered_keys(h, rarity)[: prefix_length(len(h))]
                tokens.append(prefix)
                nodes.append(np.full(len(prefix), node, np.int64))
                sizes.append(np.full(len(prefix), len(h), np.int32))
            if tokens:
                # A class of 16 x log2(count): at most this many nodes per counter.
                token, node = np.concatenate(tokens), np.concatenate(nodes)
                most = np.exp2((token >> np.uint64(54)).astype(np.float64) / 16 + 1 / 16)
                deals = np.ceil(most / RUN_NODES).astype(np.int64)
                deal = (node.view(np.uint64) >> np.uint64(7)).astype(np.int64) % deals
                arrays = [pa.array(token.view(np.int64)), pa.array(deal.astype(np.int32)), pa.array(node), pa.array(np.concatenate(sizes))]
                yield pa.RecordBatch.from_arrays(arrays, names=["token", "deal", "node", "n"])

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Sorted rows; the last run of a batch waits for the next batch.
        held = None
        for b in batches:
            if not b.num_rows:
                continue
            columns = [np.asarray(b.column(i)) for i in range(4)]
            if held is not None:
                columns = [np.concatenate(x) for x in zip(held, columns)]
            token, deal = columns[0], columns[1]
            last = np.flatnonzero((token != token[-1]) | (deal != deal[-1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            held = [x[cut:] for x in columns]
            if cut:
                yield from several([x[:cut] for x in columns])
        if held is not None and len(held[0]):
            yield from several(held)

    def several(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        token, deal, node, n = columns
        new = np.append(True, (token[1:] != token[:-1]) | (deal[1:] != deal[:-1]) | (node[1:] != node[:-1]))
        token, deal, node, n = token[new], deal[new], node[new], n[new]
        starts = np.flatnonzero(np.append(True, (token[1:] != token[:-1]) | (deal[1:] != deal[:-1])))
        lengths = np.diff(np.append(starts, len(token)))
        length = np.repeat(lengths, lengths)
        dealt = np.exp2((token.view(np.uint64) >> np.uint64(54)).astype(np.float64) / 16 + 1 / 16) > RUN_NODES
        keep = (length > 1) | dealt
        if keep.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(node[keep]), pa.array(n[keep]), pa.array(token[keep]), pa.array(length[keep])], names=["node", "n", "token", "run"]
            )

    postings = table.mapInArrow(emit, "token bigint, deal int, node bigint, n int")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = postings.repartition(parts, "token", "deal").sortWithinPartitions("token", "deal", "node")
    return ordered.mapInArrow(runs, "node bigint, n int, token bigint, run bigint")


def suffix_bound(x: np.ndarray, y: np.ndarray, depth: int = 2) -> int:
    """An upper bound of the common keys of two ascending arrays: both are cut
    at the middle key of y, again and again; a side can hold no more common
    keys than its smaller part."""
    if depth == 0 or len(x) == 0 or len(y) == 0:
        return min(len(x), len(y))
    middle = len(y) // 2
    at = int(np.searchsorted(x, y[middle]))
    return suffix_bound(x[:at], y[:middle], depth - 1) + suffix_bound(x[at:], y[middle:], depth - 1)


def block_links(nodes: np.ndarray, sets: list[np.ndarray], side: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links between the sets (keys in the common
    order). ``side``: all equal, then every pair counts; else only pairs of
    different sides."""
    order = np.argsort([len(s) for s in sets], kind="stable")
    nodes, sets, side = nodes[order], [sets[i] for i in order], side[order]
    sizes = np.array([len(s) for s in sets])
    both = side.min() != side.max()
    label = np.arange(len(sets))
    index: dict[int, tuple[list[int], list[int]]] = {}
    links, overlap = [], np.zeros(len(sets), np.int64)
    low, high = SIMILAR
    for x, keys in enumerate(sets):
        n = len(keys)
        least = needed(n)
        prefix = keys[: prefix_length(n)].tolist()
        touched = []
        for i, key in enumerate(prefix):
            entry = index.get(key)
            if entry is not None:
                y, j = np.asarray(entry[0]), np.asarray(entry[1])
                # Length filter; nothing to find inside one component.
                fit = (sizes[y] >= least) & (label[y] != label[x])
                if both:
                    fit &= side[y] != side[x]
                y, j = y[fit], j[fit]
                if len(y):
                    # Positional filter: what can still follow on both sides.
                    need = -(-low * (n + sizes[y]) // (low + high))
                    reach = overlap[y] + 1 + np.minimum(n - i - 1, sizes[y] - j - 1)
                    overlap[y] = np.where((reach >= need) & (overlap[y] >= 0), overlap[y] + 1, -1_000_000)
                    touched.append(y)
        if touched:
            found = np.unique(np.concatenate(touched))
            found = found[overlap[found] > 0]
            for y in found[np.argsort(-overlap[found], kind="stable")]:
                if label[y] == label[x]:
                    continue
                need = -(-low * (n + sizes[y]) // (low + high))
                if suffix_bound(keys, sets[y]) < need:
                    continue
                common = len(np.intersect1d(keys, sets[y], assume_unique=True))
                if high * common >= low * (n + sizes[y] - common):
                    links.append((int(nodes[x]), int(nodes[y])))
                    label[label == label[y]] = label[x]
            overlap[np.concatenate(touched)] = 0
        for j, key in enumerate(prefix):
            entry = index.setdefault(key, ([], []))
            entry[0].append(x)
            entry[1].append(j)
    return links


def _positions(key: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(FILTER_BITS)) for seed in (61, 62)]


def key_filter(keys: DataFrame) -> np.ndarray:
    """A Bloom filter of the column ``key``: a bit map of FILTER_BITS bits, two
    a key. Its parts are made from distinct bit numbers, so none is larger
    than its share of the map, whatever the number of keys."""
    each = FILTER_BITS // FILTER_PARTS
    bits = keys.select(F.explode(F.array(*_positions(F.col("key")))).alias("bit")).distinct()

    def pack(group: pa.Table) -> pa.Table:
        bit = np.asarray(group.column("bit").combine_chunks())
        held = np.zeros(each, np.uint8)
        held[bit % each] = 1
        return pa.table({"part": pa.array([int(bit[0] // each)], pa.int32()), "map": pa.array([np.packbits(held, bitorder="little").tobytes()], pa.binary())})

    out = np.zeros((FILTER_PARTS, each // 8), np.uint8)
    parts = bits.withColumn("part", F.floor(F.col("bit") / F.lit(each)).cast("int")).groupBy("part").applyInArrow(pack, "part int, map binary")
    for r in parts.collect():  # FILTER_PARTS rows, FILTER_BITS bits
        out[r["part"]] = np.frombuffer(r["map"], np.uint8)
    return out.reshape(-1)


def may_hold(held, key: Column) -> Column:
    """Whether the (broadcast) filter may have the key."""

    @F.arrow_udf("boolean")
    def look(a: pa.Array, b: pa.Array) -> pa.Array:
        found = np.ones(len(a), bool)
        for bits in (np.asarray(a), np.asarray(b)):
            found &= (held.value[bits >> 3] >> (bits & 7).astype(np.uint8)) & 1 == 1
        return pa.array(found)

    return look(*_positions(key))


def similar_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id``, ``text_key`` (hash of the text), ``n_shingles`` and
    ``component_id``: the smallest doc_id that is reachable by links
    (similarity 0.8 or more of the sets of five-word shingles).

    Null, empty and blank texts have no shingles, link with nothing and are
    their own component. Repeated rows give repeated rows. A null doc_id
    takes part in links; its component is the smallest doc_id that is not
    null, null if there is none. An empty table gives no rows."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "ngrams")
    sets, classes = _first_pass(docs, text, scratch)
    rarity = spark.sparkContext.broadcast(classes)  # COUNTERS numbers

    shared = scratch.write(_shared_prefixes(docs, text, rarity, spark), "shared")
    # A node's block: the prefix shingle that most others share, in bounded pieces.
    anchors = shared.groupBy("node").agg(F.max(F.struct("run", "token")).alias("anchor"), F.first("n").alias("n"))
    anchors = scratch.write(anchors.select("node", "n", F.col("anchor.token").alias("anchor")), "anchors")
    weights = anchors.groupBy("anchor").agg(F.ceil(F.sum(F.col("n") + NODE_SHINGLES) / F.lit(BLOCK_SHINGLES)).cast("long").alias("pieces"))
    block = F.xxhash64("anchor", F.pmod(F.xxhash64("node"), F.col("pieces")))
    blocks = scratch.write(anchors.join(weights, "anchor").select("node", block.alias("block")), "blocks")

    # A node meets the others of its block, and the nodes of every block that
    # shares one of its prefix shingles.
    placed = shared.select("node", "token").join(blocks, "node")
    there = placed.select("token", F.col("block").alias("other")).distinct()
    across = placed.join(there, "token").where("block <> other").select("node", "block", "other").distinct()
    several = blocks.groupBy("block").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("block")
    inside = blocks.join(several, "block", "left_semi").select("node", "block", F.col("block").alias("other"))
    meet = across.unionByName(inside).select(
        "node", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"), (F.col("block") > F.col("other")).cast("int").alias("side")
    )

    # Maps of the sets meet first; a node without a partner there stays away.
    one = sets.groupBy("node").agg(F.min(F.struct("doc_id", "text_key")).alias("one"), F.first("n").alias("n"), F.first("bits").alias("bits"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, ("first", "second")):
            group = group.combine_chunks()
            side = np.asarray(group.column("side").combine_chunks())
            keep = may_link(np.asarray(group.column("n").combine_chunks()), group.column("bits").to_pylist(), side)
            if keep.any():
                yield from group.drop_columns(["n", "bits"]).filter(pa.array(keep)).to_batches()

    maps = meet.join(one, "node").select("first", "second", "side", "node", F.col("one.doc_id").alias("id"), F.col("one.text_key").alias("id_key"), "n", "bits")
    maps = maps.repartition(parts, "first", "second").sortWithinPartitions("first", "second")
    kind = docs.schema["doc_id"].dataType.simpleString()
    wanted = maps.mapInArrow(sift, f"first bigint, second bigint, side int, node bigint, id {kind}, id_key bigint")
    wanted = scratch.write(wanted, "wanted")

    scratch.drop("shared", "anchors", "blocks")

    # The text of one document of each of these nodes goes there; the filter
    # keeps all others from being shuffled, however many are wanted.
    held = spark.sparkContext.broadcast(key_filter(wanted.select(F.col("id_key").alias("key"))))  # FILTER_BITS bits
    rows = docs.select("doc_id", text_key(F.col(text)).alias("key"), F.col(text).alias("text")).where(may_hold(held, F.col("key")))
    same = rows["doc_id"].eqNullSafe(wanted["id"]) & (rows["key"] == wanted["id_key"])
    met = rows.join(wanted, same).select("first", "second", "side", "node", "text")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, ("first", "second")):
            node, keep = np.unique(np.asarray(group.column("node")), return_index=True)  # repeated rows once
            side = np.asarray(group.column("side"))[keep]
            found = [ordered_keys(shingles(group.column("text")[int(i)].as_py()), rarity.value) for i in keep]
            links = block_links(node, found, side)
            if links:
                a, b = zip(*links)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    met = met.repartition(parts, "first", "second").sortWithinPartitions("first", "second")
    links = scratch.write(met.mapInArrow(link, "a bigint, b bigint"), "links")
    scratch.drop("wanted")
    roots = connected_components(links, scratch)

    known = sets.join(roots, "node", "left").withColumn("class", F.coalesce("root", "node"))
    least = known.where("n > 0").groupBy("class").agg(F.min("doc_id").alias("least"))
    out = known.join(least, "class", "left")
    component = F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "text_key", F.col("n").alias("n_shingles"), component.alias("component_id"))


#: The same from all pairs that share a shingle (small tables).
ORACLE_SQL = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), grams AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id
), common AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
    SELECT x, y FROM common JOIN sizes s ON s.doc_id = x JOIN sizes t ON t.doc_id = y WHERE 100 * c >= 80 * (s.n + t.n - c)
), reach AS (
    SELECT doc_id, doc_id AS r FROM documents
    UNION
    SELECT reach.doc_id, links.y FROM reach JOIN links ON links.x = reach.r
)
SELECT d.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(reach.r) AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id JOIN reach ON reach.doc_id = d.doc_id
GROUP BY d.doc_id
"""
