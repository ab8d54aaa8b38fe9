"""Spelling variants by a trie-node pair dictionary.

Two words are near if one inserted, deleted or replaced code point parts them.
The vocabulary is put into two tries, of the words and of the words read
backwards, and their nodes are numbered, so that a prefix or a suffix is one
integer. A word then has, for each position, the pair of the nodes before and
after it:

* skipped position: (prefix before i, suffix after i). Words that share such
  a pair differ by what stands at i: one replaced code point.
* inserted position: (prefix before i, suffix from i on). A word whose skipped
  pair is another word's inserted pair is that word with one more code point.

So the near words are exactly those that meet in a pair, and rows of integers
are all that is shuffled. A pair fixes the lengths of prefix and suffix: it
holds one word with an inserted position at most, and a word with a skipped
position for each code point of the alphabet (90) at most.

The nodes are numbered in the sorted vocabulary. A node is named after the
first word that has its prefix: the start of that word in the concatenation of
all words, plus the depth. Along a sorted range this takes only the common
prefix of neighbours; what a range shares with the ranges before and after it
follows from the first words of the ranges, which are broadcast.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from raceline.llm.common import Scratch, shuffle_partitions
from raceline.llm.sql import LOWER, crc32_ctes

#: Fixed values of the contract.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
DAMAGED_EACH, MIN_LENGTH, MIN_COUNT, MIN_RATIO = 97, 5, 3, 2
_LOWER = bytes(i + 32 if 65 <= i <= 90 else i for i in range(256))
#: Words that a task counts before it hands its counts on.
HELD_WORDS = 500_000


def count_words(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``word``, ``n``: the words of all texts and how often they occur.

    Counts are summed in the task before the shuffle, so a word that makes up
    a third of all text is one row per task."""
    rows = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("null")).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}

        def held() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])

        for b in batches:
            for k, t in zip(b.column(0), b.column(1)):
                lowered = t.as_py().encode().translate(_LOWER).decode()
                state = zlib.crc32(f"{k.as_py()}:".encode())
                for word, n in Counter(RUN.findall(lowered)).items():
                    h = zlib.crc32(word.encode(), state)
                    if h % DAMAGED_EACH == 0:
                        cut = h % len(word)
                        word = word[:cut] + word[cut + 1 :]
                    if len(word) >= MIN_LENGTH:
                        counts[word] = counts.get(word, 0) + n
                if len(counts) >= HELD_WORDS:
                    yield held()
                    counts.clear()
        yield held()

    return rows.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def shared(a: str, b: str) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    i = 0
    while a[i] == b[i]:
        i += 1
    return i


def first_nodes(part: int, firsts: list[str], adjacent: list[int], bases: list[int]) -> np.ndarray:
    """Nodes of the prefixes of ``firsts[part]``: each is named after the
    first range whose first word has it. ``adjacent[j]``: length shared by
    the first words of the ranges j - 1 and j."""
    size = len(firsts[part])
    nodes = bases[part] + np.arange(size + 1, dtype=np.int64)
    for j in range(part, 0, -1):
        size = min(size, adjacent[j])
        nodes[: size + 1] = bases[j - 1] + np.arange(size + 1)
    return nodes


def number_nodes(words: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``words`` (distinct ``word``s and other columns) with ``place`` (number
    in sorted order) and ``nodes`` (of all prefixes, from the empty one on)."""
    spark = words.sparkSession
    size = shuffle_partitions(spark)
    ranges = words.repartitionByRange(size, "word").sortWithinPartitions("word").withColumn("part", F.spark_partition_id())
    ranges = scratch.write(ranges, f"{name}-ranges")
    found = ranges.groupBy("part").agg(F.min("word").alias("first"), F.count(F.lit(1)).alias("n"), F.sum(F.length("word") + 1).alias("chars"))
    infos = sorted((r.part, r.first, r.n, r.chars) for r in found.collect())  # a row per range
    index = {part: i for i, (part, *_) in enumerate(infos)}
    firsts = [f for _, f, _, _ in infos]
    adjacent = [0] + [shared(a, b) for a, b in zip(firsts, firsts[1:])]
    places, bases = [0], [0]
    for _, _, n, chars in infos:
        places.append(places[-1] + n)
        bases.append(bases[-1] + chars)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = place = base = at = None
        before, nodes, after = "", np.zeros(0, np.int64), ""
        for b in batches:
            of_part, column = b.column(b.schema.get_field_index("part")), b.column(b.schema.get_field_index("word"))
            out_places, out_nodes = [], []
            for p, w in zip(of_part.to_pylist(), column.to_pylist()):
                if p != part:
                    part, at = p, index[p]
                    place, base = places[at], bases[at]
                    before, nodes = firsts[at], first_nodes(at, firsts, adjacent, bases)
                    after = firsts[at + 1] if at + 1 < len(firsts) else ""
                old, ahead = shared(before, w), shared(w, after)
                new = base + np.arange(len(w) + 1, dtype=np.int64)
                if ahead > old:  # named after the next range's first word
                    new[old + 1 : ahead + 1] = bases[at + 1] + np.arange(old + 1, ahead + 1)
                new[: old + 1] = nodes[: old + 1]
                before, nodes = w, new
                out_places.append(place)
                out_nodes.append(new)
                place, base = place + 1, base + len(w) + 1
            bounds = np.cumsum([0, *map(len, out_nodes)]).astype(np.int32)
            flat = np.concatenate(out_nodes) if out_nodes else np.zeros(0, np.int64)
            rest = b.drop_columns(["part"])
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, pa.array(out_places, pa.int64()), pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat))],
                names=[*rest.schema.names, "place", "nodes"],
            )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in words.schema)
    sorted_ranges = ranges.repartition(size, "part").sortWithinPartitions("part", "word")
    return scratch.write(sorted_ranges.mapInArrow(run, f"{kinds}, place bigint, nodes array<bigint>"), name)


def near_words(words: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """From distinct (``word``, ``n``): the numbered words (``place``,
    ``word``, ``n``) and, of those that have near words, ``place``, ``n_near``
    and ``best``: the near word of largest ``n``, then of smallest ``place``
    (struct of n and -place)."""
    forward = number_nodes(words.select("word", "n"), scratch, "prefixes")
    backward = number_nodes(forward.select(F.reverse("word").alias("word"), F.col("place").alias("of")), scratch, "suffixes")
    both = forward.join(backward.select(F.col("of").alias("place"), F.col("nodes").alias("suffixes")), "place")

    def node(column: str, i: Column) -> Column:
        return F.get(F.col(column), i)

    size = F.size("nodes") - 1
    letters = F.split("word", "")
    skipped = F.transform(
        F.sequence(F.lit(0), size - 1),
        lambda i: F.struct(
            node("nodes", i).alias("p"),
            node("suffixes", size - 1 - i).alias("s"),
            F.lit(False).alias("gap"),
            # Of a run of one letter only the first, as taking out any of them gives the same word.
            ((i == 0) | (node("letters", i) != node("letters", F.greatest(i - 1, F.lit(0))))).alias("head"),
        ),
    )
    inserted = F.transform(
        F.sequence(F.lit(0), size),
        lambda i: F.struct(node("nodes", i).alias("p"), node("suffixes", size - i).alias("s"), F.lit(True).alias("gap"), F.lit(False).alias("head")),
    )
    rows = both.withColumn("letters", letters).select("place", "n", F.inline(F.concat(skipped, inserted)))
    met = rows.groupBy("p", "s").agg(F.collect_list(F.struct("place", "n", "gap", "head")).alias("words")).where(F.size("words") > 1)

    def near(m: Column) -> Column:
        others = F.filter("words", lambda x: (x["place"] != m["place"]) & F.when(m["gap"], x["head"]).when(x["gap"], m["head"]).otherwise(True))
        best = F.array_max(F.transform(others, lambda x: F.struct(x["n"].alias("n"), (-x["place"]).alias("minus_place"))))
        return F.struct(m["place"].alias("place"), F.size(others).cast("long").alias("n_near"), best.alias("best"))

    each = met.select(F.inline(F.transform("words", near))).where(F.col("n_near") > 0)
    found = each.groupBy("place").agg(F.sum("n_near").alias("n_near"), F.max("best").alias("best"))
    return forward.select("place", "word", "n"), scratch.write(found, "near")


def variants(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` of every
    word with MIN_LENGTH code points that occurs MIN_COUNT times.

    Null and empty texts have no words; texts are read whole, and a run of any
    length is a word. A null key counts as ``null``. Repeated rows count as
    often as they stand there. Words of equal n: the smallest in code-point
    order is the form. An empty table, or one without frequent words, gives no
    rows. Other columns are not read."""
    scratch = Scratch(docs.sparkSession, "spelling")
    counted = scratch.write(count_words(docs, text, key).where(F.col("n") >= MIN_COUNT), "words")
    words, near = near_words(counted, scratch)
    has_form = F.col("best.n") >= MIN_RATIO * F.col("n")
    linked = words.join(near, "place", "left").select(
        "place",
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has_form, -F.col("best.minus_place")).alias("form_place"),
        F.when(has_form, F.col("best.n")).alias("form_n"),
    )
    linked = scratch.write(linked, "linked")

    # Every link at least doubles n: 62 links at most, so a few doublings of the jump.
    jumps = linked.where(F.col("form_place").isNotNull()).select("place", F.col("form_place").alias("root"))
    jumps, step, going = scratch.write(jumps, "jumps0"), 0, True
    while going:
        onward = jumps.select(F.col("place").alias("root"), F.col("root").alias("onward"))
        further = jumps.join(onward, "root", "left").select("place", F.coalesce("onward", "root").alias("root"), F.col("onward").isNotNull().alias("moved"))
        step += 1
        jumps = scratch.write(further, f"jumps{step}")
        going = bool(jumps.where("moved").limit(1).count())

    names = words.select("place", "word")
    form = names.select(F.col("place").alias("form_place"), F.col("word").alias("form"))
    root = names.select(F.col("place").alias("root_place"), F.col("word").alias("root"))
    changed = linked.where(F.col("form_place").isNotNull()).join(jumps.select("place", F.col("root").alias("root_place")), "place")
    changed = changed.join(form, "form_place").join(root, "root_place")
    columns = ["word", "form", "root", "n", "n_near", "form_n"]
    alone = linked.where(F.col("form_place").isNull()).select("word", F.lit(None).cast("string").alias("form"), F.col("word").alias("root"), "n", "n_near", "form_n")
    return alone.unionByName(changed.select(*columns)).select(*columns)


ORACLE_SQL = f"""
WITH RECURSIVE
runs AS (
    SELECT coalesce(doc_id::VARCHAR, 'null') || ':' || w AS name, w, count(*) AS n
    FROM (SELECT doc_id, unnest(regexp_extract_all({LOWER.format("text")}, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS w FROM documents) GROUP BY ALL
),
{crc32_ctes("runs", "name")},
damaged AS (
    SELECT CASE WHEN crc % {DAMAGED_EACH} = 0 THEN left(w, crc % length(w)) || substr(w, crc % length(w) + 2) ELSE w END AS word, n
    FROM runs JOIN crc32 ON s = name
),
words AS (SELECT word, sum(n)::BIGINT AS n FROM damaged WHERE length(word) >= {MIN_LENGTH} GROUP BY word HAVING sum(n) >= {MIN_COUNT}),
cut AS (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest FROM words, unnest(range(length(word))) AS u(i)),
near AS (
    SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
    UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word
),
best AS (
    SELECT word, count(*) OVER (PARTITION BY word) AS n_near, other, other_n
    FROM near QUALIFY row_number() OVER (PARTITION BY word ORDER BY other_n DESC, encode(other)) = 1
),
forms AS (
    SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN other_n >= {MIN_RATIO} * w.n THEN other END AS form,
        CASE WHEN other_n >= {MIN_RATIO} * w.n THEN other_n END AS form_n
    FROM words w LEFT JOIN best USING (word)
),
walk AS (
    SELECT word, word AS root, form AS next FROM forms
    UNION ALL
    SELECT w.word, f.word, f.form FROM walk w JOIN forms f ON f.word = w.next
)
SELECT f.word, f.form, w.root, f.n, f.n_near, f.form_n FROM forms f JOIN walk w ON w.word = f.word AND w.next IS NULL
"""
