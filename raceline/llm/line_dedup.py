"""Line dedup: a suffix array over line sequences by prefix doubling.

Every document is a sequence of lines (blank lines don't count). Prefix
doubling sorts the suffixes of all sequences by their first 1, 2, 4, ...
lines: the rank by 2k lines is the rank of the pair (rank by k lines here,
rank by k lines k lines further on), found by a sort of the distinct pairs.
Suffixes of equal rank by k lines are an interval of the suffix array whose
longest common prefix is at least k lines. A suffix whose next k lines occur
once is alone in its interval and leaves the later rounds, so these work on
repeated lines only.

A repeated run counts from ``min_words`` words on. Of these the shortest ones
that start at a line and the shortest ones that end at a line are looked at:
their lengths t in lines are decided by their words alone, and the interval of
t lines (k <= t < 2k) is named by two overlapping ranks by k lines. The first
member of an interval in document order is kept; from the others the t lines
are removed. A longer repeated run is the union of such shortest runs: a line
with fewer than ``min_words`` words from it to the run's end is in the shortest
run that ends there or, if that begins later, has so many before it that the
shortest run ending at the line itself is inside. So what is removed are the
later copies of the maximal repeated runs, and doubling can stop at
``min_words`` lines.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from raceline.llm.common import WORD, Scratch

#: Words from which on a repeated run is removed.
MIN_WORDS = 50


def _text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")), F.lit(3))


def _units(docs: DataFrame, text: str) -> DataFrame:
    """One row per distinct (doc_id, text): ``unit`` (numbers in document
    order: doc_id, null last), ``doc_id``, ``text_key`` and the lines that hold
    a word as array of (line_no, words, two hashes)."""
    lines = F.transform(
        F.split(F.coalesce(F.col(text), F.lit("")), "\n"),
        lambda x, i: F.struct(
            i.alias("line_no"), F.regexp_count(x, F.lit(WORD)).alias("words"), F.xxhash64(x).alias("a"), F.xxhash64(x, F.lit(1)).alias("b")
        ),
    )
    rows = docs.select("doc_id", _text_key(F.col(text)).alias("text_key"), F.filter(lines, lambda x: x["words"] > 0).alias("lines"))
    rows = rows.groupBy("doc_id", "text_key").agg(F.first("lines").alias("lines"))
    order = [F.col("doc_id").asc_nulls_last(), F.col("text_key").asc()]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("unit", F.monotonically_increasing_id())


def _lines(units: DataFrame, min_words: int) -> DataFrame:
    """A row per line: ``unit``, ``pos``, ``a``, ``b``, and the lengths in lines,
    ``t`` to ``most``, of the runs that start here (0: the document ends before
    ``min_words`` words). ``t`` is the shortest run of ``min_words`` words; the
    longer ones are the shortest that end at their last line, which is so as
    long as the next line's shortest run does not end before."""
    rows = units.select("unit", F.size("lines").alias("n"), F.posexplode("lines").alias("pos", "x")).select("unit", "n", "pos", "x.*")
    in_order = Window.partitionBy("unit").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("before", F.coalesce(F.sum(F.col("words").cast("long")).over(in_order), F.lit(0).cast("long")))
    # Lines that start less than min_words words after this one's start.
    by_words = Window.partitionBy("unit").orderBy("before")
    run = by_words.rangeBetween(0, min_words - 1)
    t = F.when(F.sum("words").over(run) >= min_words, F.count(F.lit(1)).over(run)).otherwise(F.lit(0))
    rows = rows.withColumn("t", t.cast("int")).withColumn("next", F.lead("t", 1, 0).over(by_words))
    # Runs from here are the shortest ending there up to the end of the next
    # line's shortest run, left out: there one line fewer is enough.
    most = F.when(F.col("next") > 0, F.col("next")).otherwise(F.col("n") - F.col("pos"))
    most = F.when(F.col("t") > 0, F.greatest("t", most)).otherwise(F.lit(0))
    return rows.select("unit", "pos", "a", "b", "t", most.cast("int").alias("most"))


def _ranks(keys: DataFrame, by: Sequence[str], scratch: Scratch, name: str) -> DataFrame:
    """Distinct ``keys`` with ``rank``, their place in the order of ``by``:
    a range-partitioned sort, numbered inside each partition and shifted by
    the rows of the partitions before (one row per partition)."""
    ordered = scratch.write(keys.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("part", F.spark_partition_id()), name)
    sizes = ordered.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    inside = Window.partitionBy("part").orderBy(*by)
    numbered = ordered.withColumn("n", F.row_number().over(inside) - 1).join(F.broadcast(shift), "part")
    return numbered.select(*by, (F.col("n") + F.col("shift")).cast("long").alias("rank"))


def _later_copies(active: DataFrame, k: int, scratch: Scratch) -> DataFrame:
    """Runs of k to 2k - 1 lines that are not the first of their interval.
    (The first ones are written, so that the join with them is one of two
    plain shuffles, whose large partitions Spark can split.)"""
    runs = active.where((F.col("most") >= k) & (F.col("t") < 2 * k) & (F.col("t") > 0))
    lengths = F.sequence(F.greatest(F.col("t"), F.lit(k)), F.least(F.col("most"), F.lit(2 * k - 1)))
    runs = runs.select("unit", "pos", "rank", F.explode(lengths).alias("t")).withColumn("pos2", F.col("pos") + F.col("t") - k)
    second = active.select("unit", F.col("pos").alias("pos2"), F.col("rank").alias("rank2"))
    runs = runs.join(second, ["unit", "pos2"])
    interval = ["t", "rank", "rank2"]
    first = runs.groupBy(*interval).agg(F.min(F.struct("unit", "pos")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    first = scratch.write(first.drop("n"), f"first{k}")
    later = runs.join(first, interval).where(F.struct("unit", "pos") != F.col("first"))
    return later.groupBy("unit", "pos").agg(F.max("t").alias("t"))


def repeated_runs(docs: DataFrame, text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """The later copies of the maximal repeated line runs: one row per
    document with any, ``doc_id``, ``text_key`` and ``runs`` (array of
    first and last line number, from 0, in order, without overlap)."""
    scratch = Scratch(docs.sparkSession, "lines")
    units = scratch.write(_units(docs, text), "units")
    lines = scratch.write(_lines(units, min_words), "lines")
    repeated = lines.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("a", "b")
    ranks = _ranks(repeated, ["a", "b"], scratch, "ids")
    active = scratch.write(lines.join(ranks, ["a", "b"]).drop("a", "b"), "by1")
    longest = active.agg(F.max("most")).first()[0] or 0

    k, later = 1, []
    while True:
        later.append(scratch.write(_later_copies(active, k, scratch), f"later{k}"))
        if 2 * k > longest:
            break
        second = active.select("unit", (F.col("pos") - k).alias("pos"), F.col("rank").alias("rank2"))
        pairs = scratch.write(active.join(second, ["unit", "pos"]), f"pairs{k}")
        pairs = pairs.withColumnsRenamed({"rank": "r1", "rank2": "r2"})
        several = pairs.groupBy("r1", "r2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("r1", "r2")
        ranks = _ranks(several, ["r1", "r2"], scratch, f"order{2 * k}")
        active = scratch.write(pairs.join(ranks, ["r1", "r2"]).drop("r1", "r2"), f"by{2 * k}")
        k *= 2

    # Runs of a document that overlap or touch are removed as one.
    marks = reduce(DataFrame.unionByName, later)
    so_far = Window.partitionBy("unit").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    begins = F.coalesce(F.col("pos") > F.max(F.col("pos") + F.col("t")).over(so_far), F.lit(True))
    run_no = F.sum(F.col("begins").cast("int")).over(so_far.rowsBetween(Window.unboundedPreceding, 0))
    islands = marks.withColumn("begins", begins).withColumn("run", run_no).groupBy("unit", "run")
    islands = islands.agg(F.min("pos").alias("first"), (F.max(F.col("pos") + F.col("t")) - 1).alias("last"))
    runs = islands.groupBy("unit").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("runs"))
    joined = runs.join(units.select("unit", "doc_id", "text_key", F.col("lines.line_no").alias("line_nos")), "unit")
    numbered = F.transform("runs", lambda r: F.struct(F.get("line_nos", r["first"]).alias("first"), F.get("line_nos", r["last"]).alias("last")))
    return joined.select("doc_id", "text_key", numbered.alias("runs"))


def remove_repeats(docs: DataFrame, text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """The documents with the later copies of repeated line runs removed from
    ``text``, and with ``n_lines`` (before), ``n_removed`` and ``removed``
    (array of first and last removed line, from 0). Input columns of these
    names are replaced.

    A run counts from ``min_words`` words on; its first copy by doc_id (null
    last) and place is kept, also against copies in the same document. Rows
    that agree in doc_id and text are one document and are cut alike. Null
    texts stay null, with no lines; an empty text is one blank line. Blank
    lines between removed lines go with them. An empty table gives no rows."""
    added = ("n_lines", "n_removed", "removed")
    runs = repeated_runs(docs, text, min_words).select(*(F.col(c).alias(f"__{c}") for c in ("doc_id", "text_key", "runs")))
    rows = docs.drop(*added).withColumn("__key", _text_key(F.col(text)))
    same = rows["doc_id"].eqNullSafe(runs["__doc_id"]) & (rows["__key"] == runs["__text_key"])
    lines = F.split(F.col(text), "\n")
    count = F.coalesce(F.size(lines), F.lit(0))
    none = F.array().cast(runs.schema["__runs"].dataType)
    joined = rows.join(runs, same, "left").withColumn("removed", F.coalesce("__runs", none))

    # What stands before, between and after the removed runs.
    def kept(i: Column) -> Column:
        begin = F.when(i > 0, F.get("removed", i - 1)["last"] + 1).otherwise(F.lit(0))
        end = F.when(i < F.size("removed"), F.get("removed", i)["first"]).otherwise(F.size(lines))
        return F.slice(lines, begin + 1, end - begin)

    rest = F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size("removed")), kept)), "\n")
    n_removed = F.aggregate("removed", F.lit(0), lambda n, r: n + r["last"] - r["first"] + 1)
    out = joined.withColumns({"n_lines": F.when(F.col(text).isNull(), 0).otherwise(count).cast("long"), "n_removed": n_removed.cast("long")})
    out = out.withColumn(text, F.when(F.size("removed") > 0, rest).otherwise(F.col(text)))
    return out.select(*docs.drop(*added).columns, *added)


#: The later copies of all pairs of equal line runs that can't be made longer,
#: found on the diagonals of equal line pairs (doc_id unique, small tables).
ORACLE_SQL = r"""
WITH lines AS (
    SELECT doc_id, i - 1 AS line_no, string_split(text, chr(10))[i] AS line,
           len(regexp_extract_all(string_split(text, chr(10))[i], '[^\x20\x09-\x0D]+')) AS words
    FROM (SELECT doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents)
), solid AS (
    SELECT doc_id, line_no, line, words, row_number() OVER w AS p, lead(line_no) OVER w AS next_no
    FROM lines WHERE words > 0 WINDOW w AS (PARTITION BY doc_id ORDER BY line_no)
), pairs AS (
    SELECT a.doc_id AS early, b.doc_id AS late, a.p AS p, b.p - a.p AS diagonal, b.words
    FROM solid a JOIN solid b ON a.line = b.line AND (a.doc_id < b.doc_id OR (a.doc_id = b.doc_id AND a.p < b.p))
), islands AS (
    SELECT *, p - row_number() OVER (PARTITION BY early, late, diagonal ORDER BY p) AS island FROM pairs
), runs AS (
    SELECT late, min(p) + diagonal AS first, max(p) + diagonal AS last FROM islands
    GROUP BY early, late, diagonal, island HAVING sum(words) >= 50
), cut AS (
    SELECT DISTINCT late AS doc_id, unnest(range(first, last + 1)) AS p FROM runs
), cut_lines AS (
    SELECT s.doc_id, s.p, s.line_no, s.next_no FROM solid s JOIN cut c ON c.doc_id = s.doc_id AND c.p = s.p
), gone AS (
    SELECT doc_id, line_no FROM cut_lines
    UNION
    SELECT a.doc_id, unnest(range(a.line_no, a.next_no)) FROM cut_lines a JOIN cut_lines b ON b.doc_id = a.doc_id AND b.p = a.p + 1
), counts AS (
    SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY doc_id
), rest AS (
    SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.line_no) AS text
    FROM lines l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.line_no = l.line_no WHERE g.line_no IS NULL GROUP BY l.doc_id
)
SELECT d.doc_id,
       CASE WHEN d.text IS NULL THEN 0 ELSE len(string_split(d.text, chr(10))) END AS n_lines,
       coalesce(c.n_removed, 0) AS n_removed,
       CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(r.text, '') END AS text
FROM documents d LEFT JOIN counts c ON c.doc_id = d.doc_id LEFT JOIN rest r ON r.doc_id = d.doc_id
"""
