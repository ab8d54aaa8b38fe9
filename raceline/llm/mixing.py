"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source should be taken ``target / source size`` times:
the whole part of that number for certain, its fraction as a probability.
Pairs of documents settle these probabilities. A pair moves *words* (its
probability times its size) from one document to the other until one of the
two probabilities is 0 or 1; the direction is drawn so that each document
keeps its expected number of copies. The moved words leave the expected total
as it was, so a source's taken words stay at its target but for the one
document that is left at the very end, which is rounded to the nearer side.

The pairs form a reduction tree. Blocks of about ``FAN_IN`` documents are
settled one document after the other, the largest first, so that what stays
fractional is small; the one document left of each block enters the next
level, whose blocks hold about ``FAN_IN`` such residuals, and so on. No block
grows with its source. The draws are hashes of the paired documents, so
reruns agree.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from raceline.llm.common import WORD, Scratch

#: Documents or residuals that one block settles, about.
FAN_IN = 100
#: Drawings of a block, of which the first that leaves the fewest words open counts.
DRAWINGS = 12
#: A probability this near to 0 or 1 is settled.
EPS = 1e-9


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """``source``, ``source_size``, ``n_units``, ``target`` from rows of
    (source, size). Sources by code point, null last, weigh ``weights``,
    repeating, and share all words; a target stops at ``most`` times its
    source's size and the excess is reshared by weight.

    Resharing ends where every target is min(cap, level x weight) for one
    level. In order of cap per weight the capped sources come first, so the
    level follows from running sums over the sources (one row each)."""
    total_each = sizes.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n_rows")).alias("source_size"), F.count(F.lit(1)).alias("n_units")
    )
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1)
    weighed = total_each.withColumn("place", F.row_number().over(by_name)).withColumn("weight", weight.cast("double")).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    by_cap = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("place"))
    everything = Window.partitionBy()
    levels = weighed.select(
        "*",
        F.sum(F.col("source_size")).over(everything).alias("total"),
        F.coalesce(F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias("capped_before"),
        F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing)).alias("weight_from"),
    ).withColumn("level", (F.col("total") - F.col("capped_before")) / F.col("weight_from"))
    is_capped = F.col("cap") <= F.col("level") * F.col("weight")
    levels = levels.withColumn("final", F.min(F.when(~is_capped, F.struct(F.col("cap") / F.col("weight"), "place", "level"))).over(everything)["level"])
    target = F.when(is_capped | F.col("final").isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("final") * F.col("weight")))
    return levels.select("source", "source_size", "n_units", target.alias("target"))


def _settled(units: Column, doc_id_kind: str, seed: int) -> Column:
    """Settle an array of (size, doc_id, words, p) in its order: a struct of
    ``done`` (doc_id, words, x) and of ``carry``, the one that is left."""
    unit_kind = f"struct<size:bigint,doc_id:{doc_id_kind},words:bigint,p:double>"
    done_kind = f"array<struct<doc_id:{doc_id_kind},words:bigint,x:bigint>>"

    def with_p(unit: Column, p: Column) -> Column:
        return F.struct(unit["size"].alias("size"), unit["doc_id"].alias("doc_id"), unit["words"].alias("words"), p.alias("p"))

    def add(done: Column, unit: Column, p: Column) -> Column:
        x = F.round(p).cast("long")
        return F.concat(done, F.array(F.struct(unit["doc_id"].alias("doc_id"), unit["words"].alias("words"), x.alias("x"))))

    def state(done: Column, carry: Column) -> Column:
        return F.struct(done.alias("done"), carry.alias("carry"))

    def off(p: Column) -> Column:
        return F.least(F.abs(p), F.abs(1 - p))

    def pair(done: Column, a: Column, b: Column, drawing: Column) -> Column:
        # Words that can move from b to a, and from a to b.
        to_a = F.least((1 - a["p"]) * a["size"], b["p"] * b["size"])
        to_b = F.least(a["p"] * a["size"], (1 - b["p"]) * b["size"])
        ids = (a["doc_id"], a["words"], b["doc_id"], b["words"])
        draw = F.pmod(F.xxhash64(*ids, drawing, F.lit(seed)), F.lit(1 << 40)) / F.lit(float(1 << 40))
        moved = F.when(draw * (to_a + to_b) < to_b, to_a).otherwise(-to_b)
        after = F.struct((a["p"] + moved / a["size"]).alias("a"), (b["p"] - moved / b["size"]).alias("b"))
        # One of the two is whole now, up to rounding: the one nearer to it.
        return F.transform(
            F.array(after),
            lambda p: F.when(off(p["a"]) <= off(p["b"]), state(add(done, a, p["a"]), with_p(b, p["b"]))).otherwise(
                state(add(done, b, p["b"]), with_p(a, p["a"]))
            ),
        )[0]

    def settle(drawing: Column) -> Column:
        def merge(now: Column, b: Column) -> Column:
            done, a = now["done"], now["carry"]
            return (
                F.when(a.isNull(), state(done, b))
                .when(off(a["p"]) < EPS, state(add(done, a, a["p"]), b))
                .otherwise(pair(done, a, b, drawing))
            )

        return F.aggregate(units, state(F.array().cast(done_kind), F.lit(None).cast(unit_kind)), merge)

    drawn = F.transform(F.sequence(F.lit(1), F.lit(DRAWINGS)), lambda i: F.struct(i.alias("i"), settle(i).alias("out")))
    left_open = F.transform(
        drawn, lambda d: F.struct(F.round(off(d["out"]["carry"]["p"]) * d["out"]["carry"]["size"], 6).alias("open"), d["i"].alias("i"), d["out"].alias("out"))
    )
    return F.array_min(left_open)["out"]


def copies(docs: DataFrame, text: str = "text", seed: int = 2, weights: tuple[int, ...] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """One row per distinct (doc_id, source, size): those three,
    ``source_size``, ``target`` and ``copies``."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "mix")
    # Rows that agree in all three are one unit; each is taken equally often.
    units = scratch.write(
        docs.select("doc_id", "source", word_count(F.col(text)).alias("size")).groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("n_rows")),
        "units",
    )
    shares = scratch.write(targets(units, weights, most), "targets")
    largest = shares.agg(F.max("n_units")).first()[0] or 0

    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    named = shares.select(F.col("source").alias("s"), "n_units", "source_size", "target")
    rated = units.join(named, units["source"].eqNullSafe(named["s"])).select(
        "doc_id",
        "source",
        F.col("size").alias("words"),
        "n_rows",
        F.floor(expected).cast("long").alias("x"),
        (expected - F.floor(expected)).alias("p"),
        F.pmod(F.xxhash64("doc_id", "size", F.lit(seed)), F.ceil(F.col("n_units") / F.lit(FAN_IN)).cast("long")).alias("block"),
    )

    left, level = largest, 0
    unit = F.struct((F.col("words") * F.col("n_rows")).alias("size"), "doc_id", "words", "p")
    unsettled = rated.where((F.col("words") > 0) & (F.col("p") > EPS)).select("source", "block", unit.alias("unit"))
    decided = [rated.select("doc_id", "source", "words", "x")]
    while True:
        blocks = unsettled.groupBy("source", "block").agg(F.sort_array(F.collect_list("unit"), asc=False).alias("units"))
        blocks = blocks.select("source", "block", _settled(F.col("units"), docs.schema["doc_id"].dataType.simpleString(), seed).alias("out"))
        blocks = scratch.write(blocks.select("source", "block", "out.done", "out.carry"), f"level{level}")
        decided.append(blocks.select("source", F.inline("done")))
        left, level = math.ceil(left / FAN_IN), level + 1
        if left <= 1:  # one block per source: its last document goes to the nearer side
            decided.append(blocks.select("source", "carry.doc_id", "carry.words", F.round("carry.p").cast("long").alias("x")))
            break
        unsettled = blocks.select("source", F.floor(F.col("block") / F.lit(FAN_IN)).cast("long").alias("block"), F.col("carry").alias("unit"))

    taken = reduce(DataFrame.unionByName, decided).groupBy("doc_id", "source", "words").agg(F.sum("x").alias("copies"))
    named = shares.select(F.col("source").alias("s"), "source_size", "target")
    return taken.join(named, taken["source"].eqNullSafe(named["s"])).select(
        "doc_id", "source", F.col("words").alias("size"), "source_size", "target", "copies"
    )


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mix(docs: DataFrame, text: str = "text", seed: int = 2, weights: tuple[int, ...] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """The documents with ``size`` (words), ``source_size``, ``target``,
    ``copies`` (how often the mix takes the row, 0 to ``most``) and ``taken``
    (copies x size). Columns of these names in the input are replaced.

    Null and empty texts have no words and are not taken. A null source is a
    source of its own, the last in order. Rows that agree in doc_id, source
    and size are taken equally often. A null doc_id is a value like any
    other. An empty table gives no rows."""
    added = ("size", "source_size", "target", "copies", "taken")
    plan = copies(docs, text, seed, weights, most)
    plan = plan.select(*(F.col(c).alias(f"__{c}") for c in plan.columns))
    rows = docs.select(*(c for c in docs.columns if c not in added), word_count(F.col(text)).alias("size"))
    same = [rows[c].eqNullSafe(plan[f"__{c}"]) for c in ("doc_id", "source")]
    joined = rows.join(plan, reduce(Column.__and__, same, rows["size"] == plan["__size"]))
    kept = [rows[c] for c in rows.columns]
    return joined.select(
        *kept,
        F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"),
        F.col("__copies").alias("copies"),
        (F.col("__copies") * rows["size"]).alias("taken"),
    )


def mixed_rows(mixed: DataFrame) -> DataFrame:
    """The mix itself: every row as often as it is taken."""
    taken = mixed.where(F.col("copies") > 0)
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
