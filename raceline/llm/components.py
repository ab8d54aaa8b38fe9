"""Connected components of an edge list by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raceline.llm.common import Scratch


def connected_components(edges: DataFrame, scratch: Scratch, name: str = "cc") -> DataFrame:
    """``node``, ``root`` for every node of ``edges`` (long columns ``a``,
    ``b``): the smallest node that is reachable.

    Each round hangs every node's neighbours on the smallest of them: first
    the larger ones (large star), then the smaller ones (small star). The
    smallest neighbour is a partial aggregate, so a node with very many
    neighbours gathers in no task; the graph ends as one star per component
    after a logarithmic number of rounds. Each step is written to the shared
    folder, so each join is one of plain shuffles that Spark can split."""
    now = scratch.write(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{name}0")
    round_no = 0
    while True:
        # Large star: larger neighbours of a node go to the smallest of its neighbourhood.
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = scratch.write(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), f"{name}-least{round_no}")
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # Small star: smaller neighbours and the node itself go to the smallest of them.
        large = scratch.write(large, f"{name}-large{round_no}")
        smallest = scratch.write(large.groupBy("a").agg(F.min("b").alias("m")), f"{name}-smallest{round_no}")
        small = large.join(smallest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        after = scratch.write(small.unionAll(smallest.select("a", F.col("m").alias("b"))).distinct(), f"{name}{round_no + 1}")
        # Done when every smaller end is a root: it stands on no larger side.
        open_ends = after.select(F.col("b").alias("a")).join(after.select("a"), "a", "left_semi").limit(1).count()
        several = after.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count()
        scratch.drop(*(f"{name}{part}{round_no}" for part in ("", "-least", "-large", "-smallest")))
        now, round_no = after, round_no + 1
        if not open_ends and not several:
            break
    members = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return members.unionAll(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
