"""Ordered window results that never hold a whole group in one task.

A window over ``partitionBy(keys)`` sorts every row of a key in one task; a
key with a third of all rows becomes one straggler task. Both helpers cut
each key into ordered *blocks* (a column that never decreases along the sort
order, e.g. ``lap_number div 16`` or a time bucket), so

    result(row) = combine(prefix over the earlier blocks of its key,
                          window result inside its own block)

The per-block aggregates are partial on the map side, the prefix runs over
one row per block, and the in-block window over ``keys + block`` spreads a
hot key over as many tasks as it has blocks. Results equal the plain window
exactly whenever the block is monotone in the ordering.

The input is read twice (block aggregates, then the rows themselves). When
it sits on top of a shuffle the second read reuses that shuffle's output;
otherwise pass ``materialize=True`` to checkpoint it to the shared checkpoint
folder first, so its lineage runs once and a lost executor re-reads the
checkpoint instead of recomputing it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from raceline.session import checkpoint_dir


def _materialized(df: DataFrame) -> DataFrame:
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _prefix_window(keys: Sequence[str], block: str):
    return Window.partitionBy(*keys).orderBy(F.col(block).asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1
    )


def join_null_safe(df: DataFrame, other: DataFrame, cols: Sequence[str], how: str) -> DataFrame:
    """Equi join on ``cols`` where NULL matches NULL (a NULL key is a group
    of its own in a window, and must find its own prefix)."""
    renamed = other.select(*[F.col(c).alias(f"__k_{c}") for c in cols], *[c for c in other.columns if c not in cols])
    cond = [df[c].eqNullSafe(renamed[f"__k_{c}"]) for c in cols]
    return df.join(renamed, cond, how).drop(*[f"__k_{c}" for c in cols])


def blocked_running_max(
    df: DataFrame,
    keys: Sequence[str],
    block: str,
    order: Sequence[Column],
    values: dict[str, str],
    materialize: bool = False,
    summary: DataFrame | None = None,
) -> DataFrame:
    """Add ``out = max(value) over (partition by keys order by order rows
    between unbounded preceding and current row)`` for each ``out: value``.

    The prefix of a block is one more row of it, before all others, so ``df``
    is shuffled once, by keys and block (NULL ones are blocks of their own).
    ``summary`` has the keys, all blocks and the values of ``df``: the block
    maxima are taken from it, so wide rows need not be made twice. It may hold
    earlier blocks that ``df`` has no rows of."""
    if materialize:
        df = _materialized(df)
    maxima = [F.max(v).alias(v) for v in dict.fromkeys(values.values())]
    per_block = (df if summary is None else summary).groupBy(*keys, block).agg(*maxima)
    before = _prefix_window(keys, block)
    prefix = per_block.select(*keys, block, *[F.max(v).over(before).alias(v) for v in dict.fromkeys(values.values())])
    rows = df.withColumn("__own", F.lit(True)).unionByName(prefix, allowMissingColumns=True)
    inside = Window.partitionBy(*keys, block).orderBy(F.col("__own").asc_nulls_first(), *order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumns({o: F.max(v).over(inside) for o, v in values.items()}).where("__own").drop("__own")


def blocked_row_numbers(
    df: DataFrame, keys: Sequence[str], numbers: dict[str, tuple[Column, Sequence[Column]]], materialize: bool = False
) -> DataFrame:
    """Add ``out = row_number() over (partition by keys order by order)`` for
    each ``out: (block, order)``. All of them read ``df`` from one exchange by
    the first block, or from one materialisation of it."""
    names = {out: f"__block_{out}" for out in numbers}
    df = df.withColumns({names[out]: block for out, (block, _) in numbers.items()})
    df = _materialized(df) if materialize else df.repartition(*keys, next(iter(names.values())))
    ranked = df
    for out, (_, order) in numbers.items():
        block = names[out]
        counts = df.groupBy(*keys, block).agg(F.count(F.lit(1)).alias("__n"))
        before = F.coalesce(F.sum("__n").over(_prefix_window(keys, block)), F.lit(0))
        ranked = join_null_safe(ranked, counts.select(*keys, block, before.alias("__offset")), [*keys, block], "inner")
        inside = Window.partitionBy(*keys, block).orderBy(*order)
        ranked = ranked.withColumn(out, (F.row_number().over(inside) + F.col("__offset")).cast("long")).drop("__offset")
    return ranked.drop(*names.values())
