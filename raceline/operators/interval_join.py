"""Point-in-range joins (``p.t BETWEEN r.lo AND r.hi`` plus equality keys).

A plain equi join on the keys with the BETWEEN as residual compares every
point of a key with every range of the same key inside one task: a session
with a third of all samples would land in one task and be checked against
all its laps. Here the range axis is cut into fixed-width buckets; each range
is exploded into the buckets it covers and each point lands in exactly one
bucket, so the join is an equi join on ``keys + bucket`` with the BETWEEN as
a cheap residual. A hot key is spread over as many tasks as it has buckets,
every (point, range) pair is produced exactly once, and the result does not
depend on the bucket width (only the cost does).

A range that covers more than ``most`` buckets (MOST_BUCKETS unless given),
for example a lap of a wrong duration of years, is not exploded into all of
them: its buckets are 2, 4, 8, ... times as wide, so that it has ``most`` + 1
rows at most. Points get a row for each such level that a range uses, one row
in ordinary data. A small ``most`` suits joins with more ranges than points.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, TimestampNTZType, TimestampType

_BUCKET, _LEVEL = "__bucket", "__level"
#: Rows of a range, at most (a power of two).
MOST_BUCKETS = 64


def _axis(df: DataFrame, name: str) -> tuple[Column, bool]:
    dtype = df.schema[name].dataType
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return F.unix_micros(F.col(name).cast("timestamp")), True
    return F.col(name).cast("long"), False


def _bucket_of(axis: Column, width: int) -> Column:
    """Exact integer floor division (no floating point on the axis)."""
    w = F.lit(width).cast("long")
    return ((axis - F.pmod(axis, w)) / w).cast("long")


def _width(is_time: bool, width: float) -> int:
    return int(round(width * 1_000_000)) if is_time else int(width)


def _check(points: DataFrame, ranges: DataFrame, keys: Sequence[str]) -> None:
    shared = (set(points.columns) & set(ranges.columns)) - set(keys)
    if shared:
        raise ValueError(f"interval join: rename shared non-key columns first: {sorted(shared)}")


def _bits(n: Column) -> Column:
    """Binary digits of a non-negative long (0 has one)."""
    return F.length(F.bin(n))


def _shifted(n: Column, by: Column) -> Column:
    return F.call_function("shiftright", n, by.cast("int"))


def _levelled(ranges: DataFrame, lo: str, hi: str, width: float, most: int) -> DataFrame:
    """The ranges with the buckets of their ends and their level: the least at
    which they are at most ``most`` (a power of two) buckets long."""
    lo_axis, is_time = _axis(ranges, lo)
    hi_axis, _ = _axis(ranges, hi)
    w = _width(is_time, width)
    located = ranges.withColumns({"__first": _bucket_of(lo_axis, w), "__last": _bucket_of(hi_axis, w)})
    many = F.greatest(F.lit(0), _bits(F.greatest(F.lit(0).cast("long"), F.col("__last") - F.col("__first"))) - _bits(F.lit(most - 1).cast("long")))
    return located.withColumn(_LEVEL, F.coalesce(many, F.lit(0)).cast("int"))


def bucketed_points(points: DataFrame, point: str, ranges: DataFrame, lo: str, hi: str, width: float | None, most: int = MOST_BUCKETS) -> DataFrame:
    """One row per point and level that a range uses."""
    if width is None:
        return points.withColumns({_LEVEL: F.lit(0), _BUCKET: F.lit(0).cast("long")})
    axis, is_time = _axis(points, point)
    used = _levelled(ranges.select(lo, hi), lo, hi, width, most).agg(F.collect_set(_LEVEL)).scalar()
    located = points.withColumn("__at", _bucket_of(axis, _width(is_time, width))).withColumn(_LEVEL, F.explode(used))
    return located.withColumn(_BUCKET, _shifted(F.col("__at"), F.col(_LEVEL))).drop("__at")


def bucketed_ranges(ranges: DataFrame, lo: str, hi: str, width: float | None, most: int = MOST_BUCKETS) -> DataFrame:
    """One row per (range, covered bucket of its level). Empty or NULL ranges
    keep a single row (they match nothing but survive a left join).
    ``width=None`` puts everything in one bucket: the plain equi join with the
    BETWEEN residual."""
    if width is None:
        return ranges.withColumns({_LEVEL: F.lit(0), _BUCKET: F.lit(0).cast("long")})
    first, last = (_shifted(F.col(c), F.col(_LEVEL)) for c in ("__first", "__last"))
    covered = F.when(first <= last, F.sequence(first, last)).otherwise(F.array(first))
    return _levelled(ranges, lo, hi, width, most).withColumn(_BUCKET, F.explode(covered)).drop("__first", "__last")


def interval_join(
    points: DataFrame,
    ranges: DataFrame,
    keys: Sequence[str],
    point: str,
    lo: str,
    hi: str,
    width: float,
    hi_inclusive: bool = True,
    most: int = MOST_BUCKETS,
) -> DataFrame:
    """Inner join: every (point, range) pair with equal keys and
    ``lo <= point <= hi`` (``lo <= point < hi`` with ``hi_inclusive=False``).
    ``width`` is the bucket width in seconds for timestamp axes, in units
    otherwise."""
    _check(points, ranges, keys)
    p = bucketed_points(points, point, ranges, lo, hi, width, most).alias("p")
    r = bucketed_ranges(ranges, lo, hi, width, most).alias("r")
    cond = [F.col(f"p.{k}") == F.col(f"r.{k}") for k in keys]
    cond += [
        F.col(f"p.{_LEVEL}") == F.col(f"r.{_LEVEL}"),
        F.col(f"p.{_BUCKET}") == F.col(f"r.{_BUCKET}"),
        F.col(f"p.{point}") >= F.col(f"r.{lo}"),
        (F.col(f"p.{point}") <= F.col(f"r.{hi}")) if hi_inclusive else (F.col(f"p.{point}") < F.col(f"r.{hi}")),
    ]
    out = [F.col(f"p.{k}").alias(k) for k in keys]
    out += [F.col(f"p.`{c}`") for c in points.columns if c not in keys]
    out += [F.col(f"r.`{c}`") for c in ranges.columns if c not in keys]
    return p.join(r, cond, "inner").select(*out)


def interval_left_aggregate(
    ranges: DataFrame,
    points: DataFrame,
    keys: Sequence[str],
    point: str,
    lo: str,
    hi: str,
    width: float,
    group_by: Sequence[str | Column],
    aggs: Sequence[Column],
    matched_only: bool = False,
    most: int = MOST_BUCKETS,
) -> DataFrame:
    """``ranges LEFT JOIN points ON keys AND point BETWEEN lo AND hi GROUP BY
    group_by`` for aggregates that ignore NULL inputs (min, max, avg, sum,
    count(col)): buckets of a range without a matching point contribute only
    NULL rows, which such aggregates skip, and a range without any match still
    yields its group with NULL aggregates, exactly as the plain left join.
    ``matched_only`` leaves those groups out, for a caller that joins the
    result to its ranges anyway: only matches are shuffled for the groups."""
    _check(points, ranges, keys)
    p = bucketed_points(points, point, ranges, lo, hi, width, most).alias("p")
    r = bucketed_ranges(ranges, lo, hi, width, most).alias("r")
    cond = [F.col(f"p.{k}") == F.col(f"r.{k}") for k in keys]
    cond += [
        F.col(f"p.{_LEVEL}") == F.col(f"r.{_LEVEL}"),
        F.col(f"p.{_BUCKET}") == F.col(f"r.{_BUCKET}"),
        F.col(f"p.{point}") >= F.col(f"r.{lo}"),
        F.col(f"p.{point}") <= F.col(f"r.{hi}"),
    ]
    cols = [F.col(f"r.`{c}`") for c in ranges.columns]
    cols += [F.col(f"p.`{c}`") for c in points.columns if c not in keys]
    joined = r.join(p, cond, "inner" if matched_only else "left").select(*cols)
    return joined.groupBy(*group_by).agg(*aggs)


#: Levels of the blocks of ``range_aggregate``: each twice as wide as the one
#: below, so 40 of them from any width on hold all of the time axis in one.
LEVELS = 40
#: Added to block numbers, so that none is negative.
_ORIGIN = 1 << 42


def dyadic_cover(first: Column, end: Column) -> Column:
    """The blocks [first, end) as the fewest aligned blocks of 1, 2, 4, ...
    times the size: array of (level, block), at most two per level.

    With l = first - 1 and r = end taken as leaves of a binary tree, these are
    the right neighbours of the left children above l and the left neighbours
    of the right children above r, below their common parent."""
    left, right = first - 1, end
    levels = F.sequence(F.lit(0), _bits(left.bitwiseXOR(right)) - 2)
    above_left = F.filter(levels, lambda k: _shifted(left, k) % 2 == 0)
    above_right = F.filter(levels, lambda k: _shifted(right, k) % 2 == 1)
    pieces = F.concat(
        F.transform(above_left, lambda k: F.struct(k.alias("level"), (_shifted(left, k) + 1).alias("block"))),
        F.transform(above_right, lambda k: F.struct(k.alias("level"), (_shifted(right, k) - 1).alias("block"))),
    )
    return F.when(right - left > 1, pieces).otherwise(F.array().cast("array<struct<level:int,block:bigint>>"))


#: Added to instants, so that none is negative.
_AT = 1 << 62
#: What a range asks for: a block of a level (sides 0), or the part of a block
#: up to (side 1) or from (side -1) an instant.
_PIECE = ("level", "block", "at", "side")


def _ends(first: Column, last: Column, lo: Column, hi: Column) -> Column:
    """The instants from ``lo`` on in its block ``first`` and up to ``hi`` in
    ``last``, level -1. If both are one block: the last instants from ``lo`` on
    of the aligned block of 2^k units that holds it, and the first ones up to
    ``hi`` of the next such block, level -2 - k. (k is the highest digit in
    which ``lo`` and ``hi`` differ, so these blocks meet between them.)"""
    digit = _bits(lo.bitwiseXOR(hi)) - 1
    level = F.when(first != last, F.lit(-1)).otherwise(-2 - digit).cast("int").alias("level")

    def end(block: Column, at: Column, side: int) -> Column:
        return F.struct(level, F.when(first != last, block).otherwise(_shifted(at, digit)).alias("block"), at.alias("at"), F.lit(side).alias("side"))

    return F.when(lo == hi, F.array(end(last, hi, 1))).otherwise(F.array(end(first, lo, -1), end(last, hi, 1)))


def range_aggregate(
    ranges: DataFrame,
    points: DataFrame,
    keys: Sequence[str],
    point: str,
    lo: str,
    hi: str,
    width: float,
    partials: dict[str, tuple[Column, Callable[[str], Column]]],
) -> DataFrame:
    """``ranges`` (distinct rows) with aggregates over the points in ``[lo, hi]``,
    NULL (sums, max) for a range without points. ``partials``: name -> (the
    aggregate over points, the function that merges two of them).

    The points are aggregated per instant, per block of ``width`` and per
    block of each coarser level. Ranges with the same ends are answered once.
    One takes the coarsest blocks inside it, at most two a level, and a row
    for each of its ends (``_ends``): what the block of that end holds up to
    it, or from it on, is a running aggregate over the instants of the block
    and the ends asked for. So no end is compared with all instants of its
    block, and every join is an equi join."""
    axis, is_time = _axis(points, point)
    if not is_time and not isinstance(points.schema[point].dataType, IntegralType):
        raise ValueError("range aggregate: times or whole numbers only")
    w = _width(is_time, width)
    merged = [m(n).alias(n) for n, (_, m) in partials.items()]
    own = {k: f"__{k}" for k in keys}
    timed = points.where(F.col(point).isNotNull()).select(*(F.col(k).alias(own[k]) for k in keys), "*", axis.alias("__axis"))
    instants = timed.groupBy(*own.values(), "__axis").agg(*[a.alias(n) for n, (a, _) in partials.items()])
    instants = instants.select(*own.values(), (_bucket_of(F.col("__axis"), w) + _ORIGIN).alias("__in"), (F.col("__axis") + _AT).alias("__at"), *partials)
    finest = instants.groupBy(*own.values(), "__in").agg(*merged)
    levelled = finest.withColumn("__level", F.explode(F.sequence(F.lit(0), F.lit(LEVELS - 1)))).withColumn("__block", _shifted(F.col("__in"), F.col("__level")))
    blocks = levelled.groupBy(*own.values(), "__level", "__block").agg(*merged)

    spans = ranges.where(F.col(lo) <= F.col(hi)).select(*(F.col(k).alias(own[k]) for k in keys), F.col(lo).alias("__lo"), F.col(hi).alias("__hi")).distinct()
    ends = {c: _axis(spans, c)[0] for c in ("__lo", "__hi")}
    first, last = (_bucket_of(a, w) + _ORIGIN for a in ends.values())
    whole = F.transform(dyadic_cover(first + 1, last), lambda x: F.struct(x["level"].alias("level"), x["block"].alias("block"), F.lit(0).cast("long").alias("at"), F.lit(0).alias("side")))
    pieces = F.concat(whole, _ends(first, last, *(a + _AT for a in ends.values())))
    asked = spans.withColumn("__x", F.explode(pieces)).select(*own.values(), "__lo", "__hi", *(F.col(f"__x.{c}").alias(f"__{c}") for c in _PIECE))

    # Instants have a row for each way in which an end asks for its block.
    used = asked.where(F.col("__level") < 0).agg(F.collect_set("__level")).scalar()
    cells = instants.withColumn("__level", F.explode(used)).withColumn("__side", F.explode(F.array(F.lit(-1), F.lit(1))))
    within = F.when(F.col("__level") == -1, F.col("__in")).otherwise(_shifted(F.col("__at"), -2 - F.col("__level")))
    at_ends = asked.where(F.col("__level") < 0).select(*own.values(), *(f"__{c}" for c in _PIECE)).distinct().withColumn("__asked", F.lit(True))
    rows = cells.withColumn("__block", within).drop("__in").unionByName(at_ends, allowMissingColumns=True)
    up_to = Window.partitionBy(*own.values(), "__level", "__block", "__side").orderBy(F.col("__at") * F.col("__side"))
    running = rows.select(*own.values(), *(f"__{c}" for c in _PIECE), "__asked", *(m(n).over(up_to).alias(n) for n, (_, m) in partials.items()))
    running = running.where("__asked").drop("__asked")

    held = running.unionByName(blocks.withColumns({"__at": F.lit(0).cast("long"), "__side": F.lit(0)}))
    totals = asked.join(held, [*own.values(), *(f"__{c}" for c in _PIECE)]).groupBy(*own.values(), "__lo", "__hi").agg(*merged)
    same = [F.col(k) == F.col(own[k]) for k in keys] + [F.col(lo) == F.col("__lo"), F.col(hi) == F.col("__hi")]
    return ranges.join(totals, same, "left").select(*(F.col(c) for c in ranges.columns), *partials)
