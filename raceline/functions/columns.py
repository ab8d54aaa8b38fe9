"""Column expressions with warehouse (PostgreSQL) semantics, built from
``pyspark.sql.functions`` only, so they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# The gap text meaning "no value", and the letter that marks a
# lapped car's gap ("+1 LAP").
NO_VALUE_TEXT = "None"
LAPPED_MARK = "L"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def concat_ignore_nulls(*parts: Column | str) -> Column:
    """SQL ``concat``: NULL arguments count as empty text (Spark's ``concat``
    would return NULL)."""
    return F.concat_ws("", *[_c(p).cast("string") for p in parts])


def round_half_up(col: Column | str, digits: int) -> Column:
    """``round(x::numeric, n)``: the value as decimal (9 decimals), rounded
    half away from zero, as double."""
    return F.round(_c(col).cast("decimal(38,9)"), digits).cast("double")


def exact_sum(col: Column | str) -> Column:
    """Sum over decimals of 9 digits: the same in any order of the rows."""
    return F.sum(_c(col).cast("decimal(28,9)"))


def add_seconds(ts: Column | str, seconds: Column | str) -> Column:
    """``ts + interval '1 second' * seconds`` with microsecond precision."""
    return _c(ts) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), _c(seconds).cast("decimal(18,6)"))


def epoch_seconds_between(a: Column | str, b: Column | str) -> Column:
    """``EXTRACT(EPOCH FROM a - b)`` as double seconds."""
    return (F.unix_micros(_c(a)) - F.unix_micros(_c(b))) / F.lit(1_000_000.0)


def strip_lapped(col: Column | str) -> Column:
    """Gap text of a lapped car (``'+1 LAP'``, any text with ``L``) -> NULL."""
    c = _c(col)
    return F.when(c.contains(LAPPED_MARK), F.lit(None).cast("string")).otherwise(c)


def clean_gap(col: Column | str) -> Column:
    """Staging rule for gap texts: ``'None'`` or anything with ``L`` -> NULL."""
    c = _c(col)
    return F.when((c == NO_VALUE_TEXT) | c.contains(LAPPED_MARK), F.lit(None).cast("string")).otherwise(c)


def nan_to_null(col: Column | str) -> Column:
    """NaN -> NULL (JSON nulls are NULL already)."""
    c = _c(col)
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)
