"""Session selection rules of the loaders."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The session types requested by most loaders, and the name
# tokens of the intervals and weather loaders.
RACE_TYPES = ("Race", "Qualifying")
NAME_TOKENS = ("Qualifying", "Race", "Sprint", "Sprint Shootout")


def _truthy_key() -> F.Column:
    """A present, non-zero session key (0 and NULL are falsy)."""
    return F.coalesce(F.col("session_key"), F.lit(0)) != 0


def sessions_by_type(sessions: DataFrame, types: Sequence[str] = RACE_TYPES, check_key: bool = True) -> DataFrame:
    cond = F.col("session_type").isin(*types)
    return sessions.filter(cond & _truthy_key() if check_key else cond)


def sessions_one_type(sessions: DataFrame, types: Sequence[str] = ("Race",)) -> DataFrame:
    """Exactly the given type(s), with a key and both dates."""
    return sessions.filter(
        F.col("session_type").isin(*types)
        & _truthy_key()
        & F.col("date_start").isNotNull()
        & F.col("date_end").isNotNull()
    )


def sessions_by_name(sessions: DataFrame, tokens: Sequence[str] = NAME_TOKENS) -> DataFrame:
    """Session name contains any token (case-sensitive), and a key."""
    name = F.coalesce(F.col("session_name"), F.lit(""))
    cond = F.lit(False)
    for token in tokens:
        cond = cond | name.contains(token)
    return sessions.filter(cond & _truthy_key())


def session_limit(sessions: DataFrame, n: int | None) -> DataFrame:
    """Optional first-N sessions (by key), a feature of the weather loader."""
    return sessions if n is None else sessions.orderBy("session_key").limit(n)


def skip_sessions(sessions: DataFrame, deny: Iterable[int] | DataFrame) -> DataFrame:
    """Drop deny-listed sessions: a short literal list stays an ``isin``
    filter (pushed to the scan); a table of keys is a ``left_anti`` join."""
    if isinstance(deny, DataFrame):
        keys = deny.select("session_key").distinct()
        return sessions.join(keys, "session_key", "left_anti")
    return sessions.filter(~F.col("session_key").isin(list(deny)) | F.col("session_key").isNull())
