"""Resume ledger of finished (session_key, driver_number) pairs.

A CSV file set without header. Data is written first and the ledger second,
so a pair is in the ledger only once its rows are committed (a failed write
leaves its pairs to be redone). Reading never drops a first line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from raceline.schemas import LEDGER

PAIR = ["session_key", "driver_number"]


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(LEDGER).option("header", False).csv(path)
    except Exception as exc:  # an absent ledger means nothing is done yet
        if getattr(exc, "getCondition", lambda: None)() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], LEDGER)
        raise


def append_ledger(pairs: DataFrame, path: str) -> None:
    pairs.select(*PAIR).distinct().write.mode("append").option("header", False).csv(path)


def ledger_skip(pairs: DataFrame, ledger: DataFrame) -> DataFrame:
    """Pairs not yet in the ledger (NULL-safe, so a NULL pair never repeats)."""
    cond = [pairs[k].eqNullSafe(ledger[k]) for k in PAIR]
    return pairs.join(ledger.select(*PAIR).distinct(), cond, "left_anti")
