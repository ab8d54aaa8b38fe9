"""Raw timing tables from storage: ``<root>/<table>`` per table.

This is how the models run on real data: the loaders append to one table
per dataset under a root folder (parquet by default, optionally partitioned
by session_key); ``read_raw_tables`` reads them back with the fixed DDL
schemas (never inferred), lazily, and an absent table reads as empty. Of a
table that the loaders wrote only published loads are read.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from raceline import schemas
from raceline.session import prepare
from raceline.sources.manifest import read_stored


class StoredRawTables(Mapping[str, DataFrame]):
    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark, self.root, self.fmt = prepare(spark), root.rstrip("/"), fmt
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in schemas.RAW:
            raise KeyError(name)
        if name not in self._cache:
            df = read_stored(self.spark, f"{self.root}/{name}", schemas.RAW[name], self.fmt)
            self._cache[name] = df.select(*schemas.columns(name))
        return self._cache[name]

    def __iter__(self) -> Iterator[str]:
        return iter(schemas.RAW)

    def __len__(self) -> int:
        return len(schemas.RAW)


def read_raw_tables(spark: SparkSession, root: str, fmt: str = "parquet") -> StoredRawTables:
    """Lazy mapping table name -> DataFrame over ``<root>/<table>``."""
    return StoredRawTables(spark, root, fmt)
