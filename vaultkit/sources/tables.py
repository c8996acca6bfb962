"""Reading source tables (Parquet) with optional explicit schema."""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Driver test tables (TPC-H-like star schema plus events).
TEST_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def read_table(spark: SparkSession, base: str, name: str, schema: T.StructType | str | None = None) -> DataFrame:
    """``<base>/<name>.parquet`` (file or folder); with ``schema`` no footer inference is needed."""
    path = os.path.join(base, f"{name}.parquet")
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


class Tables(Mapping):
    """Lazy name -> DataFrame mapping over a folder of Parquet tables (read once per name)."""

    def __init__(self, spark: SparkSession, base: str, overrides: Mapping[str, DataFrame] | None = None):
        self.spark = spark
        self.base = base
        self._cache: dict[str, DataFrame] = dict(overrides or {})
        self.memo: dict[str, object] = {}     # derived frames of this table set

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = read_table(self.spark, self.base, name)
        return self._cache[name]

    def __iter__(self):
        return iter(TEST_TABLES)

    def __len__(self) -> int:
        return len(TEST_TABLES)
