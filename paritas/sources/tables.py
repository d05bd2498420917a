"""Parquet table readers (DM1, A4-A7 storage side)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """``{base_dir}/{name}.parquet``; column pruning and filters reach the scan through Catalyst."""
    return spark.read.parquet(f"{base_dir.rstrip('/')}/{name}.parquet")


class TableSet:
    """Lazy accessor for the tables of one directory: ``TableSet(spark, d).orders``."""

    def __init__(self, spark: SparkSession, base_dir: str):
        self.spark = spark
        self.base_dir = base_dir
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in TABLES:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = read_table(self.spark, self.base_dir, name)
        return self._cache[name]
