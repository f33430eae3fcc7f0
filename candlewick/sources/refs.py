"""Named tables: a source or a model is addressed by name, not by path."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class Refs:
    """``source(group, table)`` and ``ref(model)`` resolution."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._sources: dict[tuple[str, str], Callable[[], DataFrame]] = {}
        self._models: dict[str, Callable[[], DataFrame]] = {}

    def add_source(self, group: str, table: str, read: Callable[[], DataFrame]) -> None:
        self._sources[(group, table)] = read

    def add_parquet(self, group: str, table: str, path: str) -> None:
        self.add_source(group, table, lambda: self.spark.read.parquet(path))

    def add_model(self, name: str, read: Callable[[], DataFrame]) -> None:
        self._models[name] = read

    def source(self, group: str, table: str) -> DataFrame:
        if (group, table) not in self._sources:
            raise KeyError(f"unknown source {group}.{table}")
        return self._sources[(group, table)]()

    def ref(self, name: str) -> DataFrame:
        if name not in self._models:
            raise KeyError(f"unknown model {name}")
        return self._models[name]()
