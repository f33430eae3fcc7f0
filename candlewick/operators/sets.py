"""Set operations by column name."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def concat(frames: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def intersect(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b.select(*a.columns))


def except_(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.subtract(b.select(*a.columns))
