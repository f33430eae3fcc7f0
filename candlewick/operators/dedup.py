"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Keep the first row of each key in the given order.

    The rank filter becomes a per-task limit before the shuffle, so a key with very many copies
    sends one row per map task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def latest_by_offset(df: DataFrame, keys: Sequence[str], offset: str) -> DataFrame:
    return first_per_key(df, keys, [F.desc(offset)])


def prefer_source(df: DataFrame, keys: Sequence[str], source: str, preferred: str, ties: Sequence = ()) -> DataFrame:
    """One row per key, rows of the preferred source first."""
    rank = F.when(F.col(source) == preferred, F.lit(1)).otherwise(F.lit(2))
    return first_per_key(df, keys, [rank, *ties])


def first_n_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")
