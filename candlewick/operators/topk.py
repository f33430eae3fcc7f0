"""Limits and rankings over whole tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.functions.scalars import QUOTE


def top(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    """Each task keeps its own n best; only those meet."""
    return df.orderBy(*order).limit(n)


def newest_ranked(df: DataFrame, day: Column, rank: str, n: int = 10, worst_first: bool = True) -> DataFrame:
    """Newest day first, then by rank. The default takes the highest rank numbers."""
    return top(df, [day.desc(), F.desc(rank) if worst_first else F.asc(rank)], n)


def listed_coins(
    ranked: DataFrame, listed: DataFrame, n: int, excluded: Sequence[str], symbol: str = "symbol", rank: str = "rank"
) -> DataFrame:
    """The first n ranked symbols that are listed and not excluded, plus the quote asset itself."""
    kept = ranked.filter(~F.col(symbol).isin(*excluded)).join(listed.select(symbol).distinct(), symbol, "left_semi")
    extra = ranked.filter(F.col(symbol) == QUOTE)
    return top(kept, [rank, symbol], n).unionByName(extra.select(*kept.columns))
