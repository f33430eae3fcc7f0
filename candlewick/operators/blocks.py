"""Ordered windows over keys that may hold a large part of all rows.

A plain ``Window.partitionBy(key)`` sends a whole key to one task. Here a key is cut into
consecutive blocks along its own order, and each block receives the few rows that precede it,
so row frames and lags give the same values as over the whole key while work is spread by
(key, block).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.operators.sets import concat
from candlewick.session import stage

BLOCK, CARRIED = "_block", "_carried"
BLOCK_ROWS = 5_000_000


@dataclass(frozen=True)
class Series:
    """How the rows of a key are ordered and where the order may be cut.

    ``order`` must be total within a key. ``levels`` are block expressions from coarse to fine,
    each non-decreasing along ``order``; the last one bounds a block by itself.
    """

    keys: Sequence[str]
    order: Sequence[str]
    levels: Sequence[Column]


def pick_level(df: DataFrame, series: Series, block_rows: int = BLOCK_ROWS) -> int:
    """The coarsest level whose largest block stays within ``block_rows``: a counted check, no guess.

    A table that is small as a whole (a count from file footers) needs no further look. Otherwise
    rows are counted once at the finest countable level; the coarser sizes are sums of those.
    """
    if df.count() <= block_rows:
        return 0
    names = [f"_level{i}" for i in range(len(series.levels) - 1)]
    counted = df.groupBy(*series.keys, *[c.alias(n) for c, n in zip(series.levels, names)]).agg(F.count("*").alias("_n"))
    largest = [
        counted.groupBy(*series.keys, n).agg(F.sum("_n").alias("_n")).agg(F.max("_n").alias("_n")).select(F.lit(i).alias("level"), "_n")
        for i, n in enumerate(names)
    ]
    fitting = [r.level for r in concat(largest).collect() if (r["_n"] or 0) <= block_rows]
    return min(fitting, default=len(series.levels) - 1)


def with_lookback(df: DataFrame, series: Series, n: int, level: int) -> DataFrame:
    """Rows of ``df`` with their block, plus for each block copies of the n rows before it.

    Copies are flagged in ``_carried``; drop them after the window.
    """
    keys, order = list(series.keys), list(series.order)
    columns = df.columns
    base = df.withColumn(BLOCK, series.levels[level])
    latest_first = Window.partitionBy(*keys, BLOCK).orderBy(*[F.desc(c) for c in order])
    # row_number() <= n is applied before the shuffle, so a hot block sends n rows per map task
    tails = base.withColumn("_rn", F.row_number().over(latest_first)).filter(F.col("_rn") <= n).drop("_rn")
    seen = f"_seen{level}"
    if level >= 2:
        # many small blocks: the tails are themselves cut at the next coarser level, down to days
        outer = Series(keys, order, series.levels[:level])
        fine = f"_fine{level}"
        inner = with_lookback(tails.withColumnRenamed(BLOCK, fine), outer, n, level - 1)
        tails = inner.withColumnsRenamed({BLOCK: f"_outer{level}", CARRIED: seen}).withColumnRenamed(fine, BLOCK)
        along = Window.partitionBy(*keys, f"_outer{level}").orderBy(*order)
    else:
        tails = tails.withColumn(seen, F.lit(False))
        along = Window.partitionBy(*keys).orderBy(*order)
    previous = F.collect_list(F.struct(*columns)).over(along.rowsBetween(-n, -1))
    before = F.lag(BLOCK).over(along)
    heads = (
        tails.withColumns({"_previous": previous, "_before": before})
        .filter(~F.col(seen) & F.col("_before").isNotNull() & (F.col("_before") != F.col(BLOCK)))
        .select(F.col(BLOCK), F.explode("_previous").alias("_row"))
    )
    carried = heads.select(*[F.col("_row")[c].alias(c) for c in columns], F.col(BLOCK), F.lit(True).alias(CARRIED))
    return base.withColumn(CARRIED, F.lit(False)).unionByName(carried)


def over_series(
    df: DataFrame, series: Series, lookback: int, build, level: int | None = None, block_rows: int = BLOCK_ROWS,
    stored: bool = False,
) -> DataFrame:
    """Add the columns ``build(window)`` returns, computed block-wise with an exact look-back.

    ``build`` takes the window (keys and block, ordered) and returns {name: Column}; its frames
    may reach at most ``lookback`` rows back. The rows are read up to three times (block sizes,
    block tails, the window), so they are written once first unless ``stored`` says that df is a
    cheap read of a stored table already.
    """
    if not stored:
        df = stage(df, "series")
    if level is None:
        level = pick_level(df, series, block_rows)
    extended = with_lookback(df, series, lookback, level)
    w = Window.partitionBy(*series.keys, BLOCK).orderBy(*series.order)
    out = extended.withColumns(build(w)).filter(~F.col(CARRIED))
    return out.drop(BLOCK, CARRIED)


def running_sum(df: DataFrame, series: Series, value: str, name: str, level: int) -> DataFrame:
    """Running total along a hot key: totals per block first, then an offset for each block.

    With many small blocks the offsets are themselves sums of two steps, so no task sees all blocks of a key.
    """
    keys = list(series.keys)
    base = df.withColumn(BLOCK, series.levels[level]).withColumn("_outer", series.levels[max(0, min(level - 1, 1))])
    totals = base.groupBy(*keys, "_outer", BLOCK).agg(F.sum(value).alias("_total"))
    before = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    earlier = lambda order, *by: F.coalesce(F.sum("_total").over(before(*by).orderBy(order)), F.lit(0))
    if level >= 2:
        # offsets of days (or months) first, then of the blocks inside each
        outer = totals.groupBy(*keys, "_outer").agg(F.sum("_total").alias("_total"))
        outer = outer.select(*keys, "_outer", earlier("_outer", *keys).alias("_start"))
        inner = totals.select(*keys, "_outer", BLOCK, earlier(BLOCK, *keys, "_outer").alias("_rest"))
        offsets = inner.join(outer, [*keys, "_outer"]).select(*keys, BLOCK, (F.col("_start") + F.col("_rest")).alias("_offset"))
    else:
        offsets = totals.select(*keys, BLOCK, earlier(BLOCK, *keys).alias("_offset"))
    base = base.drop("_outer")
    w = Window.partitionBy(*keys, BLOCK).orderBy(*series.order).rowsBetween(Window.unboundedPreceding, 0)
    inside = base.withColumn("_inside", F.sum(value).over(w))
    return (
        inside.join(offsets, [*keys, BLOCK])
        .withColumn(name, F.col("_inside") + F.col("_offset"))
        .drop("_inside", "_offset", BLOCK)
    )


def trade_series(
    keys: Sequence[str] = ("pair_symbol",),
    date: str = "transaction_date",
    second: str = "_second",
    id_col: str = "agg_trade_id",
    ids_per_block: int = 1_000_000,
) -> Series:
    """Trades ordered by (date, second of day, id), cut at month, day, hour, minute or id range.

    The finest level holds at most ``ids_per_block`` ids of one second.
    """
    day = F.unix_date(F.col(date)).cast("bigint")
    month = (F.year(date) * 12 + F.month(date)).cast("bigint")
    sec = F.col(second).cast("bigint")
    ids = F.struct(
        (day * 86400 + sec).alias("s"), F.floor(F.col(id_col) / F.lit(ids_per_block)).cast("bigint").alias("i")
    )
    levels = [month, day, day * 24 + F.floor(sec / 3600), day * 1440 + F.floor(sec / 60), ids]
    return Series(tuple(keys), (date, second, id_col), tuple(levels))
