"""Gold facts: hourly candles, trades, daily candles and the daily indicators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from candlewick.functions import expressions as X
from candlewick.functions import scalars as S
from candlewick.operators import dedup, joins
from candlewick.plans.staging import SUMMED, roll_up
from candlewick.session import stage
from candlewick.tables import incremental

CUTOFF = "2025-01-01"  # fixed value: the hourly fact ends before this day
# Key columns of the daily facts, in their order.
PAIR_DAY = ["asset_pair_symbol", "open_date"]
DAILY_KEYS = [
    "base_asset_fk", "quote_asset_fk", "open_date_fk", "asset_pair_symbol", "base_asset_symbol",
    "quote_asset_symbol", "open_date",
]


def series_window() -> WindowSpec:
    """Daily rows of a pair in date order.

    The grain is (pair, day), so a partition holds at most one row per calendar day.
    """
    return Window.partitionBy("asset_pair_symbol").orderBy("open_date")


# ---- hourly candles ---------------------------------------------------------


def current_assets(assets_dim: DataFrame) -> DataFrame:
    return assets_dim.filter(F.col("rank_valid_to").isNull())


def with_asset_key(df: DataFrame, dim: DataFrame, symbol: str, name: str, **how) -> DataFrame:
    """Case-insensitive key of the asset's current version."""
    keys = dim.select(F.upper("symbol").alias("_symbol"), F.col("asset_sk").alias(name))
    return joins.lookup_join(df.withColumn("_symbol", F.upper(symbol)), keys, ["_symbol"], **how).drop("_symbol")


def with_date_key(df: DataFrame, date_dim: DataFrame, date: str, name: str) -> DataFrame:
    days = date_dim.select(F.col("full_date").alias(date), F.col("date_sk").alias(name))
    return joins.fixed_lookup(df, days, date)


def fct_ohlcv_hourly(
    stg: DataFrame, assets_dim: DataFrame, date_dim: DataFrame, existing: DataFrame | None = None, cutoff: str = CUTOFF
) -> DataFrame:
    """Candles with resolved keys. The time key is the second of the day, so no lookup is needed.

    Stored candles are compared from the first to the last day of the new ones; the bounds reach the scan.
    """
    src = stg.filter(F.col("open_date") < F.lit(cutoff).cast("date"))
    if existing is not None:
        days = src.agg(F.min("open_date").alias("first"), F.max("open_date").alias("last")).first()
        if days.first is not None:
            existing = existing.filter(F.col("open_date").between(F.lit(days.first), F.lit(days.last)))
        src = joins.absent(src, existing, ["open_date", "open_time", "base_asset_symbol"])
    now = current_assets(assets_dim)
    small = joins.small_enough(now)
    keyed = with_asset_key(src, now, "base_asset_symbol", "base_asset_fk", small=small)
    keyed = keyed.filter(F.col("base_asset_fk").isNotNull())
    keyed = with_asset_key(keyed, now, "quote_asset_symbol", "quote_asset_fk", small=small)
    keyed = with_date_key(keyed, date_dim, "open_date", "open_date_fk")
    return keyed.select(
        S.surrogate_key("base_asset_fk", "open_date", "open_time").alias("ohlcv_sk"),
        "open_date_fk",
        S.second_of_day("open_time").alias("open_time_fk"),
        "base_asset_fk", "quote_asset_fk",
        "asset_pair_symbol", "base_asset_symbol", "quote_asset_symbol",
        "open_date", "open_time", "close_date", "close_time",
        "open", "high", "low", "close", *SUMMED,
    )


# ---- trades -----------------------------------------------------------------


def fct_trades(
    stg: DataFrame, assets_dim: DataFrame, date_dim: DataFrame, existing: DataFrame | None = None,
    versions: str = "as_of",
) -> DataFrame:
    """Trades with resolved keys, one row per (id, pair, price).

    ``versions`` picks the asset row: ``as_of`` the one valid at trade time, ``current`` the open
    one, ``all`` every version (fans out once history exists). With stored trades, a pair is read
    from its last stored day on; the upsert that follows removes the overlap.
    """
    if existing is not None:
        stg = incremental.above_own_mark(stg, existing, ["pair_symbol"], "transaction_date", inclusive=True)
    ties = ["quantity", "first_trade_id", "last_trade_id", "transaction_date", "transaction_time"]
    base = dedup.first_per_key(stg, ["agg_trade_id", "pair_symbol", "price"], ties)
    base = base.withColumns(
        {
            "base_asset": S.pair_base("pair_symbol"),
            "quote_asset": S.pair_quote("pair_symbol"),
            "_at": F.to_timestamp_ntz(F.concat_ws(" ", "transaction_date", "transaction_time")),
        }
    )
    dim = current_assets(assets_dim) if versions == "current" else assets_dim
    small = joins.small_enough(dim)
    for symbol, name in (("base_asset", "base_asset_fk"), ("quote_asset", "quote_asset_fk")):
        side = dim.select(
            F.col("symbol").alias(symbol), F.col("asset_sk").alias(name),
            F.col("rank_valid_from").alias("_from"), F.col("rank_valid_to").alias("_to"),
        )
        if versions == "as_of":
            base = joins.as_of_version(base, side, symbol, "_at", "_from", "_to", small=small).drop("_from", "_to")
        else:
            base = joins.lookup_join(base, side.drop("_from", "_to"), [symbol], small=small)
    base = with_date_key(base, date_dim, "transaction_date", "date_fk")
    return base.select(
        S.surrogate_key("agg_trade_id", "pair_symbol", "price").alias("trades_sk"),
        "agg_trade_id", "pair_symbol", "base_asset_fk", "quote_asset_fk", "price", "quantity",
        "first_trade_id", "last_trade_id", "transaction_date", "transaction_time", "date_fk",
        S.second_of_day("transaction_time").alias("time_fk"),
    )


# ---- daily candles ----------------------------------------------------------


def candles_daily(hourly: DataFrame, keys: list[str] = DAILY_KEYS) -> DataFrame:
    """Hourly candles to daily ones in one aggregate."""
    at = S.second_of_day("open_time")
    return roll_up(hourly, keys, at, at)


def returns_daily(daily: DataFrame) -> DataFrame:
    o, c = F.col("open"), F.col("close")
    return daily.withColumns(
        {
            "return_abs": c - o,
            "return_pct": X.safe_divide(c - o, o),
            "log_return": F.when((o > 0) & (c > 0), F.ln(c) - F.ln(o)),
        }
    )


def running_log_return() -> Column:
    return F.sum("log_return").over(series_window().rowsBetween(Window.unboundedPreceding, 0))


def cumulative_return(returns: DataFrame) -> DataFrame:
    return returns.withColumn("cumulative_return", (F.exp(running_log_return()) - 1) * 100)


def with_prev_close(daily: DataFrame) -> DataFrame:
    return daily.withColumn("prev_close", F.lag("close").over(series_window()))


def rolling_volatility(returns: DataFrame) -> DataFrame:
    return returns.withColumns(
        {
            "candle_range": F.col("high") - F.col("low"),
            "rolling_vol_10": X.rolling_stddev("log_return", 10, series_window()),
        }
    )


def with_true_range(daily: DataFrame) -> DataFrame:
    return daily.withColumn("tr", X.true_range("high", "low", "prev_close"))


def with_atr(ranges: DataFrame, n: int = 14) -> DataFrame:
    return ranges.withColumn(f"atr_{n}", X.atr("tr", n, series_window()))


def volatility_label(df: DataFrame, column: str = "atr_14") -> DataFrame:
    """Thirds of a pair's own history by exact interpolated percentiles."""
    whole = Window.partitionBy("asset_pair_symbol")
    low, high = (F.percentile(column, q).over(whole) for q in (0.33, 0.66))
    c = F.col(column)
    label = (
        F.when(c.isNull(), None).when(c < low, X.VOL_LOW).when(c < high, X.VOL_NORMAL).otherwise(X.VOL_HIGH)
    )
    return df.withColumn("volatility_label", label)


def enrich_daily(daily: DataFrame) -> DataFrame:
    """All daily candle measures. One window spec, so one shuffle by pair."""
    df = returns_daily(with_prev_close(daily))
    df = rolling_volatility(cumulative_return(df))
    df = with_atr(with_true_range(df))
    df = df.withColumn("trend_direction", X.trend_direction("return_pct"))
    return volatility_label(df)


def fct_ohlcv_daily(hourly: DataFrame) -> DataFrame:
    df = enrich_daily(candles_daily(hourly))
    return df.select(S.surrogate_key("base_asset_fk", "open_date").alias("daily_ohlcv_sk"), "*")


# ---- daily indicators -------------------------------------------------------


def technical_columns(df: DataFrame) -> DataFrame:
    w = series_window()
    df = df.withColumns({"price_avg_50": X.sma("close", 50, w), "price_avg_200": X.sma("close", 200, w)})
    return df.withColumn("ma_crossover_event", X.crossover_event("price_avg_50", "price_avg_200", w))


def pair_day_key(name: str) -> Column:
    return S.surrogate_key(*PAIR_DAY).alias(name)


def fct_technical_daily(daily: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    # a crossover compares with the previous row's 200-row mean
    return with_new_days(daily, existing, technical_columns, 200).select(
        pair_day_key("technical_sk"), "asset_pair_symbol", "base_asset_fk", "open_date",
        "price_avg_50", "price_avg_200", "ma_crossover_event",
    )


def liquidity_columns(df: DataFrame) -> DataFrame:
    w = series_window()
    q = F.col("quote_asset_volume")
    return df.withColumns(
        {
            "range_pct": X.safe_divide(F.col("high") - F.col("low"), "close"),
            "avg_trade_size_usd": X.safe_divide(q, "num_trades"),
            "liquidity_usd": q,
            "buy_liquidity_usd": F.col("taker_buy_quote_volume"),
            "sell_liquidity_usd": F.when((q == 0), None).otherwise(q - F.col("taker_buy_quote_volume")),
            "rolling_volume_20": X.sma("quote_asset_volume", 20, w),
            "rolling_trades_20": X.sma("num_trades", 20, w),
        }
    ).withColumn("normalized_liquidity", X.safe_divide("quote_asset_volume", "rolling_volume_20"))


def with_market_share(df: DataFrame, daily: DataFrame | None = None) -> DataFrame:
    """Share of the day's total over all pairs of ``daily`` (default: of df).

    The totals are one pre-aggregated row per day, joined back; no task sees all pairs of a day.
    The daily rows are read twice, so they should be a stored table.
    """
    totals = (daily if daily is not None else df).groupBy("open_date").agg(F.sum("quote_asset_volume").alias("_day_total"))
    return (
        df.join(totals, "open_date", "left")
        .withColumn("liquidity_market_share", X.safe_divide("quote_asset_volume", "_day_total"))
        .drop("_day_total")
    )


# Output columns of the liquidity fact, in their order.
LIQUIDITY = [
    "asset_pair_symbol", "base_asset_fk", "quote_asset_fk", "base_asset_symbol", "quote_asset_symbol", "open_date",
    "open_date_fk", "open", "high", "low", "close", "base_asset_volume", "quote_asset_volume", "num_trades",
    "liquidity_usd", "avg_trade_size_usd", "buy_liquidity_usd", "sell_liquidity_usd", "range_pct",
    "rolling_volume_20", "rolling_trades_20", "normalized_liquidity", "liquidity_market_share",
]


def fct_liquidity_daily(daily: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    rows = with_new_days(daily, existing, liquidity_columns, 19)
    return with_market_share(rows, daily).select(pair_day_key("liquidity_sk"), *LIQUIDITY)


def pressure_columns(df: DataFrame) -> DataFrame:
    q, b = F.col("quote_asset_volume"), F.col("base_asset_volume")
    tq, tb = F.col("taker_buy_quote_volume"), F.col("taker_buy_base_volume")
    df = df.withColumns(
        {
            "instant_buy_ratio_quote": X.safe_divide(tq, q),
            "instant_buy_ratio_base": X.safe_divide(tb, b),
            "passive_quote_volume": q - tq,
            "passive_base_volume": b - tb,
            "passive_ratio_quote": X.safe_divide(q - tq, q),
            "passive_ratio_base": X.safe_divide(b - tb, b),
        }
    )
    return df.withColumns(
        {
            "aggression_index": F.abs(F.col("instant_buy_ratio_base") - 0.5) * 2,
            "pressure_regime": X.pressure_regime("instant_buy_ratio_base"),
        }
    )


# Output columns of the pressure fact, in their order.
PRESSURE = [
    "asset_pair_symbol", "base_asset_fk", "quote_asset_fk", "base_asset_symbol", "quote_asset_symbol", "open_date",
    "open_date_fk", "taker_buy_base_volume", "taker_buy_quote_volume", "base_asset_volume", "quote_asset_volume",
    "num_trades", "instant_buy_ratio_quote", "instant_buy_ratio_base", "passive_quote_volume", "passive_base_volume",
    "passive_ratio_quote", "passive_ratio_base", "aggression_index", "pressure_regime",
]


def fct_pressure_daily(daily: DataFrame) -> DataFrame:
    return pressure_columns(daily).select(pair_day_key("daily_pressure_sk"), *PRESSURE)


def with_new_days(daily: DataFrame, existing: DataFrame | None, build, lookback: int) -> DataFrame:
    """Indicator rows of days newer than the stored ones, equal to those of a full run.

    Each pair is read from its ``lookback`` last stored days on, so the row frames are complete. Where those begin
    is told from the stored pairs and days alone; daily candles are read in bands of those days.
    """
    if existing is None:
        return build(daily)
    pair = ["asset_pair_symbol"]
    last = dedup.first_n_per_key(existing.select(*pair, "open_date"), pair, [F.desc("open_date")], lookback)
    spans = stage(last.groupBy(*pair).agg(F.min("open_date").alias("_start"), F.max("open_date").alias("_mark")), "spans")
    if spans.isEmpty():
        return build(daily)
    rows = incremental.in_bands(daily, spans, pair, "open_date", "_start").drop("_start")
    fresh = stage(joins.absent(daily.select(*pair).distinct(), spans, pair), "new-pairs")
    if not fresh.isEmpty():
        rows = rows.unionByName(joins.lookup_join(daily, fresh, pair, "inner"), allowMissingColumns=True)
    out = joins.lookup_join(build(rows.drop("_mark")), spans.drop("_start"), pair)
    return out.filter(F.col("_mark").isNull() | (F.col("open_date") > F.col("_mark"))).drop("_mark")


# ---- wide view --------------------------------------------------------------

# Output columns of the wide view, in their order.
WIDE_DATE = ["day", "month", "monthname", "year", "quarter", "quartername"]
WIDE_ASSET = ["asset_name", "num_market_pairs", "asset_launch_date", "supply_type", "market_cap_based_rank"]
WIDE_MEASURES = [
    "open", "high", "low", "close", "daily_range", "num_trades", "return_abs", "return_pct", "cumulative_return_pct",
    "atr_14", "tr", "rolling_vol_10", "trend_direction", "volatility_label", "price_avg_50", "price_avg_200",
    "ma_crossover_event", "liquidity_usd", "avg_trade_size_usd", "buy_liquidity_usd", "sell_liquidity_usd",
    "price_range_pct", "liquidity_market_share", "normalized_liquidity", "rolling_trades_20", "rolling_volume_20",
    "taker_buy_base_volume", "taker_buy_quote_volume", "instant_buy_ratio_quote", "instant_buy_ratio_base",
    "passive_quote_volume", "passive_base_volume", "passive_ratio_quote", "passive_ratio_base", "aggression_index",
    "pressure_regime",
]


def _wide(df: DataFrame, date_dim: DataFrame, assets_dim: DataFrame) -> DataFrame:
    days = date_dim.select(F.col("date_sk").alias("open_date_fk"), *WIDE_DATE)
    assets = current_assets(assets_dim).select(F.col("asset_sk").alias("base_asset_fk"), *WIDE_ASSET)
    df = joins.fixed_lookup(df, days, "open_date_fk")
    df = joins.lookup_join(df, assets, ["base_asset_fk"])
    df = df.withColumns(
        {
            "daily_range": F.col("high") - F.col("low"),
            "cumulative_return_pct": F.col("cumulative_return"),
            "price_range_pct": F.col("range_pct"),
        }
    )
    return df.select(
        "open_date", *WIDE_DATE, "asset_pair_symbol", "base_asset_symbol", "quote_asset_symbol", *WIDE_ASSET,
        *WIDE_MEASURES,
    )


def market_daily_wide(daily: DataFrame, date_dim: DataFrame, assets_dim: DataFrame) -> DataFrame:
    """One wide row per (pair, day).

    The four daily facts share their grain and their source, so their columns are added in one
    chain over one shuffle instead of being joined.
    """
    df = with_market_share(pressure_columns(liquidity_columns(technical_columns(daily))), daily)
    return _wide(df, date_dim, assets_dim)


def market_daily_joined(
    daily: DataFrame, technical: DataFrame, liquidity: DataFrame, pressure: DataFrame, date_dim: DataFrame,
    assets_dim: DataFrame,
) -> DataFrame:
    """The same view from four stored facts."""
    t = technical.select(*PAIR_DAY, "price_avg_50", "price_avg_200", "ma_crossover_event")
    l = liquidity.select(*PAIR_DAY, *LIQUIDITY[14:])
    p = pressure.select(*PAIR_DAY, *PRESSURE[12:])
    df = daily.join(t, PAIR_DAY, "left").join(l, PAIR_DAY, "left").join(p, PAIR_DAY, "left")
    return _wide(df, date_dim, assets_dim)
