"""Described insights over daily candles and over single trades.

Candle series are keyed (pair, day): one pair holds at most one row per calendar day, so plain
windows apply. Trade series can hold any share of all rows in one pair and use block windows.
Thresholds the descriptions leave open are parameters.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.functions import expressions as X
from candlewick.functions import scalars as S
from candlewick.operators import blocks
from candlewick.plans.facts import series_window
from candlewick.session import stage

PAIR = "asset_pair_symbol"


# ---- candle series ----------------------------------------------------------


def ma_10_20(daily: DataFrame) -> DataFrame:
    w = series_window()
    df = daily.withColumns({"ma_10": X.sma("close", 10, w), "ma_20": X.sma("close", 20, w)})
    trend = F.when(F.col("ma_10") > F.col("ma_20"), "up").when(F.col("ma_10") < F.col("ma_20"), "down").otherwise("flat")
    return df.withColumns({"ma_trend": trend, "ma_cross": X.crossover("ma_10", "ma_20", w)})


def candle_geometry(daily: DataFrame, doji: float = 0.1) -> DataFrame:
    o, h, l, c = (F.col(n) for n in ("open", "high", "low", "close"))
    body, spread = F.abs(c - o), h - l
    kind = F.when(body <= spread * doji, "doji").when(c > o, "bullish").otherwise("bearish")
    return daily.withColumns(
        {
            "candle_range": spread,
            "range_to_open": X.safe_divide(spread, o),
            "body": body,
            "upper_wick": h - F.greatest(o, c),
            "lower_wick": F.least(o, c) - l,
            "candle_type": kind,
        }
    )


def candle_patterns(daily: DataFrame) -> DataFrame:
    """Engulfing against the previous candle; hammer and shooting star by wick to body."""
    w = series_window()
    df = candle_geometry(daily).withColumns({"_po": F.lag("open").over(w), "_pc": F.lag("close").over(w)})
    o, c, po, pc = (F.col(n) for n in ("open", "close", "_po", "_pc"))
    body, up, low = F.col("body"), F.col("upper_wick"), F.col("lower_wick")
    pattern = (
        F.when((pc < po) & (c > o) & (o <= pc) & (c >= po), "bullish engulfing")
        .when((pc > po) & (c < o) & (o >= pc) & (c <= po), "bearish engulfing")
        .when((low >= 2 * body) & (up <= body), "hammer")
        .when((up >= 2 * body) & (low <= body), "shooting star")
    )
    return df.withColumn("pattern", pattern).drop("_po", "_pc")


def rolling_vol_close(daily: DataFrame, sizes: Sequence[int] = (10, 14, 20)) -> DataFrame:
    w = series_window()
    return daily.withColumns({f"vol_close_{n}": X.rolling_stddev("close", n, w) for n in sizes})


def volume_spike(daily: DataFrame, factor: float = 2, n: int = 20) -> DataFrame:
    mean = X.sma("base_asset_volume", n, series_window())
    return daily.withColumns({"avg_volume": mean, "is_spike": F.col("base_asset_volume") > mean * factor})


def typical_price() -> Column:
    return (F.col("high") + F.col("low") + F.col("close")) / 3


def vwap(candles: DataFrame, keys: Sequence[str] = (PAIR, "open_date")) -> DataFrame:
    """Volume-weighted close per group and the same with the typical price."""
    v = F.col("base_asset_volume")
    weighted = lambda p: X.safe_divide(F.sum(p * v), F.sum(v))
    return candles.groupBy(*keys).agg(
        weighted(F.col("close")).alias("vwap"), weighted(typical_price()).alias("vwap_typical")
    )


def buy_sell_ratio(daily: DataFrame, n: int = 5) -> DataFrame:
    buy = X.safe_divide("taker_buy_base_volume", "base_asset_volume")
    df = daily.withColumns({"buy_ratio": buy, "sell_ratio": 1 - buy})
    return df.withColumn("buy_ratio_mean", X.sma("buy_ratio", n, series_window()))


def _move_and_mean(daily: DataFrame) -> DataFrame:
    move = F.abs(X.safe_divide(F.col("close") - F.col("open"), "open"))
    return volume_spike(daily).withColumn("_move", move)


def breakout(daily: DataFrame, move: float = 0.05) -> DataFrame:
    df = _move_and_mean(daily)
    return df.withColumn("is_breakout", F.col("is_spike") & (F.col("_move") > move)).drop("_move")


def liquidity_stress(daily: DataFrame, move: float = 0.05, share: float = 0.5) -> DataFrame:
    df = _move_and_mean(daily)
    thin = F.col("base_asset_volume") < F.col("avg_volume") * share
    return df.withColumn("is_stressed", thin & (F.col("_move") > move)).drop("_move")


def rsi(daily: DataFrame, n: int = 14) -> DataFrame:
    w = series_window()
    df = daily.withColumn("_d", F.col("close") - F.lag("close").over(w))
    d = F.col("_d")
    df = df.withColumns(
        {
            "_gain": F.avg(F.when(d.isNotNull(), F.greatest(d, F.lit(0.0)))).over(X.last_rows(w, n)),
            "_loss": F.avg(F.when(d.isNotNull(), F.greatest(-d, F.lit(0.0)))).over(X.last_rows(w, n)),
        }
    )
    value = F.when(F.col("_loss") == 0, 100.0).otherwise(100 - 100 / (1 + F.try_divide("_gain", "_loss")))
    return df.withColumn(f"rsi_{n}", value).drop("_d", "_gain", "_loss")


#: Rows of a block in an exponential mean; inverse powers of the decay stay far from overflow.
EWM_BLOCK = 100


def exponential_mean(df: DataFrame, source: str, n: int, name: str) -> DataFrame:
    """The exponential mean of a daily column with span n, its first value the column's first.

    It is recursive, so no row frame has it. Inside blocks of 100 rows it is a decaying sum; what a block passes on
    is one number, and these are folded in order, one per 100 days of a pair. ``df`` is read twice: pass a stored one.
    """
    decay = 1 - 2 / (n + 1)
    at = F.row_number().over(series_window()) - 1
    rows = df.withColumn("_i", at).withColumns({"_b": F.floor(F.col("_i") / EWM_BLOCK), "_j": F.col("_i") % EWM_BLOCK})
    inside = Window.partitionBy(PAIR, "_b").orderBy("_j").rowsBetween(Window.unboundedPreceding, 0)
    power = lambda e: F.pow(F.lit(decay), e)
    rows = rows.withColumn("_local", F.sum((1 - decay) * F.col(source) * power(-F.col("_j"))).over(inside) * power(F.col("_j")))
    ends = rows.groupBy(PAIR, "_b").agg(
        F.max_by("_local", "_j").alias("end"), F.count("*").alias("size"), F.min_by(source, "_j").alias("first"))
    chain = ends.groupBy(PAIR).agg(F.sort_array(F.collect_list(F.struct("_b", "end", "size", "first"))).alias("blocks"))
    passed = F.aggregate(
        "blocks", F.struct(F.expr("CAST(array() AS array<double>)").alias("before"), F.col("blocks")[0]["first"].alias("last")),
        lambda s, b: F.struct(
            F.concat(s["before"], F.array(s["last"])).alias("before"), (power(b["size"]) * s["last"] + b["end"]).alias("last")),
    )
    carried = chain.select(PAIR, F.posexplode(passed["before"]).alias("_b", "_before"))
    carried = carried.withColumn("_b", F.col("_b").cast("bigint"))
    out = rows.join(carried, [PAIR, "_b"], "left")
    return out.withColumn(name, F.col("_local") + power(F.col("_j") + 1) * F.col("_before")).select(*df.columns, name)


def ema(daily: DataFrame, sizes: Sequence[int] = (12, 26)) -> DataFrame:
    """Exponential means of the close."""
    df = stage(daily.select(PAIR, "open_date", "close"), "closes")
    for n in sizes:
        df = exponential_mean(df, "close", n, f"ema_{n}")
    return df


def macd(daily: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9) -> DataFrame:
    df = ema(daily, (fast, slow))
    line = df.select(PAIR, "open_date", "close", (F.col(f"ema_{fast}") - F.col(f"ema_{slow}")).alias("macd"))
    df = exponential_mean(stage(line, "macd"), "macd", signal, "signal")
    return df.withColumn("histogram", F.col("macd") - F.col("signal"))


def rate_of_change(daily: DataFrame, n: int = 10) -> DataFrame:
    old = F.lag("close", n).over(series_window())
    return daily.withColumn(f"roc_{n}", X.safe_divide(F.col("close") - old, old) * 100)


def momentum(daily: DataFrame, n: int = 10) -> DataFrame:
    return daily.withColumn(f"momentum_{n}", F.col("close") - F.lag("close", n).over(series_window()))


def bollinger(daily: DataFrame, n: int = 20, k: float = 2) -> DataFrame:
    w = series_window()
    mid, sd = X.sma("close", n, w), X.rolling_stddev("close", n, w)
    return daily.withColumns({"band_middle": mid, "band_upper": mid + k * sd, "band_lower": mid - k * sd})


def forward_return(daily: DataFrame, signal: Column, ahead: Sequence[int] = (1, 7)) -> DataFrame:
    """Mean return n rows after each value of a signal."""
    w = series_window()
    later = {f"_r{n}": X.safe_divide(F.lead("close", n).over(w) - F.col("close"), "close") for n in ahead}
    df = daily.withColumns({"signal": signal, **later})
    means = [F.avg(f"_r{n}").alias(f"mean_return_{n}") for n in ahead]
    return df.groupBy("signal").agg(F.count("*").alias("days"), *means)


def regime_share(daily: DataFrame) -> DataFrame:
    ret = X.safe_divide(F.col("close") - F.col("open"), "open")
    t = daily.withColumn("_t", X.trend_direction(ret))
    share = lambda label: F.count_if(F.col("_t") == label) * 100.0 / F.count("*")
    return t.groupBy(PAIR).agg(
        share(X.TREND_UP).alias("up_pct"), share(X.TREND_DOWN).alias("down_pct"), share(X.TREND_FLAT).alias("flat_pct")
    )


def period_performance(daily: DataFrame, period: str) -> DataFrame:
    """Return per calendar period and what one unit became."""
    df = daily.groupBy(PAIR, F.trunc("open_date", period).alias("period")).agg(
        F.min_by("open", "open_date").alias("first_open"), F.max_by("close", "open_date").alias("last_close")
    )
    growth = X.safe_divide("last_close", "first_open")
    return df.withColumns({"growth_of_one": growth, "return_pct": (growth - 1) * 100})


def sharpe(daily: DataFrame) -> DataFrame:
    r = F.when((F.col("open") > 0) & (F.col("close") > 0), F.ln("close") - F.ln("open"))
    return daily.groupBy(PAIR).agg(F.try_divide(F.avg(r), F.stddev_samp(r)).alias("sharpe"))


def price_volume_confirm(daily: DataFrame) -> DataFrame:
    w = series_window()
    up = F.col("close") > F.lag("close").over(w)
    more = F.col("base_asset_volume") > F.lag("base_asset_volume").over(w)
    label = F.when(up & more, "confirmed").when(up & ~more, "weak").when(~up & more, "selling").when(~up & ~more, "quiet")
    return daily.withColumn("price_volume", label)


def price_vs_vwap(candles: DataFrame, daily: DataFrame, tolerance: float = 0.0) -> DataFrame:
    """Side of the close against the day's VWAP; within the tolerance it is neutral."""
    v = vwap(candles).select(PAIR, "open_date", "vwap")
    df = daily.join(v, [PAIR, "open_date"], "left")
    above = F.col("close") - F.col("vwap")
    side = F.when(above > tolerance, "bullish").when(above < -tolerance, "bearish").otherwise("neutral")
    return df.withColumn("vwap_side", side)


def signal_checklist(daily: DataFrame) -> DataFrame:
    """Price against the 200-row mean, RSI limits, MACD against its signal, volume by candle colour."""
    w = series_window()
    df = rsi(daily).withColumn("_sma", X.sma("close", 200, w))
    df = df.join(macd(daily).drop("close"), [PAIR, "open_date"])
    green = F.col("close") >= F.col("open")
    busy = F.col("base_asset_volume") > X.sma("base_asset_volume", 20, w)
    return df.withColumns(
        {
            "above_sma_200": F.col("close") > F.col("_sma"),
            "rsi_signal": F.when(F.col("rsi_14") < 30, "buy").when(F.col("rsi_14") > 70, "sell").otherwise("none"),
            "macd_above_signal": F.col("macd") > F.col("signal"),
            "volume_signal": F.when(busy & green, "buy").when(busy & ~green, "sell").otherwise("none"),
        }
    ).drop("_sma")


def asset_correlation(daily: DataFrame, bases: Sequence[str]) -> DataFrame:
    """Correlation of each pair's daily log returns with those of a few named pairs."""
    r = F.ln("close") - F.ln("open")
    returns = daily.select(PAIR, "open_date", r.alias("r"))
    base = returns.filter(F.col(PAIR).isin(list(bases))).select(F.col(PAIR).alias("base_pair"), "open_date", F.col("r").alias("base_r"))
    both = returns.join(base, "open_date")
    return both.groupBy(PAIR, "base_pair").agg(F.corr("r", "base_r").alias("correlation"), F.count("*").alias("days"))


#: Bits of a series' code.
CODE_BITS = 256


def bands_for(threshold: float, bits: int = CODE_BITS, recall: float = 0.97) -> tuple[int, int]:
    """Bits per band and number of bands, as wide as bands can be for pairs at the threshold to meet this often.

    Two series agree in a bit with probability 1 - angle / pi, the angle being the arc cosine of their correlation.
    """
    p = 1 - math.acos(threshold) / math.pi
    for width in range(24, 0, -1):
        if 1 - (1 - p**width) ** (bits // width) >= recall:
            return width, bits // width
    return 1, bits


def correlated_pairs(daily: DataFrame, threshold: float = 0.8, least_days: int = 30, exact: bool = False, bits: int = CODE_BITS) -> DataFrame:
    """Pairs of coins whose daily log returns correlate at the threshold or above, on days that both have.

    A coin's standardised returns are projected on random directions (one sign per day and bit, from the day's hash);
    the signs are its code. Coins with equal bits in some band are candidates, and only those are compared day by
    day. Bands are chosen so that a pair at the threshold meets with 97 % probability, closer ones more often; sparse
    series, whose common days differ from their own, may be missed more easily. ``exact`` compares all pairs.
    """
    r = F.ln("close") - F.ln("open")
    returns = daily.select(PAIR, "open_date", r.alias("r")).filter(F.col("r").isNotNull() & ~F.isnan("r"))
    known = returns.groupBy(PAIR).agg(F.count("*").alias("_n"), F.avg("r").alias("_mean"), F.stddev_pop("r").alias("_sd"))
    rows = stage(returns.join(known.filter(F.col("_n") >= least_days), PAIR), "returns")
    if exact:
        met = rows.select(PAIR, F.col("open_date").alias("_met"))
    else:
        width, count = bands_for(threshold, bits)
        score = F.when(F.col("_sd") > 0, (F.col("r") - F.col("_mean")) / F.col("_sd")).otherwise(0.0)
        words = {f"_h{i}": F.xxhash64("open_date", F.lit(i)) for i in range(-(-width * count // 64))}
        signed = rows.select(PAIR, score.alias("_z"), *[h.alias(c) for c, h in words.items()])
        signs = [F.sum(F.when(F.getbit(f"_h{i // 64}", F.lit(i % 64)) == 1, F.col("_z")).otherwise(-F.col("_z"))) for i in range(width * count)]
        codes = signed.groupBy(PAIR).agg(*[x.alias(f"_s{i}") for i, x in enumerate(signs)])
        bit = lambda i: F.when(F.col(f"_s{i}") > 0, "1").otherwise("0")
        bands = [F.concat(F.lit(f"{j}:"), *[bit(j * width + i) for i in range(width)]) for j in range(count)]
        met = stage(codes.select(PAIR, F.explode(F.array(*bands)).alias("_met")), "codes")
    a, b = met.withColumnRenamed(PAIR, "pair_a"), met.withColumnRenamed(PAIR, "pair_b")
    candidates = stage(a.join(b, "_met").filter("pair_a < pair_b").select("pair_a", "pair_b").distinct(), "candidates")
    one = lambda pair, value: rows.select(F.col(PAIR).alias(pair), "open_date", F.col("r").alias(value))
    both = candidates.join(one("pair_a", "_x"), "pair_a").join(one("pair_b", "_y"), ["pair_b", "open_date"])
    # a series that doesn't move on the common days has no correlation
    rho = F.try_divide(F.covar_pop("_x", "_y"), F.stddev_pop("_x") * F.stddev_pop("_y"))
    out = both.groupBy("pair_a", "pair_b").agg(rho.alias("correlation"), F.count("*").alias("days"))
    return out.filter((F.col("days") >= least_days) & (F.col("correlation") >= threshold))


# ---- trades -----------------------------------------------------------------


def at_second(trades: DataFrame) -> DataFrame:
    """Second of day and epoch second of each trade."""
    df = trades.withColumn("_second", S.second_of_day("transaction_time"))
    return df.withColumn("at", F.unix_date("transaction_date").cast("bigint") * 86400 + F.col("_second"))


def _slim(trades: DataFrame, *more: str) -> DataFrame:
    return at_second(trades.select("pair_symbol", "agg_trade_id", "transaction_date", "transaction_time", *more))


def trade_gaps(trades: DataFrame, level: int | None = None, stored: bool = False) -> DataFrame:
    """Seconds since the pair's previous trade, over full timestamps. ``stored`` trades are not copied first."""
    out = blocks.over_series(
        _slim(trades), blocks.trade_series(), 1, lambda w: {"gap_seconds": F.col("at") - F.lag("at").over(w)}, level, stored=stored
    )
    return out.select("agg_trade_id", "pair_symbol", "transaction_date", "transaction_time", "gap_seconds")


def activity(trades: DataFrame, seconds: int = 1) -> DataFrame:
    """Trades, volume and price of each pair per bucket of seconds."""
    df = at_second(trades).withColumn("bucket", F.floor(F.col("at") / seconds) * seconds)
    return df.groupBy("pair_symbol", "bucket").agg(
        F.count("*").alias("trades"),
        F.sum("quantity").alias("volume"),
        F.avg("quantity").alias("mean_quantity"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.avg("price").alias("mean_price"),
    )


def bursts(trades: DataFrame, seconds: int = 10, at_least: int = 100) -> DataFrame:
    return activity(trades, seconds).filter(F.col("trades") >= at_least)


def trades_per_second(trades: DataFrame) -> DataFrame:
    return activity(trades, 1).select("pair_symbol", "bucket", "trades", "volume")


def whale_proxy(trades: DataFrame, seconds: int = 3600) -> DataFrame:
    """Largest against mean trade size per candle."""
    df = at_second(trades).withColumn("bucket", F.floor(F.col("at") / seconds) * seconds)
    return df.groupBy("pair_symbol", "bucket").agg(
        F.try_divide(F.max("quantity"), F.avg("quantity")).alias("whale_ratio")
    )


def flow_streaks(trades: DataFrame, side: Column, level: int | None = None, stored: bool = False) -> DataFrame:
    """Runs of consecutive trades on one side, per pair. ``stored`` trades are not copied first.

    The marked trades are written once in either case: the totals of the blocks and the runs inside read them.
    """
    series = blocks.trade_series()
    slim = _slim(trades.withColumn("side", side), "side", "quantity")
    if not stored:
        slim = stage(slim, "sides")
    if level is None:
        level = blocks.pick_level(slim, series)
    changed = lambda w: F.when(F.lag("side").over(w).eqNullSafe(F.col("side")), 0).otherwise(1)
    marked = blocks.over_series(slim, series, 1, lambda w: {"_change": changed(w)}, level, stored=True)
    runs = blocks.running_sum(stage(marked, "changes"), series, "_change", "run", level)
    return runs.groupBy("pair_symbol", "run", "side").agg(
        F.count("*").alias("trades"), F.sum("quantity").alias("volume"),
        F.min("at").alias("first_at"), F.max("at").alias("last_at"),
    )


def month_growth(trades: DataFrame) -> DataFrame:
    monthly = trades.groupBy("pair_symbol", F.trunc("transaction_date", "month").alias("month")).agg(
        F.sum("quantity").alias("volume"), F.count("*").alias("trades")
    )
    w = Window.partitionBy("pair_symbol").orderBy("month")
    growth = lambda c: X.safe_divide((F.col(c) - F.lag(c).over(w)) * 100.0, F.lag(c).over(w))
    return monthly.withColumns({"volume_growth_pct": growth("volume"), "trades_growth_pct": growth("trades")})


def total_value(trades: DataFrame) -> DataFrame:
    """Traded value per pair, of the newest year and of all time."""
    per_year = trades.groupBy("pair_symbol", F.year("transaction_date").alias("_y")).agg(
        F.sum(F.col("price") * F.col("quantity")).alias("_v")
    )
    newest = trades.agg(F.max(F.year("transaction_date"))).scalar()
    df = per_year.withColumn("_newest", newest)
    this_year = F.when(F.col("_y") == F.col("_newest"), F.col("_v"))
    return df.groupBy("pair_symbol").agg(
        F.coalesce(F.sum(this_year), F.lit(0.0)).alias("value_ytd"), F.sum("_v").alias("value_all_time")
    )


def peak_times(trades: DataFrame) -> DataFrame:
    return trades.groupBy(
        F.date_format("transaction_date", "EEEE").alias("dayname"), S.hour_of("transaction_time").alias("hour")
    ).agg(F.count("*").alias("trades"), F.sum("quantity").alias("volume"))


def trader_segments(trades: DataFrame) -> DataFrame:
    v = F.col("price") * F.col("quantity")
    return trades.groupBy(X.trade_size(v).alias("segment")).agg(F.count("*").alias("trades"), F.avg(v).alias("mean_value"))


def price_impact(trades: DataFrame, level: int | None = None, stored: bool = False) -> DataFrame:
    """Correlation of a trade's size with its absolute price move. ``stored`` trades are not copied first."""
    out = blocks.over_series(
        _slim(trades, "price", "quantity"), blocks.trade_series(), 1,
        lambda w: {"_move": F.abs(F.col("price") - F.lag("price").over(w))}, level, stored=stored,
    )
    return out.groupBy("pair_symbol").agg(F.corr("quantity", "_move").alias("impact"))


def micro_volatility(trades: DataFrame, seconds: int = 60) -> DataFrame:
    df = at_second(trades).withColumn("bucket", F.floor(F.col("at") / seconds) * seconds)
    return df.groupBy("pair_symbol", "bucket").agg(
        F.stddev_samp("price").alias("price_stddev"), (F.max("price") - F.min("price")).alias("swing")
    )


def trade_size_trend(trades: DataFrame) -> DataFrame:
    return trades.groupBy("pair_symbol", "transaction_date").agg(
        F.count("*").alias("trades"), F.avg("quantity").alias("mean_quantity"), F.max("quantity").alias("max_quantity")
    )


def trade_anomalies(trades: DataFrame, seconds: int = 1, many: int = 50, tiny: float = 1, few: int = 3, spike: float = 0.01) -> DataFrame:
    """Bursts of tiny trades, and price spikes on few trades."""
    spread = X.safe_divide(F.col("max_price") - F.col("min_price"), "min_price")
    kind = (
        F.when((F.col("trades") >= many) & (F.col("mean_quantity") <= tiny), "tiny burst")
        .when((F.col("trades") <= few) & (spread > spike), "thin spike")
    )
    return activity(trades, seconds).withColumn("anomaly", kind).filter(F.col("anomaly").isNotNull())


def event_reactions(trades: DataFrame, seconds: int = 1, n: int = 20, factor: float = 2, move: float = 0.01, level: int | None = None) -> DataFrame:
    """Buckets where trades, volume and price jump together against the n buckets before."""
    day = F.floor(F.col("bucket") / 86400)
    levels = [F.floor(day / 28), day, F.floor(F.col("bucket") / 3600), F.floor(F.col("bucket") / 60), F.col("bucket")]
    series = blocks.Series(("pair_symbol",), ("bucket",), tuple(levels))

    def build(w):
        before = w.rowsBetween(-n, -1)
        prev = F.lag("mean_price").over(w)
        jump = (
            (F.col("trades") > F.avg("trades").over(before) * factor)
            & (F.col("volume") > F.avg("volume").over(before) * factor)
            & (F.abs(X.safe_divide(F.col("mean_price") - prev, prev)) > move)
        )
        return {"_jump": jump}

    rows = blocks.over_series(activity(trades, seconds), series, n, build, level)
    return rows.filter(F.col("_jump")).drop("_jump")


def price_stddev(trades: DataFrame) -> DataFrame:
    return trades.groupBy("pair_symbol").agg(F.stddev_samp("price").alias("price_stddev"))
