"""Described insights."""

from pyspark.sql import functions as F

from candlewick.functions import expressions as X
from candlewick.plans import facts
from candlewick.plans import indicators as I
from candlewick.session import stage
from verification.base import DAY_KEYS, SIZE_SQL, candles_long, check, daily, r, rounded, rr, stg_trades, table, using

W = "PARTITION BY asset_pair_symbol ORDER BY open_date"
KEYS = "asset_pair_symbol, open_date"
ATW = "PARTITION BY pair_symbol ORDER BY transaction_date, transaction_time, agg_trade_id"
AT = "CAST(epoch(date_trunc('second', ts)) AS BIGINT)"


def rows(n):
    return f"OVER ({W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def pick(df, exact, floors=()):
    out = df.select(*DAY_KEYS, *exact, *floors)
    return rounded(out, *floors) if floors else out


_MA = f"(SELECT *, avg(close) {rows(10)} AS ma_10, avg(close) {rows(20)} AS ma_20 FROM daily)"


@check("ind_ma_10_20", using("daily", f"""SELECT {KEYS}, {rr('ma_10', 'ma_20')}, CASE WHEN ma_10 > ma_20 THEN 'up' WHEN ma_10 < ma_20 THEN 'down' ELSE 'flat' END AS ma_trend,
    CASE WHEN ma_10 > ma_20 AND lag(ma_10) OVER ({W}) <= lag(ma_20) OVER ({W}) THEN 'golden_cross'
    WHEN ma_10 < ma_20 AND lag(ma_10) OVER ({W}) >= lag(ma_20) OVER ({W}) THEN 'death_cross' END AS ma_cross FROM {_MA}"""))
def ind_ma_10_20(spark, sf):
    # the two means of a pair's first ten rows are the same numbers, so only later rows can cross
    return pick(I.ma_10_20(daily(spark, sf)), ["ma_trend", "ma_cross"], ["ma_10", "ma_20"])


_GEO = """(SELECT *, high - low AS candle_range, (high - low) / nullif(open, 0) AS range_to_open, abs(close - open) AS body,
    high - greatest(open, close) AS upper_wick, least(open, close) - low AS lower_wick,
    CASE WHEN abs(close - open) <= (high - low) * 0.1::DOUBLE THEN 'doji' WHEN close > open THEN 'bullish' ELSE 'bearish' END AS candle_type FROM daily)"""
_GEO_COLS = ["candle_range", "range_to_open", "body", "upper_wick", "lower_wick"]


@check("ind_candle_geometry", using("daily", f"SELECT {KEYS}, {', '.join(_GEO_COLS)}, candle_type FROM {_GEO}"))
def ind_candle_geometry(spark, sf):
    return pick(I.candle_geometry(daily(spark, sf)), [*_GEO_COLS, "candle_type"])


@check("ind_candle_patterns", using("daily", f"""SELECT {KEYS}, CASE WHEN pc < po AND close > open AND open <= pc AND close >= po THEN 'bullish engulfing'
    WHEN pc > po AND close < open AND open >= pc AND close <= po THEN 'bearish engulfing'
    WHEN lower_wick >= 2 * body AND upper_wick <= body THEN 'hammer' WHEN upper_wick >= 2 * body AND lower_wick <= body THEN 'shooting star' END AS pattern
    FROM (SELECT *, lag(open) OVER ({W}) AS po, lag(close) OVER ({W}) AS pc FROM {_GEO})"""))
def ind_candle_patterns(spark, sf):
    return pick(I.candle_patterns(daily(spark, sf)), ["pattern"])


@check("ind_rolling_vol_close", using("daily", f"SELECT {KEYS}, " + ", ".join(r(f"stddev_samp(close) {rows(n)}", f"vol_close_{n}") for n in (10, 14, 20)) + " FROM daily"))
def ind_rolling_vol_close(spark, sf):
    return pick(I.rolling_vol_close(daily(spark, sf)), [], ["vol_close_10", "vol_close_14", "vol_close_20"])


_SPIKE = f"(SELECT *, avg(base_asset_volume) {rows(20)} AS avg_volume, abs((close - open) / nullif(open, 0)) AS move FROM daily)"


@check("ind_volume_spike", using("daily", f"SELECT {KEYS}, {r('avg_volume', 'avg_volume')}, base_asset_volume > avg_volume * 2 AS is_spike FROM {_SPIKE}"))
def ind_volume_spike(spark, sf):
    return pick(I.volume_spike(daily(spark, sf)), ["is_spike"], ["avg_volume"])


_VWAP = "sum(close * base_asset_volume) / nullif(sum(base_asset_volume), 0)"


@check("ind_vwap", using("candles_long", f"""SELECT {KEYS}, {r(_VWAP, 'vwap')},
    {r('sum((high + low + close) / 3 * base_asset_volume) / nullif(sum(base_asset_volume), 0)', 'vwap_typical')} FROM candles_long GROUP BY 1, 2"""))
def ind_vwap(spark, sf):
    return rounded(I.vwap(candles_long(spark, sf)), "vwap", "vwap_typical")


@check("ind_buy_sell_ratio", using("daily", f"""SELECT {KEYS}, {rr('buy_ratio', 'sell_ratio')}, {r(f'avg(buy_ratio) {rows(5)}', 'buy_ratio_mean')} FROM (
    SELECT *, taker_buy_base_volume / nullif(base_asset_volume, 0) AS buy_ratio, 1 - taker_buy_base_volume / nullif(base_asset_volume, 0) AS sell_ratio FROM daily)"""))
def ind_buy_sell_ratio(spark, sf):
    return pick(I.buy_sell_ratio(daily(spark, sf)), [], ["buy_ratio", "sell_ratio", "buy_ratio_mean"])


@check("ind_breakout", using("daily", f"SELECT {KEYS}, base_asset_volume > avg_volume * 2 AND move > 0.05::DOUBLE AS is_breakout FROM {_SPIKE}"))
def ind_breakout(spark, sf):
    return pick(I.breakout(daily(spark, sf)), ["is_breakout"])


@check("ind_liquidity_stress", using("daily", f"SELECT {KEYS}, base_asset_volume < avg_volume * 0.5 AND move > 0.05::DOUBLE AS is_stressed FROM {_SPIKE}"))
def ind_liquidity_stress(spark, sf):
    return pick(I.liquidity_stress(daily(spark, sf)), ["is_stressed"])


@check("ind_whale_proxy", using("trades", f"SELECT pair_symbol, {AT} // 3600 * 3600 AS bucket, {r('max(quantity) / nullif(avg(quantity), 0)', 'whale_ratio')} FROM trades GROUP BY 1, 2"))
def ind_whale_proxy(spark, sf):
    return rounded(I.whale_proxy(stg_trades(spark, sf)), "whale_ratio")


_RSI = f"""(SELECT *, CASE WHEN loss = 0 THEN 100 ELSE 100 - 100 / (1 + gain / nullif(loss, 0)) END AS rsi_14 FROM (
    SELECT *, avg(CASE WHEN d IS NOT NULL THEN greatest(d, 0) END) {rows(14)} AS gain, avg(CASE WHEN d IS NOT NULL THEN greatest(-d, 0) END) {rows(14)} AS loss
    FROM (SELECT *, close - lag(close) OVER ({W}) AS d FROM daily)))"""


@check("ind_rsi_14", using("daily", f"SELECT {KEYS}, {r('rsi_14', 'rsi_14')} FROM {_RSI}"))
def ind_rsi_14(spark, sf):
    return pick(I.rsi(daily(spark, sf)), [], ["rsi_14"])


def ema_sql(source, value, n, name):
    """An exponential mean by its own recursion, row by row."""
    a = f"(2.0::DOUBLE / {n + 1})"
    return f"""(WITH RECURSIVE numbered AS (SELECT {KEYS}, CAST({value} AS DOUBLE) AS v, row_number() OVER ({W}) AS i FROM {source}),
    steps AS (SELECT {KEYS}, i, v AS {name} FROM numbered WHERE i = 1 UNION ALL
    SELECT n.asset_pair_symbol, n.open_date, n.i, {a} * n.v + (1 - {a}) * s.{name} FROM steps s JOIN numbered n
    ON n.asset_pair_symbol = s.asset_pair_symbol AND n.i = s.i + 1) SELECT {KEYS}, {name} FROM steps)"""


@check("ind_ema", using("daily", f"SELECT {KEYS}, close, {rr('ema_12', 'ema_26')} FROM daily JOIN {ema_sql('daily', 'close', 12, 'ema_12')} USING ({KEYS}) JOIN {ema_sql('daily', 'close', 26, 'ema_26')} USING ({KEYS})"))
def ind_ema(spark, sf):
    return rounded(I.ema(daily(spark, sf)), "ema_12", "ema_26")


_LINE = f"line AS (SELECT {KEYS}, close, ema_12 - ema_26 AS macd FROM daily JOIN {ema_sql('daily', 'close', 12, 'ema_12')} USING ({KEYS}) JOIN {ema_sql('daily', 'close', 26, 'ema_26')} USING ({KEYS}))"


@check("ind_macd", using("daily", f"SELECT {KEYS}, close, {rr('macd', 'signal')}, {r('macd - signal', 'histogram')} FROM line JOIN {ema_sql('line', 'macd', 9, 'signal')} USING ({KEYS})").replace("\nSELECT", f",\n{_LINE}\nSELECT", 1))
def ind_macd(spark, sf):
    return rounded(I.macd(daily(spark, sf)), "macd", "signal", "histogram")


@check("ind_roc", using("daily", f"SELECT {KEYS}, {r(f'(close - lag(close, 10) OVER ({W})) / lag(close, 10) OVER ({W}) * 100', 'roc_10')} FROM daily"))
def ind_roc(spark, sf):
    return pick(I.rate_of_change(daily(spark, sf)), [], ["roc_10"])


@check("ind_momentum", using("daily", f"SELECT {KEYS}, close - lag(close, 10) OVER ({W}) AS momentum_10 FROM daily"))
def ind_momentum(spark, sf):
    return pick(I.momentum(daily(spark, sf)), ["momentum_10"])


@check("ind_bollinger", using("daily", f"""SELECT {KEYS}, {r('m', 'band_middle')}, {r('m + 2 * s', 'band_upper')}, {r('m - 2 * s', 'band_lower')} FROM (
    SELECT *, avg(close) {rows(20)} AS m, stddev_samp(close) {rows(20)} AS s FROM daily)"""))
def ind_bollinger(spark, sf):
    return pick(I.bollinger(daily(spark, sf)), [], ["band_middle", "band_upper", "band_lower"])


# ---- trades -----------------------------------------------------------------


@check("ind_trades_per_second", using("trades", f"SELECT pair_symbol, {AT} AS bucket, count(*) AS trades, sum(quantity) AS volume FROM trades GROUP BY 1, 2"))
def ind_trades_per_second(spark, sf):
    return I.trades_per_second(stg_trades(spark, sf))


@check("ind_inter_trade_delay", using("trades", f"SELECT agg_trade_id, pair_symbol, transaction_date, transaction_time, {AT} - lag({AT}) OVER ({ATW}) AS gap_seconds FROM trades"))
def ind_inter_trade_delay(spark, sf):
    return I.trade_gaps(stg_trades(spark, sf))


@check("ind_burst", using("trades", f"""SELECT pair_symbol, {AT} // 10 * 10 AS bucket, count(*) AS trades, sum(quantity) AS volume, {r('avg(quantity)', 'mean_quantity')},
    min(price) AS min_price, max(price) AS max_price, {r('avg(price)', 'mean_price')} FROM trades GROUP BY 1, 2 HAVING count(*) >= 2"""))
def ind_burst(spark, sf):
    return rounded(I.bursts(stg_trades(spark, sf), 10, 2), "mean_quantity", "mean_price")


@check("ind_order_flow_streak", using("trades", f"""SELECT pair_symbol, CAST(run AS BIGINT) AS run, side, count(*) AS trades, sum(quantity) AS volume, min(s) AS first_at, max(s) AS last_at FROM (
    SELECT *, sum(ch) OVER ({ATW} ROWS UNBOUNDED PRECEDING) AS run FROM (SELECT *, {AT} AS s,
    CASE WHEN agg_trade_id % 2 = 0 THEN 'buy' ELSE 'sell' END AS side,
    CASE WHEN lag(agg_trade_id % 2) OVER ({ATW}) IS NOT DISTINCT FROM agg_trade_id % 2 THEN 0 ELSE 1 END AS ch FROM trades)) GROUP BY 1, 2, 3"""))
def ind_order_flow_streak(spark, sf):
    side = F.when(F.col("agg_trade_id") % 2 == 0, "buy").otherwise("sell")
    return I.flow_streaks(stg_trades(spark, sf), side)


_ORDERS_AS_TRADES = "(SELECT o_orderpriority AS pair_symbol, CAST(o_orderdate AS DATE) AS transaction_date, o_totalprice AS price, 1.0::DOUBLE AS quantity FROM orders)"


def order_trades(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("pair_symbol"), F.to_date("o_orderdate").alias("transaction_date"),
        F.col("o_totalprice").alias("price"), F.lit(1.0).alias("quantity"))


_MW = "(PARTITION BY pair_symbol ORDER BY month)"


@check("ind_month_growth", f"""SELECT pair_symbol, month, volume, trades, {r(f'(volume - lag(volume) OVER {_MW}) * 100 / lag(volume) OVER {_MW}', 'volume_growth_pct')},
    {r(f'(trades - lag(trades) OVER {_MW}) * 100.0::DOUBLE / lag(trades) OVER {_MW}', 'trades_growth_pct')} FROM (
    SELECT pair_symbol, CAST(date_trunc('month', transaction_date) AS DATE) AS month, sum(quantity) AS volume, count(*) AS trades FROM {_ORDERS_AS_TRADES} GROUP BY 1, 2)""")
def ind_month_growth(spark, sf):
    return rounded(I.month_growth(order_trades(spark, sf)), "volume_growth_pct", "trades_growth_pct")


@check("ind_total_value", f"""SELECT pair_symbol, {r("sum(CASE WHEN year(transaction_date) = (SELECT max(year(o_orderdate)) FROM orders) THEN price * quantity ELSE 0 END)", 'value_ytd', 2)},
    {r('sum(price * quantity)', 'value_all_time', 2)} FROM {_ORDERS_AS_TRADES} GROUP BY 1""")
def ind_total_value(spark, sf):
    return rounded(I.total_value(order_trades(spark, sf)), "value_ytd", "value_all_time", places=2)


@check("ind_peak_times", using("trades", "SELECT dayname(transaction_date) AS dayname, CAST(left(transaction_time, 2) AS INTEGER) AS hour, count(*) AS trades, sum(quantity) AS volume FROM trades GROUP BY 1, 2"))
def ind_peak_times(spark, sf):
    return I.peak_times(stg_trades(spark, sf))


@check("ind_trader_segment", using("trades", f"SELECT {SIZE_SQL.format('price * quantity')} AS segment, count(*) AS trades, {r('avg(price * quantity)', 'mean_value')} FROM trades GROUP BY 1"))
def ind_trader_segment(spark, sf):
    return rounded(I.trader_segments(stg_trades(spark, sf)), "mean_value")


@check("ind_price_impact", using("trades", f"SELECT pair_symbol, {r('corr(quantity, m)', 'impact')} FROM (SELECT *, abs(price - lag(price) OVER ({ATW})) AS m FROM trades) GROUP BY 1"))
def ind_price_impact(spark, sf):
    return rounded(I.price_impact(stg_trades(spark, sf)), "impact")


_LEAD = "(lead(close, {0}) OVER ({1}) - close) / nullif(close, 0)"


@check("ind_forward_return", using("crossed", f"""SELECT ma_crossover_event AS signal, count(*) AS days, {r('avg(r1)', 'mean_return_1')}, {r('avg(r7)', 'mean_return_7')} FROM (
    SELECT *, {_LEAD.format(1, W)} AS r1, {_LEAD.format(7, W)} AS r7 FROM crossed) GROUP BY 1"""))
def ind_forward_return(spark, sf):
    df = facts.technical_columns(daily(spark, sf))
    return rounded(I.forward_return(df, F.col("ma_crossover_event")), "mean_return_1", "mean_return_7")


@check("ind_regime_share", using("series", "SELECT asset_pair_symbol, " + ", ".join(
    r(f"count(*) FILTER (trend_direction LIKE '{p}%') * 100.0::DOUBLE / count(*)", n) for p, n in (("UP", "up_pct"), ("DOWN", "down_pct"), ("SIDE", "flat_pct"))) + " FROM series GROUP BY 1"))
def ind_regime_share(spark, sf):
    return rounded(I.regime_share(daily(spark, sf)), "up_pct", "down_pct", "flat_pct")


@check("ind_period_performance", using("daily", f"""SELECT asset_pair_symbol, period, first_open, last_close, {r('last_close / first_open', 'growth_of_one')},
    {r('(last_close / first_open - 1) * 100', 'return_pct')}, kind FROM (""" + " UNION ALL ".join(
    f"""SELECT asset_pair_symbol, CAST(date_trunc('{k}', open_date) AS DATE) AS period, first(open ORDER BY open_date) AS first_open,
    last(close ORDER BY open_date) AS last_close, '{k}' AS kind FROM daily GROUP BY 1, 2""" for k in ("week", "month", "year")) + ")"))
def ind_period_performance(spark, sf):
    from candlewick.operators.sets import concat

    d = stage(daily(spark, sf), "daily")
    out = concat([I.period_performance(d, k).withColumn("kind", F.lit(k)) for k in ("week", "month", "year")])
    return rounded(out, "growth_of_one", "return_pct")


@check("ind_sharpe", using("lagged", f"SELECT asset_pair_symbol, {r('avg(log_return) / stddev_samp(log_return)', 'sharpe')} FROM lagged GROUP BY 1"))
def ind_sharpe(spark, sf):
    return rounded(I.sharpe(daily(spark, sf)), "sharpe")


@check("ind_price_volume_confirm", using("daily", f"""SELECT {KEYS}, CASE WHEN up AND more THEN 'confirmed' WHEN up AND NOT more THEN 'weak'
    WHEN NOT up AND more THEN 'selling' WHEN NOT up AND NOT more THEN 'quiet' END AS price_volume FROM (SELECT *, close > lag(close) OVER ({W}) AS up,
    base_asset_volume > lag(base_asset_volume) OVER ({W}) AS more FROM daily)"""))
def ind_price_volume_confirm(spark, sf):
    return pick(I.price_volume_confirm(daily(spark, sf)), ["price_volume"])


# a day of one candle has its close as its mean price up to the last digit, so such a day counts as neutral
@check("ind_price_vs_vwap", using("daily, candles_long", f"""SELECT {KEYS}, {r('close - v', 'distance', 4)}, CASE WHEN close - v > 1e-6::DOUBLE THEN 'bullish'
    WHEN close - v < -1e-6::DOUBLE THEN 'bearish' ELSE 'neutral' END AS vwap_side FROM daily JOIN (SELECT {KEYS}, {_VWAP} AS v FROM candles_long GROUP BY 1, 2) USING ({KEYS})"""))
def ind_price_vs_vwap(spark, sf):
    c = candles_long(spark, sf)
    c = stage(c, "hourly")
    df = I.price_vs_vwap(c, facts.candles_daily(c, DAY_KEYS), 1e-6)
    return rounded(df.select(*DAY_KEYS, (F.col("close") - F.col("vwap")).alias("distance"), "vwap_side"), "distance", places=4)


@check("ind_signal_checklist", using("daily", f"""SELECT {KEYS}, CASE WHEN rsi_14 < 30 THEN 'buy' WHEN rsi_14 > 70 THEN 'sell' ELSE 'none' END AS rsi_signal,
    CASE WHEN busy AND close >= open THEN 'buy' WHEN busy THEN 'sell' ELSE 'none' END AS volume_signal, close > sma AS above_sma_200, macd > signal AS macd_above_signal FROM (
    SELECT q.*, avg(close) {rows(200)} AS sma, base_asset_volume > avg(base_asset_volume) {rows(20)} AS busy FROM {_RSI} q)
    JOIN line USING ({KEYS}) JOIN {ema_sql('line', 'macd', 9, 'signal')} USING ({KEYS})""").replace("\nSELECT", f",\n{_LINE.replace(', close, ', ', ')}\nSELECT", 1))
def ind_signal_checklist(spark, sf):
    # the first rows of a pair compare equal means; both engines agree on them within the grid only
    return pick(I.signal_checklist(stage(daily(spark, sf), "daily")), ["rsi_signal", "volume_signal", "above_sma_200", "macd_above_signal"])


@check("ind_micro_volatility", using("trades", f"SELECT pair_symbol, {AT} // 3600 * 3600 AS bucket, {r('stddev_samp(price)', 'price_stddev')}, max(price) - min(price) AS swing FROM trades GROUP BY 1, 2"))
def ind_micro_volatility(spark, sf):
    return rounded(I.micro_volatility(stg_trades(spark, sf), 3600), "price_stddev")


@check("ind_trade_size_trend", using("trades", f"SELECT pair_symbol, transaction_date, count(*) AS trades, {r('avg(quantity)', 'mean_quantity')}, max(quantity) AS max_quantity FROM trades GROUP BY 1, 2"))
def ind_trade_size_trend(spark, sf):
    return rounded(I.trade_size_trend(stg_trades(spark, sf)), "mean_quantity")


_ACT = f"""(SELECT pair_symbol, {AT} // 3600 * 3600 AS bucket, count(*) AS trades, sum(quantity) AS volume, avg(quantity) AS mean_quantity,
    min(price) AS min_price, max(price) AS max_price, avg(price) AS mean_price FROM trades GROUP BY 1, 2)"""
_ACT_COLS = f"pair_symbol, bucket, trades, volume, {r('mean_quantity', 'mean_quantity')}, min_price, max_price, {r('mean_price', 'mean_price')}"


@check("ind_trade_anomaly", using("trades", f"""SELECT {_ACT_COLS}, CASE WHEN trades >= 5 AND mean_quantity <= 40 THEN 'tiny burst' ELSE 'thin spike' END AS anomaly FROM {_ACT}
    WHERE (trades >= 5 AND mean_quantity <= 40) OR (trades <= 3 AND (max_price - min_price) / nullif(min_price, 0) > 0.01::DOUBLE)"""))
def ind_trade_anomaly(spark, sf):
    return rounded(I.trade_anomalies(stg_trades(spark, sf), 3600, 5, 40), "mean_quantity", "mean_price")


_BW = "OVER (PARTITION BY pair_symbol ORDER BY bucket ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)"


@check("ind_event_reaction", using("trades", f"""SELECT {_ACT_COLS} FROM (SELECT *, trades > avg(trades) {_BW} * 1.5 AND volume > avg(volume) {_BW} * 1.5
    AND abs((mean_price - lag(mean_price) OVER (PARTITION BY pair_symbol ORDER BY bucket)) / nullif(lag(mean_price) OVER (PARTITION BY pair_symbol ORDER BY bucket), 0)) > 0.01::DOUBLE AS j FROM {_ACT}) WHERE j"""))
def ind_event_reaction(spark, sf):
    return rounded(I.event_reactions(stg_trades(spark, sf), 3600, 20, 1.5), "mean_quantity", "mean_price")


@check("ind_price_stddev_asset", using("trades", f"SELECT pair_symbol, {r('stddev_samp(price)', 'price_stddev')} FROM trades GROUP BY 1"))
def ind_price_stddev_asset(spark, sf):
    return rounded(I.price_stddev(stg_trades(spark, sf)), "price_stddev")


@check("ind_asset_correlation", using("lagged", f"""SELECT a.asset_pair_symbol, b.asset_pair_symbol AS base_pair, {r('corr(a.log_return, b.log_return)', 'correlation')}, count(*) AS days
    FROM lagged a JOIN lagged b ON a.open_date = b.open_date WHERE b.asset_pair_symbol IN ('AFUSDT', 'NOUSDT') GROUP BY 1, 2"""))
def ind_asset_correlation(spark, sf):
    return rounded(I.asset_correlation(stage(daily(spark, sf), "daily"), ["AFUSDT", "NOUSDT"]), "correlation")


# ---- correlated pairs -------------------------------------------------------

_PAIRS = """SELECT a.asset_pair_symbol AS pair_a, b.asset_pair_symbol AS pair_b, {} FROM {} a JOIN {} b ON a.open_date = b.open_date
    AND a.asset_pair_symbol < b.asset_pair_symbol GROUP BY 1, 2 HAVING corr(a.log_return, b.log_return) >= {} AND count(*) >= 30"""
_CORR = f"{r('corr(a.log_return, b.log_return)', 'correlation')}, count(*) AS days"


@check("ind_correlated_pairs", using("lagged", _PAIRS.format(_CORR, "lagged", "lagged", 0.005)))
def ind_correlated_pairs(spark, sf):
    """All pairs compared; the stand-in coins hardly correlate, so the threshold is low."""
    return rounded(I.correlated_pairs(stage(daily(spark, sf), "daily"), 0.005, exact=True), "correlation")


@check("ind_correlated_pairs_sketched", using("lagged", "SELECT * FROM (WITH twice AS (SELECT asset_pair_symbol, open_date, log_return FROM lagged UNION ALL "
       "SELECT asset_pair_symbol || '2', open_date, ln(exp(log_return) * (1 + ((day(open_date) % 7) - 3) / 500.0)) FROM lagged) " + _PAIRS.format(_CORR, "twice", "twice", 0.8) + ")"))
def ind_correlated_pairs_sketched(spark, sf):
    """Candidates by codes. Beside each coin a second one follows it with small moves of its own."""
    d = stage(daily(spark, sf), "daily").select("asset_pair_symbol", "open_date", "open", "close")
    moved = F.col("close") * (1 + (F.day("open_date") % 7 - 3) / F.lit(500.0))
    twice = d.unionByName(d.withColumns({"asset_pair_symbol": F.concat("asset_pair_symbol", F.lit("2")), "close": moved}))
    return rounded(I.correlated_pairs(twice, 0.8), "correlation")
