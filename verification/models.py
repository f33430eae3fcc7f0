"""Named analytics: dimensions, candles, facts, marts."""

from pyspark.sql import functions as F

from candlewick.plans import dims, facts, marts, staging
from candlewick.session import stage
from verification.base import (
    DAY_KEYS, SIZE_SQL, assets_dim, calendar, candles_1m, candles_long, check, daily, daily_series, hourly_fct, key_sql, r,
    rounded, rr, sig, significant, stg_trades, trades_fct, using,
)

SUMS = ["base_asset_volume", "quote_asset_volume", "taker_buy_base_volume", "taker_buy_quote_volume"]
OHLC = "open, high, low, close"


# ---- dimensions -------------------------------------------------------------


@check("dim_assets", using("assets_dim, trades_fct", """SELECT a.*, coalesce(n, 0) AS trades FROM assets_dim a
    LEFT JOIN (SELECT base_asset_fk, count(*) AS n FROM trades_fct GROUP BY 1) t ON t.base_asset_fk = a.asset_sk"""))
def dim_assets(spark, sf):
    n = trades_fct(spark, sf).groupBy(F.col("base_asset_fk").alias("asset_sk")).agg(F.count("*").alias("n"))
    out = assets_dim(spark, sf).join(n, "asset_sk", "left")
    return out.select(*[c for c in out.columns if c != "n"], F.coalesce("n", F.lit(0)).alias("trades"))


@check("dim_date", using("date_dim", """SELECT d.*, coalesce(n, 0) AS orders FROM date_dim d
    LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS full_date, count(*) AS n FROM orders GROUP BY 1) USING (full_date)"""))
def dim_date(spark, sf):
    n = spark.read.parquet(f"{sf}/orders.parquet").groupBy(F.to_date("o_orderdate").alias("full_date")).agg(F.count("*").alias("n"))
    out = calendar(spark).drop("created_at")
    return out.join(n, "full_date", "left").select(*out.columns, F.coalesce("n", F.lit(0)).alias("orders"))


@check("dim_time", using("time_dim, trades", """SELECT d.*, coalesce(n, 0) AS trades FROM time_dim d
    LEFT JOIN (SELECT transaction_time AS time_of_day, count(*) AS n FROM trades GROUP BY 1) USING (time_of_day)"""))
def dim_time(spark, sf):
    n = stg_trades(spark, sf).groupBy(F.col("transaction_time").alias("time_of_day")).agg(F.count("*").alias("n"))
    out = dims.time_dim(spark).drop("created_at")
    return out.join(n, "time_of_day", "left").select(*out.columns, F.coalesce("n", F.lit(0)).alias("trades"))


# ---- candles ----------------------------------------------------------------

_HOUR = ("asset_pair_symbol, base_asset_symbol, quote_asset_symbol, open_date, open_time, close_date, close_time, "
         "open, high, low, close, num_trades, record_source")


@check("candles_hourly_from_stream", using("hourly_stream", f"SELECT {_HOUR}, {rr(*SUMS)} FROM hourly_stream"))
def candles_hourly_from_stream(spark, sf):
    return rounded(staging.hourly_from_stream(candles_1m(spark, sf)), *SUMS)


def bronze_ohlcv(spark, sf):
    """Landed hourly candles: the minute candles' hours with shifted prices, so both sources overlap."""
    h = staging.hourly_from_stream(candles_1m(spark, sf))
    long = candles_long(spark, sf).select(*h.columns)
    both = h.withColumn("open", F.col("open") + 1).unionByName(long)
    at = F.to_timestamp_ntz(F.concat_ws(" ", "open_date", "open_time"))
    return both.select(
        F.col("asset_pair_symbol").alias("asset_symbol"), at.alias("open_time"), "open", "high", "low", "close",
        F.col("base_asset_volume").alias("volume"), at.alias("close_time"), "quote_asset_volume", "num_trades",
        "taker_buy_base_volume", "taker_buy_quote_volume", F.lit(0).cast("bigint").alias("ignore"),
    )


_UNIFIED = f"SELECT {_HOUR}, {rr(*SUMS)} FROM hourly_stream UNION ALL SELECT {_HOUR}, {rr(*SUMS)} FROM candles_long"


@check("candles_unified", using("hourly_stream, candles_long", _UNIFIED))
def candles_unified(spark, sf):
    return rounded(staging.stg_ohlcv(bronze_ohlcv(spark, sf), candles_1m(spark, sf)), *SUMS)


# ---- facts ------------------------------------------------------------------


@check("fct_ohlcv_hourly", using("hourly_fct", f"SELECT * EXCLUDE ({', '.join(SUMS)}), {rr(*SUMS)} FROM hourly_fct"))
def fct_ohlcv_hourly(spark, sf):
    return rounded(hourly_fct(spark, sf), *SUMS)


@check("fct_trades", using("trades_fct", """SELECT * FROM (SELECT * FROM trades_fct UNION ALL
    SELECT * REPLACE (quantity + 1 AS quantity) FROM trades_fct WHERE agg_trade_id % 10 = 0)
    QUALIFY row_number() OVER (PARTITION BY agg_trade_id, pair_symbol, price ORDER BY quantity) = 1"""))
def fct_trades(spark, sf):
    """A tenth of the trades arrives twice, the second time with another quantity."""
    t = stg_trades(spark, sf)
    again = t.filter("agg_trade_id % 10 = 0").withColumn("quantity", F.col("quantity") + 1)
    return facts.fct_trades(t.unionByName(again), assets_dim(spark, sf), calendar(spark))


@check("candles_daily", using("daily", f"SELECT asset_pair_symbol, open_date, {OHLC}, num_trades, {rr(*SUMS)} FROM daily"))
def candles_daily(spark, sf):
    return rounded(daily(spark, sf), *SUMS)


def _pick(df, exact, floored, places=6):
    return rounded(df.select(*DAY_KEYS, *exact, *floored), *floored, places=places)


def _pick_sql(cte, exact, floored):
    cols = ", ".join([*DAY_KEYS, *exact])
    return using(cte, f"SELECT {cols}{', ' + rr(*floored) if floored else ''} FROM {cte}")


@check("returns_daily", _pick_sql("lagged", ["return_abs", "return_pct"], ["log_return"]))
def returns_daily(spark, sf):
    return _pick(facts.returns_daily(daily(spark, sf)), ["return_abs", "return_pct"], ["log_return"])


_COMPOUNDED = "(exp(cumulative_log_return) - 1) * 100"


# the compounded value leaves any fixed grid, so its significant digits are compared
@check("cumulative_return", using("ranged", f"SELECT asset_pair_symbol, open_date, {r('cumulative_log_return', 'cumulative_log_return')}, {sig(_COMPOUNDED, 'cumulative_return')} FROM ranged"))
def cumulative_return(spark, sf):
    df = facts.cumulative_return(facts.returns_daily(daily(spark, sf)))
    df = df.withColumn("cumulative_log_return", facts.running_log_return()).select(*DAY_KEYS, "cumulative_log_return", "cumulative_return")
    return significant(rounded(df, "cumulative_log_return"), "cumulative_return")


@check("true_range", _pick_sql("ranged", ["tr"], []))
def true_range(spark, sf):
    return _pick(facts.with_true_range(facts.with_prev_close(daily(spark, sf))), ["tr"], [])


@check("rolling_vol_10", _pick_sql("ranged", ["candle_range"], ["rolling_vol_10"]))
def rolling_vol_10(spark, sf):
    return _pick(facts.rolling_volatility(facts.returns_daily(daily(spark, sf))), ["candle_range"], ["rolling_vol_10"])


@check("atr_14", _pick_sql("atr", ["atr_14"], []))
def atr_14(spark, sf):
    return _pick(facts.with_atr(facts.with_true_range(facts.with_prev_close(daily(spark, sf)))), ["atr_14"], [])


@check("volatility_label", _pick_sql("series", ["volatility_label"], []))
def volatility_label(spark, sf):
    df = facts.with_atr(facts.with_true_range(facts.with_prev_close(daily(spark, sf))))
    return _pick(facts.volatility_label(df), ["volatility_label"], [])


_DAY_EXACT = ["open", "high", "low", "close", "num_trades", "prev_close", "return_abs", "return_pct", "candle_range", "tr",
              "atr_14", "trend_direction", "volatility_label"]
_DAY_FLOOR = [*SUMS, "log_return", "rolling_vol_10"]


def _asset_key_sql(cte):
    return f"""{cte} s JOIN (SELECT asset_sk, upper(symbol) || 'USDT' AS p FROM assets_dim WHERE rank_valid_to IS NULL) a
        ON a.p = s.asset_pair_symbol"""


@check("fct_ohlcv_daily", using("series, assets_dim", f"""SELECT {key_sql('asset_sk', 'open_date')} AS daily_ohlcv_sk,
    asset_sk AS base_asset_fk, {', '.join([*DAY_KEYS, *_DAY_EXACT])}, {rr(*_DAY_FLOOR)}, {sig(_COMPOUNDED, 'cumulative_return')} FROM {_asset_key_sql('series')}"""))
def fct_ohlcv_daily(spark, sf):
    df = facts.fct_ohlcv_daily(hourly_fct(spark, sf))
    df = df.select("daily_ohlcv_sk", "base_asset_fk", *DAY_KEYS, *_DAY_EXACT, *_DAY_FLOOR, "cumulative_return")
    return significant(rounded(df, *_DAY_FLOOR), "cumulative_return")


@check("ma_crossover_50_200", _pick_sql("crossed", ["ma_crossover_event"], ["price_avg_50", "price_avg_200"]))
def ma_crossover_50_200(spark, sf):
    return _pick(facts.technical_columns(daily(spark, sf)), ["ma_crossover_event"], ["price_avg_50", "price_avg_200"])


_LIQ = ["range_pct", "avg_trade_size_usd", "liquidity_usd", "buy_liquidity_usd", "sell_liquidity_usd", "rolling_volume_20",
        "rolling_trades_20", "normalized_liquidity", "liquidity_market_share"]


@check("liquidity_daily", using("pressed, assets_dim", f"""SELECT {key_sql('asset_pair_symbol', 'open_date')} AS liquidity_sk,
    asset_sk AS base_asset_fk, asset_pair_symbol, open_date, {OHLC}, num_trades, {rr(*_LIQ)} FROM (
    SELECT s.* EXCLUDE (liquidity_market_share), asset_sk,
    quote_asset_volume / sum(quote_asset_volume) OVER (PARTITION BY open_date) AS liquidity_market_share
    FROM {_asset_key_sql('pressed')}) x"""))
def liquidity_daily(spark, sf):
    d = stage(facts.candles_daily(hourly_fct(spark, sf)), "daily")
    df = facts.fct_liquidity_daily(d)
    return rounded(df.select("liquidity_sk", "base_asset_fk", *DAY_KEYS, "open", "high", "low", "close", "num_trades", *_LIQ), *_LIQ)


_PRESS = ["instant_buy_ratio_quote", "instant_buy_ratio_base", "passive_quote_volume", "passive_base_volume",
          "passive_ratio_quote", "passive_ratio_base", "aggression_index"]


@check("pressure_daily", _pick_sql("regimes", ["pressure_regime"], _PRESS))
def pressure_daily(spark, sf):
    return _pick(facts.pressure_columns(daily(spark, sf)), ["pressure_regime"], _PRESS)


_WIDE_EXACT = ["open", "high", "low", "close", "num_trades", "return_abs", "return_pct", "tr", "atr_14", "trend_direction",
               "volatility_label", "ma_crossover_event", "pressure_regime"]
_WIDE_FLOOR = ["rolling_vol_10", "price_avg_50", "price_avg_200", "liquidity_usd", "avg_trade_size_usd", "buy_liquidity_usd",
               "sell_liquidity_usd", "liquidity_market_share", "normalized_liquidity", "rolling_trades_20",
               "rolling_volume_20", "taker_buy_base_volume", "taker_buy_quote_volume", *_PRESS]
_WIDE_SQL = using("regimes, assets_dim, date_dim", f"""SELECT open_date, d.day, d.month, d.monthname, d.year, d.quarter, d.quartername,
    asset_pair_symbol, asset_name, num_market_pairs, asset_launch_date, supply_type, market_cap_based_rank,
    high - low AS daily_range, {', '.join(_WIDE_EXACT)}, {rr(*_WIDE_FLOOR)}, {r('range_pct', 'price_range_pct')}, {sig(_COMPOUNDED, 'cumulative_return_pct')} FROM (
    SELECT s.* EXCLUDE (liquidity_market_share), a.*, quote_asset_volume / sum(quote_asset_volume) OVER (PARTITION BY open_date)
        AS liquidity_market_share
    FROM regimes s JOIN (SELECT *, upper(symbol) || 'USDT' AS p FROM assets_dim WHERE rank_valid_to IS NULL) a
        ON a.p = s.asset_pair_symbol) x
    LEFT JOIN date_dim d ON d.full_date = open_date""")


def _wide(df):
    df = df.drop("base_asset_symbol", "quote_asset_symbol")
    return significant(rounded(df, *_WIDE_FLOOR, "price_range_pct"), "cumulative_return_pct")


@check("market_daily_wide", _WIDE_SQL)
def market_daily_wide(spark, sf):
    d = stage(facts.fct_ohlcv_daily(hourly_fct(spark, sf)), "daily")
    return _wide(facts.market_daily_wide(d, calendar(spark), assets_dim(spark, sf)))


@check("join_wide_market_view", _WIDE_SQL)
def join_wide_market_view(spark, sf):
    d = stage(facts.fct_ohlcv_daily(hourly_fct(spark, sf)), "daily")
    t, l, p = facts.fct_technical_daily(d), facts.fct_liquidity_daily(d), facts.fct_pressure_daily(d)
    return _wide(facts.market_daily_joined(d, t, l, p, calendar(spark), assets_dim(spark, sf)))


# ---- marts ------------------------------------------------------------------


@check("mart_trade_size_distribution", using("trades", f"""SELECT pair_symbol, count(*) AS total_trades,
    count(*) FILTER (c LIKE 'Micro%') AS micro_trades, count(*) FILTER (c LIKE 'Small%') AS small_trades,
    count(*) FILTER (c LIKE 'Medium%') AS medium_trades, count(*) FILTER (c LIKE 'Large%') AS large_trades,
    count(*) FILTER (c LIKE 'Whale%') AS whale_trades
    FROM (SELECT pair_symbol, {SIZE_SQL.format('price * quantity')} AS c FROM trades) GROUP BY pair_symbol"""))
def mart_trade_size_distribution(spark, sf):
    return marts.trade_size_distribution(trades_fct(spark, sf))


@check("mart_market_share", using("trades_fct, date_dim, assets_dim", f"""SELECT trade_year, trade_month, asset_name,
    {r('v', 'total_value_traded')}, {r('m', 'total_market_value')}, {r('v / m * 100', 'asset_market_share_percentage')} FROM (
    SELECT *, sum(v) OVER (PARTITION BY trade_year, trade_month) AS m FROM (
    SELECT base_asset_fk, d.year AS trade_year, d.month AS trade_month, sum(quantity * price) AS v
    FROM trades_fct JOIN date_dim d ON d.date_sk = date_fk GROUP BY 1, 2, 3)) x JOIN assets_dim a ON a.asset_sk = base_asset_fk"""))
def mart_market_share(spark, sf):
    df = marts.market_share(trades_fct(spark, sf), calendar(spark), assets_dim(spark, sf))
    return rounded(df, "total_value_traded", "total_market_value", "asset_market_share_percentage")


@check("mart_time_between_trades", using("trades_fct, date_dim", f"""SELECT pair_symbol, trade_year,
    {r("avg(s - p)", 'avg_time_between_trades_in_seconds')} FROM (
    SELECT pair_symbol, d.year AS trade_year, time_fk AS s,
    lag(time_fk) OVER (PARTITION BY pair_symbol ORDER BY transaction_date, transaction_time, agg_trade_id) AS p
    FROM trades_fct LEFT JOIN date_dim d ON d.date_sk = date_fk) x WHERE p IS NOT NULL AND p <= s GROUP BY 1, 2"""))
def mart_time_between_trades(spark, sf):
    return rounded(marts.time_between_trades(trades_fct(spark, sf), calendar(spark)), "avg_time_between_trades_in_seconds")


@check("mart_price_by_hour", using("trades", f"""SELECT transaction_date AS full_date, pair_symbol,
    CAST(left(transaction_time, 2) AS INTEGER) AS trade_hour, {r('avg(price)', 'avg_price')}, min(price) AS min_price,
    max(price) AS max_price FROM trades GROUP BY ALL"""))
def mart_price_by_hour(spark, sf):
    return rounded(marts.price_by_hour(trades_fct(spark, sf), dims.time_dim(spark), calendar(spark)), "avg_price")


@check("mart_daily_volume", using("trades_fct", f"""SELECT date_fk, transaction_date, pair_symbol,
    {r('sum(quantity)', 'total_quantity_traded')}, {r('sum(quantity * price)', 'total_value_traded')},
    CAST(sum(last_trade_id - first_trade_id + 1) AS BIGINT) AS total_trades, {r('avg(price)', 'avg_price')},
    min(price) AS min_price, max(price) AS max_price FROM trades_fct WHERE date_fk IS NOT NULL GROUP BY 1, 2, 3"""))
def mart_daily_volume(spark, sf):
    df = marts.daily_volume(trades_fct(spark, sf), calendar(spark))
    return rounded(df, "total_quantity_traded", "total_value_traded", "avg_price")


@check("mart_intraday_pattern", using("trades_fct, time_dim", f"""SELECT hour_of_day, time_division, {r('avg(quantity)', 'avg_quantity')},
    {r('avg(price * quantity)', 'avg_trade_value')}, CAST(sum(last_trade_id - first_trade_id + 1) AS BIGINT) AS trade_frequency
    FROM trades_fct JOIN time_dim ON time_fk = time_sk GROUP BY 1, 2"""))
def mart_intraday_pattern(spark, sf):
    return rounded(marts.intraday_pattern(trades_fct(spark, sf), dims.time_dim(spark)), "avg_quantity", "avg_trade_value")


def _large_sql(factor):
    """Every step is kept as a table, equal keys are joined first, and the inequality is the last filter."""
    steps = using("trades_fct, date_dim", f"""SELECT pair_symbol, year AS trade_year, month AS trade_month, quantity AS large_trades_quantity, price,
    {r('quantity * price', 'trade_value_usdt')}, {r('aq', 'avg_quantity')}, {r('av', 'avg_trade_value')} FROM paired WHERE quantity >= aq * {factor}""")
    head, _, body = steps.rpartition("\nSELECT pair_symbol, year AS trade_year")
    return head.replace(" AS (", " AS MATERIALIZED (") + """,
dated AS MATERIALIZED (SELECT t.pair_symbol, t.base_asset_fk, t.quantity, t.price, d.year, d.month FROM trades_fct t JOIN date_dim d ON d.date_sk = t.date_fk),
means AS MATERIALIZED (SELECT base_asset_fk, pair_symbol, year, month, avg(quantity) AS aq, avg(quantity * price) AS av FROM dated GROUP BY ALL),
paired AS MATERIALIZED (SELECT t.pair_symbol, t.year, t.month, t.quantity, t.price, m.aq, m.av FROM dated t
    JOIN means m ON m.base_asset_fk = t.base_asset_fk AND m.year = t.year AND m.month = t.month)
SELECT pair_symbol, year AS trade_year""" + body


# the stand-in quantities are uniform, so a lower factor is used to have rows to compare
@check("mart_large_trades", _large_sql(1.5))
def mart_large_trades(spark, sf):
    return rounded(marts.large_trades(trades_fct(spark, sf), calendar(spark), 1.5), "trade_value_usdt", "avg_quantity", "avg_trade_value")


@check("mart_trading_intensity", using("trades_fct, time_dim, date_dim", f"""SELECT hour_of_day, dayname,
    CASE WHEN dayname IN ('Saturday', 'Sunday') THEN 1 ELSE 0 END AS is_weekend, pair_symbol,
    CAST(sum(last_trade_id - first_trade_id + 1) AS BIGINT) AS trade_count, {r('sum(quantity)', 'hourly_volume')},
    {r('avg(price)', 'avg_hourly_price')}, {r('stddev_samp(price)', 'price_volatility')}
    FROM trades_fct LEFT JOIN time_dim ON time_fk = time_sk LEFT JOIN date_dim ON date_fk = date_sk GROUP BY 1, 2, 3, 4"""))
def mart_trading_intensity(spark, sf):
    df = marts.trading_intensity(trades_fct(spark, sf), dims.time_dim(spark), calendar(spark))
    return rounded(df, "hourly_volume", "avg_hourly_price", "price_volatility")


@check("mart_trading_velocity", using("trades", f"""SELECT transaction_date AS trade_date, CAST(left(transaction_time, 2) AS INTEGER) AS trade_hour,
    CAST(sum(last_trade_id - first_trade_id + 1) AS BIGINT) AS trades_per_hour, {r('sum(quantity)', 'volume_per_hour')},
    {r('sum(price * quantity)', 'value_per_hour')}, {r('CAST(sum(last_trade_id - first_trade_id + 1) AS DOUBLE) / 60', 'trades_per_minute')}
    FROM trades GROUP BY 1, 2"""))
def mart_trading_velocity(spark, sf):
    return rounded(marts.trading_velocity(trades_fct(spark, sf)), "volume_per_hour", "value_per_hour", "trades_per_minute")


_ORDERED = "PARTITION BY pair_symbol ORDER BY transaction_date, transaction_time, agg_trade_id"


@check("mart_volatility_7", using("trades", f"""SELECT agg_trade_id, transaction_date, pair_symbol, price,
    {r(f'stddev_samp(price) OVER ({_ORDERED} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)', 'volatility_7_day')} FROM trades"""))
def mart_volatility_7(spark, sf):
    return rounded(marts.volatility_rows(trades_fct(spark, sf)), "volatility_7_day")


@check("mart_volatility_7_days", using("trades", f"""SELECT d.pair_symbol, d.transaction_date, count(*) AS trades,
    {r('stddev_samp(price)', 'volatility_7_days')}
    FROM (SELECT DISTINCT pair_symbol, transaction_date FROM trades) d JOIN trades t ON t.pair_symbol = d.pair_symbol
    AND t.transaction_date BETWEEN d.transaction_date - 6 AND d.transaction_date GROUP BY 1, 2"""))
def mart_volatility_7_days(spark, sf):
    return rounded(marts.volatility_days(trades_fct(spark, sf)), "volatility_7_days")


@check("adhoc_pair_value_rank", using("trades", f"SELECT pair_symbol, {r('sum(quantity * price)', 'total_value_traded')} FROM trades GROUP BY 1"))
def adhoc_pair_value_rank(spark, sf):
    return rounded(marts.pair_value_rank(trades_fct(spark, sf)), "total_value_traded")


@check("adhoc_trade_size_label", using("trades", f"""SELECT pair_symbol, price * quantity AS trade_value,
    {SIZE_SQL.format('price * quantity')} AS trade_size_category, quantity, price, transaction_date FROM trades"""))
def adhoc_trade_size_label(spark, sf):
    return marts.trade_size_label(trades_fct(spark, sf))


_SIDES = ["trades", "min_price", "max_price", "avg_price", "first_price", "last_price"]


def _neighbors_sql(threshold):
    side = lambda l, a: ", ".join(
        r(f"{a}.{m}", f"{l}_day_{m}") if m == "avg_price" else f"{a}.{m} AS {l}_day_{m}" for m in _SIDES)
    return using("trades", f"""SELECT agg_trade_id, w.pair_symbol, price AS current_price, quantity AS trade_quantity,
    w.transaction_date, transaction_time, {side('previous', 'p')}, {side('next', 'n')}
    FROM trades w LEFT JOIN day p ON p.pair_symbol = w.pair_symbol AND p.d = w.transaction_date - 1
    LEFT JOIN day n ON n.pair_symbol = w.pair_symbol AND n.d = w.transaction_date + 1 WHERE quantity > {threshold}""").replace(
        "\nSELECT", """, day AS (SELECT pair_symbol, transaction_date AS d, count(*) AS trades, min(price) AS min_price,
    max(price) AS max_price, avg(price) AS avg_price, first(price ORDER BY transaction_time, agg_trade_id) AS first_price,
    last(price ORDER BY transaction_time, agg_trade_id) AS last_price FROM trades GROUP BY 1, 2)\nSELECT""", 1)


@check("adhoc_whale_neighbors", _neighbors_sql(90))
def adhoc_whale_neighbors(spark, sf):
    df = marts.whale_neighbors(trades_fct(spark, sf), 90)
    return rounded(df, "previous_day_avg_price", "next_day_avg_price")
