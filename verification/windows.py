"""Window functions."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from candlewick.functions import expressions as X
from candlewick.operators import dedup
from candlewick.plans import facts, marts, staging
from candlewick.session import stage
from candlewick.sources import generators as G
from verification.base import (
    DAY_KEYS, candles_1m, candles_long, check, daily, kline_messages, r, rounded, rr, stg_trades, table, using,
)
from verification.models import bronze_ohlcv
from verification.projections import KLINE_FLOOR, _KLINE


@check("win_dedup_latest_offset", using("latest", f"SELECT {_KLINE} FROM latest"))
def win_dedup_latest_offset(spark, sf):
    return rounded(staging.streamed_ohlcv(staging.stg_klines(kline_messages(spark, sf))), *KLINE_FLOOR)


@check("win_dedup_priority", using("hourly_stream, candles_long", """SELECT asset_pair_symbol, open_date, open_time, close, record_source FROM hourly_stream
    UNION ALL SELECT asset_pair_symbol, open_date, open_time, close, record_source FROM candles_long"""))
def win_dedup_priority(spark, sf):
    cols = ["asset_pair_symbol", "open_date", "open_time", "close", "record_source"]
    both = staging.batch_candles(bronze_ohlcv(spark, sf)).select(*cols).unionByName(staging.hourly_from_stream(candles_1m(spark, sf)).select(*cols))
    return dedup.prefer_source(both, staging.CANDLE_KEYS, "record_source", "streamed", ["close"])


_DUP = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"]


@check("win_dedup_arbitrary", f"""SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY {', '.join(_DUP)}) = 1""")
def win_dedup_arbitrary(spark, sf):
    return dedup.first_per_key(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], _DUP)


@check("win_row_number_both_ends", using("candles_1m", """SELECT asset_symbol, open_time,
    CAST(row_number() OVER (PARTITION BY asset_symbol, date_trunc('hour', open_time) ORDER BY open_time) AS INTEGER) AS rn_open,
    CAST(row_number() OVER (PARTITION BY asset_symbol, date_trunc('hour', open_time) ORDER BY close_time DESC) AS INTEGER) AS rn_close FROM candles_1m"""))
def win_row_number_both_ends(spark, sf):
    # an hour holds at most 60 minute candles
    w = Window.partitionBy("asset_symbol", F.date_trunc("hour", "open_time"))
    return candles_1m(spark, sf).select(
        "asset_symbol", "open_time", F.row_number().over(w.orderBy("open_time")).alias("rn_open"),
        F.row_number().over(w.orderBy(F.desc("close_time"))).alias("rn_close"))


@check("win_row_number_global", """SELECT d AS date_day, (row_number() OVER (ORDER BY d) - 1)::INTEGER AS n FROM (
    SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate) - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d FROM orders)""")
def win_row_number_global(spark, sf):
    b = table(spark, sf, "orders").agg(F.min("o_orderdate").alias("start"), F.max("o_orderdate").alias("end"))
    spine = G.date_spine(b, "day")
    start = table(spark, sf, "orders").agg(F.min("o_orderdate")).scalar()
    return spine.withColumn("start", start).select("date_day", F.datediff("date_day", "start").alias("n"))


@check("win_lag_prev_close", using("lagged", "SELECT asset_pair_symbol, open_date, close, prev_close FROM lagged"))
def win_lag_prev_close(spark, sf):
    return facts.with_prev_close(daily(spark, sf)).select(*DAY_KEYS, "close", "prev_close")


@check("win_lag_prev_time", using("trades", """SELECT agg_trade_id, pair_symbol, lag(CAST(epoch(CAST(transaction_time AS TIME)) AS INTEGER)) OVER (
    PARTITION BY pair_symbol ORDER BY transaction_date, transaction_time, agg_trade_id) AS previous_second FROM trades"""))
def win_lag_prev_time(spark, sf):
    t = stg_trades(spark, sf).select("agg_trade_id", "pair_symbol", "transaction_date", "transaction_time")
    return marts.with_previous_clock(t).select("agg_trade_id", "pair_symbol", "previous_second")


_W = "PARTITION BY asset_pair_symbol ORDER BY open_date"


def _mean(n):
    return r(f"avg(close) OVER ({_W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)", f"sma_{n}")


@check("win_rolling_avg", using("daily", f"SELECT asset_pair_symbol, open_date, {_mean(20)}, {_mean(50)}, {_mean(200)} FROM daily"))
def win_rolling_avg(spark, sf):
    w = facts.series_window()
    out = daily(spark, sf).select(*DAY_KEYS, *[X.sma("close", n, w).alias(f"sma_{n}") for n in (20, 50, 200)])
    return rounded(out, "sma_20", "sma_50", "sma_200")


@check("win_atr", using("ranged", f"SELECT asset_pair_symbol, open_date, {r(f'avg(tr) OVER ({_W} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)', 'atr_5')} FROM ranged"))
def win_atr(spark, sf):
    df = facts.with_true_range(facts.with_prev_close(daily(spark, sf)))
    return rounded(facts.with_atr(df, 5).select(*DAY_KEYS, "atr_5"), "atr_5")


@check("win_rolling_stddev", using("lagged", f"""SELECT asset_pair_symbol, open_date,
    {r(f'stddev_samp(log_return) OVER ({_W} ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)', 'sd_return_10')},
    {r(f'stddev_samp(close) OVER ({_W} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)', 'sd_close_7')} FROM lagged"""))
def win_rolling_stddev(spark, sf):
    w = facts.series_window()
    df = facts.returns_daily(daily(spark, sf))
    out = df.select(*DAY_KEYS, X.rolling_stddev("log_return", 10, w).alias("sd_return_10"), X.rolling_stddev("close", 7, w).alias("sd_close_7"))
    return rounded(out, "sd_return_10", "sd_close_7")


@check("win_cumulative_sum", using("daily", f"SELECT asset_pair_symbol, open_date, CAST(sum(num_trades) OVER ({_W} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running_trades FROM daily"))
def win_cumulative_sum(spark, sf):
    w = facts.series_window().rowsBetween(Window.unboundedPreceding, 0)
    return daily(spark, sf).select(*DAY_KEYS, F.sum("num_trades").over(w).alias("running_trades"))


@check("win_partition_total", using("daily", f"""SELECT asset_pair_symbol, open_date,
    {r('quote_asset_volume / nullif(sum(quote_asset_volume) OVER (PARTITION BY open_date), 0)', 'liquidity_market_share')} FROM daily"""))
def win_partition_total(spark, sf):
    out = facts.with_market_share(stage(daily(spark, sf), "daily")).select(*DAY_KEYS, "liquidity_market_share")
    return rounded(out, "liquidity_market_share")


@check("win_percentile_cont", using("atr", f"""SELECT asset_pair_symbol, open_date, {r('quantile_cont(atr_14, 0.33) OVER (PARTITION BY asset_pair_symbol)', 'p33')},
    {r('quantile_cont(atr_14, 0.66) OVER (PARTITION BY asset_pair_symbol)', 'p66')} FROM atr"""))
def win_percentile_cont(spark, sf):
    df = facts.with_atr(facts.with_true_range(facts.with_prev_close(daily(spark, sf))))
    w = Window.partitionBy("asset_pair_symbol")
    out = df.select(*DAY_KEYS, F.percentile("atr_14", 0.33).over(w).alias("p33"), F.percentile("atr_14", 0.66).over(w).alias("p66"))
    return rounded(out, "p33", "p66")


@check("win_crossover", using("crossed", """SELECT asset_pair_symbol, open_date, CASE WHEN ma_crossover_event LIKE 'GOLDEN%' THEN 'golden_cross'
    WHEN ma_crossover_event LIKE 'DEATH%' THEN 'death_cross' END AS crossing FROM crossed"""))
def win_crossover(spark, sf):
    df = facts.technical_columns(daily(spark, sf))
    return df.select(*DAY_KEYS, X.crossover("price_avg_50", "price_avg_200", facts.series_window()).alias("crossing"))
