"""Candle rules, returns, labels and the rolling measures on hand-made rows."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from candlewick.functions import expressions as X
from candlewick.functions import scalars as S
from candlewick.plans import dims, facts, marts, staging
from candlewick.sources import files


def one(df):
    return df.collect()[0]


def daily(spark, rows):
    """(day, open, high, low, close) of one pair, plus volumes."""
    out = [("AUSDT", dt.date(2024, 1, d), o, h, l, c, 10.0, 100.0, 5, 6.0, 60.0) for d, o, h, l, c in rows]
    schema = (
        "asset_pair_symbol string, open_date date, open double, high double, low double, close double, base_asset_volume double, "
        "quote_asset_volume double, num_trades bigint, taker_buy_base_volume double, taker_buy_quote_volume double"
    )
    return spark.createDataFrame(out, schema)


def test_hourly_from_stream(spark):
    t = lambda m: dt.datetime(2024, 1, 1, 10, m)
    rows = [("AUSDT", t(5), 2.0, 5.0, 1.0, 3.0, t(6)), ("AUSDT", t(1), 1.0, 4.0, 0.5, 2.0, t(2)), ("AUSDT", t(59), 3.0, 3.5, 2.0, 9.0, t(59)),
            ("BTC", dt.datetime(2024, 1, 1, 11, 0), 7.0, 7.0, 7.0, 7.0, dt.datetime(2024, 1, 1, 11, 1))]
    df = spark.createDataFrame(rows, "asset_symbol string, open_time timestamp_ntz, open double, high double, low double, close double, close_time timestamp_ntz")
    df = df.withColumns({c: F.lit(1.0) for c in ("volume", "quote_asset_volume", "taker_buy_base_volume", "taker_buy_quote_volume")})
    df = df.withColumn("num_trades", F.lit(2).cast("bigint"))
    got = {r.asset_pair_symbol: r for r in staging.hourly_from_stream(df).collect()}
    a = got["AUSDT"]
    assert (a.open, a.high, a.low, a.close, a.num_trades) == (1.0, 5.0, 0.5, 9.0, 6)
    assert (a.open_time, a.close_time, a.base_asset_symbol, a.quote_asset_symbol) == ("10:00:00", "10:00:00", "A", "USDT")
    assert (got["BTC"].base_asset_symbol, got["BTC"].quote_asset_symbol) == ("BTC", "UNKNOWN")


def test_roll_up_stays_in_hash_aggregation(spark, sf):
    from verification.base import candles_1m

    plan = staging.hourly_from_stream(candles_1m(spark, sf))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_streamed_row_wins(spark, sf):
    rows = [("A", "2024-01-01", "10:00:00", 1.0, "batch"), ("A", "2024-01-01", "10:00:00", 2.0, "streamed"), ("A", "2024-01-01", "11:00:00", 3.0, "batch")]
    df = spark.createDataFrame(rows, "p string, d string, t string, close double, src string")
    from candlewick.operators import dedup

    got = {r.t: r.close for r in dedup.prefer_source(df, ["p", "d", "t"], "src", "streamed").collect()}
    assert got == {"10:00:00": 2.0, "11:00:00": 3.0}


def test_returns_with_zero_and_null(spark):
    rows = [(1, 0.0, 1.0, 0.0, 1.0), (2, 2.0, 4.0, 1.0, 4.0), (3, None, 1.0, 1.0, 1.0), (4, 4.0, 4.0, 0.0, 0.0)]
    got = facts.returns_daily(daily(spark, rows)).orderBy("open_date").collect()
    assert [r.return_pct for r in got] == [None, 1.0, None, -1.0]
    assert got[0].log_return is None and got[3].log_return is None
    assert got[1].log_return == pytest.approx(math.log(2))


def test_cumulative_return(spark):
    rows = [(1, 1.0, 2.0, 1.0, 2.0), (2, 2.0, 3.0, 1.0, 1.0), (3, 1.0, 3.0, 1.0, 3.0)]
    got = facts.cumulative_return(facts.returns_daily(daily(spark, rows))).orderBy("open_date").collect()
    assert [r.cumulative_return for r in got] == pytest.approx([100.0, 0.0, 200.0])


def test_true_range_guards_null(spark):
    df = spark.createDataFrame([(5.0, 3.0, None), (5.0, 3.0, 9.0), (None, 3.0, 1.0), (5.0, None, 1.0), (5.0, 3.0, 4.0)], "h double, l double, p double")
    got = [r[0] for r in df.select(X.true_range("h", "l", "p")).collect()]
    assert got == [2.0, 6.0, None, None, 2.0]


def test_rolling_prefix_is_averaged(spark):
    rows = [(d, float(d), float(d), float(d), float(d)) for d in range(1, 6)]
    w = facts.series_window()
    got = daily(spark, rows).select("open_date", X.sma("close", 3, w).alias("m"), X.rolling_stddev("close", 3, w).alias("s")).orderBy("open_date").collect()
    assert [r.m for r in got] == [1.0, 1.5, 2.0, 3.0, 4.0]
    assert got[0].s is None and got[4].s == pytest.approx(1.0)


def test_one_row_series(spark):
    r = one(facts.enrich_daily(daily(spark, [(1, 1.0, 3.0, 1.0, 2.0)])))
    assert r.prev_close is None and r.rolling_vol_10 is None
    assert (r.tr, r.atr_14, r.volatility_label) == (2.0, 2.0, X.VOL_HIGH)


def test_crossover(spark):
    vals = [(1, 1.0, 2.0), (2, 3.0, 2.0), (3, 3.0, 2.0), (4, 1.0, 2.0), (5, 2.0, 2.0), (6, 3.0, 2.0)]
    df = spark.createDataFrame([("A", dt.date(2024, 1, d), s, l) for d, s, l in vals], "asset_pair_symbol string, open_date date, s double, l double")
    w = facts.series_window()
    got = df.select("open_date", X.crossover("s", "l", w).alias("c"), X.crossover_event("s", "l", w).alias("e")).orderBy("open_date").collect()
    assert [r.c for r in got] == [None, "golden_cross", None, "death_cross", None, "golden_cross"]
    assert [r.e for r in got][:2] == [X.NO_CROSS, X.GOLDEN]


def test_pressure_borders(spark):
    df = spark.createDataFrame([(0.55,), (0.40,), (0.4000001,), (0.5499,), (None,)], "r double")
    got = [r[0] for r in df.select(X.pressure_regime("r")).collect()]
    assert got == [X.REGIME_BUYERS, X.REGIME_PASSIVE, X.REGIME_BALANCED, X.REGIME_BALANCED, None]


def test_zero_volume_gives_null(spark):
    df = daily(spark, [(1, 1.0, 1.0, 1.0, 0.0)]).withColumns({"quote_asset_volume": F.lit(0.0), "base_asset_volume": F.lit(0.0), "num_trades": F.lit(0).cast("bigint")})
    r = one(facts.with_market_share(facts.pressure_columns(facts.liquidity_columns(df))))
    for c in ("range_pct", "avg_trade_size_usd", "sell_liquidity_usd", "normalized_liquidity", "liquidity_market_share",
              "instant_buy_ratio_base", "pressure_regime", "aggression_index"):
        assert r[c] is None, c


def test_shares_sum_to_one(spark, sf):
    from verification.base import daily as long_daily

    sums = facts.with_market_share(long_daily(spark, sf)).groupBy("open_date").agg(F.sum("liquidity_market_share").alias("s"))
    assert sums.filter(F.abs(F.col("s") - 1) > 1e-9).count() == 0


def test_candle_invariant(spark, sf):
    from verification.base import daily as long_daily

    bad = long_daily(spark, sf).filter("low > open or low > close or high < open or high < close")
    assert bad.count() == 0


def test_trade_size_buckets(spark):
    df = spark.createDataFrame([(99.99,), (100.0,), (1000.0,), (10000.0,), (100000.0,), (None,)], "v double")
    got = [r[0].split()[0] for r in df.select(X.trade_size("v")).collect()]
    assert got == ["Micro", "Small", "Medium", "Large", "Whale", "Whale"]


def test_pair_split(spark):
    df = spark.createDataFrame([("BTCUSDT",), ("USDTUSDT",), ("BTCEUR",)], "s string")
    got = [tuple(r) for r in df.select(S.pair_base("s"), S.pair_quote("s"), S.strip_quote("s"), S.quote_of("s")).collect()]
    assert got == [("BTC", "USDT", "BTC", "USDT"), ("", "USDTUSDT", "", "USDT"), ("", "BTCEUR", "BTCEUR", "UNKNOWN")]


def test_second_boundaries(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00.9' a, timestamp_ntz'2024-01-01 00:00:02.1' b")
    assert one(df.select(S.date_diff_units("second", "a", "b")))[0] == 2


def test_time_between_trades_ignores_dates(spark):
    rows = [(1, "AUSDT", "2024-01-01", "10:00:00", 20240101), (2, "AUSDT", "2024-01-02", "11:00:00", 20240102), (3, "AUSDT", "2024-01-03", "09:00:00", 20240103)]
    t = spark.createDataFrame(rows, "agg_trade_id bigint, pair_symbol string, transaction_date string, transaction_time string, date_fk int")
    t = t.withColumn("transaction_date", F.to_date("transaction_date"))
    r = one(marts.time_between_trades(t, dims.calendar(spark)))
    assert (r.trade_year, r.avg_time_between_trades_in_seconds) == (2024, 3600.0)


def test_large_trades_cross_pairs_of_one_asset(spark):
    rows = [("AUSDT", "fk", 1.0, 1.0, 20240101), ("AUSDT", "fk", 1.0, 1.0, 20240101), ("ABTC", "fk", 2.0, 10.0, 20240101)]
    t = spark.createDataFrame(rows, "pair_symbol string, base_asset_fk string, price double, quantity double, date_fk int")
    got = marts.large_trades(t, dims.calendar(spark)).collect()
    # 10 units against the mean of the asset's other pair
    assert [(r.pair_symbol, r.avg_quantity) for r in got] == [("ABTC", 1.0)]


def test_whale_neighbors_one_row_per_trade(spark):
    rows = [(1, "A", 5.0, 1.0, "2024-01-01", "10:00:00"), (2, "A", 6.0, 1.0, "2024-01-01", "11:00:00"), (3, "A", 7.0, 200.0, "2024-01-02", "10:00:00")]
    t = spark.createDataFrame(rows, "agg_trade_id bigint, pair_symbol string, price double, quantity double, transaction_date string, transaction_time string")
    t = t.withColumn("transaction_date", F.to_date("transaction_date"))
    got = marts.whale_neighbors(t).collect()
    assert len(got) == 1
    r = got[0]
    assert (r.previous_day_trades, r.previous_day_first_price, r.previous_day_last_price, r.next_day_trades) == (2, 5.0, 6.0, None)


def test_calendar(spark):
    cal = {str(r.full_date): r for r in dims.calendar(spark).collect()}
    assert len(cal) == 3287
    leap = cal["2024-02-29"]
    assert (leap.date_sk, leap.dayname, leap.daysuffix, leap.monthname, leap.dayofyear) == (20240229, "Thursday", "th", "February", 60)
    assert cal["2024-12-31"].quartername == "Fourth" and cal["2023-11-11"].daysuffix == "th" and cal["2023-11-21"].daysuffix == "st"


def test_time_dim(spark):
    t = {r.time_sk: r for r in dims.time_dim(spark).filter("time_sk in (0, 43200, 61200, 72000, 86399)").collect()}
    assert (t[0].time_of_day, t[0].time_desc_12, t[0].am_or_pm, t[0].time_division) == ("00:00:00", "12:00:00 AM", "AM", "Night")
    assert (t[43200].am_or_pm, t[43200].time_division, t[61200].time_division, t[72000].time_division) == ("PM", "Afternoon", "Evening", "Night")
    assert (t[86399].military_time, t[86399].second_of_hour, t[86399].minute_of_day) == ("2359", 3599, 1439)


def test_volatility_days_is_exact(spark):
    rows = [("A", f"2024-01-{d:02d}", float(p)) for d, p in [(1, 1), (1, 2), (3, 5), (8, 7), (9, 1)]]
    t = spark.createDataFrame(rows, "pair_symbol string, transaction_date string, price double").withColumn("transaction_date", F.to_date("transaction_date"))
    got = {str(r.transaction_date): (r.trades, r.volatility_7_days) for r in marts.volatility_days(t).collect()}
    import statistics

    assert got["2024-01-08"] == (2, pytest.approx(statistics.stdev([5, 7])))
    assert got["2024-01-09"] == (3, pytest.approx(statistics.stdev([5, 7, 1])))
    assert got["2024-01-01"][0] == 2


def test_api_trade_keys_differ_by_case(spark):
    df = spark.createDataFrame([('{"a":1,"p":"2.5","q":"3","f":4,"l":5,"T":6,"t":7,"P":8}',), ("{bad",)], "value string")
    got = files.normalize_api_trades(df, "value", F.lit("AUSDT")).collect()
    assert tuple(got[0]) == (1, "AUSDT", 2.5, 3.0, 4, 5, 6)
    assert got[1].agg_trade_id is None
