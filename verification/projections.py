"""Projections, filters and CASE rules."""

from pyspark.sql import functions as F

from candlewick.functions import expressions as X
from candlewick.functions import scalars as S
from candlewick.plans import dims, facts, marts, staging
from candlewick.sources import files
from candlewick.tables import quality
from verification.base import (
    DAY_KEYS, SIZE_SQL, assets_dim, calendar, candles_1m, candles_long, check, daily, hourly_fct, kline_messages, part_assets, r,
    raw_trades, rounded, rr, stg_trades, table, trades_fct, using,
)

_TRADE = "agg_trade_id, pair_symbol, price, quantity, first_trade_id, last_trade_id"


@check("proj_rename_trades", using("trades", f"SELECT {_TRADE}, transaction_date, transaction_time FROM trades"))
def proj_rename_trades(spark, sf):
    return stg_trades(spark, sf)


@check("proj_rename_assets", using("part_assets", """SELECT id AS asset_id, name AS asset_name, pair_symbol AS symbol, num_market_pairs,
    CAST(date_added AS DATE) AS asset_launch_date, max_supply, circulating_supply,
    CASE WHEN max_supply IS NULL THEN 'Unlimited' WHEN max_supply IS NOT NULL THEN 'Fixed' ELSE 'Unknown' END AS supply_type,
    cmc_rank AS market_cap_based_rank, last_updated AS cmc_last_updated, "timestamp" AS ingestion_timestamp,
    dbt_valid_from, dbt_valid_to FROM part_assets"""))
def proj_rename_assets(spark, sf):
    return staging.stg_assets(part_assets(spark, sf))


def api_trades(spark, sf):
    t = raw_trades(spark, sf)
    body = F.struct(
        F.col("agg_trade_id").alias("a"), F.col("price").cast("string").alias("p"), F.col("quantity").cast("string").alias("q"),
        F.col("first_trade_id").alias("f"), F.col("last_trade_id").alias("l"), F.col("transact_time").alias("T"),
        F.lit(0).alias("t"), F.lit(True).alias("m"),
    )
    return t.select("pair_symbol", F.to_json(body).alias("value"))


@check("proj_normalize_api_trades", using("trades", f"SELECT {_TRADE}, transact_time FROM trades"))
def proj_normalize_api_trades(spark, sf):
    return files.normalize_api_trades(api_trades(spark, sf), "value", F.col("pair_symbol"))


@check("proj_normalize_ohlcv", using("candles_1m", f"""SELECT asset_symbol, strftime(open_time, '%Y-%m-%d %H:%M:%S') AS open_time,
    open, high, low, close, CASE WHEN num_trades = 1 THEN volume END AS volume, strftime(close_time, '%Y-%m-%d %H:%M:%S') AS close_time,
    {rr('quote_asset_volume', 'taker_buy_base_volume', 'taker_buy_quote_volume')}, num_trades, "ignore" FROM candles_1m"""))
def proj_normalize_ohlcv(spark, sf):
    c = candles_1m(spark, sf)
    broken = c.withColumn("volume", F.when(F.col("num_trades") == 1, F.col("volume")).otherwise(F.lit(float("nan"))))
    out = files.normalize_ohlcv(broken, F.col("asset_symbol"))
    return rounded(out, "quote_asset_volume", "taker_buy_base_volume", "taker_buy_quote_volume")


def listing(spark, sf):
    """Nested listing records made from parts."""
    p = table(spark, sf, "part")
    stamp = lambda n: F.date_format(F.timestamp_add("DAY", n, F.lit("2020-01-01").cast("timestamp_ntz")), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    price = F.col("p_retailprice")
    fields = []
    for i, f in enumerate(files.QUOTE_FIELDS):
        fields.append((stamp(F.col("p_size") + 7) if f == "last_updated" else price + i).alias(f))
    quote = F.struct(F.struct(*fields).alias("USDT"))
    return p.select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_brand").alias("symbol"),
        F.lower("p_type").alias("slug"), F.col("p_size").cast("bigint").alias("num_market_pairs"),
        stamp(F.col("p_size")).alias("date_added"), F.when(F.col("p_size") % 3 != 0, price).alias("max_supply"),
        (price / 2).alias("circulating_supply"), price.alias("total_supply"), (F.col("p_size") % 3 == 0).alias("infinite_supply"),
        F.col("p_size").cast("bigint").alias("cmc_rank"), stamp(F.col("p_size") + 3).alias("last_updated"), quote.alias("quote"),
    )


_DAY = "strftime(TIMESTAMP '2020-01-01' + to_days(p_size{}), '%Y-%m-%d %H:%M:%S')"
_QUOTES = ", ".join(
    f"{_DAY.format(' + 7')} AS {n}" if f == "last_updated" else f"p_retailprice + {i} AS {n}"
    for i, (f, n) in enumerate(files.QUOTE_FIELDS.items())
)


@check("proj_normalize_assets", f"""SELECT p_partkey AS id, p_name AS name, p_brand AS pair_symbol, lower(p_type) AS slug,
    CAST(p_size AS BIGINT) AS num_market_pairs, {_DAY.format('')} AS date_added, CASE WHEN p_size % 3 <> 0 THEN p_retailprice END AS max_supply,
    p_retailprice / 2 AS circulating_supply, p_retailprice AS total_supply, p_size % 3 = 0 AS infinite_supply,
    CAST(p_size AS BIGINT) AS cmc_rank, {_DAY.format(' + 3')} AS last_updated, {_QUOTES}, '2024-05-01 10:00:00' AS "timestamp" FROM part""")
def proj_normalize_assets(spark, sf):
    return files.normalize_assets(listing(spark, sf), F.lit("2024-05-01 10:00:00").cast("timestamp_ntz"))


@check("proj_star_extend", using("daily", """SELECT asset_pair_symbol, open_date, open, high, low, close, num_trades,
    close - open AS return_abs, (close - open) / nullif(open, 0) AS return_pct FROM daily"""))
def proj_star_extend(spark, sf):
    df = daily(spark, sf).select(*DAY_KEYS, "open", "high", "low", "close", "num_trades")
    return facts.returns_daily(df).drop("log_return")


@check("proj_constant_tag", using("candles_long", "SELECT asset_pair_symbol, open_date, open_time, 'batch' AS record_source FROM candles_long"))
def proj_constant_tag(spark, sf):
    return candles_long(spark, sf).drop("record_source").select(*DAY_KEYS, "open_time", F.lit("batch").alias("record_source"))


# ---- filters ----------------------------------------------------------------

_KLINE = ("asset_symbol, open_time, open, high, low, close, close_time, num_trades, \"ignore\", kafka_offset, "
          + rr("volume", "quote_asset_volume", "taker_buy_base_volume", "taker_buy_quote_volume"))
KLINE_FLOOR = ["volume", "quote_asset_volume", "taker_buy_base_volume", "taker_buy_quote_volume"]


@check("filter_closed_candles", using("closed", f"SELECT {_KLINE} FROM closed"))
def filter_closed_candles(spark, sf):
    return rounded(staging.stg_klines(kline_messages(spark, sf)), *KLINE_FLOOR)


@check("filter_in_set", using("trades", f"SELECT {_TRADE} FROM trades WHERE pair_symbol IN ('VIEUSDT', 'CLIUSDT', 'ERRUSDT') AND pair_symbol NOT IN ('ERRUSDT', 'USDCUSDT')"))
def filter_in_set(spark, sf):
    t = raw_trades(spark, sf)
    listed, stable = ["VIEUSDT", "CLIUSDT", "ERRUSDT"], ["ERRUSDT", "USDCUSDT"]
    return t.filter(F.col("pair_symbol").isin(listed) & ~F.col("pair_symbol").isin(stable)).drop("transact_time")


@check("filter_date_bound", using("hourly_fct", """SELECT ohlcv_sk, base_asset_fk, open_date, open_time FROM hourly_fct
    WHERE open_date < DATE '1998-01-01' AND base_asset_fk IS NOT NULL"""))
def filter_date_bound(spark, sf):
    df = facts.fct_ohlcv_hourly(candles_long(spark, sf), assets_dim(spark, sf), calendar(spark), cutoff="1998-01-01")
    return df.select("ohlcv_sk", "base_asset_fk", "open_date", "open_time")


@check("filter_not_equal", using("trades", f"SELECT {_TRADE} FROM trades WHERE pair_symbol <> 'SIGUSDT'"))
def filter_not_equal(spark, sf):
    return raw_trades(spark, sf).filter(F.col("pair_symbol") != "SIGUSDT").drop("transact_time")


@check("filter_quantity_threshold", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem WHERE l_quantity > 40")
def filter_quantity_threshold(spark, sf):
    li = table(spark, sf, "lineitem").filter(F.col("l_quantity") > 40)
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


_PREV = "lag(CAST(epoch(CAST(transaction_time AS TIME)) AS INTEGER)) OVER (PARTITION BY pair_symbol ORDER BY transaction_date, transaction_time, agg_trade_id)"


@check("filter_lag_monotonic", using("trades", f"""SELECT * FROM (SELECT agg_trade_id, pair_symbol, transaction_date,
    {_PREV} AS previous_second, CAST(epoch(CAST(transaction_time AS TIME)) AS INTEGER) AS second FROM trades)
    WHERE previous_second IS NOT NULL AND previous_second <= second"""))
def filter_lag_monotonic(spark, sf):
    t = stg_trades(spark, sf).select("agg_trade_id", "pair_symbol", "transaction_date", "transaction_time")
    df = marts.with_previous_clock(t).filter(F.col("previous_second") <= F.col("_second"))
    return df.select("agg_trade_id", "pair_symbol", "transaction_date", "previous_second", F.col("_second").alias("second"))


@check("filter_like_suffix", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%ring'")
def filter_like_suffix(spark, sf):
    return table(spark, sf, "part").filter(F.col("p_name").like("%ring")).select("p_partkey", "p_name")


@check("filter_where_subquery", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 1000")
def filter_where_subquery(spark, sf):
    o = quality.tested(table(spark, sf, "orders"), "o_orderstatus = 'F' and o_totalprice > 1000")
    return o.select("o_orderkey", "o_custkey")


# ---- CASE rules -------------------------------------------------------------


@check("case_supply_type", using("part_assets", "SELECT id, CASE WHEN max_supply IS NULL THEN 'Unlimited' ELSE 'Fixed' END AS supply_type FROM part_assets"))
def case_supply_type(spark, sf):
    return part_assets(spark, sf).select("id", X.supply_type("max_supply").alias("supply_type"))


@check("case_trade_size", f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
    {SIZE_SQL.format("CASE WHEN l_linenumber = 7 THEN NULL ELSE l_extendedprice END")} AS trade_size_category FROM lineitem""")
def case_trade_size(spark, sf):
    v = F.when(F.col("l_linenumber") != 7, F.col("l_extendedprice"))
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", X.trade_size(v).alias("trade_size_category"))


@check("case_time_division", """SELECT event_id, CASE WHEN hour(ts) < 6 THEN 'Night' WHEN hour(ts) < 12 THEN 'Morning'
    WHEN hour(ts) < 17 THEN 'Afternoon' WHEN hour(ts) < 20 THEN 'Evening' ELSE 'Night' END AS time_division FROM events""")
def case_time_division(spark, sf):
    return table(spark, sf, "events").select("event_id", X.time_division(F.hour("ts")).alias("time_division"))


@check("case_weekend", "SELECT o_orderkey, CASE WHEN dayname(o_orderdate) IN ('Saturday', 'Sunday') THEN 1 ELSE 0 END AS is_weekend FROM orders")
def case_weekend(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", X.is_weekend(F.date_format("o_orderdate", "EEEE")).alias("is_weekend"))


@check("case_trend_direction", using("series", "SELECT asset_pair_symbol, open_date, trend_direction FROM series"))
def case_trend_direction(spark, sf):
    return facts.returns_daily(daily(spark, sf)).select(*DAY_KEYS, X.trend_direction("return_pct").alias("trend_direction"))


@check("case_pressure_regime", using("regimes", f"SELECT asset_pair_symbol, open_date, {r('instant_buy_ratio_base', 'ratio')}, pressure_regime FROM regimes"))
def case_pressure_regime(spark, sf):
    ratio = X.safe_divide("taker_buy_base_volume", "base_asset_volume")
    return rounded(daily(spark, sf).select(*DAY_KEYS, ratio.alias("ratio"), X.pressure_regime(ratio).alias("pressure_regime")), "ratio")
