"""Registration of queries, the stand-in tables in Spark, and the same tables as SQL."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.operators.aggregates import joined_key, order_key
from candlewick.plans import dims, facts, staging
from candlewick.session import stage

QUERIES: dict = {}
ORACLES: dict = {}
CAL_START, CAL_END = "1992-01-01", "2027-12-31"


def check(name: str, sql: str | None = None):
    def add(fn):
        @wraps(fn)
        def run(spark, sf):
            spark.conf.set("spark.sql.session.timeZone", "UTC")  # the SQL side has no other zone
            return fn(spark, sf)

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return fn

    return add


# ---- comparable numbers -----------------------------------------------------


def rounded(df: DataFrame, *cols: str, places: int = 6) -> DataFrame:
    """Float results are compared on a fixed grid; both engines print raw doubles apart."""
    k = 10.0**places
    return df.withColumns({c: F.floor(F.col(c) * k + 0.501) / k for c in cols})


def r(expr: str, name: str | None = None, places: int = 6) -> str:
    k = f"1e{places}"
    return f"floor(({expr})*{k}+0.501)/{k}" + (f" AS {name}" if name else "")


def rr(*names: str, places: int = 6) -> str:
    return ", ".join(r(n, n.split(".")[-1], places) for n in names)


def significant(df: DataFrame, *cols: str) -> DataFrame:
    """Values that leave any fixed grid, as seven significant digits and their scale."""
    for c in cols:
        x = F.col(c)
        scale = F.when(x != 0, F.floor(F.log10(F.abs(x))) - 6)
        digits = F.when(x == 0, F.lit(0.0)).otherwise(F.floor(x / F.pow(F.lit(10.0), scale) + 0.501).cast("double"))
        df = df.withColumns({f"{c}_scale": scale.cast("int"), f"{c}_digits": digits}).drop(c)
    return df


def sig(expr: str, name: str) -> str:
    scale = f"CASE WHEN ({expr}) <> 0 THEN floor(log10(abs({expr}))) - 6 END"
    return f"""CAST({scale} AS INTEGER) AS {name}_scale, CASE WHEN ({expr}) = 0 THEN 0.0::DOUBLE
        WHEN ({expr}) <> 0 THEN floor(({expr}) / pow(10.0::DOUBLE, floor(log10(abs({expr}))) - 6) + 0.501) END AS {name}_digits"""


# ---- stand-in tables in Spark -----------------------------------------------


def table(spark, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def raw_trades(spark, sf) -> DataFrame:
    e = table(spark, sf, "events")
    return e.select(
        F.col("event_id").alias("agg_trade_id"),
        F.concat(F.upper(F.left("event_type", F.lit(3))), F.lit("USDT")).alias("pair_symbol"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("double").alias("quantity"),
        (F.col("event_id") * 5).alias("first_trade_id"),
        (F.col("event_id") * 5 + F.col("event_id") % 5).alias("last_trade_id"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("transact_time"),
    )


def stg_trades(spark, sf) -> DataFrame:
    return staging.stg_agg_trades(raw_trades(spark, sf))


def candles_1m(spark, sf) -> DataFrame:
    """Minute candles of the trades in the shape of the streamed table."""
    e = table(spark, sf, "events")
    df = e.select(
        F.col("event_id"),
        F.concat(F.upper(F.left("event_type", F.lit(3))), F.lit("USDT")).alias("asset_symbol"),
        F.date_trunc("minute", "ts").alias("open_time"),
        F.col("value").alias("p"),
        F.get_json_object("props", "$.k").cast("double").alias("q"),
        order_key(F.unix_micros(F.col("ts").cast("timestamp")), F.col("event_id")).alias("o"),
    )
    even = F.col("event_id") % 2 == 0
    out = df.groupBy("asset_symbol", "open_time").agg(
        F.min_by("p", "o").alias("open"),
        F.max("p").alias("high"),
        F.min("p").alias("low"),
        F.max_by("p", "o").alias("close"),
        F.sum("q").alias("volume"),
        F.sum(F.col("p") * F.col("q")).alias("quote_asset_volume"),
        F.count("*").alias("num_trades"),
        F.coalesce(F.sum(F.when(even, F.col("q"))), F.lit(0.0)).alias("taker_buy_base_volume"),
        F.coalesce(F.sum(F.when(even, F.col("p") * F.col("q"))), F.lit(0.0)).alias("taker_buy_quote_volume"),
        F.max("event_id").alias("kafka_offset"),
    )
    return out.select(
        "asset_symbol", F.col("open_time").cast("timestamp_ntz").alias("open_time"), "open", "high", "low", "close",
        "volume", (F.col("open_time") + F.expr("interval 59 seconds")).cast("timestamp_ntz").alias("close_time"),
        "quote_asset_volume", "num_trades", "taker_buy_base_volume", "taker_buy_quote_volume",
        F.lit("0").alias("ignore"), "kafka_offset",
    )


def candles_long(spark, sf) -> DataFrame:
    """Hourly candles of line items, in the unified shape: a long daily history per pair."""
    # a dyadic share keeps the summed taker volumes exact, so regime borders do not depend on sum order
    share = (20 + 3 * (F.col("l_discount") * 100 + 0.5).cast("int")) / 64
    df = table(spark, sf, "lineitem").select(
        "l_returnflag", "l_linestatus", "l_linenumber",
        F.to_date("l_shipdate").alias("open_date"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("p"),
        F.col("l_quantity").alias("q"),
        F.col("l_extendedprice").alias("v"),
        (F.col("l_quantity") * share).alias("tb"),
        (F.col("l_extendedprice") * share).alias("tq"),
        # order, part, supplier and quantity side by side in one decimal: 13 + 12 + 11 + 2 digits
        joined_key([("l_orderkey", 13), ("l_partkey", 12), ("l_suppkey", 11), ("l_quantity", 2)]).alias("o"),
    )
    h = df.groupBy("l_returnflag", "l_linestatus", "open_date", "l_linenumber").agg(
        F.min_by("p", "o").alias("open"),
        F.max("p").alias("high"),
        F.min("p").alias("low"),
        F.max_by("p", "o").alias("close"),
        F.sum("q").alias("base_asset_volume"),
        F.sum("v").alias("quote_asset_volume"),
        F.count("*").alias("num_trades"),
        F.sum("tb").alias("taker_buy_base_volume"),
        F.sum("tq").alias("taker_buy_quote_volume"),
    )
    hour = F.concat(F.lpad(F.col("l_linenumber").cast("string"), 2, "0"), F.lit(":00:00"))
    base = F.concat("l_returnflag", "l_linestatus")
    return h.select(
        F.concat(base, F.lit("USDT")).alias("asset_pair_symbol"), base.alias("base_asset_symbol"),
        F.right(F.concat(base, F.lit("USDT")), F.lit(4)).alias("quote_asset_symbol"), "open_date",
        hour.alias("open_time"), F.col("open_date").alias("close_date"), hour.alias("close_time"),
        "open", "high", "low", "close", "base_asset_volume", "quote_asset_volume", "num_trades",
        "taker_buy_base_volume", "taker_buy_quote_volume", F.lit("batch").alias("record_source"),
    )


def part_assets(spark, sf) -> DataFrame:
    """Parts in the shape of the asset history, all open."""
    p = table(spark, sf, "part")
    day = lambda n: F.timestamp_add("DAY", n, F.lit("2020-01-01").cast("timestamp_ntz"))
    return p.select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("pair_symbol"),
        F.col("p_size").cast("bigint").alias("num_market_pairs"),
        day(F.col("p_size")).alias("date_added"),
        F.when(F.col("p_size") % 3 != 0, F.col("p_retailprice")).alias("max_supply"),
        (F.col("p_retailprice") / 2).alias("circulating_supply"),
        F.col("p_size").cast("bigint").alias("cmc_rank"),
        day(F.col("p_size") + 100).alias("last_updated"),
        day(F.lit(1000)).alias("timestamp"),
        day(F.lit(0)).alias("dbt_valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("dbt_valid_to"),
    )


def kline_messages(spark, sf, corrections: bool = True, with_kind: bool = False) -> DataFrame:
    """Raw messages of the minute candles.

    Each candle has an open update and a closed message; some have a later correction, and some
    are followed by malformed text, a message without a candle or an update with a bad number. The topic has two
    partitions; offsets count within each, so the same offset occurs in both.
    """
    c = candles_1m(spark, sf)
    ms = lambda t: F.unix_millis(F.col(t).cast("timestamp"))
    text = lambda x: x.cast("string")

    def message(closed: bool, close, open_=None):
        k = F.struct(
            ms("open_time").alias("t"), ms("close_time").alias("T"), F.col("asset_symbol").alias("s"), F.lit("1m").alias("i"),
            text(open_ if open_ is not None else F.col("open")).alias("o"), text(close).alias("c"), text(F.col("high")).alias("h"), text(F.col("low")).alias("l"),
            text(F.col("volume")).alias("v"), F.col("num_trades").alias("n"), F.lit(closed).alias("x"),
            text(F.col("quote_asset_volume")).alias("q"), text(F.col("taker_buy_base_volume")).alias("V"),
            text(F.col("taker_buy_quote_volume")).alias("Q"), F.col("ignore").alias("B"),
        )
        data = F.struct(F.lit("kline").alias("e"), ms("close_time").alias("E"), F.col("asset_symbol").alias("s"), k.alias("k"))
        return F.to_json(F.struct(F.concat(F.lower("asset_symbol"), F.lit("@kline_1m")).alias("stream"), data.alias("data")))

    o = F.col("kafka_offset")
    kinds = ["update", "closed", "correction", "noise"]
    second = (F.col("asset_symbol") >= "M").cast("int")
    item = lambda value, n: F.struct(
        value.alias("value"), (o * 4 + n - second * 4).alias("offset"), second.alias("partition"),
        F.timestamp_add("SECOND", F.lit(n), F.col("close_time").cast("timestamp")).alias("timestamp"), F.lit(kinds[n]).alias("kind"))
    out = [item(message(True, F.col("close")), 1)]
    if corrections:
        extra = (
            F.when(o % 10 == 0, item(message(True, F.col("close") + 1), 2))
            .when(o % 10 == 1, item(F.lit("{bad"), 3))
            .when(o % 10 == 2, item(F.lit('{"stream":"x","data":{"e":"ping"}}'), 3))
            .when(o % 10 == 3, item(message(False, F.col("close"), F.lit("abc")), 3))
        )
        out = [item(message(False, F.col("open")), 0), *out, extra]
    return c.select(F.explode(F.filter(F.array(*out), lambda x: x.isNotNull())).alias("m")).select(
        "m.value", "m.offset", "m.partition", "m.timestamp", *(["m.kind"] if with_kind else []))


DAY_KEYS = ["asset_pair_symbol", "open_date"]


def daily(spark, sf) -> DataFrame:
    return facts.candles_daily(candles_long(spark, sf), DAY_KEYS)


def daily_series(spark, sf) -> DataFrame:
    return facts.enrich_daily(daily(spark, sf))


# ---- assets -----------------------------------------------------------------

VERSION_CUT = "2024-01-16 00:00:00"
_ASSETS: dict = {}


def scd_assets(spark, sf) -> DataFrame:
    """Asset versions of the symbols that occur in the trades and line items, one symbol left out and one written
    in lower case. Every other asset has a second version."""
    key = (spark.sparkContext.applicationId, sf)
    if key in _ASSETS:
        return _ASSETS[key]
    pairs = raw_trades(spark, sf).select("pair_symbol").distinct()
    lines = table(spark, sf, "lineitem").select(F.concat("l_returnflag", "l_linestatus").alias("s")).distinct().filter("s <> 'RO'")
    symbols = pairs.select(F.replace("pair_symbol", F.lit("USDT"), F.lit("")).alias("s")).unionAll(
        pairs.select(F.right("pair_symbol", F.lit(4)).alias("s"))).unionAll(lines.selectExpr("if(s = 'AF', 'af', s) AS s")).distinct()
    i, v = F.col("i"), F.col("v")
    numbered = symbols.withColumn("i", F.row_number().over(Window.orderBy(F.upper("s"))).cast("bigint") - 1)  # a dozen rows
    rows = numbered.withColumn("v", F.explode(F.expr("IF(i % 2 = 0, array(0L, 1L), array(0L))")))
    at = lambda t: F.lit(t).cast("timestamp_ntz")
    out = rows.select(
        (i + 1).alias("id"), F.concat(F.lit("Asset "), "s").alias("name"), F.col("s").alias("pair_symbol"),
        (i + 100).alias("num_market_pairs"), at("2015-07-30 12:00:00").alias("date_added"),
        F.when(i % 3 != 0, i * F.lit(1000.0)).alias("max_supply"), (i * F.lit(500.0)).alias("circulating_supply"),
        (i + 1 + v).alias("cmc_rank"), at("2024-01-20 00:00:00").alias("last_updated"), at("2024-01-21 00:00:00").alias("timestamp"),
        F.when(v == 0, at("2019-01-01 00:00:00")).otherwise(at(VERSION_CUT)).alias("dbt_valid_from"),
        F.when((v == 0) & (i % 2 == 0), at(VERSION_CUT)).alias("dbt_valid_to"),
    )
    _ASSETS[key] = stage(out, "assets")  # read by most queries
    return _ASSETS[key]


def assets_dim(spark, sf) -> DataFrame:
    return dims.assets_dim(staging.stg_assets(scd_assets(spark, sf)))


def calendar(spark) -> DataFrame:
    return dims.calendar(spark, CAL_START, CAL_END)


def trades_fct(spark, sf, versions: str = "as_of") -> DataFrame:
    return facts.fct_trades(stg_trades(spark, sf), assets_dim(spark, sf), calendar(spark), versions=versions)


def hourly_fct(spark, sf) -> DataFrame:
    return facts.fct_ohlcv_hourly(candles_long(spark, sf), assets_dim(spark, sf), calendar(spark))


# ---- the same tables as SQL -------------------------------------------------


_ASSETS_SQL = f"""SELECT i + 1 AS id, 'Asset ' || s AS name, s AS pair_symbol, i + 100 AS num_market_pairs, TIMESTAMP '2015-07-30 12:00:00' AS date_added,
    CASE WHEN i % 3 <> 0 THEN i * 1000.0::DOUBLE END AS max_supply, i * 500.0::DOUBLE AS circulating_supply, i + 1 + v AS cmc_rank,
    TIMESTAMP '2024-01-20 00:00:00' AS last_updated, TIMESTAMP '2024-01-21 00:00:00' AS "timestamp",
    CASE WHEN v = 0 THEN TIMESTAMP '2019-01-01 00:00:00' ELSE TIMESTAMP '{VERSION_CUT}' END AS dbt_valid_from,
    CASE WHEN v = 0 AND i % 2 = 0 THEN TIMESTAMP '{VERSION_CUT}' END AS dbt_valid_to
    FROM (SELECT s, row_number() OVER (ORDER BY upper(s)) - 1 AS i FROM (SELECT DISTINCT upper(left(event_type, 3)) AS s FROM events
    UNION SELECT DISTINCT right(upper(left(event_type, 3)) || 'USDT', 4) FROM events
    UNION SELECT DISTINCT CASE l_returnflag || l_linestatus WHEN 'AF' THEN 'af' ELSE l_returnflag || l_linestatus END FROM lineitem
    WHERE l_returnflag || l_linestatus <> 'RO')), (VALUES (0), (1)) t(v) WHERE v = 0 OR i % 2 = 0"""


def key_sql(*cols: str) -> str:
    return "md5(concat_ws('-', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '_null_')" for c in cols) + "))"


_ORD = "l_orderkey, l_partkey, l_suppkey, l_quantity"
_W = "PARTITION BY asset_pair_symbol ORDER BY open_date"
_STAR = "asset_pair_symbol, open_date"
SIZE_SQL = (
    "CASE WHEN {0} < 100 THEN 'Micro (<$100)' WHEN {0} < 1000 THEN 'Small ($100-1K)' "
    "WHEN {0} < 10000 THEN 'Medium ($1K-10K)' WHEN {0} < 100000 THEN 'Large ($10K-100K)' ELSE 'Whale (>$100K)' END"
)

CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "trades": ((), """SELECT event_id AS agg_trade_id, upper(left(event_type, 3)) || 'USDT' AS pair_symbol,
        value AS price, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS quantity,
        event_id * 5 AS first_trade_id, event_id * 5 + event_id % 5 AS last_trade_id,
        epoch_us(ts) // 1000 AS transact_time, CAST(ts AS DATE) AS transaction_date,
        strftime(ts, '%H:%M:%S') AS transaction_time, ts FROM events"""),
    "candles_1m": (("trades",), """SELECT pair_symbol AS asset_symbol, date_trunc('minute', ts) AS open_time,
        first(price ORDER BY ts, agg_trade_id) AS open, max(price) AS high, min(price) AS low,
        last(price ORDER BY ts, agg_trade_id) AS close, sum(quantity) AS volume,
        date_trunc('minute', ts) + INTERVAL 59 SECOND AS close_time,
        sum(price * quantity) AS quote_asset_volume, count(*) AS num_trades,
        coalesce(sum(quantity) FILTER (agg_trade_id % 2 = 0), 0) AS taker_buy_base_volume,
        coalesce(sum(price * quantity) FILTER (agg_trade_id % 2 = 0), 0) AS taker_buy_quote_volume,
        '0' AS "ignore", max(agg_trade_id) AS kafka_offset
        FROM trades GROUP BY pair_symbol, date_trunc('minute', ts)"""),
    "hourly_stream": (("candles_1m",), """SELECT asset_symbol AS asset_pair_symbol,
        replace(asset_symbol, 'USDT', '') AS base_asset_symbol, 'USDT' AS quote_asset_symbol,
        CAST(date_trunc('hour', open_time) AS DATE) AS open_date, strftime(date_trunc('hour', open_time), '%H:%M:%S') AS open_time,
        CAST(date_trunc('hour', open_time) AS DATE) AS close_date, strftime(date_trunc('hour', open_time), '%H:%M:%S') AS close_time,
        first(open ORDER BY c.open_time) AS open, max(high) AS high, min(low) AS low, last(close ORDER BY c.close_time) AS close,
        sum(volume) AS base_asset_volume, sum(quote_asset_volume) AS quote_asset_volume,
        CAST(sum(num_trades) AS BIGINT) AS num_trades, sum(taker_buy_base_volume) AS taker_buy_base_volume,
        sum(taker_buy_quote_volume) AS taker_buy_quote_volume, 'streamed' AS record_source
        FROM candles_1m c GROUP BY asset_symbol, date_trunc('hour', c.open_time)"""),
    "candles_long": ((), f"""SELECT l_returnflag || l_linestatus || 'USDT' AS asset_pair_symbol,
        l_returnflag || l_linestatus AS base_asset_symbol, 'USDT' AS quote_asset_symbol,
        CAST(l_shipdate AS DATE) AS open_date, lpad(CAST(l_linenumber AS VARCHAR), 2, '0') || ':00:00' AS open_time,
        CAST(l_shipdate AS DATE) AS close_date, lpad(CAST(l_linenumber AS VARCHAR), 2, '0') || ':00:00' AS close_time,
        first(l_extendedprice / l_quantity ORDER BY {_ORD}) AS open, max(l_extendedprice / l_quantity) AS high,
        min(l_extendedprice / l_quantity) AS low, last(l_extendedprice / l_quantity ORDER BY {_ORD}) AS close,
        sum(l_quantity) AS base_asset_volume, sum(l_extendedprice) AS quote_asset_volume, count(*) AS num_trades,
        sum(l_quantity * (20 + 3 * floor(l_discount * 100 + 0.5)) / 64) AS taker_buy_base_volume,
        sum(l_extendedprice * (20 + 3 * floor(l_discount * 100 + 0.5)) / 64) AS taker_buy_quote_volume, 'batch' AS record_source
        FROM lineitem GROUP BY l_returnflag, l_linestatus, CAST(l_shipdate AS DATE), l_linenumber"""),
    "daily": (("candles_long",), """SELECT asset_pair_symbol, open_date,
        first(open ORDER BY open_time) AS open, max(high) AS high, min(low) AS low,
        last(close ORDER BY open_time) AS close, sum(base_asset_volume) AS base_asset_volume,
        sum(quote_asset_volume) AS quote_asset_volume, CAST(sum(num_trades) AS BIGINT) AS num_trades,
        sum(taker_buy_base_volume) AS taker_buy_base_volume, sum(taker_buy_quote_volume) AS taker_buy_quote_volume
        FROM candles_long GROUP BY asset_pair_symbol, open_date"""),
    "lagged": (("daily",), f"""SELECT *, lag(close) OVER ({_W}) AS prev_close, close - open AS return_abs,
        CASE WHEN open = 0 THEN NULL ELSE (close - open) / open END AS return_pct,
        CASE WHEN open > 0 AND close > 0 THEN ln(close) - ln(open) END AS log_return FROM daily"""),
    "ranged": (("lagged",), f"""SELECT *, high - low AS candle_range,
        greatest(high - low, abs(high - coalesce(prev_close, high)), abs(low - coalesce(prev_close, low))) AS tr,
        sum(log_return) OVER ({_W} ROWS UNBOUNDED PRECEDING) AS cumulative_log_return,
        stddev_samp(log_return) OVER ({_W} ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS rolling_vol_10 FROM lagged"""),
    "atr": (("ranged",), f"""SELECT *, avg(tr) OVER ({_W} ROWS BETWEEN 13 PRECEDING AND CURRENT ROW) AS atr_14 FROM ranged"""),
    "thirds": (("atr",), """SELECT asset_pair_symbol, quantile_cont(atr_14, 0.33) AS low_third,
        quantile_cont(atr_14, 0.66) AS high_third FROM atr GROUP BY asset_pair_symbol"""),
    "series": (("atr", "thirds"), """SELECT a.*, CASE WHEN return_pct > 0 THEN 'UP/bullish' WHEN return_pct < 0 THEN 'DOWN/bearish'
        ELSE 'SIDEWAYS/flat' END AS trend_direction,
        CASE WHEN atr_14 IS NULL THEN NULL WHEN atr_14 < low_third THEN 'Low volatility'
        WHEN atr_14 < high_third THEN 'Normal volatility' ELSE 'High volatility' END AS volatility_label
        FROM atr a JOIN thirds USING (asset_pair_symbol)"""),
    "averages": (("series",), f"""SELECT *, avg(close) OVER ({_W} ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS price_avg_50,
        avg(close) OVER ({_W} ROWS BETWEEN 199 PRECEDING AND CURRENT ROW) AS price_avg_200 FROM series"""),
    "crossed": (("averages",), f"""SELECT *, CASE
        WHEN price_avg_50 > price_avg_200 AND lag(price_avg_50) OVER ({_W}) <= lag(price_avg_200) OVER ({_W})
            THEN 'GOLDEN CROSS - BIG BULL SIGNAL'
        WHEN price_avg_50 < price_avg_200 AND lag(price_avg_50) OVER ({_W}) >= lag(price_avg_200) OVER ({_W})
            THEN 'DEATH CROSS - BIG BEAR SIGNAL' ELSE 'NO BIG CROSS TODAY' END AS ma_crossover_event FROM averages"""),
    "liquid": (("crossed",), f"""SELECT *, CASE WHEN close = 0 THEN NULL ELSE (high - low) / close END AS range_pct,
        CASE WHEN num_trades = 0 THEN NULL ELSE quote_asset_volume / num_trades END AS avg_trade_size_usd,
        quote_asset_volume AS liquidity_usd, taker_buy_quote_volume AS buy_liquidity_usd,
        CASE WHEN quote_asset_volume = 0 THEN NULL ELSE quote_asset_volume - taker_buy_quote_volume END AS sell_liquidity_usd,
        avg(quote_asset_volume) OVER ({_W} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS rolling_volume_20,
        avg(num_trades) OVER ({_W} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS rolling_trades_20,
        quote_asset_volume / nullif(sum(quote_asset_volume) OVER (PARTITION BY open_date), 0) AS liquidity_market_share
        FROM crossed"""),
    "pressed": (("liquid",), """SELECT *, quote_asset_volume / nullif(rolling_volume_20, 0) AS normalized_liquidity,
        taker_buy_quote_volume / nullif(quote_asset_volume, 0) AS instant_buy_ratio_quote,
        taker_buy_base_volume / nullif(base_asset_volume, 0) AS instant_buy_ratio_base,
        quote_asset_volume - taker_buy_quote_volume AS passive_quote_volume,
        base_asset_volume - taker_buy_base_volume AS passive_base_volume,
        (quote_asset_volume - taker_buy_quote_volume) / nullif(quote_asset_volume, 0) AS passive_ratio_quote,
        (base_asset_volume - taker_buy_base_volume) / nullif(base_asset_volume, 0) AS passive_ratio_base,
        abs(taker_buy_base_volume / nullif(base_asset_volume, 0) - 0.5) * 2 AS aggression_index FROM liquid"""),
    "regimes": (("pressed",), """SELECT *, CASE WHEN instant_buy_ratio_base IS NULL THEN NULL
        WHEN instant_buy_ratio_base >= 0.55 THEN 'Buyers Dominant'
        WHEN instant_buy_ratio_base <= 0.40 THEN 'Passive/Neutral Trades' ELSE 'Balanced' END AS pressure_regime FROM pressed"""),
    "topic": (("candles_1m",), """SELECT *, CASE WHEN asset_symbol >= 'M' THEN 1 ELSE 0 END AS kafka_partition FROM candles_1m"""),
    "closed": (("topic",), """SELECT asset_symbol, open_time, open, high, low, close, volume, close_time, quote_asset_volume,
        num_trades, taker_buy_base_volume, taker_buy_quote_volume, "ignore", kafka_offset * 4 + 1 - kafka_partition * 4 AS kafka_offset,
        kafka_partition, close_time + INTERVAL 1 SECOND AS arrived FROM topic
        UNION ALL SELECT asset_symbol, open_time, open, high, low, close + 1, volume, close_time, quote_asset_volume,
        num_trades, taker_buy_base_volume, taker_buy_quote_volume, "ignore", kafka_offset * 4 + 2 - kafka_partition * 4,
        kafka_partition, close_time + INTERVAL 2 SECOND FROM topic
        WHERE kafka_offset % 10 = 0"""),
    "latest": (("closed",), """SELECT * FROM closed QUALIFY row_number() OVER (PARTITION BY asset_symbol, open_time
        ORDER BY arrived DESC, kafka_partition DESC, kafka_offset DESC) = 1"""),
    "part_assets": ((), """SELECT p_partkey AS id, p_name AS name, p_brand AS pair_symbol, CAST(p_size AS BIGINT) AS num_market_pairs,
        TIMESTAMP '2020-01-01' + to_days(p_size) AS date_added, CASE WHEN p_size % 3 <> 0 THEN p_retailprice END AS max_supply,
        p_retailprice / 2 AS circulating_supply, CAST(p_size AS BIGINT) AS cmc_rank,
        TIMESTAMP '2020-01-01' + to_days(p_size + 100) AS last_updated, TIMESTAMP '2020-01-01' + to_days(1000) AS "timestamp",
        TIMESTAMP '2020-01-01' AS dbt_valid_from, CAST(NULL AS TIMESTAMP) AS dbt_valid_to FROM part"""),
    "raw_assets": ((), _ASSETS_SQL),
    "stg_assets": (("raw_assets",), """SELECT id AS asset_id, name AS asset_name, pair_symbol AS symbol, num_market_pairs,
        CAST(date_added AS DATE) AS asset_launch_date, max_supply, circulating_supply,
        CASE WHEN max_supply IS NULL THEN 'Unlimited' ELSE 'Fixed' END AS supply_type,
        cmc_rank AS market_cap_based_rank, last_updated AS cmc_last_updated, "timestamp" AS ingestion_timestamp,
        dbt_valid_from, dbt_valid_to FROM raw_assets"""),
    "assets_dim": (("stg_assets",), f"""SELECT {key_sql('asset_id', 'dbt_valid_from')} AS asset_sk, * EXCLUDE (dbt_valid_from, dbt_valid_to),
        dbt_valid_from AS rank_valid_from, dbt_valid_to AS rank_valid_to FROM stg_assets"""),
    "date_dim": ((), f"""SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_sk, d AS full_date,
        CAST(day(d) AS INTEGER) AS "day", CAST(month(d) AS INTEGER) AS "month", monthname(d) AS monthname,
        CAST(year(d) AS INTEGER) AS "year",
        CASE WHEN day(d) IN (11, 12, 13) THEN 'th' WHEN day(d) % 10 = 1 THEN 'st' WHEN day(d) % 10 = 2 THEN 'nd'
        WHEN day(d) % 10 = 3 THEN 'rd' ELSE 'th' END AS daysuffix, dayname(d) AS dayname,
        CAST((day(d) + 6) // 7 AS INTEGER) AS weekday_of_month, CAST(dayofyear(d) AS INTEGER) AS dayofyear,
        CAST(weekofyear(d) AS INTEGER) AS weekofyear,
        CAST((day(d) + isodow(date_trunc('month', d)) - 1 + 6) // 7 AS INTEGER) AS weekofmonth,
        CAST(quarter(d) AS INTEGER) AS quarter,
        CASE quarter(d) WHEN 1 THEN 'First' WHEN 2 THEN 'Second' WHEN 3 THEN 'Third' ELSE 'Fourth' END AS quartername,
        '{CAL_START}' AS dimension_start_date, '{CAL_END}' AS dimension_end_date
        FROM (SELECT CAST(unnest(generate_series(TIMESTAMP '{CAL_START}', TIMESTAMP '{CAL_END}', INTERVAL 1 DAY)) AS DATE) AS d)"""),
    "time_dim": ((), """SELECT s AS time_sk, strftime(t, '%H:%M:%S') AS time_of_day, strftime(t, '%I:%M:%S %p') AS time_desc_12,
        strftime(t, '%H:%M:%S') AS time_desc_24, CASE WHEN hour(t) < 12 THEN 'AM' ELSE 'PM' END AS am_or_pm,
        CASE WHEN hour(t) < 6 THEN 'Night' WHEN hour(t) < 12 THEN 'Morning' WHEN hour(t) < 17 THEN 'Afternoon'
        WHEN hour(t) < 20 THEN 'Evening' ELSE 'Night' END AS time_division, strftime(t, '%H%M') AS military_time,
        CAST(hour(t) AS INTEGER) AS hour_of_day, CAST(hour(t) * 60 + minute(t) AS INTEGER) AS minute_of_day,
        CAST(minute(t) AS INTEGER) AS minute_of_hour, s AS second_of_day,
        CAST(minute(t) * 60 + second(t) AS INTEGER) AS second_of_hour, CAST(second(t) AS INTEGER) AS second_of_minute
        FROM (SELECT CAST(range AS INTEGER) AS s, TIMESTAMP '1970-01-01' + to_seconds(range) AS t FROM range(86400))"""),
    "trades_fct": (("trades", "assets_dim", "date_dim", "time_dim"), f"""SELECT {key_sql('agg_trade_id', 'pair_symbol', 'price')} AS trades_sk,
        agg_trade_id, pair_symbol, b.asset_sk AS base_asset_fk, q.asset_sk AS quote_asset_fk, price, quantity,
        first_trade_id, last_trade_id, transaction_date, transaction_time, d.date_sk AS date_fk, ti.time_sk AS time_fk
        FROM trades t
        LEFT JOIN assets_dim b ON b.symbol = left(pair_symbol, position('USDT' IN pair_symbol) - 1)
            AND date_trunc('second', ts) >= b.rank_valid_from AND (b.rank_valid_to IS NULL OR date_trunc('second', ts) < b.rank_valid_to)
        LEFT JOIN assets_dim q ON q.symbol = 'USDT'
            AND date_trunc('second', ts) >= q.rank_valid_from AND (q.rank_valid_to IS NULL OR date_trunc('second', ts) < q.rank_valid_to)
        LEFT JOIN date_dim d ON d.full_date = transaction_date LEFT JOIN time_dim ti ON ti.time_of_day = transaction_time"""),
    "hourly_fct": (("candles_long", "assets_dim", "date_dim", "time_dim"), f"""SELECT
        {key_sql('b.asset_sk', 'open_date', 'open_time')} AS ohlcv_sk, d.date_sk AS open_date_fk, ti.time_sk AS open_time_fk,
        b.asset_sk AS base_asset_fk, q.asset_sk AS quote_asset_fk, c.* EXCLUDE (record_source)
        FROM candles_long c LEFT JOIN assets_dim b ON upper(b.symbol) = upper(base_asset_symbol) AND b.rank_valid_to IS NULL
        LEFT JOIN assets_dim q ON upper(q.symbol) = upper(quote_asset_symbol) AND q.rank_valid_to IS NULL
        LEFT JOIN date_dim d ON d.full_date = open_date LEFT JOIN time_dim ti ON ti.time_of_day = open_time
        WHERE b.asset_sk IS NOT NULL AND open_date < DATE '2025-01-01'"""),
}


def using(names: str, body: str) -> str:
    """A statement over named stand-in tables."""
    done: list[str] = []

    def visit(n):
        for dep in CTES[n][0]:
            visit(dep)
        if n not in done:
            done.append(n)

    for n in names.replace(",", " ").split():
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][1]})" for n in done) + "\n" + body
