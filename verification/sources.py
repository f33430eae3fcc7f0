"""Sources and sinks. Files are first written from the given tables, then read by the operator."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.functions import scalars as S
from candlewick.session import scratch_path
from candlewick.sources import files
from candlewick.sources import generators as G
from candlewick.sources.refs import Refs
from candlewick.tables import incremental
from candlewick.tables.store import Table
from verification.base import candles_1m, check, r, raw_trades, rounded, rr, stg_trades, table, using
from verification.projections import listing

_CUST = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"
_CUST_TYPE = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


def _csv(df, spark, label, header=True):
    path = scratch_path(spark, label)
    df.write.option("header", header).option("escape", "\\").csv(path)
    return path


@check("src_csv_options", "SELECT c_custkey, 'say \"' || c_name || '\", ok' AS c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def src_csv_options(spark, sf):
    c = table(spark, sf, "customer").withColumn("c_name", F.concat(F.lit('say "'), "c_name", F.lit('", ok')))
    return files.read_csv(spark, _csv(c, spark, "csv"), _CUST_TYPE)


@check("src_csv_positional", "SELECT c_custkey AS id, c_acctbal AS balance, c_mktsegment AS segment FROM customer")
def src_csv_positional(spark, sf):
    path = _csv(table(spark, sf, "customer"), spark, "wide")
    return files.read_csv_positional(spark, path, {1: ("id", "bigint"), 4: ("balance", "double"), 5: ("segment", "string")}, 5)


@check("src_csv_partial_cols", "SELECT c_custkey, c_mktsegment FROM customer")
def src_csv_partial_cols(spark, sf):
    return files.read_csv(spark, _csv(table(spark, sf, "customer"), spark, "csv"), _CUST_TYPE).select("c_custkey", "c_mktsegment")


def _per_symbol_files(spark, sf):
    """One CSV file per event type, named like the symbol it holds."""
    folder = scratch_path(spark, "symbols")
    e = table(spark, sf, "events").select("event_id", "event_type", "value")
    e.repartitionByRange("event_type", "event_id").write.option("header", True).partitionBy("event_type").csv(folder)
    return folder


@check("src_file_name_column", "SELECT event_id, value, event_type AS asset_symbol, 'part' AS first_part FROM events")
def src_file_name_column(spark, sf):
    folder = _per_symbol_files(spark, sf)
    df = spark.read.schema("event_id bigint, value double").option("header", True).option("recursiveFileLookup", True).csv(folder)
    df = files.with_file_symbol(df, "first_part", first_part=True)
    symbol = F.regexp_extract(F.col("_metadata.file_path"), "event_type=([^/]+)/", 1)
    return df.select("event_id", "value", symbol.alias("asset_symbol"), "first_part")


@check("src_file_pattern", "SELECT event_id, value FROM events WHERE event_type IN ('click', 'view')")
def src_file_pattern(spark, sf):
    return files.read_matching(spark, _per_symbol_files(spark, sf), "event_id bigint, value double", ".*event_type=(click|view)/.*[.]csv")


@check("src_headerless_csv", using("trades", """SELECT agg_trade_id AS trade_id, price, quantity, price * quantity AS quote_qty, transact_time AS "timestamp",
    agg_trade_id % 2 = 0 AS is_buyer_maker, true AS is_best_match FROM trades"""))
def src_headerless_csv(spark, sf):
    from candlewick.sources.schemas import TRADE_FILE

    t = raw_trades(spark, sf).select(
        "agg_trade_id", "price", "quantity", F.col("price") * F.col("quantity"), "transact_time", F.col("agg_trade_id") % 2 == 0, F.lit(True))
    return files.read_csv_headerless(spark, _csv(t, spark, "trades", header=False), TRADE_FILE)


@check("src_json_flatten", """SELECT p_partkey AS id, p_name AS name, p_retailprice AS price, p_retailprice + 9 AS market_cap FROM part""")
def src_json_flatten(spark, sf):
    path = scratch_path(spark, "listing")
    listing(spark, sf).write.json(path)
    flat = files.flatten_listing(files.read_listing(spark, path))
    return flat.select("id", "name", F.col("`quote.USDT.price`").alias("price"), F.col("`quote.USDT.market_cap`").alias("market_cap"))


@check("src_json_array_rows", using("candles_1m", f"""SELECT asset_symbol, open_time, open, high, low, close, close_time, num_trades, "ignore",
    {rr('volume', 'quote_asset_volume', 'taker_buy_base_volume', 'taker_buy_quote_volume')} FROM candles_1m"""))
def src_json_array_rows(spark, sf):
    ms = lambda c: F.unix_millis(F.col(c).cast("timestamp")).cast("string")
    text = lambda c: F.col(c).cast("string")
    order = ["open", "high", "low", "close", "volume"]
    tail = ["quote_asset_volume", "num_trades", "taker_buy_base_volume", "taker_buy_quote_volume", "ignore"]
    row = F.array(ms("open_time"), *[text(c) for c in order], ms("close_time"), *[text(c) for c in tail])
    # a page of candles per symbol and hour, as an API would return them
    pages = candles_1m(spark, sf).groupBy("asset_symbol", F.date_trunc("hour", "open_time").alias("h")).agg(F.to_json(F.collect_list(row)).alias("value"))
    out = files.explode_klines(pages, "value", ["asset_symbol"])
    return rounded(out, "volume", "quote_asset_volume", "taker_buy_base_volume", "taker_buy_quote_volume")


@check("src_exchange_info", "SELECT DISTINCT p_brand AS \"baseAsset\" FROM part WHERE p_size % 2 = 0 AND p_type <> 'SMALL'")
def src_exchange_info(spark, sf):
    p = table(spark, sf, "part")
    s = F.struct(
        F.col("p_brand").alias("baseAsset"), F.when(F.col("p_size") % 2 == 0, "USDT").otherwise("BTC").alias("quoteAsset"),
        F.when(F.col("p_type") == "SMALL", "BREAK").otherwise("TRADING").alias("status"))
    return files.tradable_bases(p.select(F.array(s).alias("symbols")))


@check("src_table_ref", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def src_table_ref(spark, sf):
    refs = Refs(spark)
    refs.add_parquet("raw", "orders", f"{sf}/orders.parquet")
    refs.add_model("by_status", lambda: refs.source("raw", "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n")))
    return refs.ref("by_status")


@check("src_row_generator", "SELECT CAST(s AS BIGINT) AS seq, count(event_id) AS trades FROM range(86400) t(s) LEFT JOIN events ON hour(ts) * 3600 + minute(ts) * 60 + second(ts) = s GROUP BY 1")
def src_row_generator(spark, sf):
    n = table(spark, sf, "events").groupBy(S.second_of_day(S.clock("ts")).cast("bigint").alias("seq")).agg(F.count("*").alias("n"))
    return G.rows(spark, 86400).join(n, "seq", "left").select("seq", F.coalesce("n", F.lit(0)).alias("trades"))


@check("src_generate_series", "SELECT g AS generated_number, count(o_orderkey) AS orders FROM (SELECT unnest(generate_series(1, (SELECT max(o_custkey) FROM orders))) AS g) LEFT JOIN orders ON o_custkey = g GROUP BY 1")
def src_generate_series(spark, sf):
    o = table(spark, sf, "orders")
    upper = o.agg(F.max("o_custkey")).first()[0]
    n = o.groupBy(F.col("o_custkey").alias("generated_number")).agg(F.count("*").alias("n"))
    return G.generate_series(spark, upper).join(n, "generated_number", "left").select("generated_number", F.coalesce("n", F.lit(0)).alias("orders"))


@check("src_date_spine", """SELECT d AS date_day, count(o_orderkey) AS orders FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate) - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d
    FROM orders) LEFT JOIN orders ON o_orderdate = d GROUP BY 1""")
def src_date_spine(spark, sf):
    o = table(spark, sf, "orders")
    spine = G.date_spine(o.agg(F.min("o_orderdate").alias("start"), F.max("o_orderdate").alias("end")), "day")
    n = o.groupBy(F.col("o_orderdate").alias("date_day")).agg(F.count("*").alias("n"))
    return spine.join(n, "date_day", "left").select("date_day", F.coalesce("n", F.lit(0)).alias("orders"))


@check("src_intervals_between", "SELECT o_custkey, date_diff('day', min(o_orderdate), max(o_orderdate)) AS days, date_diff('month', min(o_orderdate), max(o_orderdate)) AS months FROM orders GROUP BY 1")
def src_intervals_between(spark, sf):
    span = table(spark, sf, "orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))
    return span.select("o_custkey", G.intervals_between("day", "a", "b").alias("days"), G.intervals_between("month", "a", "b").alias("months"))


@check("src_seed_csv", "SELECT CAST(c_custkey AS BIGINT) AS c_custkey, lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS c_nationkey, c_acctbal FROM customer")
def src_seed_csv(spark, sf):
    """Codes with leading zeros look like numbers and stay texts."""
    code = F.lpad(F.col("c_nationkey").cast("string"), 3, "0").alias("c_nationkey")
    path = _csv(table(spark, sf, "customer").select("c_custkey", code, "c_acctbal"), spark, "seed")
    seeds = Table(spark, scratch_path(spark, "seed_table"))
    seeds.replace(files.seed_csv(spark, path, {"c_custkey": "bigint", "C_NATIONKEY": "string"}))
    return seeds.read()


@check("src_literal_rows", "SELECT label, bonus, count(*) AS orders FROM orders JOIN (VALUES ('F', 'final', 1.5::DOUBLE), ('O', 'open', NULL)) v(s, label, bonus) ON s = o_orderstatus GROUP BY 1, 2")
def src_literal_rows(spark, sf):
    schema = T.StructType([T.StructField("o_orderstatus", T.StringType()), T.StructField("label", T.StringType()), T.StructField("bonus", T.DoubleType())])
    names = G.literal_rows(spark, [{"o_orderstatus": "F", "label": "final", "bonus": 1.5}, {"o_orderstatus": "O", "label": "open"}], schema)
    n = table(spark, sf, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("orders"))
    return n.join(names, "o_orderstatus").select("label", "bonus", "orders")


@check("src_empty_schema", "SELECT l_suppkey, sum(l_quantity) AS q FROM lineitem WHERE false GROUP BY 1")
def src_empty_schema(spark, sf):
    return G.empty_like(table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.sum("l_quantity").alias("q")))


# ---- sinks ------------------------------------------------------------------


@check("sink_append_rows", using("trades", "SELECT agg_trade_id, pair_symbol, price FROM trades UNION ALL SELECT agg_trade_id, pair_symbol, price FROM trades WHERE quantity > 50"))
def sink_append_rows(spark, sf):
    t = raw_trades(spark, sf).select("agg_trade_id", "pair_symbol", "price", "quantity")
    out = Table(spark, scratch_path(spark, "bronze"))
    out.replace(t)
    out.append(t.filter("quantity > 50"))
    return out.read().drop("quantity")


@check("sink_csv", _CUST)
def sink_csv(spark, sf):
    path = scratch_path(spark, "out")
    table(spark, sf, "customer").write.option("header", True).csv(path)
    return files.read_csv(spark, path, _CUST_TYPE)


@check("mat_view", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1")
def mat_view(spark, sf):
    table(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n")).createOrReplaceTempView("cw_orders_by_customer")
    return spark.table("cw_orders_by_customer")


@check("mat_table", f"SELECT l_suppkey, {r('sum(l_quantity)', 'q')} FROM lineitem GROUP BY 1")
def mat_table(spark, sf):
    li = table(spark, sf, "lineitem")
    out = Table(spark, scratch_path(spark, "rebuilt"))
    out.replace(li.groupBy("l_suppkey").agg(F.sum("l_tax").alias("q")))
    out.replace(li.groupBy("l_suppkey").agg(F.sum("l_quantity").alias("q")))
    return rounded(out.read(), "q")


@check("mat_clustered_write", "SELECT o_orderkey, o_orderdate, o_custkey FROM orders")
def mat_clustered_write(spark, sf):
    out = Table(spark, scratch_path(spark, "clustered"))
    out.replace(table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_custkey"), ["o_orderdate", "o_custkey"])
    return out.read()


@check("mat_refreshable", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def mat_refreshable(spark, sf):
    from candlewick.streaming import klines

    landed = scratch_path(spark, "landed")
    table(spark, sf, "events").select(F.col("event_type").alias("value"), F.col("event_id").alias("offset")).write.parquet(landed)
    out = Table(spark, scratch_path(spark, "refreshed"))
    df = klines.read_files(spark, landed).groupBy(F.col("value").alias("event_type")).agg(F.count("*").alias("n"))
    checkpoint = scratch_path(spark, "chk")
    for _ in range(2):  # a refresh on demand; the second finds nothing new
        klines.finish(klines.upsert_to(df, out, ["event_type"], checkpoint))
    return out.read()
