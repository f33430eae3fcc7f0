"""Joins."""

from pyspark.sql import functions as F

from candlewick.functions import scalars as S
from candlewick.operators import joins as J
from candlewick.plans import dims, facts, marts, staging
from verification.base import (
    assets_dim, calendar, candles_1m, candles_long, check, key_sql, r, raw_trades, rounded, stg_trades, table, trades_fct, using,
)


@check("join_inner_multikey", using("candles_1m", """SELECT c.asset_symbol, c.open_time, c.close, h.hour_open, h.hour_close FROM candles_1m c
    JOIN (SELECT asset_symbol, date_trunc('hour', open_time) AS hour, first(open ORDER BY open_time) AS hour_open,
    last(close ORDER BY close_time) AS hour_close FROM candles_1m GROUP BY 1, 2) h
    ON h.asset_symbol = c.asset_symbol AND h.hour = date_trunc('hour', c.open_time)"""))
def join_inner_multikey(spark, sf):
    c = candles_1m(spark, sf).withColumn("hour", F.date_trunc("hour", "open_time"))
    h = c.groupBy("asset_symbol", "hour").agg(
        F.min_by("open", "open_time").alias("hour_open"), F.max_by("close", "close_time").alias("hour_close"))
    return c.join(h, ["asset_symbol", "hour"]).select("asset_symbol", "open_time", "close", "hour_open", "hour_close")


@check("join_inner_daily", using("candles_long, daily", """SELECT c.asset_pair_symbol, c.open_date, c.open_time, c.close,
    d.open AS day_open, d.close AS day_close FROM candles_long c JOIN daily d USING (asset_pair_symbol, open_date)"""))
def join_inner_daily(spark, sf):
    c = candles_long(spark, sf)
    keys = ["asset_pair_symbol", "open_date"]
    d = facts.candles_daily(c, keys).select(*keys, F.col("open").alias("day_open"), F.col("close").alias("day_close"))
    return c.select(*keys, "open_time", "close").join(d, keys)


@check("join_left_dim_lookup", using("candles_long, date_dim, time_dim", """SELECT asset_pair_symbol, open_date, open_time,
    date_sk AS open_date_fk, time_sk AS open_time_fk FROM candles_long LEFT JOIN date_dim ON full_date = open_date
    LEFT JOIN time_dim ON time_of_day = open_time"""))
def join_left_dim_lookup(spark, sf):
    c = candles_long(spark, sf).select("asset_pair_symbol", "open_date", "open_time")
    c = facts.with_date_key(c, calendar(spark), "open_date", "open_date_fk")
    times = dims.time_dim(spark).select(F.col("time_of_day").alias("open_time"), F.col("time_sk").alias("open_time_fk"))
    return J.fixed_lookup(c, times, "open_time")


@check("join_left_current_version", using("candles_long, assets_dim", """SELECT asset_pair_symbol, open_date, open_time, asset_sk AS base_asset_fk
    FROM candles_long LEFT JOIN assets_dim ON upper(base_asset_symbol) = upper(symbol) AND rank_valid_to IS NULL"""))
def join_left_current_version(spark, sf):
    c = candles_long(spark, sf).select("asset_pair_symbol", "base_asset_symbol", "open_date", "open_time")
    return facts.with_asset_key(c, facts.current_assets(assets_dim(spark, sf)), "base_asset_symbol", "base_asset_fk").drop("base_asset_symbol")


@check("join_left_expr_key", using("time_dim", """SELECT event_id, time_sk FROM events LEFT JOIN time_dim
    ON time_of_day = strftime(date_trunc('second', ts), '%H:%M:%S')"""))
def join_left_expr_key(spark, sf):
    e = table(spark, sf, "events").select("event_id", S.clock(F.date_trunc("second", "ts")).alias("time_of_day"))
    return J.fixed_lookup(e, dims.time_dim(spark).select("time_of_day", "time_sk"), "time_of_day").drop("time_of_day")


@check("join_left_all_versions", using("trades, assets_dim", """SELECT agg_trade_id, asset_sk AS base_asset_fk FROM trades
    LEFT JOIN assets_dim ON symbol = replace(pair_symbol, 'USDT', '')"""))
def join_left_all_versions(spark, sf):
    return trades_fct(spark, sf, "all").select("agg_trade_id", "base_asset_fk").distinct()


@check("join_inner_star", f"""SELECT n_name, r_name, {r('sum(o_totalprice)', 'total', 2)}, count(*) AS orders FROM orders
    JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY 1, 2""")
def join_inner_star(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_totalprice")
    # one row per customer before the join: a customer with very many orders is already summed
    o = o.groupBy("c_custkey").agg(F.sum("o_totalprice").alias("t"), F.count("*").alias("n"))
    c = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    n = table(spark, sf, "nation").select("n_nationkey", "n_name", F.col("n_regionkey").alias("r_regionkey"))
    df = J.lookup_join(o.join(c, "c_custkey"), n, ["n_nationkey"], "inner")
    df = J.lookup_join(df, table(spark, sf, "region"), ["r_regionkey"], "inner")
    return rounded(df.groupBy("n_name", "r_name").agg(F.sum("t").alias("total"), F.sum("n").alias("orders")), "total", places=2)


@check("join_left_star", using("trades, time_dim, date_dim", """SELECT agg_trade_id, hour_of_day, time_division, dayname FROM trades
    LEFT JOIN time_dim ON time_of_day = transaction_time AND hour_of_day < 20 LEFT JOIN date_dim ON full_date = transaction_date"""))
def join_left_star(spark, sf):
    t = stg_trades(spark, sf)
    times = dims.time_dim(spark).filter("hour_of_day < 20").select(
        F.col("time_of_day").alias("transaction_time"), "hour_of_day", "time_division")
    days = calendar(spark).select(F.col("full_date").alias("transaction_date"), "dayname")
    df = J.fixed_lookup(J.fixed_lookup(t, times, "transaction_time"), days, "transaction_date")
    return df.select("agg_trade_id", "hour_of_day", "time_division", "dayname")


@check("join_agg_to_detail", f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, {r('a', 'avg_l_quantity')} FROM lineitem
    JOIN (SELECT l_suppkey, avg(l_quantity) AS a FROM lineitem GROUP BY 1) USING (l_suppkey) WHERE l_quantity >= a * 1.75""")
def join_agg_to_detail(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return rounded(J.against_group_mean(li, ["l_suppkey"], "l_quantity", 1.75), "avg_l_quantity")


@check("join_total_share", f"""SELECT c_mktsegment, y, m, {r('v', 'total', 2)}, {r('100 * v / sum(v) OVER (PARTITION BY y, m)', 'share_pct')} FROM (
    SELECT c_mktsegment, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m, sum(o_totalprice) AS v
    FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2, 3)""")
def join_total_share(spark, sf):
    from candlewick.operators.aggregates import group_share

    o = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"), "o_totalprice")
    df = o.join(table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), "c_custkey")
    out = group_share(df, ["c_mktsegment"], ["y", "m"], F.col("o_totalprice"), "total").drop("period_total")
    return rounded(rounded(out, "total", places=2), "share_pct")


@check("join_self_day_offset", using("daily", """SELECT d.asset_pair_symbol, d.open_date, d.close, p.close AS previous_close, n.close AS next_close
    FROM daily d LEFT JOIN daily p ON p.asset_pair_symbol = d.asset_pair_symbol AND p.open_date = d.open_date - 1
    LEFT JOIN daily n ON n.asset_pair_symbol = d.asset_pair_symbol AND n.open_date = d.open_date + 1"""))
def join_self_day_offset(spark, sf):
    keys = ["asset_pair_symbol", "open_date"]
    d = facts.candles_daily(candles_long(spark, sf), keys).select(*keys, "close")
    out = d
    for name, shift in (("previous_close", 1), ("next_close", -1)):
        out = out.join(d.select(keys[0], F.date_add("open_date", shift).alias("open_date"), F.col("close").alias(name)), keys, "left")
    return out


@check("join_anti_not_in", """SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE (o_custkey, o_orderstatus) NOT IN (
    SELECT CASE WHEN o_custkey % 50 <> 0 THEN o_custkey END, o_orderstatus FROM orders WHERE o_totalprice > 450000 AND o_orderstatus <> 'F')""")
def join_anti_not_in(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    dear = table(spark, sf, "orders").filter("o_totalprice > 450000 and o_orderstatus <> 'F'").select(
        F.when(F.col("o_custkey") % 50 != 0, F.col("o_custkey")).alias("o_custkey"), "o_orderstatus")
    return J.not_in(o, dear, ["o_custkey", "o_orderstatus"])


@check("join_anti_is_null", "SELECT c_custkey, c_name FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_totalprice > 400000) ON o_custkey = c_custkey WHERE o_orderkey IS NULL")
def join_anti_is_null(spark, sf):
    o = table(spark, sf, "orders").filter("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return J.absent(table(spark, sf, "customer").select("c_custkey", "c_name"), o, ["c_custkey"])


@check("join_semi_in_distinct", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
    WHERE l_orderkey IN (SELECT DISTINCT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')""")
def join_semi_in_distinct(spark, sf):
    o = table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("l_orderkey"))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").join(o, "l_orderkey", "left_semi")


@check("join_null_safe_equals", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, g.n AS group_rows FROM
    (SELECT *, CASE WHEN l_linenumber <> 7 THEN l_linenumber END AS k FROM lineitem) l JOIN
    (SELECT CASE WHEN l_linenumber <> 7 THEN l_linenumber END AS k, count(*) AS n FROM lineitem GROUP BY 1) g ON l.k IS NOT DISTINCT FROM g.k""")
def join_null_safe_equals(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("k", F.when(F.col("l_linenumber") != 7, F.col("l_linenumber")))
    g = li.groupBy(F.col("k").alias("gk")).agg(F.count("*").alias("group_rows"))
    out = li.join(g, S.equals("k", "gk", null_safe=True))
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "group_rows")


@check("join_asof_scd2", using("trades, assets_dim", """SELECT agg_trade_id, asset_sk, market_cap_based_rank FROM trades LEFT JOIN assets_dim
    ON symbol = replace(pair_symbol, 'USDT', '') AND ts >= rank_valid_from AND (rank_valid_to IS NULL OR ts < rank_valid_to)"""))
def join_asof_scd2(spark, sf):
    t = raw_trades(spark, sf).select("agg_trade_id", S.pair_base("pair_symbol").alias("symbol"), S.from_epoch_ms("transact_time").alias("ts"))
    v = assets_dim(spark, sf).select("symbol", "asset_sk", "market_cap_based_rank", "rank_valid_from", "rank_valid_to")
    out = J.as_of_version(t, v, "symbol", "ts", "rank_valid_from", "rank_valid_to")
    return out.select("agg_trade_id", "asset_sk", "market_cap_based_rank")


@check("join_asof_merge", using("trades, assets_dim", """SELECT agg_trade_id, asset_sk, market_cap_based_rank FROM trades LEFT JOIN assets_dim
    ON symbol = replace(pair_symbol, 'USDT', '') AND ts >= rank_valid_from AND (rank_valid_to IS NULL OR ts < rank_valid_to)"""))
def join_asof_merge(spark, sf):
    """The same join for versions that are too many to send to every task: blocks of at most 2,000 trades."""
    t = raw_trades(spark, sf).select("agg_trade_id", S.pair_base("pair_symbol").alias("symbol"), S.from_epoch_ms("transact_time").alias("ts"))
    v = assets_dim(spark, sf).select("symbol", "asset_sk", "market_cap_based_rank", "rank_valid_from", "rank_valid_to")
    out = J.as_of_merge(t, v, "symbol", "ts", "rank_valid_from", "rank_valid_to", block_rows=2000)
    return out.select("agg_trade_id", "asset_sk", "market_cap_based_rank")
