"""Aggregations, sorts, limits and set operations."""

from pyspark.sql import functions as F

from candlewick.functions import expressions as X
from candlewick.operators import aggregates as A
from candlewick.operators import sets, topk
from candlewick.plans import facts, staging
from candlewick.tables import incremental
from verification.base import candles_1m, candles_long, check, r, raw_trades, rounded, rr, stg_trades, table, using


@check("agg_basic", f"""SELECT l_returnflag, l_linestatus, {r('sum(l_quantity)', 'sum_qty')}, {r('avg(l_extendedprice)', 'avg_price')},
    min(l_discount) AS min_discount, max(l_tax) AS max_tax, count(*) AS n FROM lineitem GROUP BY 1, 2""")
def agg_basic(spark, sf):
    out = table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").alias("sum_qty"), F.avg("l_extendedprice").alias("avg_price"),
        F.min("l_discount").alias("min_discount"), F.max("l_tax").alias("max_tax"), F.count("*").alias("n"))
    return rounded(out, "sum_qty", "avg_price")


@check("agg_count_all", "SELECT count(*) AS n FROM lineitem")
def agg_count_all(spark, sf):
    return table(spark, sf, "lineitem").agg(F.count("*").alias("n"))


@check("agg_conditional_count", """SELECT o_orderpriority, CAST(sum(CASE WHEN o_totalprice < 100000 THEN 1 ELSE 0 END) AS BIGINT) AS small,
    CAST(sum(CASE WHEN o_totalprice >= 100000 THEN 1 ELSE 0 END) AS BIGINT) AS large FROM orders GROUP BY 1""")
def agg_conditional_count(spark, sf):
    small = F.col("o_totalprice") < 100000
    return table(spark, sf, "orders").groupBy("o_orderpriority").agg(F.count_if(small).alias("small"), F.count_if(~small).alias("large"))


@check("agg_first_last_pick", using("candles_long", """SELECT asset_pair_symbol, open_date, first(open ORDER BY open_time) AS first_open,
    last(close ORDER BY open_time) AS last_close FROM candles_long GROUP BY 1, 2"""))
def agg_first_last_pick(spark, sf):
    d = facts.candles_daily(candles_long(spark, sf), ["asset_pair_symbol", "open_date"])
    return d.select("asset_pair_symbol", "open_date", F.col("open").alias("first_open"), F.col("close").alias("last_close"))


@check("agg_derived_measure", using("trades", "SELECT pair_symbol, CAST(sum(last_trade_id - first_trade_id + 1) AS BIGINT) AS raw_trades FROM trades GROUP BY 1"))
def agg_derived_measure(spark, sf):
    return raw_trades(spark, sf).groupBy("pair_symbol").agg(F.sum(X.raw_trade_count()).alias("raw_trades"))


@check("agg_product_sum", f"SELECT l_suppkey, {r('sum(l_quantity * l_extendedprice)', 'total', 2)} FROM lineitem GROUP BY 1")
def agg_product_sum(spark, sf):
    out = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.sum(F.col("l_quantity") * F.col("l_extendedprice")).alias("total"))
    return rounded(out, "total", places=2)


@check("agg_stddev_sample", f"SELECT l_partkey, {r('stddev_samp(l_quantity)', 'sd')}, count(*) AS n FROM lineitem GROUP BY 1")
def agg_stddev_sample(spark, sf):
    return rounded(table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.stddev_samp("l_quantity").alias("sd"), F.count("*").alias("n")), "sd")


@check("agg_two_level_share", using("trades", f"""SELECT pair_symbol, period, {r('v', 'value')}, {r('sum(v) OVER (PARTITION BY period)', 'period_total')},
    {r('v / sum(v) OVER (PARTITION BY period) * 100', 'share_pct')} FROM (
    SELECT pair_symbol, date_trunc('month', transaction_date)::DATE AS period, sum(price * quantity) AS v FROM trades GROUP BY 1, 2)"""))
def agg_two_level_share(spark, sf):
    t = stg_trades(spark, sf).withColumn("period", F.trunc("transaction_date", "month"))
    out = A.group_share(t, ["pair_symbol"], ["period"], F.col("price") * F.col("quantity"), "value")
    return rounded(out, "value", "period_total", "share_pct")


@check("agg_group_by_ordinal", "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2")
def agg_group_by_ordinal(spark, sf):
    return spark.sql("SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM {o} GROUP BY 1, 2", o=table(spark, sf, "orders"))


@check("agg_group_by_alias", "SELECT year(o_orderdate)::INTEGER AS y, CASE WHEN o_totalprice > 200000 THEN 1 ELSE 0 END AS big, count(*) AS n FROM orders GROUP BY 1, 2")
def agg_group_by_alias(spark, sf):
    q = "SELECT year(o_orderdate) AS y, CASE WHEN o_totalprice > 200000 THEN 1 ELSE 0 END AS big, count(*) AS n FROM {o} GROUP BY y, big"
    return spark.sql(q, o=table(spark, sf, "orders"))


@check("agg_group_by_expr", "SELECT ts::DATE AS d, hour(ts)::INTEGER AS h, count(*) AS n FROM events GROUP BY 1, 2")
def agg_group_by_expr(spark, sf):
    return table(spark, sf, "events").groupBy(F.to_date("ts").alias("d"), F.hour("ts").alias("h")).agg(F.count("*").alias("n"))


@check("agg_having", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def agg_having(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n")).filter("n > 1")


_PREV = "lag(time_s) OVER (PARTITION BY pair_symbol ORDER BY transaction_date, transaction_time, agg_trade_id)"


@check("agg_avg_datediff", using("trades", f"""SELECT pair_symbol, {r('avg(s - p)', 'avg_gap')} FROM (SELECT pair_symbol,
    epoch(date_trunc('second', ts)) AS s, lag(epoch(date_trunc('second', ts))) OVER (PARTITION BY pair_symbol ORDER BY transaction_date, transaction_time, agg_trade_id) AS p
    FROM trades) WHERE p IS NOT NULL GROUP BY 1"""))
def agg_avg_datediff(spark, sf):
    from candlewick.plans import indicators

    gaps = indicators.trade_gaps(stg_trades(spark, sf)).filter(F.col("gap_seconds").isNotNull())
    return rounded(gaps.groupBy("pair_symbol").agg(F.avg("gap_seconds").alias("avg_gap")), "avg_gap")


@check("agg_max_scalar", "SELECT * FROM (SELECT event_id, user_id FROM events) WHERE event_id > coalesce((SELECT max(o_orderkey) // 2 FROM orders), -1)")
def agg_max_scalar(spark, sf):
    mark = table(spark, sf, "orders").select((F.col("o_orderkey")).alias("event_id")).agg(F.floor(F.max("event_id") / 2).alias("event_id"))
    return incremental.above_mark(table(spark, sf, "events").select("event_id", "user_id"), mark, "event_id")


@check("agg_max_per_key", """SELECT event_id, event_type, user_id FROM events e WHERE ts > coalesce((SELECT max(ts) - INTERVAL 10 DAY FROM events m
    WHERE m.event_type = e.event_type AND m.event_type <> 'click'), TIMESTAMP '1970-01-01')""")
def agg_max_per_key(spark, sf):
    e = table(spark, sf, "events").select("event_id", "event_type", "user_id", "ts")
    stored = e.filter("event_type <> 'click'").withColumn("ts", F.expr("ts - interval 10 days"))
    return incremental.above_own_mark(e, stored, ["event_type"], "ts").drop("ts")


@check("agg_distinct_tuples", "SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem")
def agg_distinct_tuples(spark, sf):
    return table(spark, sf, "lineitem").select("l_suppkey", "l_returnflag").distinct()


@check("agg_listagg", """SELECT o_custkey, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS first_orders FROM (
    SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) <= 3) GROUP BY 1""")
def agg_listagg(spark, sf):
    return A.listagg(table(spark, sf, "orders"), ["o_custkey"], "o_orderkey", ",", ["o_orderkey"], 3, "first_orders")


@check("agg_any_value", "SELECT c_nationkey, any_value(c_nationkey * 2) AS v FROM customer GROUP BY 1")
def agg_any_value(spark, sf):
    return table(spark, sf, "customer").groupBy("c_nationkey").agg(F.any_value(F.col("c_nationkey") * 2).alias("v"))


@check("agg_bool_or", "SELECT o_custkey, bool_or(o_totalprice > 400000) AS any_large FROM orders GROUP BY 1")
def agg_bool_or(spark, sf):
    return table(spark, sf, "orders").groupBy("o_custkey").agg(F.bool_or(F.col("o_totalprice") > 400000).alias("any_large"))


@check("agg_describe", f"""SELECT count(o_totalprice) AS "count", {r('avg(o_totalprice)', 'mean')}, {r('stddev_samp(o_totalprice)', 'stddev')},
    min(o_totalprice) AS "min", {r('quantile_cont(o_totalprice, 0.25)', 'p25')}, {r('quantile_cont(o_totalprice, 0.5)', 'p50')},
    {r('quantile_cont(o_totalprice, 0.75)', 'p75')}, max(o_totalprice) AS "max" FROM orders""")
def agg_describe(spark, sf):
    return rounded(A.describe(table(spark, sf, "orders"), "o_totalprice"), "mean", "stddev", "p25", "p50", "p75")


@check("agg_freshness", "SELECT max(ts) AS max_loaded_at FROM events WHERE event_type = 'click'")
def agg_freshness(spark, sf):
    return A.freshness(table(spark, sf, "events"), "ts", "event_type = 'click'").drop("snapshotted_at")


@check("agg_freshness_query", "SELECT max(ts) AS max_loaded_at FROM events WHERE event_type <> 'click' AND value > 10")
def agg_freshness_query(spark, sf):
    query = "SELECT max(ts) FROM {events} WHERE event_type <> 'click' AND value > 10"
    return A.freshness_of_query(spark, query, events=table(spark, sf, "events")).drop("snapshotted_at")


# ---- sorts and limits -------------------------------------------------------


@check("sort_multi_key", "SELECT o_orderstatus, o_orderpriority, o_orderkey FROM orders ORDER BY 1, 2, 3")
def sort_multi_key(spark, sf):
    return table(spark, sf, "orders").select("o_orderstatus", "o_orderpriority", "o_orderkey").orderBy("o_orderstatus", "o_orderpriority", "o_orderkey")


@check("sort_desc", "SELECT event_id, ts FROM events ORDER BY ts DESC, event_id")
def sort_desc(spark, sf):
    return table(spark, sf, "events").select("event_id", "ts").orderBy(F.desc("ts"), "event_id")


@check("topk_rank", "SELECT p_partkey, p_size FROM part ORDER BY p_size, p_partkey LIMIT 10")
def topk_rank(spark, sf):
    return topk.top(table(spark, sf, "part").select("p_partkey", "p_size"), ["p_size", "p_partkey"], 10)


@check("topk_latest_symbols", "SELECT o_orderkey, o_orderdate, o_custkey FROM orders ORDER BY o_orderdate::DATE DESC, o_custkey DESC, o_orderkey LIMIT 10")
def topk_latest_symbols(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_custkey")
    ranked = o.withColumn("rank", F.struct("o_custkey", (-F.col("o_orderkey")).alias("k")))
    return topk.newest_ranked(ranked, F.to_date("o_orderdate"), "rank").drop("rank")


_STABLE = ["Brand#1", "Brand#2"]


@check("topk_first_n_matching", """SELECT symbol, rank FROM (SELECT CAST(p_partkey AS VARCHAR) AS symbol, p_size AS rank, p_partkey FROM part
    WHERE p_partkey NOT IN (0, 1) AND p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)
    ORDER BY p_size, symbol LIMIT 25) UNION ALL SELECT 'USDT', p_size FROM part WHERE p_partkey = 7""")
def topk_first_n_matching(spark, sf):
    p = table(spark, sf, "part")
    ranked = p.select(F.col("p_partkey").cast("string").alias("symbol"), F.col("p_size").alias("rank"))
    extra = p.filter("p_partkey = 7").select(F.lit("USDT").alias("symbol"), F.col("p_size").alias("rank"))
    listed = table(spark, sf, "lineitem").filter("l_quantity > 45").select(F.col("l_partkey").cast("string").alias("symbol"))
    return topk.listed_coins(ranked.unionByName(extra), listed, 25, ["0", "1"])


@check("limit_n", "SELECT event_id, event_type FROM events ORDER BY event_id LIMIT 5")
def limit_n(spark, sf):
    return topk.top(table(spark, sf, "events").select("event_id", "event_type"), ["event_id"], 5)


# ---- set operations ---------------------------------------------------------


@check("set_union_all", using("hourly_stream, candles_long", """SELECT asset_pair_symbol, open_date, open_time, close, record_source FROM candles_long
    UNION ALL SELECT asset_pair_symbol, open_date, open_time, close, record_source FROM hourly_stream"""))
def set_union_all(spark, sf):
    cols = ["asset_pair_symbol", "open_date", "open_time", "close", "record_source"]
    return sets.concat([candles_long(spark, sf).select(*cols), staging.hourly_from_stream(candles_1m(spark, sf)).select(*cols)])


@check("set_concat_frames", "SELECT r_regionkey AS k, r_name AS n FROM region UNION ALL SELECT n_nationkey, n_name FROM nation UNION ALL SELECT c_custkey, c_name FROM customer")
def set_concat_frames(spark, sf):
    parts = [("region", "r_regionkey", "r_name"), ("nation", "n_nationkey", "n_name"), ("customer", "c_custkey", "c_name")]
    return sets.concat([table(spark, sf, t).select(F.col(k).cast("bigint").alias("k"), F.col(n).alias("n")) for t, k, n in parts])


@check("set_union_change_rows", """SELECT 'insert' AS change, c_custkey AS id, c_name AS name, CAST(NULL AS DOUBLE) AS balance FROM customer WHERE c_acctbal < 0
    UNION ALL SELECT 'update', s_suppkey, s_name, s_acctbal FROM supplier UNION ALL SELECT 'delete', n_nationkey, NULL, NULL FROM nation""")
def set_union_change_rows(spark, sf):
    ins = table(spark, sf, "customer").filter("c_acctbal < 0").select(F.lit("insert").alias("change"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    upd = table(spark, sf, "supplier").select(F.lit("update").alias("change"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    gone = table(spark, sf, "nation").select(F.lit("delete").alias("change"), F.col("n_nationkey").cast("bigint").alias("id"))
    return sets.concat([ins, upd, gone], allow_missing=True)


@check("set_intersect", "SELECT o_custkey AS k FROM orders INTERSECT SELECT c_custkey FROM customer WHERE c_acctbal > 0")
def set_intersect(spark, sf):
    return sets.intersect(table(spark, sf, "orders").select(F.col("o_custkey").alias("k")), table(spark, sf, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("k")))


@check("set_except", "SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 400000")
def set_except(spark, sf):
    dear = table(spark, sf, "orders").filter("o_totalprice > 400000")
    return sets.except_(table(spark, sf, "customer").select(F.col("c_custkey").alias("k")), dear.select(F.col("o_custkey").alias("k")))


@check("agg_quantiles_by_key", "SELECT l_returnflag, 0.05::DOUBLE AS point, " + r("quantile_cont(l_extendedprice, 0.05)", "value") + " FROM lineitem GROUP BY 1 UNION ALL "
       "SELECT l_returnflag, 0.5, " + r("quantile_cont(l_extendedprice, 0.5)", "value") + " FROM lineitem GROUP BY 1 UNION ALL "
       "SELECT l_returnflag, 0.99, " + r("quantile_cont(l_extendedprice, 0.99)", "value") + " FROM lineitem GROUP BY 1")
def agg_quantiles_by_key(spark, sf):
    """Exact quantiles of three flags, one of which has half of all rows."""
    out = A.quantiles_by_key(table(spark, sf, "lineitem"), ["l_returnflag"], "l_extendedprice", [0.05, 0.5, 0.99], bins=64, rows=500)
    return rounded(out, "value")
