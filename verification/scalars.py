"""Scalar functions, user functions."""

from pyspark.sql import functions as F

from candlewick.functions import expressions as X
from candlewick.functions import scalars as S
from candlewick.plans import facts, staging
from candlewick.sources.generators import rows as number_rows
from verification.base import (
    DAY_KEYS, candles_1m, check, daily, kline_messages, key_sql, r, raw_trades, rounded, stg_trades, table, using,
)
from verification.projections import KLINE_FLOOR, _KLINE, api_trades


def simple(name, tbl, keys, spark_cols, sql_cols, floors=()):
    """A map-only query: keys plus computed columns of one table."""
    sql = f"SELECT {', '.join(keys)}, {', '.join(f'{e} AS {n}' for n, e in sql_cols.items())} FROM {tbl}"

    @check(name, sql)
    def run(spark, sf):
        df = table(spark, sf, tbl).select(*keys, *[c.alias(n) for n, c in spark_cols().items()])
        return rounded(df, *floors) if floors else df

    return run


C = F.col
PAIR = lambda: F.concat(F.upper(F.left("event_type", F.lit(3))), F.lit("USDT"))
PAIR_SQL = "(upper(left(event_type, 3)) || 'USDT')"
E_KEY, O_KEY, P_KEY = ["event_id"], ["o_orderkey"], ["p_partkey"]

# ---- text -------------------------------------------------------------------

simple("fn_replace", "events", E_KEY, lambda: {"v": F.replace(F.concat(PAIR(), F.lit("USDTX")), F.lit("USDT"), F.lit(""))},
       {"v": f"replace({PAIR_SQL} || 'USDTX', 'USDT', '')"})


@check("fn_left_right_position", f"""SELECT event_id, left(p, greatest(position('USDT' IN p) - 1, 0)) AS base,
    right(p, length(p) - position('USDT' IN p) + 1) AS quote FROM (
    SELECT event_id, CASE WHEN event_type = 'click' THEN 'CLIBTC' WHEN event_type = 'view' THEN 'USDTUSDT' ELSE {PAIR_SQL} END AS p FROM events)""")
def fn_left_right_position(spark, sf):
    p = F.when(C("event_type") == "click", "CLIBTC").when(C("event_type") == "view", "USDTUSDT").otherwise(PAIR())
    e = table(spark, sf, "events").select("event_id", p.alias("p"))
    return e.select("event_id", S.pair_base("p").alias("base"), S.pair_quote("p").alias("quote"))


simple("fn_position", "part", P_KEY, lambda: {"v": F.position(F.lit("in"), C("p_name"))}, {"v": "CAST(position('in' IN p_name) AS INTEGER)"})
simple("fn_length", "part", P_KEY, lambda: {"v": F.length("p_name")}, {"v": "CAST(length(p_name) AS INTEGER)"})
simple("fn_right", "part", P_KEY, lambda: {"v": S.right("p_name", 3), "none": S.right("p_name", 0)}, {"v": "right(p_name, 3)", "none": "''"})
simple("fn_split_part", "part", P_KEY,
       lambda: {"first": S.split_part("p_name", " ", 1), "last": S.split_part("p_name", " ", -1)},
       {"first": "split_part(p_name, ' ', 1)", "last": "split_part(p_name, ' ', -1)"})


@check("fn_like_case_split", f"""SELECT event_id, CASE WHEN p LIKE '%USDT' THEN replace(p, 'USDT', '') ELSE p END AS base,
    CASE WHEN p LIKE '%USDT' THEN 'USDT' ELSE 'UNKNOWN' END AS quote FROM (
    SELECT event_id, CASE WHEN event_type = 'click' THEN 'CLIBTC' ELSE {PAIR_SQL} END AS p FROM events)""")
def fn_like_case_split(spark, sf):
    p = F.when(C("event_type") == "click", "CLIBTC").otherwise(PAIR())
    e = table(spark, sf, "events").select("event_id", p.alias("p"))
    return e.select("event_id", S.strip_quote("p").alias("base"), S.quote_of("p").alias("quote"))


simple("fn_upper", "part", P_KEY, lambda: {"v": F.upper("p_name")}, {"v": "upper(p_name)"})
simple("fn_lpad_concat", "events", E_KEY,
       lambda: {"military": F.concat(F.lpad(F.hour("ts").cast("string"), 2, "0"), F.lpad(F.minute("ts").cast("string"), 2, "0"))},
       {"military": "lpad(CAST(hour(ts) AS VARCHAR), 2, '0') || lpad(CAST(minute(ts) AS VARCHAR), 2, '0')"})
simple("fn_concat", "orders", O_KEY,
       lambda: {"v": F.concat("o_orderstatus", F.lit("/"), F.when(C("o_custkey") % 2 == 0, C("o_orderpriority")))},
       {"v": "o_orderstatus || '/' || CASE WHEN o_custkey % 2 = 0 THEN o_orderpriority END"})
simple("fn_to_char_time", "events", E_KEY,
       lambda: {"t12": F.date_format("ts", "hh:mm:ss a"), "t24": S.clock("ts")},
       {"t12": "strftime(ts, '%I:%M:%S %p')", "t24": "strftime(ts, '%H:%M:%S')"})
simple("fn_strftime", "events", E_KEY, lambda: {"v": F.date_format("ts", "yyyy-MM-dd HH:mm:ss")}, {"v": "strftime(ts, '%Y-%m-%d %H:%M:%S')"})

# ---- keys -------------------------------------------------------------------

simple("fn_surrogate_key", "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"],
       lambda: {"sk": S.surrogate_key("l_orderkey", F.when(C("l_linenumber") > 1, C("l_linenumber")), "l_partkey")},
       {"sk": key_sql("l_orderkey", "CASE WHEN l_linenumber > 1 THEN l_linenumber END", "l_partkey")})
simple("fn_hash", "orders", O_KEY, lambda: {"v": S.hash_text("o_custkey")}, {"v": "md5(CAST(o_custkey AS VARCHAR))"})
simple("fn_scd_hash", "orders", O_KEY,
       lambda: {"v": S.history_key("o_orderkey", F.when(C("o_custkey") % 2 == 0, C("o_orderstatus")))},
       {"v": "md5(concat_ws('|', CAST(o_orderkey AS VARCHAR), coalesce(CASE WHEN o_custkey % 2 = 0 THEN o_orderstatus END, '')))"})
simple("fn_string_literal", "region", ["r_regionkey"], lambda: {"v": F.concat(F.lit("it's "), C("r_name"))}, {"v": "'it''s ' || r_name"})
simple("fn_escape_quotes", "part", P_KEY, lambda: {"v": F.replace(F.concat("p_name", F.lit("'s")), F.lit("'"), F.lit("''"))},
       {"v": "replace(p_name || '''s', '''', '''''')"})

# ---- time -------------------------------------------------------------------

simple("fn_epoch_ms_to_ts", "events", E_KEY,
       lambda: {"v": S.from_epoch_ms(F.unix_millis(C("ts").cast("timestamp")))}, {"v": "make_timestamp((epoch_us(ts) // 1000) * 1000)"})
simple("fn_date_of", "events", E_KEY, lambda: {"v": F.to_date("ts")}, {"v": "CAST(ts AS DATE)"})
simple("fn_time_of", "events", E_KEY, lambda: {"v": S.clock("ts"), "s": S.second_of_day(S.clock("ts"))},
       {"v": "strftime(ts, '%H:%M:%S')", "s": "CAST(hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS INTEGER)"})
simple("fn_date_trunc", "events", E_KEY,
       lambda: {p: F.date_trunc(p, "ts").cast("timestamp_ntz") for p in ("second", "hour", "day", "week", "month")},
       {p: f"CAST(date_trunc('{p}', ts) AS TIMESTAMP)" for p in ("second", "hour", "day", "week", "month")})
simple("fn_date_part", "events", E_KEY, lambda: {"h": F.hour("ts"), "m": F.minute("ts"), "s": F.second("ts")},
       {"h": "CAST(hour(ts) AS INTEGER)", "m": "CAST(minute(ts) AS INTEGER)", "s": "CAST(second(ts) AS INTEGER)"})
simple("fn_dateadd", "events", E_KEY,
       lambda: {"a": S.date_add_units("second", 90, "ts"), "b": S.date_add_units("day", -1, "ts"), "c": S.date_add_units("month", 1, "ts")},
       {"a": "ts + INTERVAL 90 SECOND", "b": "ts - INTERVAL 1 DAY", "c": "ts + INTERVAL 1 MONTH"})


@check("fn_datediff", """SELECT o_orderkey, """ + ", ".join(f"date_diff('{p}', o_orderdate, e) AS {p}s" for p in ("day", "month", "quarter", "year")) + """,
    CAST((date_trunc('week', e)::DATE - date_trunc('week', o_orderdate)::DATE) / 7 AS BIGINT) AS weeks, date_diff('hour', o_orderdate, e) AS hours,
    date_diff('minute', o_orderdate, e) AS minutes, date_diff('second', o_orderdate, e) AS seconds
    FROM (SELECT o_orderkey, o_orderdate, o_orderdate + to_microseconds(o_custkey * 7777777777) AS e FROM orders)""")
def fn_datediff(spark, sf):
    later = F.timestamp_micros(F.unix_micros(C("o_orderdate").cast("timestamp")) + C("o_custkey") * F.lit(7777777777).cast("bigint")).cast("timestamp_ntz")
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", later.alias("e"))
    parts = ["day", "month", "quarter", "year", "week", "hour", "minute", "second"]
    return o.select("o_orderkey", *[S.date_diff_units(p, "o_orderdate", "e").alias(f"{p}s") for p in parts])


simple("fn_last_day", "orders", O_KEY, lambda: {p: S.last_day_of(p, F.to_date("o_orderdate")) for p in ("month", "quarter", "year", "week")},
       {"month": "last_day(o_orderdate)", "quarter": "CAST(date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE)",
        "year": "CAST(date_trunc('year', o_orderdate) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE)",
        "week": "CAST(date_trunc('week', o_orderdate) + INTERVAL 6 DAY AS DATE)"})
simple("fn_make_date", "orders", O_KEY, lambda: {"v": F.make_date(F.year("o_orderdate"), F.month("o_orderdate"), F.lit(1))},
       {"v": "make_date(year(o_orderdate), month(o_orderdate), 1)"})
simple("fn_to_date", "orders", O_KEY, lambda: {"v": F.to_date("o_orderdate")}, {"v": "CAST(o_orderdate AS DATE)"})
simple("fn_current_timestamp", "orders", O_KEY, lambda: {"in_past": C("o_orderdate").cast("timestamp") < F.current_timestamp()},
       {"in_past": "o_orderdate < CAST(now() AS TIMESTAMP)"})

# ---- numbers ----------------------------------------------------------------

simple("fn_arith", "orders", O_KEY, lambda: {"v": F.abs((C("o_totalprice") - 200000) * 2 + 1) / 4}, {"v": "floor((abs((o_totalprice - 200000) * 2 + 1) / 4)*1e6+0.501)/1e6"}, ["v"])


@check("fn_ln_exp", using("daily", f"SELECT asset_pair_symbol, open_date, {r('ln(close) - ln(open)', 'log_return')}, {r('exp((close - open) / greatest(close, open))', 'e')} FROM daily"))
def fn_ln_exp(spark, sf):
    df = daily(spark, sf).select(
        *DAY_KEYS, (F.ln("close") - F.ln("open")).alias("log_return"),
        F.exp((C("close") - C("open")) / F.greatest("close", "open")).alias("e"))
    return rounded(df, "log_return", "e")


@check("fn_greatest", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_linenumber = 7 THEN NULL ELSE
    greatest(l_quantity - 5, abs(l_quantity - coalesce(CASE WHEN l_linenumber > 2 THEN l_discount * 100 END, l_quantity)),
    abs(5 - coalesce(CASE WHEN l_linenumber > 2 THEN l_discount * 100 END, 5))) END AS tr FROM lineitem""")
def fn_greatest(spark, sf):
    li = table(spark, sf, "lineitem")
    high = F.when(C("l_linenumber") != 7, C("l_quantity"))
    prev = F.when(C("l_linenumber") > 2, C("l_discount") * 100)
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", X.true_range(high, F.lit(5.0), prev).alias("tr"))


simple("fn_power", "nation", ["n_nationkey"], lambda: {"v": F.pow(F.lit(2.0), C("n_nationkey"))}, {"v": "pow(2.0::DOUBLE, n_nationkey)"})
simple("fn_safe_divide", "orders", O_KEY, lambda: {"v": X.safe_divide("o_totalprice", (C("o_custkey") % 3).cast("double"))},
       {"v": "CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE o_totalprice / (o_custkey % 3) END"})
simple("fn_nullif_divide", "orders", O_KEY, lambda: {"v": C("o_totalprice") / F.nullif(C("o_custkey") % 3, F.lit(0).cast("bigint"))},
       {"v": "o_totalprice / nullif(o_custkey % 3, 0)"})
simple("fn_coalesce_nullif", "orders", O_KEY, lambda: {"v": F.coalesce(F.nullif(C("o_orderstatus"), F.lit("F")), F.lit("none"))},
       {"v": "coalesce(nullif(o_orderstatus, 'F'), 'none')"})
simple("fn_cast", "orders", O_KEY, lambda: {"i": S.cast_to(F.floor("o_totalprice"), "int"), "t": S.cast_to("o_custkey", "string"), "b": S.cast_to(C("o_custkey") % 2, "boolean")},
       {"i": "CAST(floor(o_totalprice) AS INTEGER)", "t": "CAST(o_custkey AS VARCHAR)", "b": "CAST(o_custkey % 2 AS BOOLEAN)"})
simple("fn_safe_cast", "orders", O_KEY, lambda: {"v": S.try_cast_to(F.left("o_orderpriority", F.lit(1)), "int"), "n": S.try_cast_to("o_orderpriority", "int")},
       {"v": "TRY_CAST(left(o_orderpriority, 1) AS INTEGER)", "n": "TRY_CAST(o_orderpriority AS INTEGER)"})
simple("fn_bool_to_text", "orders", O_KEY, lambda: {"v": S.bool_to_text(C("o_totalprice") > 200000)}, {"v": "CAST(o_totalprice > 200000 AS VARCHAR)"})


@check("fn_nan_to_null", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_linenumber <> 3 THEN l_quantity END AS v FROM lineitem")
def fn_nan_to_null(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("q", F.when(C("l_linenumber") == 3, F.lit(float("nan"))).otherwise(C("l_quantity")))
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", S.nan_to_null("q").alias("v"))


# ---- semi-structured --------------------------------------------------------


@check("fn_json_path", using("closed", f"SELECT {_KLINE} FROM closed"))
def fn_json_path(spark, sf):
    parsed = staging.parse_klines(kline_messages(spark, sf)).filter("is_closed")
    return rounded(parsed.select(*staging.KLINE_FIELDS, "kafka_offset"), *KLINE_FLOOR)


@check("fn_json_parse", using("topic", """SELECT kafka_offset * 4 + n - kafka_partition * 4 AS "offset", n = 3 AND kafka_offset % 10 = 1 AS is_malformed FROM topic,
    (VALUES (0), (1), (2), (3)) v(n) WHERE n < 2 OR (n = 2 AND kafka_offset % 10 = 0) OR (n = 3 AND kafka_offset % 10 IN (1, 2, 3))"""))
def fn_json_parse(spark, sf):
    return kline_messages(spark, sf).select("offset", S.parse_json("value").isNull().alias("is_malformed"))


simple("fn_json_serialize", "orders", O_KEY, lambda: {"v": S.to_message(C("o_orderkey").alias("k"), C("o_orderstatus").alias("s"))},
       {"v": "'{\"k\":' || o_orderkey || ',\"s\":\"' || o_orderstatus || '\"}'"})
simple("fn_array_construct", "orders", O_KEY, lambda: {"v": F.array_join(S.array_of([C("o_custkey"), C("o_orderkey")], "bigint"), "|")},
       {"v": "o_custkey || '|' || o_orderkey"})
simple("fn_array_append", "orders", O_KEY, lambda: {"v": F.array_join(F.array_append(F.array("o_orderstatus"), C("o_orderpriority")), "|")},
       {"v": "o_orderstatus || '|' || o_orderpriority"})
simple("fn_array_concat", "orders", O_KEY, lambda: {"v": F.array_join(F.concat(F.array("o_orderstatus"), F.array("o_orderpriority", "o_orderstatus")), "|")},
       {"v": "o_orderstatus || '|' || o_orderpriority || '|' || o_orderstatus"})
simple("fn_array_slice_join", "part", P_KEY, lambda: {"v": S.first_joined(F.split("p_name", " "), 1, ","), "w": S.first_joined(F.split(F.concat_ws(" ", "p_name", "p_type"), " "), 2, ",")},
       {"v": "split_part(p_name, ' ', 1)", "w": "split_part(p_name || ' ' || p_type, ' ', 1) || ',' || split_part(p_name || ' ' || p_type, ' ', 2)"})

# ---- user functions ---------------------------------------------------------


@check("udf_sql_scalar", "SELECT o_orderkey, CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE o_totalprice / (o_custkey % 3) END AS v FROM orders")
def udf_sql_scalar(spark, sf):
    S.create_sql_function(spark, "cw_ratio", {"num": "DOUBLE", "den": "DOUBLE"}, "DOUBLE", "try_divide(num, den)")
    return table(spark, sf, "orders").select("o_orderkey", F.expr("cw_ratio(o_totalprice, o_custkey % 3)").alias("v"))


@check("udf_expr_macros", using("crossed", f"""SELECT asset_pair_symbol, open_date, tr, atr_14, {r('price_avg_50', 'sma_50')},
    taker_buy_base_volume / nullif(base_asset_volume, 0) AS ratio, CASE WHEN ma_crossover_event LIKE 'GOLDEN%' THEN 'golden_cross'
    WHEN ma_crossover_event LIKE 'DEATH%' THEN 'death_cross' END AS crossing FROM crossed"""))
def udf_expr_macros(spark, sf):
    w = facts.series_window()
    df = facts.with_prev_close(daily(spark, sf)).withColumn("tr", X.true_range("high", "low", "prev_close"))
    df = df.withColumns({"atr_14": X.atr("tr", 14, w), "sma_50": X.sma("close", 50, w), "sma_200": X.sma("close", 200, w),
                         "ratio": X.safe_divide("taker_buy_base_volume", "base_asset_volume")})
    out = df.select(*DAY_KEYS, "tr", "atr_14", "sma_50", "ratio", X.crossover("sma_50", "sma_200", w).alias("crossing"))
    return rounded(out, "sma_50")


@check("udf_python_model", using("trades", f"SELECT pair_symbol, count(*) AS n, {r('sum(price)', 'total')} FROM trades GROUP BY 1"))
def udf_python_model(spark, sf):
    """A model is a plain function of DataFrames, resolved by name."""
    from candlewick.plans.registry import Model, Project
    from candlewick.session import scratch_path
    from candlewick.sources.refs import Refs

    refs = Refs(spark)
    refs.add_source("raw", "agg_trades", lambda: raw_trades(spark, sf))
    project = Project(spark, refs, scratch_path(spark, "models"))
    project.add(Model("totals", lambda t: t.groupBy("pair_symbol").agg(F.count("*").alias("n"), F.sum("price").alias("total")), ["stg"]))
    project.add(Model("stg", staging.stg_agg_trades, ["raw.agg_trades"], "view"))
    project.run()
    return rounded(refs.ref("totals"), "total")
