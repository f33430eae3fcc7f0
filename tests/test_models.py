"""The model project, and every checked query at the smallest scale."""

import os

import duckdb
import pytest

import verification
from candlewick.plans import registry
from candlewick.session import scratch_path
from candlewick.sources.refs import Refs
from verification import base

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, ORACLES = verification.load()


@pytest.fixture(scope="module")
def db(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


def plain(v):
    return str(int(v)) if isinstance(v, float) and v == int(v) and abs(v) < 1e15 else str(v)


def ordered(rows):
    return sorted(tuple(plain(v) for v in r) for r in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


# a cross-section by default; CHECK_ALL=1 runs every query (so does tools_check.py at any scale)
SOME = """candles_hourly_from_stream candles_unified fct_ohlcv_hourly fct_trades fct_ohlcv_daily market_daily_wide
    liquidity_daily mart_market_share mart_time_between_trades mart_volatility_7 mart_large_trades join_anti_not_in
    join_asof_scd2 agg_listagg win_dedup_arbitrary src_json_array_rows inc_merge_partitioned inc_schema_sync
    scd2_hard_delete_new_record dq_relationships st_hourly_candles ind_macd ind_order_flow_streak""".split()


@pytest.mark.parametrize("name", sorted(QUERIES) if os.environ.get("CHECK_ALL") else SOME)
def test_query_matches_sql(spark, sf, db, name):
    got = QUERIES[name](spark, sf)
    columns = sorted(got.columns)
    cur = db.execute(ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    want = [tuple(r[i] for i in at) for r in cur.fetchall()]
    assert ordered(got.select(*columns).collect()) == ordered(want)


def test_project_builds_and_reruns(spark, sf):
    from verification.models import bronze_ohlcv

    refs = Refs(spark)
    refs.add_source("raw", "agg_trades", lambda: base.raw_trades(spark, sf))
    refs.add_source("raw", "scd_raw_assets", lambda: base.scd_assets(spark, sf))
    refs.add_source("raw", "kline", lambda: base.kline_messages(spark, sf))
    refs.add_source("raw", "ohlcv", lambda: bronze_ohlcv(spark, sf))
    project = registry.market_models(spark, refs, scratch_path(spark, "project"), base.CAL_START, base.CAL_END)
    order = project.run()
    assert order.index("stg_ohlcv") < order.index("ohlcv_fct") < order.index("fct_ohlcv_daily") < order.index("vw_gold_market_daily")
    counts = {n: refs.ref(n).count() for n in ("streamed_ohlcv", "ohlcv_fct", "trades_fct", "fct_technical_daily", "fct_liquidity_daily", "vw_gold_market_daily")}
    assert counts["trades_fct"] == base.raw_trades(spark, sf).count()
    assert counts["fct_technical_daily"] == counts["fct_liquidity_daily"] == counts["vw_gold_market_daily"]
    before = refs.ref("fct_technical_daily").select("technical_sk", "price_avg_200").collect()
    project.run()  # nothing new: the incremental models keep their rows
    assert {n: refs.ref(n).count() for n in counts} == counts
    assert sorted(before) == sorted(refs.ref("fct_technical_daily").select("technical_sk", "price_avg_200").collect())


def test_unknown_names(spark):
    refs = Refs(spark)
    with pytest.raises(KeyError):
        refs.ref("nothing")
    with pytest.raises(KeyError):
        refs.source("raw", "nothing")


def test_trades_outside_the_calendar_are_refused(spark, sf):
    from verification.models import bronze_ohlcv

    refs = Refs(spark)
    refs.add_source("raw", "agg_trades", lambda: base.raw_trades(spark, sf))
    refs.add_source("raw", "scd_raw_assets", lambda: base.scd_assets(spark, sf))
    refs.add_source("raw", "kline", lambda: base.kline_messages(spark, sf))
    refs.add_source("raw", "ohlcv", lambda: bronze_ohlcv(spark, sf))
    project = registry.market_models(spark, refs, scratch_path(spark, "short"), base.CAL_START, "2024-01-05")
    with pytest.raises(registry.CheckFailed, match="trades_fct"):
        project.run()
