"""Block windows equal plain windows, whatever the block level."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from candlewick.functions import expressions as X
from candlewick.operators import blocks
from candlewick.plans import indicators, marts


def trades(spark, n=400):
    """A hot pair with four fifths of all rows, equal seconds, gaps of days, month ends."""
    rng = random.Random(7)
    rows = []
    for i in range(n):
        pair = "HOTUSDT" if rng.random() < 0.8 else rng.choice(["AUSDT", "BUSDT"])
        day = rng.choice(["2024-01-30", "2024-01-31", "2024-02-01", "2024-02-29", "2024-03-01"])
        clock = rng.choice(["00:00:00", "00:00:01", "00:59:59", "12:30:00", "12:30:01", "23:59:59"])
        rows.append((i, pair, day, clock, float(rng.randint(1, 50)), float(rng.randint(0, 9))))
    schema = "agg_trade_id bigint, pair_symbol string, transaction_date string, transaction_time string, price double, quantity double"
    df = spark.createDataFrame(rows, schema)
    return df.withColumn("transaction_date", F.to_date("transaction_date"))


def whole():
    return Window.partitionBy("pair_symbol").orderBy("transaction_date", "transaction_time", "agg_trade_id")


@pytest.mark.parametrize("level", [0, 1, 2, 3, 4])
def test_rolling_frame_at_every_level(spark, level):
    t = trades(spark)
    got = marts.volatility_rows(t, 7, level)
    want = t.select("agg_trade_id", F.stddev_samp("price").over(whole().rowsBetween(-6, 0)).alias("want"))
    both = got.join(want, "agg_trade_id")
    assert got.count() == t.count() == both.count()
    assert both.filter(~F.round("volatility_7_day", 9).eqNullSafe(F.round("want", 9))).count() == 0


@pytest.mark.parametrize("level", [0, 2, 4])
def test_lag_at_every_level(spark, level):
    t = trades(spark)
    got = indicators.trade_gaps(t, level).select("agg_trade_id", "gap_seconds")
    at = indicators.at_second(t)
    want = at.select("agg_trade_id", (F.col("at") - F.lag("at").over(whole())).alias("want"))
    assert got.join(want, "agg_trade_id").filter(~F.col("gap_seconds").eqNullSafe(F.col("want"))).count() == 0


@pytest.mark.parametrize("level", [1, 3, 4])
def test_streaks(spark, level):
    t = trades(spark)
    side = F.when(F.col("quantity") > 4, "buy").otherwise("sell")
    got = indicators.flow_streaks(t, side, level)
    marked = t.withColumn("side", side).withColumn("c", F.when(F.lag("side").over(whole()).eqNullSafe(F.col("side")), 0).otherwise(1))
    runs = marked.withColumn("run", F.sum("c").over(whole())).groupBy("pair_symbol", "run", "side").agg(F.count("*").alias("n"))
    both = got.join(runs, ["pair_symbol", "run", "side"], "full")
    assert both.filter(~F.col("trades").eqNullSafe(F.col("n"))).count() == 0


def test_level_is_chosen_by_counted_size(spark):
    t = marts.with_clock_seconds(trades(spark))
    series = blocks.trade_series()
    assert blocks.pick_level(t, series, 10_000) == 0
    assert blocks.pick_level(t, series, 40) > 1
    assert blocks.pick_level(t, series, 1) == len(series.levels) - 1


def test_tails_are_limited_before_the_shuffle(spark):
    t = marts.with_clock_seconds(trades(spark))
    df = blocks.with_lookback(t, blocks.trade_series(), 6, 1)
    assert "Partial" in df._jdf.queryExecution().executedPlan().toString()


def test_small_ids_per_block(spark):
    t = marts.with_clock_seconds(trades(spark))
    series = blocks.trade_series(ids_per_block=16)
    got = blocks.over_series(t, series, 3, lambda w: {"m": X.sma("price", 4, w)}, level=4)
    want = t.select("agg_trade_id", F.avg("price").over(whole().rowsBetween(-3, 0)).alias("want"))
    assert got.join(want, "agg_trade_id").filter(F.abs(F.col("m") - F.col("want")) > 1e-9).count() == 0


def test_many_small_blocks(spark):
    """Thousands of blocks of one pair: tails and offsets are cut in steps, down to seconds."""
    t = spark.range(4000).select(
        F.col("id").alias("agg_trade_id"), F.lit("HOTUSDT").alias("pair_symbol"),
        F.date_add(F.lit("2024-01-01"), (F.col("id") / 500).cast("int")).alias("transaction_date"),
        F.date_format(F.timestamp_seconds(F.col("id") % 500 * 37), "HH:mm:ss").alias("transaction_time"),
        (F.col("id") * 7 % 31).cast("double").alias("price"), (F.col("id") % 9).cast("double").alias("quantity"))
    for level in (3, 4):
        got = marts.volatility_rows(t, 7, level)
        want = t.select("agg_trade_id", F.stddev_samp("price").over(whole().rowsBetween(-6, 0)).alias("want"))
        both = got.join(want, "agg_trade_id")
        assert both.count() == 4000 and both.filter(~F.round("volatility_7_day", 9).eqNullSafe(F.round("want", 9))).count() == 0
    runs = indicators.flow_streaks(t, F.when(F.col("quantity") > 4, "buy").otherwise("sell"), 4)
    assert runs.agg(F.sum("trades")).first()[0] == 4000 and runs.count() == runs.select("run").distinct().count()
    assert runs.agg(F.max("run")).first()[0] == runs.count()
