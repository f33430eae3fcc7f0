"""Message parsing, the upsert path and stream against batch."""

import datetime as dt
import json
import random
import statistics

import pytest
from pyspark.sql import functions as F

from candlewick.plans import staging
from candlewick.session import scratch_path
from candlewick.streaming import klines as K
from candlewick.tables.store import Table


def message(symbol="AUSDT", t=1704067200000, closed=True, **k):
    body = {"t": t, "T": t + 59999, "s": symbol, "i": "1m", "o": "1.5", "c": "2", "h": "3", "l": "1", "v": "10", "n": 4, "x": closed,
            "q": "20", "V": "5", "Q": "9", "B": "0", **k}
    return json.dumps({"stream": "s", "data": {"e": "kline", "s": symbol, "k": body}})


def raw(spark, values):
    return spark.createDataFrame([(v, i) for i, v in enumerate(values)], "value string, offset bigint")


def test_case_sensitive_fields(spark):
    r = staging.stg_klines(raw(spark, [message()])).collect()[0]
    assert (r.volume, r.taker_buy_base_volume, r.quote_asset_volume, r.taker_buy_quote_volume) == (10.0, 5.0, 20.0, 9.0)
    assert str(r.open_time) == "2024-01-01 00:00:00" and str(r.close_time) == "2024-01-01 00:00:59.999000"


def test_only_closed(spark):
    values = [message(closed=False), message(), "{bad", '{"data":{}}', "null", ""]
    assert staging.stg_klines(raw(spark, values)).count() == 1
    assert K.closed_envelopes(raw(spark, values)).collect()[0].value == message()


def test_reasons(spark):
    values = [message(), "{bad", '{"data":{"e":"x"}}', message(o="abc"), message(h=None)]
    got = {r.offset: (r.reason, r.asset_symbol) for r in K.quarantine(raw(spark, values)).collect()}
    assert got == {1: ("malformed", "UNKNOWN"), 2: ("no candle", "UNKNOWN"), 3: ("bad number", "AUSDT"), 4: ("bad number", "AUSDT")}


def test_last_arrival_wins(spark):
    values = [message(c="1"), message(c="7", t=1704067260000), message(c="5")]
    r = K.last_values(raw(spark, values)).collect()
    assert len(r) == 1 and r[0].close == 5.0 and r[0].kafka_offset == 2


def test_upsert_replay_and_correction(spark):
    folder, checkpoint = scratch_path(spark, "in"), scratch_path(spark, "chk")
    out = Table(spark, scratch_path(spark, "candles"), ["open_date"])
    day = 86_400_000
    first = [message(), message(t=1704067200000 + day), message(c="4")]
    raw(spark, first).write.mode("append").parquet(folder)
    K.finish(K.upsert_candles(K.read_files(spark, folder), out, checkpoint))
    assert sorted(r.close for r in out.read().collect()) == [2.0, 4.0]
    late = raw(spark, [message(c="9")]).withColumn("offset", F.col("offset") + 100)
    late.write.mode("append").parquet(folder)
    for _ in range(2):
        K.finish(K.upsert_candles(K.read_files(spark, folder), out, checkpoint))
    assert sorted(r.close for r in out.read().collect()) == [2.0, 9.0]
    # a restart without its checkpoint replays everything and ends in the same rows
    K.finish(K.upsert_candles(K.read_files(spark, folder), out, scratch_path(spark, "chk")))
    assert sorted(r.close for r in out.read().collect()) == [2.0, 9.0]


def in_two_partitions(spark, rows):
    """(value, offset, partition, seconds): offsets count within a partition."""
    df = spark.createDataFrame(rows, "value string, offset bigint, partition int, s bigint")
    return df.withColumn("timestamp", F.timestamp_seconds("s")).drop("s")


def test_newest_across_partitions(spark):
    rows = [(message(c="1"), 900, 0, 10), (message(c="2"), 3, 1, 20), (message("BUSDT", c="5"), 3, 0, 5), (message("BUSDT", c="6"), 3, 1, 5)]
    df = in_two_partitions(spark, rows)
    got = {r.asset_symbol: r.close for r in K.last_values(df).collect()}
    assert got == {"AUSDT": 2.0, "BUSDT": 6.0}
    newest = staging.streamed_ohlcv(staging.stg_klines(df, coordinates=True))
    assert {r.asset_symbol: r.close for r in newest.collect()} == got


def test_marks_per_partition(spark):
    first = in_two_partitions(spark, [(message("AUSDT"), 100, 0, 1), (message("BUSDT"), 2, 1, 1)])
    stored = staging.streamed_ohlcv(staging.stg_klines(first, coordinates=True))
    more = first.unionByName(in_two_partitions(spark, [(message("BUSDT", t=1704067260000), 3, 1, 2), (message("CUSDT"), 1, 2, 2)]))
    new = staging.streamed_ohlcv(staging.stg_klines(more, coordinates=True), stored)
    assert sorted((r.asset_symbol, r.kafka_offset) for r in new.collect()) == [("BUSDT", 3), ("CUSDT", 1)]


def test_topic_source_keeps_coordinates(monkeypatch):
    """Without a broker: the options of the reader and the columns taken from what it delivers."""
    seen = {}

    class Reader:
        def format(self, name):
            seen["format"] = name
            return self

        def options(self, **options):
            seen.update(options)
            return self

        def load(self):
            return self

        def select(self, *columns):
            return [c if isinstance(c, str) else c._jc.toString() for c in columns]

    spark = type("Session", (), {"readStream": Reader()})()
    columns = K.read_topic(spark, "broker:9092", "klines", "earliest", 500)
    assert columns[1:] == ["offset", "partition", "timestamp"] and "value" in columns[0]
    assert seen == {"format": "kafka", "kafka.bootstrap.servers": "broker:9092", "subscribe": "klines", "startingOffsets": "earliest", "maxOffsetsPerTrigger": "500"}


def test_windows_with_late_and_superseded_candles(spark):
    folder, checkpoint = scratch_path(spark, "in"), scratch_path(spark, "chk")
    candles, out = Table(spark, scratch_path(spark, "c"), ["open_date"]), Table(spark, scratch_path(spark, "w"), ["window_date"])
    hour, t0 = 3_600_000, 1704067200000
    arrivals = [
        [(message(t=t0 + 40 * hour, v="3"), 5, 0, 50)],  # far ahead of what follows
        [(message(t=t0, v="10"), 6, 0, 60), (message(t=t0 + 60_000, v="1"), 7, 0, 61)],
        [(message(t=t0, v="7"), 9, 0, 70), (message(t=t0, v="99"), 1, 0, 10)],  # a correction, and an older message after it
    ]
    for rows in arrivals:
        in_two_partitions(spark, rows).write.mode("append").parquet(folder)
        K.finish(K.run_windows(K.read_files(spark, folder), K.hourly_windows(), candles, out, checkpoint))
    want = [("2024-01-01 00:00:00", 8.0, 8), ("2024-01-02 16:00:00", 3.0, 4)]
    got = lambda: sorted((str(r.hour), r.volume, r.num_trades) for r in out.read().collect())
    assert got() == want
    # everything again without the checkpoint: the same rows
    K.finish(K.run_windows(K.read_files(spark, folder), K.hourly_windows(), candles, out, scratch_path(spark, "chk")))
    assert got() == want
    assert sorted(r.volume for r in K.hourly_windows().of(candles.read()).collect()) == [3.0, 8.0]


# ---- sliding windows by panes -----------------------------------------------


def candle_rows(seed, n=300):
    """Candles with gaps, some inside one minute, a series that never changes, prices far above their moves."""
    rng, out, start = random.Random(seed), [], dt.datetime(2024, 1, 31, 20)
    for symbol in ("A", "B"):
        for s in sorted(rng.sample(range(0, 40_000 if symbol == "A" else 400_000, 15), n)):
            p = 1e5 + rng.random()
            out.append((symbol, start + dt.timedelta(seconds=s), p, p + 1, p - 1, p + rng.random()))
    return out + [("C", start + dt.timedelta(minutes=i), 3.0, 3.0, 3.0, 3.0) for i in range(5)]


def windows_plain(rows, length, slide):
    out = {}
    for r in rows:
        t = (r[1] - dt.datetime(1970, 1, 1)).total_seconds()
        end = (t // slide + 1) * slide
        while end - length <= t:
            out.setdefault((r[0], dt.datetime(1970, 1, 1) + dt.timedelta(seconds=end)), []).append(r)
            end += slide
    return {k: sorted(v) for k, v in out.items()}


CANDLES = "asset_symbol string, open_time timestamp_ntz, open double, high double, low double, close double"


@pytest.mark.parametrize("block", [40_320, 60, 61, 100])
def test_sliding_windows(spark, block):
    rows = candle_rows(block)
    df = spark.createDataFrame(rows, CANDLES).repartition(3)
    want = windows_plain(rows, 3600, 60)
    got = {(r.asset_symbol, r.window_end): r for r in K.price_range().of(df, block_panes=block).collect()}
    assert got.keys() == want.keys()
    assert all((got[k].highest, got[k].lowest) == (max(r[3] for r in v), min(r[4] for r in v)) for k, v in want.items())
    spread = {(r.asset_symbol, r.window_end): r.volatility for r in K.price_volatility().of(df, block_panes=block).collect()}
    assert spread.keys() == want.keys()
    for k, v in want.items():
        closes = [r[5] for r in v]
        if len(v) == 1:
            assert spread[k] is None
        else:
            assert spread[k] == pytest.approx(statistics.stdev(closes) / statistics.mean(closes), rel=1e-6, abs=1e-12)


@pytest.mark.parametrize(("length", "slide", "seconds", "step"), [("10 minutes", "1 minute", 600, 60), ("1 hour", "10 minutes", 3600, 600), ("1 minute", "1 minute", 60, 60)])
def test_first_and_last_of_sliding_windows(spark, length, slide, seconds, step):
    rows = candle_rows(5)
    got = K.first_last(length, slide).of(spark.createDataFrame(rows, CANDLES), block_panes=70).collect()
    want = windows_plain(rows, seconds, step)
    assert {(r.asset_symbol, r.window_end): (r.first_price, r.last_price) for r in got} == {k: (v[0][2], v[-1][5]) for k, v in want.items()}


@pytest.mark.parametrize("block", [40_320, 60])
def test_windows_of_changed_candles(spark, block):
    rows = candle_rows(9)
    df = spark.createDataFrame(rows, CANDLES)
    changed = [(r[0], r[1]) for r in rows[::37]] + [("C", rows[-1][1])]
    keys = spark.createDataFrame(changed, "asset_symbol string, open_time timestamp_ntz")
    got = K.price_range().of(df, keys, block)
    want = {k for k, v in windows_plain(rows, 3600, 60).items() if {(r[0], r[1]) for r in v} & set(changed)}
    assert {(r.asset_symbol, r.window_end) for r in got.collect()} == want and got.columns == ["asset_symbol", "highest", "lowest", "window_end"]


def test_candles_are_shuffled_once(spark):
    """Of a dense series only the last panes of a block are copied: one exchange, as many rows as candles and those."""
    start = dt.datetime(2024, 1, 1)
    rows = [("A", start + dt.timedelta(minutes=i), 1.0, 1.0, 1.0, 1.0) for i in range(4000)]
    out = K.price_range().of(spark.createDataFrame(rows, CANDLES))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    before = out._jdf.queryExecution().analyzed().collectLeaves()
    assert before.size() == 1 and out.count() == 4000 + 59


def test_window_lengths_must_fit(spark):
    with pytest.raises(ValueError, match="no multiple"):
        K.first_last("1 hour", "7 minutes").of(spark.createDataFrame([], CANDLES))
    assert K.first_last("1 hour", "1 minute").of(spark.createDataFrame([], CANDLES)).collect() == []
