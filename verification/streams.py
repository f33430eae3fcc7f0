"""Streams over files of messages made from the given tables, run until all input is read."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from candlewick.session import scratch_path, ship
from candlewick.streaming import klines as K
from candlewick.tables.compaction import Landing
from candlewick.tables.store import Table
from verification.base import candles_1m, check, kline_messages, r, rounded, rr, using
from verification.projections import KLINE_FLOOR, _KLINE

_LANDED: dict = {}


def landed(spark, sf, shuffled=False):
    """Message files, written once per session and scale: eight files in the order of the time, or with messages
    dealt at random, so that corrections come before what they correct and candles come days late."""
    key = (spark.sparkContext.applicationId, sf, shuffled)
    if key not in _LANDED:
        path = scratch_path(spark, "messages")
        m = kline_messages(spark, sf)
        dealt = m.repartition(8, F.xxhash64("value", "offset")) if shuffled else m.repartitionByRange(8, "timestamp", "partition", "offset")
        dealt.write.parquet(path)
        _LANDED[key] = path
    return _LANDED[key]


def stream(spark, sf, max_files=None, shuffled=False):
    return K.read_files(spark, landed(spark, sf, shuffled), max_files)


def chk(spark):
    return scratch_path(spark, "checkpoint")


def appended(spark, df):
    path = scratch_path(spark, "stream_out")
    K.finish(K.append_to(df, path, chk(spark)))
    return spark.read.schema(df.schema).parquet(path)


def upserted(spark, df, keys, day_of=None):
    """The stream's table; with ``day_of`` a batch rewrites only the days it holds."""
    if day_of:
        df = df.withColumn("day", F.to_date(day_of))
    out = Table(spark, scratch_path(spark, "stream_table"), ["day"] if day_of else ())
    K.finish(K.upsert_to(df, out, [*keys, "day"] if day_of else keys, chk(spark), partition_in_key=bool(day_of)))
    return out.read().drop("day")


_ALL = """SELECT kafka_offset * 4 + n - kafka_partition * 4 AS "offset", kafka_partition AS "partition",
    epoch_us(close_time) + n * 1000000 AS micros{} FROM topic, (VALUES (0), (1), (2), (3)) v(n)
    WHERE n < 2 OR (n = 2 AND kafka_offset % 10 = 0) OR (n = 3 AND kafka_offset % 10 IN (1, 2, 3))"""
_MALFORMED = "n = 3 AND kafka_offset % 10 = 1 AS is_malformed"


def micros():
    return F.unix_micros("timestamp").alias("micros")


@check("st_source_topic", using("topic", _ALL.format(f", {_MALFORMED}, n = 1 OR n = 2 AS is_closed, CASE WHEN n < 3 THEN asset_symbol END AS symbol")))
def st_source_topic(spark, sf):
    out = appended(spark, stream(spark, sf, max_files=3))
    path = lambda p: F.get_json_object("value", p)
    symbol = F.when(path("$.data.k.o") != "abc", path("$.data.s")).alias("symbol")
    closed = F.coalesce((path("$.data.k.x") == "true"), F.lit(False)).alias("is_closed")
    return out.select("offset", "partition", micros(), (F.col("value") == "{bad").alias("is_malformed"), closed, symbol)


@check("st_filter_closed_publish", using("closed", "SELECT kafka_offset AS \"offset\", kafka_partition AS \"partition\", lower(asset_symbol) || '@kline_1m' AS stream FROM closed"))
def st_filter_closed_publish(spark, sf):
    out = appended(spark, K.closed_envelopes(stream(spark, sf)))
    return out.select("offset", "partition", F.get_json_object("value", "$.stream").alias("stream"))


@check("st_land_raw", using("topic", _ALL.format(f", {_MALFORMED}, CASE WHEN n < 3 THEN asset_symbol END AS symbol")))
def st_land_raw(spark, sf):
    """Batches wait until there are 10,000 rows, 5 MB or a minute of them; the rest is flushed at the end."""
    landing = Landing(Table(spark, scratch_path(spark, "landed")), Table(spark, scratch_path(spark, "waiting")))
    K.finish(K.land(stream(spark, sf, max_files=2), landing, chk(spark)))
    landing.flush()
    out = landing.target.read()
    path = lambda p: F.get_json_object("value", p)
    symbol = F.when(path("$.data.k.o") != "abc", path("$.data.s")).alias("symbol")
    return out.select("offset", "partition", micros(), (F.col("value") == "{bad").alias("is_malformed"), symbol)


@check("st_parse_typed", using("closed", f"SELECT {_KLINE} FROM closed"))
def st_parse_typed(spark, sf):
    return rounded(appended(spark, K.typed(stream(spark, sf))), *KLINE_FLOOR)


@check("st_bad_records", using("topic", """SELECT kafka_offset * 4 + 3 - kafka_partition * 4 AS "offset", CASE WHEN kafka_offset % 10 = 3 THEN asset_symbol ELSE 'UNKNOWN' END AS asset_symbol,
    CASE kafka_offset % 10 WHEN 1 THEN 'malformed' WHEN 2 THEN 'no candle' ELSE 'bad number' END AS reason FROM topic WHERE kafka_offset % 10 IN (1, 2, 3)"""))
def st_bad_records(spark, sf):
    return appended(spark, K.quarantine(stream(spark, sf))).select("offset", "asset_symbol", "reason")


@check("st_last_value_gauge", using("closed", f"""SELECT asset_symbol, '1m' AS "interval", open, high, low, close, {r('volume', 'volume')}, close_time, kafka_offset, kafka_partition
    FROM closed QUALIFY row_number() OVER (PARTITION BY asset_symbol ORDER BY arrived DESC, kafka_partition DESC, kafka_offset DESC) = 1"""))
def st_last_value_gauge(spark, sf):
    out = upserted(spark, K.last_values(stream(spark, sf, max_files=3, shuffled=True)), ["asset_symbol", "interval"])
    return rounded(out.drop("kafka_timestamp"), "volume")


STORED = ("open_date", "kafka_timestamp", "kafka_partition")


def _candle_table(spark, sf, runs=1, shuffled=False):
    out = Table(spark, scratch_path(spark, "streamed"), ["open_date"])
    checkpoint = chk(spark)
    for _ in range(runs):
        K.finish(K.upsert_candles(stream(spark, sf, 4, shuffled), out, checkpoint))
    return out.read().drop(*STORED)


def windowed(spark, sf, windows, max_files=4):
    """The windows that a stream of shuffled messages, corrections among them, leaves after several batches."""
    candles = Table(spark, scratch_path(spark, "candles"), ["open_date"])
    out = Table(spark, scratch_path(spark, "windows"), ["window_date"])
    K.finish(K.run_windows(stream(spark, sf, max_files, shuffled=True), windows, candles, out, chk(spark)))
    return out.read().drop("window_date")


@check("st_dedup_upsert", using("latest", f"SELECT {_KLINE} FROM latest"))
def st_dedup_upsert(spark, sf):
    return rounded(_candle_table(spark, sf, shuffled=True), *KLINE_FLOOR)


@check("st_late_correction", using("latest", f"SELECT {_KLINE} FROM latest"))
def st_late_correction(spark, sf):
    """Corrections arrive after everything else and still replace their candles."""
    out = Table(spark, scratch_path(spark, "corrected"), ["open_date"])
    checkpoint, folder = chk(spark), scratch_path(spark, "arrivals")
    messages = kline_messages(spark, sf, with_kind=True)
    late = F.col("kind") == "correction"
    for arrival in (~late, late):
        messages.filter(arrival).drop("kind").write.mode("append").parquet(folder)
        K.finish(K.upsert_candles(K.read_files(spark, folder), out, checkpoint))
    return rounded(out.read().drop(*STORED), *KLINE_FLOOR)


_H = "asset_symbol, date_trunc('hour', open_time) AS hour"


@check("st_hourly_candles", using("latest", f"""SELECT {_H}, first(open ORDER BY c.open_time) AS open, max(high) AS high, min(low) AS low, last(close ORDER BY c.close_time) AS close,
    CAST(sum(num_trades) AS BIGINT) AS num_trades, {', '.join(r(f'sum({c})', c) for c in KLINE_FLOOR)} FROM latest c GROUP BY asset_symbol, date_trunc('hour', c.open_time)"""))
def st_hourly_candles(spark, sf):
    return rounded(windowed(spark, sf, K.hourly_windows(), 3).drop("window_end"), *KLINE_FLOOR)


@check("st_periodic_run", using("latest", f"SELECT {_KLINE} FROM latest"))
def st_periodic_run(spark, sf):
    return rounded(_candle_table(spark, sf, runs=2), *KLINE_FLOOR)


def sliding_sql(length, slide, measures):
    """Every window of the length that ends on a slide step and holds a candle."""
    return using("latest", f"""SELECT asset_symbol, window_end, {measures} FROM (SELECT c.*, unnest(generate_series(
    time_bucket(INTERVAL '{slide}', open_time) + INTERVAL '{slide}', time_bucket(INTERVAL '{slide}', open_time) + INTERVAL '{length}', INTERVAL '{slide}')) AS window_end FROM latest c) x
    GROUP BY asset_symbol, window_end""")


@check("st_range_1h", sliding_sql("1 hour", "1 minute", "max(high) AS highest, min(low) AS lowest"))
def st_range_1h(spark, sf):
    return windowed(spark, sf, K.price_range())


@check("st_volatility", sliding_sql("1 hour", "1 minute", f"{r('stddev_samp(close) / nullif(avg(close), 0)', 'volatility')}, stddev_samp(close) / nullif(avg(close), 0) > 0.005::DOUBLE AS is_high"))
def st_volatility(spark, sf):
    return rounded(windowed(spark, sf, K.price_volatility()), "volatility")


_FIRST, _LAST = "first(open ORDER BY open_time)", "last(close ORDER BY open_time)"


@check("st_change_1h", sliding_sql("1 hour", "10 minutes", f"{_FIRST} AS first_price, {_LAST} AS last_price, {r(f'({_LAST} - {_FIRST}) / nullif({_FIRST}, 0) * 100', 'change_pct')}"))
def st_change_1h(spark, sf):
    out = windowed(spark, sf, K.first_last("1 hour", "10 minutes"))
    return rounded(out.drop("momentum"), "change_pct")


@check("st_momentum_10m", sliding_sql("10 minutes", "1 minute", f"{_LAST} - {_FIRST} AS momentum"))
def st_momentum_10m(spark, sf):
    out = windowed(spark, sf, K.first_last("10 minutes", "1 minute"))
    return out.select("asset_symbol", "window_end", "momentum")


@check("st_market_overview", using("latest", f"""SELECT asset_symbol, arg_max(close, open_time) AS price, {r('sum(volume)', 'volume_24h')},
    {r('(arg_max(close, open_time) - arg_min(open, open_time) FILTER (recent)) / arg_min(open, open_time) FILTER (recent) * 100', 'change_1h_pct')} FROM (
    SELECT *, open_time > newest - INTERVAL 1 HOUR AS recent FROM (SELECT *, max(open_time) OVER (PARTITION BY asset_symbol) AS newest FROM latest) l
    WHERE open_time > newest - INTERVAL 24 HOUR) x GROUP BY 1"""))
def st_market_overview(spark, sf):
    return rounded(K.market_overview(_candle_table(spark, sf)), "volume_24h", "change_1h_pct")


_VW = "OVER (PARTITION BY asset_symbol ORDER BY open_time ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"


@check("st_volume_spike", using("latest", f"SELECT asset_symbol, open_time, volume > 2 * avg(volume) {_VW} AS is_spike, {r(f'avg(volume) {_VW}', 'mean_volume')} FROM latest"))
def st_volume_spike(spark, sf):
    return rounded(K.volume_bars(_candle_table(spark, sf)).select("asset_symbol", "open_time", "is_spike", "mean_volume"), "mean_volume")


@check("st_unique_within_watermark", using("topic", """SELECT asset_symbol, open_time, open, num_trades, kafka_partition FROM topic"""))
def st_unique_within_watermark(spark, sf):
    """Each candle is stored once, whatever its lateness; which of its messages came first isn't compared."""
    out = Table(spark, scratch_path(spark, "unique"), ["open_date"])
    K.finish(K.append_new_candles(stream(spark, sf, 3, shuffled=True), out, chk(spark)))
    return out.read().select("asset_symbol", "open_time", "open", "num_trades", "kafka_partition")


@check("st_source_topic_files", using("topic", _ALL.format("")))
def st_source_topic_files(spark, sf):
    """The messages in a topic of segment files, read from its start by offsets per partition."""
    from datetime import timezone

    from candlewick.streaming import topic

    path = scratch_path(spark, "topic")
    local = path.removeprefix("file:")

    def write(pdf):
        pdf = pdf.sort_values("offset")
        messages = [(v, t.to_pydatetime().replace(tzinfo=timezone.utc)) for v, t in zip(pdf["numbered"], pdf["timestamp"])]
        topic.write_segment(local, int(pdf["partition"].iloc[0]), int(pdf["first"].iloc[0]), messages)
        return pdf[["partition"]].head(1)

    ship(spark)
    m = kline_messages(spark, sf).withColumns({"numbered": F.concat_ws("|", "offset", "value"), "part": F.floor(F.col("offset") / 2000)})
    sizes = m.groupBy("partition", "part").count()
    before = Window.partitionBy("partition").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("partition", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    rows = m.select("numbered", "timestamp", "partition", "offset", "part").join(firsts, ["partition", "part"])
    rows.groupBy("partition", "part").applyInPandas(write, "partition int").count()
    out = appended(spark, topic.read_topic_files(spark, local, "earliest"))
    number = F.substring_index("value", "|", 1).cast("bigint").alias("offset")
    return out.select(number, "partition", micros())
