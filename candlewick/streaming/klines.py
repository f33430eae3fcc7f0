"""Candle streams: sources, landing, gauges, upserts and time windows.

The parsing and the candle rules are those of the batch path. A query is started by the caller's
trigger: ``availableNow`` for a scheduled run, ``processingTime`` for a live one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from candlewick.functions import scalars as S
from candlewick.operators import blocks, joins
from candlewick.plans import staging
from candlewick.session import stage
from candlewick.sources.schemas import RAW_MESSAGE
from candlewick.tables import incremental
from candlewick.tables.compaction import Landing
from candlewick.tables.store import Table

ONCE = {"availableNow": True}


# ---- sources ----------------------------------------------------------------


def read_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Raw messages from a folder of landed files, oldest first."""
    reader = spark.readStream.schema(RAW_MESSAGE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def read_topic(
    spark: SparkSession, servers: str, topic: str, start: str = "latest", max_offsets: int | None = None
) -> DataFrame:
    """Raw messages from a topic; needs the Kafka connector on the class path."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": start}
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return (
        spark.readStream.format("kafka").options(**options).load()
        .select(F.col("value").cast("string").alias("value"), "offset", "partition", "timestamp")
    )


# ---- running ----------------------------------------------------------------


def finish(query: StreamingQuery) -> None:
    query.awaitTermination()


def append_to(df: DataFrame, path: str, checkpoint: str, trigger: dict = ONCE) -> StreamingQuery:
    """Exactly-once append to a Parquet folder."""
    return (
        df.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(**trigger).start()
    )


def land(messages: DataFrame, landing: Landing, checkpoint: str, trigger: dict = ONCE) -> StreamingQuery:
    """Exactly-once landing in few files: batches wait until there are enough rows, bytes or seconds of them."""
    return each_batch(messages, landing.take, checkpoint, "append", trigger)


def each_batch(
    df: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append", trigger: dict = ONCE
) -> StreamingQuery:
    return (
        df.writeStream.foreachBatch(apply).outputMode(mode)
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def upsert_to(
    df: DataFrame, table: Table, keys: Sequence[str], checkpoint: str, mode: str = "update", trigger: dict = ONCE,
    partition_in_key: bool = False,
) -> StreamingQuery:
    """Upsert every micro-batch. Replaying a batch after a failure changes nothing."""

    def apply(batch: DataFrame, _: int) -> None:
        incremental.load(table, batch, "merge", keys, partition_in_key=partition_in_key)

    return each_batch(df, apply, checkpoint, mode, trigger)


# ---- message handling -------------------------------------------------------


def closed_envelopes(messages: DataFrame) -> DataFrame:
    """Messages with a closed candle, passed on unchanged."""
    body = messages.withColumn("_body", S.parse_json("value"))
    return body.filter(S.json_path("_body", "$.data.k.x", "boolean")).drop("_body")


# The numbers that a candle message must have.
NUMBERS = ("open", "high", "low", "close", "volume")


def sort_out(messages: DataFrame) -> DataFrame:
    """Every message with the reason it cannot be used, NULL when it is good."""
    parsed = staging.parse_klines(messages)
    missing = F.lit(False)
    for n in NUMBERS:
        missing = missing | F.col(n).isNull()
    reason = (
        F.when(F.col("is_malformed"), "malformed")
        .when(~F.col("has_candle"), "no candle")
        .when(missing, "bad number")
    )
    return parsed.withColumns(
        {"reason": reason, "asset_symbol": F.coalesce("asset_symbol", F.lit("UNKNOWN"))}
    )


def quarantine(messages: DataFrame) -> DataFrame:
    bad = sort_out(messages).filter(F.col("reason").isNotNull())
    return bad.select("offset", "asset_symbol", "reason", "value")


def typed(messages: DataFrame) -> DataFrame:
    return staging.stg_klines(messages)


# ---- last values ------------------------------------------------------------

# Names of the last-value gauges.
GAUGES = ("open", "high", "low", "close", "volume", "close_time")


def last_values(messages: DataFrame) -> DataFrame:
    """Newest values per (symbol, interval); the last arrival wins.

    Arrivals are ordered by message time, topic partition and offset: an offset alone counts within its partition.
    State is one row per series, and a map-side partial keeps one row per series and task.
    """
    good = sort_out(messages).filter(F.col("reason").isNull())
    interval = S.json_path(S.parse_json("value"), "$.data.k.i", "string")
    rows = good.withColumn("interval", interval)
    known = [F.coalesce(F.col(c), F.lit(least).cast(kind)) for c, kind, least in (
        ("kafka_timestamp", "timestamp", "0001-01-01"), ("kafka_partition", "int", -1), ("kafka_offset", "bigint", -1))]
    picked = F.max_by(F.struct(*GAUGES, *staging.COORDINATES), F.struct(*known)).alias("_last")
    last = rows.groupBy("asset_symbol", "interval").agg(picked)
    return last.select("asset_symbol", "interval", "_last.*")


# ---- upserts ----------------------------------------------------------------


def store_candles(batch: DataFrame, table: Table) -> DataFrame:
    """Brings a batch of messages into the candle table; the keys (symbol, open time) that it holds.

    The newest message of a candle wins, whether it arrives first or last and however late; the table is partitioned
    by the day of the open time, and the days of the batch alone are read and written.
    """
    newest = staging.newest_candles(staging.stg_klines(batch, coordinates=True))
    rows = stage(newest.withColumn("open_date", F.to_date("open_time")), "candles")
    if not table.exists():
        table.replace(rows)
    else:
        touched = table.partitions(rows)
        if touched:
            both = table.only(touched).unionByName(rows)
            table.replace_partitions(staging.newest_candles(both), touched)
    return rows.select("asset_symbol", "open_time")


def upsert_candles(messages: DataFrame, table: Table, checkpoint: str, trigger: dict = ONCE) -> StreamingQuery:
    """Closed candles by (symbol, open time), the newest message of each.

    There is no lateness bound: a correction of any age replaces its candle. A replay changes nothing.
    """

    def apply(batch: DataFrame, _: int) -> None:
        store_candles(batch, table)

    return each_batch(messages, apply, checkpoint, "append", trigger)


def append_new_candles(messages: DataFrame, table: Table, checkpoint: str, trigger: dict = ONCE) -> StreamingQuery:
    """Closed candles, each stored once: the first batch that holds a candle decides, however late it comes.

    The table is partitioned by the day of the open time; only keys of the batch's days are compared.
    """

    def apply(batch: DataFrame, _: int) -> None:
        newest = staging.newest_candles(staging.stg_klines(batch, coordinates=True))
        rows = stage(newest.withColumn("open_date", F.to_date("open_time")), "candles")
        if not table.exists():
            table.replace(rows)
        elif touched := table.partitions(rows):
            table.append(joins.absent(rows, table.only(touched), ["asset_symbol", "open_time"]))

    return each_batch(messages, apply, checkpoint, "append", trigger)


# ---- time windows -----------------------------------------------------------


@dataclass(frozen=True)
class Windows:
    """Time windows over stored candles: length, slide, what is measured, and the columns made of it."""

    length: str
    slide: str
    measures: Sequence[Column]
    finish: Callable[[DataFrame], DataFrame] = lambda df: df
    days: int = 1  # whole days that a window may reach to either side of a candle's day

    def keyed(self, candles: DataFrame) -> DataFrame:
        """Each candle once per window that holds it; a window is named by its end."""
        at = F.window(F.col("open_time").cast("timestamp"), self.length, self.slide)
        return candles.withColumn("_w", at).withColumn("window_end", F.col("_w.end").cast("timestamp_ntz")).drop("_w")

    def of(self, candles: DataFrame, changed: DataFrame | None = None) -> DataFrame:
        """All windows of the candles, or those that hold a changed candle."""
        rows = self.keyed(candles)
        if changed is not None:
            touched = self.keyed(changed).select("asset_symbol", "window_end").distinct()
            rows = rows.join(touched, ["asset_symbol", "window_end"], "left_semi")
        return self.finish(rows.groupBy("asset_symbol", "window_end").agg(*self.measures))


#: Panes of a block of sliding windows: the most that one task orders at once for one series.
BLOCK_PANES = 40_320
# Seconds of the units of a length.
UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86_400}


def seconds_of(length: str) -> int:
    number, unit = length.split()
    return int(number) * UNITS[unit.rstrip("s")]


@dataclass(frozen=True)
class SlidingWindows:
    """Windows that overlap, by panes: the stretches between two window ends.

    Each candle enters one pane. A pane keeps a partial state (``states``: an aggregate function and its input); a
    window combines the states of its panes (``measures`` over a frame of panes). A series is cut into blocks of
    BLOCK_PANES, whose last panes are also given to the next block, so frames are whole; candles of other panes are
    shuffled once. Windows that end in a gap exist as long as they hold a candle.
    """

    length: str
    slide: str
    states: dict[str, tuple[Callable, Column]]
    measures: Callable[[WindowSpec], dict[str, Column]]
    finish: Callable[[DataFrame], DataFrame] = lambda df: df
    days: int = 1  # whole days that a window may reach to either side of a candle's day

    def of(self, candles: DataFrame, changed: DataFrame | None = None, block_panes: int = BLOCK_PANES) -> DataFrame:
        """All windows of the candles, or those that hold a changed candle."""
        slide = seconds_of(self.slide)
        reach, rest = divmod(seconds_of(self.length), slide)
        if rest:
            raise ValueError(f"a window of {self.length} is no multiple of {self.slide}")
        rows = candles.withColumn("_changed", F.lit(False))
        if changed is not None:
            marks = changed.select("asset_symbol", "open_time", F.lit(True).alias("_changed"))
            rows = rows.unionByName(marks, allowMissingColumns=True)
        pane = F.floor(F.unix_seconds(F.col("open_time").cast("timestamp")) / slide).cast("bigint")
        rows = rows.withColumn("_pane", pane).filter(F.col("_pane").isNotNull())
        own = F.floor(F.col("_pane") / block_panes).cast("bigint")
        if reach > 1:
            late = F.pmod("_pane", F.lit(block_panes)) > block_panes - reach
            rows = rows.withColumn("_block", F.explode(F.when(late, F.array(own, own + 1)).otherwise(F.array(own))))
        else:
            rows = rows.withColumn("_block", own)
        # one exchange: the panes and the frames over them are grouped inside its partitions
        block = ["asset_symbol", "_block"]
        states = [f(F.when(~F.col("_changed"), c)).alias(f"_{n}") for n, (f, c) in self.states.items()]
        panes = rows.repartition(*block).groupBy(*block, "_pane").agg(*states, F.max("_changed").alias("_changed"))
        along = Window.partitionBy(*block).orderBy("_pane")
        until = F.least(F.coalesce(F.lead("_pane").over(along) - 1, F.col("_pane") + reach - 1), F.col("_pane") + reach - 1)
        ends = panes.withColumn("_until", until).withColumn("_at", F.explode(F.sequence("_pane", "_until")))
        alone = F.col("_at") == F.col("_pane")
        ends = ends.withColumns({c: F.when(alone, F.col(c)) for c in [*[f"_{n}" for n in self.states], "_changed"]})
        frame = Window.partitionBy(*block).orderBy("_at").rangeBetween(-(reach - 1), 0)
        out = ends.withColumns(self.measures(frame) | {"_touched": F.max("_changed").over(frame)})
        out = out.filter(F.floor(F.col("_at") / block_panes) == F.col("_block"))
        if changed is not None:
            out = out.filter("_touched")
        out = out.withColumn("window_end", F.timestamp_seconds((F.col("_at") + 1) * slide).cast("timestamp_ntz"))
        helpers = [*[f"_{n}" for n in self.states], "_changed", "_touched", "_block", "_pane", "_until", "_at"]
        return self.finish(out.drop(*helpers))


def run_windows(
    messages: DataFrame, windows: Windows | SlidingWindows, candles: Table, out: Table, checkpoint: str, trigger: dict = ONCE
) -> StreamingQuery:
    """Keeps a table of windows up to date with a candle table.

    Each batch first enters the candle table; then the windows that hold one of its candles are computed again from
    the stored candles. A superseded candle is never counted, a late one always is, and a replay gives the same
    rows. ``out`` is partitioned by ``window_date``; only the days around the batch's candles are read.
    """

    def apply(batch: DataFrame, _: int) -> None:
        changed = store_candles(batch, candles)
        days = {date.fromisoformat(r.d) for r in changed.select(F.to_date("open_time").cast("string").alias("d")).distinct().collect() if r.d}
        around = {(str(d + timedelta(days=k)),) for d in days for k in range(-windows.days, windows.days + 1)}
        rows = windows.of(candles.only(around), changed).withColumn("window_date", F.to_date("window_end"))
        incremental.load(out, rows, "merge", ["asset_symbol", "window_end", "window_date"], partition_in_key=True)

    return each_batch(messages, apply, checkpoint, "append", trigger)


def hourly_windows() -> Windows:
    """Minute candles to hours; the windowed form of the batch roll-up."""
    sums = ["volume", "quote_asset_volume", "num_trades", "taker_buy_base_volume", "taker_buy_quote_volume"]
    measures = [
        F.min_by("open", "open_time").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "close_time").alias("close"),
        *[F.sum(c).alias(c) for c in sums],
    ]
    start = F.col("window_end") - F.expr("interval 1 hour")
    return Windows("1 hour", "1 hour", measures, lambda df: df.withColumn("hour", start))


def price_range(slide: str = "1 minute") -> SlidingWindows:
    """Highest and lowest price of the last hour."""
    states = {"high": (F.max, F.col("high")), "low": (F.min, F.col("low"))}
    return SlidingWindows("1 hour", slide, states, lambda w: {"highest": F.max("_high").over(w), "lowest": F.min("_low").over(w)})


def price_volatility(slide: str = "1 minute", high_above: float = 0.005) -> SlidingWindows:
    """Stddev of the close over its mean in the last hour, and whether it is high.

    Panes keep count, mean and variance. They are combined as differences to the mean of the window's block, so
    nothing is lost by subtracting large squares.
    """
    states = {"n": (F.count, F.col("close")), "mean": (F.avg, F.col("close")), "var": (F.var_pop, F.col("close"))}

    def measures(w):
        whole = F.avg("_mean").over(Window.partitionBy("asset_symbol", "_block"))
        off = F.col("_mean") - whole
        n, first = F.sum("_n").over(w), F.sum(F.col("_n") * off).over(w)
        second = F.sum(F.col("_n") * (F.col("_var") + off * off)).over(w)
        sd = F.when(n > 1, F.sqrt(F.greatest(second - first * first / n, F.lit(0.0)) / (n - 1)))
        return {"_sd": sd, "_window_mean": F.try_divide(F.sum(F.col("_n") * F.col("_mean")).over(w), n)}

    ratio = F.try_divide("_sd", "_window_mean")
    return SlidingWindows(
        "1 hour", slide, states, measures,
        lambda df: df.select("asset_symbol", "window_end", ratio.alias("volatility"), (ratio > high_above).alias("is_high")),
    )


def first_last(length: str, slide: str) -> SlidingWindows:
    """First and last price of a sliding window and their difference."""
    states = {"first": (F.min, F.struct("open_time", "open")), "last": (F.max, F.struct("open_time", "close"))}
    change = F.col("last_price") - F.col("first_price")
    return SlidingWindows(
        length, slide, states,
        lambda w: {"first_price": F.min("_first").over(w)["open"], "last_price": F.max("_last").over(w)["close"]},
        lambda df: df.withColumns({"momentum": change, "change_pct": F.try_divide(change, F.col("first_price")) * 100}),
    )


def market_overview(candles: DataFrame) -> DataFrame:
    """Per coin from stored candles: newest price, change against an hour ago, volume of 24 hours."""
    newest = stage(candles.groupBy("asset_symbol").agg(F.max("open_time").alias("_at")), "newest")
    least = newest.agg(F.min("_at")).first()[0]
    if least is not None:  # a literal bound: older candles aren't read
        candles = candles.filter(F.col("open_time") > F.lit(least - timedelta(hours=24)).cast(candles.schema["open_time"].dataType))
    df = joins.lookup_join(candles, newest, ["asset_symbol"], "inner")
    age = lambda h: F.col("open_time") > F.col("_at") - F.expr(f"interval {h} hours")
    last_hour = age(1)
    out = df.filter(age(24)).groupBy("asset_symbol").agg(
        F.max_by("close", "open_time").alias("price"),
        F.min_by("open", F.when(last_hour, F.col("open_time"))).alias("_hour_ago"),
        F.sum("volume").alias("volume_24h"),
    )
    change = F.try_divide(F.col("price") - F.col("_hour_ago"), F.col("_hour_ago")) * 100
    return out.select("asset_symbol", "price", change.alias("change_1h_pct"), "volume_24h")


def volume_bars(candles: DataFrame, n: int = 20, factor: float = 2) -> DataFrame:
    """Volume of stored minute candles against the mean of the last n, in blocks of a day per coin."""
    day = F.unix_date(F.to_date("open_time")).cast("bigint")
    minute = F.floor(F.unix_seconds(F.col("open_time").cast("timestamp")) / 60)
    series = blocks.Series(("asset_symbol",), ("open_time",), (F.floor(day / 28), day, minute))

    def build(w):
        mean = F.avg("volume").over(w.rowsBetween(-(n - 1), 0))
        return {"mean_volume": mean, "is_spike": F.col("volume") > mean * factor}

    # a day holds at most 1440 minute candles of a coin
    return blocks.over_series(candles, series, n - 1, build, level=1, stored=True)
