"""Silver layer: typed trades, assets, stream candles and the unified hourly candles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.functions import expressions as X
from candlewick.functions import scalars as S
from candlewick.operators import dedup
from candlewick.tables import incremental

# Message fields below the candle object. Case matters.
KLINE_FIELDS = {
    "asset_symbol": ("s", "string"),
    "open_time": ("t", "bigint"),
    "open": ("o", "double"),
    "high": ("h", "double"),
    "low": ("l", "double"),
    "close": ("c", "double"),
    "volume": ("v", "double"),
    "close_time": ("T", "bigint"),
    "quote_asset_volume": ("q", "double"),
    "num_trades": ("n", "bigint"),
    "taker_buy_base_volume": ("V", "double"),
    "taker_buy_quote_volume": ("Q", "double"),
    "ignore": ("B", "string"),
}
#: Where a candle's message stands in its topic; newest first means by time, then partition, then offset.
COORDINATES = ["kafka_timestamp", "kafka_partition", "kafka_offset"]
SUMMED = ["base_asset_volume", "quote_asset_volume", "num_trades", "taker_buy_base_volume", "taker_buy_quote_volume"]
CANDLE_KEYS = ["asset_pair_symbol", "open_date", "open_time"]
STG_OHLCV = [
    "asset_pair_symbol", "base_asset_symbol", "quote_asset_symbol", "open_date", "open_time", "close_date",
    "close_time", "open", "high", "low", "close", *SUMMED, "record_source",
]


def stg_agg_trades(raw: DataFrame) -> DataFrame:
    ts = S.from_epoch_ms("transact_time")
    return raw.select(
        "agg_trade_id", "pair_symbol", "price", "quantity", "first_trade_id", "last_trade_id",
        F.to_date(ts).alias("transaction_date"), S.clock(ts).alias("transaction_time"),
    )


def stg_assets(history: DataFrame) -> DataFrame:
    return history.select(
        F.col("id").alias("asset_id"),
        F.col("name").alias("asset_name"),
        F.col("pair_symbol").alias("symbol"),
        "num_market_pairs",
        F.to_date("date_added").alias("asset_launch_date"),
        "max_supply",
        "circulating_supply",
        X.supply_type("max_supply").alias("supply_type"),
        F.col("cmc_rank").alias("market_cap_based_rank"),
        F.col("last_updated").alias("cmc_last_updated"),
        F.col("timestamp").alias("ingestion_timestamp"),
        "dbt_valid_from",
        "dbt_valid_to",
    )


def parse_klines(messages: DataFrame, value: str = "value", offset: str = "offset") -> DataFrame:
    """Every message with its parsed body, the closed flag and the typed candle fields.

    Offsets count within a topic partition, so the partition and the message time go with them; both are NULL for
    messages that were landed without.
    """
    body = messages.withColumn("_body", S.parse_json(value))
    fields = {n: S.json_path("_body", f"$.data.k.{k}", t) for n, (k, t) in KLINE_FIELDS.items()}
    for n in ("open_time", "close_time"):
        fields[n] = S.from_epoch_ms(fields[n])
    fields["kafka_offset"] = F.col(offset).cast("bigint")
    for n, kind in (("partition", "int"), ("timestamp", "timestamp")):
        fields[f"kafka_{n}"] = (F.col(n) if n in messages.columns else F.lit(None)).cast(kind)
    fields["is_closed"] = S.json_path("_body", "$.data.k.x", "boolean")
    fields["is_malformed"] = F.col("_body").isNull()
    fields["has_candle"] = S.json_path("_body", "$.data.k", "variant").isNotNull()
    return body.withColumns(fields).drop("_body")


def stg_klines(messages: DataFrame, value: str = "value", offset: str = "offset", coordinates: bool = False) -> DataFrame:
    """Closed candles, 13 typed columns and the offset; with ``coordinates`` the topic partition and time, too."""
    parsed = parse_klines(messages, value, offset)
    return parsed.filter(F.col("is_closed")).select(*KLINE_FIELDS, *(COORDINATES if coordinates else COORDINATES[-1:]))


def newest_candles(klines: DataFrame) -> DataFrame:
    """The newest row of each candle."""
    order = [F.desc_nulls_last(c) for c in COORDINATES if c in klines.columns]
    return dedup.first_per_key(klines, ["asset_symbol", "open_time"], order)


def streamed_ohlcv(klines: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Newest row of each candle, among offsets above the stored ones of their topic partition."""
    if existing is not None:
        if "kafka_partition" in klines.columns:
            klines = incremental.above_own_mark(klines, existing, ["kafka_partition"], "kafka_offset")
        else:
            klines = incremental.above_mark(klines, existing, "kafka_offset")
    return newest_candles(klines)


def streamed_by_day(klines: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """The same with the day of the candle, for a table that is partitioned by it."""
    return streamed_ohlcv(klines, existing).withColumn("candle_date", F.to_date("open_time"))


def batch_candles(raw: DataFrame) -> DataFrame:
    """Landed hourly candles in the unified shape."""
    return raw.select(
        F.col("asset_symbol").alias("asset_pair_symbol"),
        S.strip_quote("asset_symbol").alias("base_asset_symbol"),
        S.quote_of("asset_symbol").alias("quote_asset_symbol"),
        F.to_date("open_time").alias("open_date"),
        S.clock("open_time").alias("open_time"),
        F.to_date("close_time").alias("close_date"),
        S.clock("close_time").alias("close_time"),
        "open", "high", "low", "close",
        F.col("volume").alias("base_asset_volume"),
        "quote_asset_volume", "num_trades", "taker_buy_base_volume", "taker_buy_quote_volume",
        F.lit("batch").alias("record_source"),
    )


def roll_up(df: DataFrame, keys: list, first_at: Column, last_at: Column) -> DataFrame:
    """Candles to coarser candles in one aggregate: no rank, no rejoin.

    Time order keys are fixed-width, so first and last picks stay in hash aggregation with a
    map-side partial; a hot pair arrives pre-aggregated.
    """
    sums = [F.sum(c).alias(c) for c in SUMMED]
    return df.groupBy(*keys).agg(
        F.min_by("open", first_at).alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", last_at).alias("close"),
        *sums,
    )


def hourly_from_stream(streamed: DataFrame) -> DataFrame:
    """One-minute candles to hourly ones; the close time is the hour start, as defined."""
    renamed = streamed.withColumnRenamed("volume", "base_asset_volume")
    hour = F.date_trunc("hour", "open_time").alias("_hour")
    hourly = roll_up(renamed, ["asset_symbol", hour], F.col("open_time"), F.col("close_time"))
    at_date, at_clock = F.to_date("_hour"), S.clock("_hour")
    return hourly.select(
        F.col("asset_symbol").alias("asset_pair_symbol"),
        S.strip_quote("asset_symbol").alias("base_asset_symbol"),
        S.quote_of("asset_symbol").alias("quote_asset_symbol"),
        at_date.alias("open_date"), at_clock.alias("open_time"),
        at_date.alias("close_date"), at_clock.alias("close_time"),
        "open", "high", "low", "close", *SUMMED,
        F.lit("streamed").alias("record_source"),
    )


def stg_ohlcv(raw_ohlcv: DataFrame, streamed: DataFrame) -> DataFrame:
    """Batch and streamed candles, one row per (pair, date, time), streamed first."""
    both = batch_candles(raw_ohlcv).unionByName(hourly_from_stream(streamed))
    ties = [F.col(c) for c in ("close_date", "close_time", "open", "high", "low", "close", *SUMMED)]
    return dedup.prefer_source(both, CANDLE_KEYS, "record_source", "streamed", ties).select(*STG_OHLCV)
