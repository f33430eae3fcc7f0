"""Trade marts over the trade fact and the fixed-size dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.functions import expressions as X
from candlewick.functions import scalars as S
from candlewick.operators import blocks, joins
from candlewick.session import stage


def _value() -> Column:
    return F.col("quantity") * F.col("price")


def _days(date_dim: DataFrame, *cols) -> DataFrame:
    return date_dim.select(F.col("date_sk").alias("date_fk"), *cols)


def _times(time_dim: DataFrame, *cols) -> DataFrame:
    return time_dim.select(F.col("time_sk").alias("time_fk"), *cols)


def outside_calendar(trades: DataFrame) -> DataFrame:
    """Days of trades that the calendar doesn't have, with their number of trades; the star joins would drop these."""
    return trades.filter(F.col("date_fk").isNull()).groupBy("transaction_date").agg(F.count("*").alias("trades"))


def trade_size_distribution(trades: DataFrame) -> DataFrame:
    sized = trades.select("pair_symbol", X.trade_size(F.col("price") * F.col("quantity")).alias("_size"))
    labels = [label for _, label in X.TRADE_SIZES] + [X.TRADE_SIZE_TOP]
    names = ["micro_trades", "small_trades", "medium_trades", "large_trades", "whale_trades"]
    counts = [F.count_if(F.col("_size") == label).alias(n) for label, n in zip(labels, names)]
    return sized.groupBy("pair_symbol").agg(F.count("*").alias("total_trades"), *counts)


def market_share(trades: DataFrame, date_dim: DataFrame, assets_dim: DataFrame) -> DataFrame:
    """Monthly value per asset version and its share of the month's total, in percent."""
    days = _days(date_dim, F.col("year").alias("trade_year"), F.col("month").alias("trade_month"))
    per_asset = (
        joins.fixed_lookup(trades, days, "date_fk", "inner")
        .groupBy("base_asset_fk", "trade_year", "trade_month")
        .agg(F.sum(_value()).alias("total_value_traded"))
    )
    per_asset = stage(per_asset, "totals")  # small, and read twice
    per_month = per_asset.groupBy("trade_year", "trade_month").agg(F.sum("total_value_traded").alias("total_market_value"))
    names = assets_dim.select(F.col("asset_sk").alias("base_asset_fk"), "asset_name")
    return (
        per_asset.join(per_month, ["trade_year", "trade_month"])
        .join(names, "base_asset_fk")
        .select(
            "trade_year", "trade_month", "asset_name", "total_value_traded", "total_market_value",
            (X.safe_divide("total_value_traded", "total_market_value") * 100).alias("asset_market_share_percentage"),
        )
        .orderBy("trade_year", "trade_month", "asset_name")
    )


def with_clock_seconds(trades: DataFrame) -> DataFrame:
    return trades.withColumn("_second", S.second_of_day("transaction_time"))


def with_previous_clock(trades: DataFrame, level: int | None = None, stored: bool = False) -> DataFrame:
    """Second of day of the pair's previous trade in (date, time, id) order."""
    slim = with_clock_seconds(trades)
    return blocks.over_series(
        slim, blocks.trade_series(), 1, lambda w: {"previous_second": F.lag("_second").over(w)}, level, stored=stored
    )


def time_between_trades(
    trades: DataFrame, date_dim: DataFrame, level: int | None = None, stored: bool = False
) -> DataFrame:
    """Mean clock-time gap between consecutive trades per pair and year.

    Only times of day are compared, as defined; a smaller later clock time is left out.
    """
    slim = trades.select("pair_symbol", "agg_trade_id", "transaction_date", "transaction_time", "date_fk")
    gaps = with_previous_clock(slim, level, stored).filter(F.col("previous_second") <= F.col("_second"))
    days = _days(date_dim, F.col("year").alias("trade_year"))
    return (
        joins.fixed_lookup(gaps, days, "date_fk")
        .groupBy("pair_symbol", "trade_year")
        .agg(F.avg(F.col("_second") - F.col("previous_second")).alias("avg_time_between_trades_in_seconds"))
        .orderBy("pair_symbol", "trade_year")
    )


def price_by_hour(trades: DataFrame, time_dim: DataFrame, date_dim: DataFrame) -> DataFrame:
    df = joins.fixed_lookup(trades, _times(time_dim, F.col("hour_of_day").alias("trade_hour")), "time_fk", "inner")
    df = joins.fixed_lookup(df, _days(date_dim, "full_date"), "date_fk", "inner")
    return df.groupBy("full_date", "pair_symbol", "trade_hour").agg(
        F.avg("price").alias("avg_price"), F.min("price").alias("min_price"), F.max("price").alias("max_price")
    )


def daily_volume(trades: DataFrame, date_dim: DataFrame) -> DataFrame:
    df = joins.fixed_lookup(trades, _days(date_dim), "date_fk", "inner")
    return df.groupBy("date_fk", "transaction_date", "pair_symbol").agg(
        F.sum("quantity").alias("total_quantity_traded"),
        F.sum(_value()).alias("total_value_traded"),
        F.sum(X.raw_trade_count()).alias("total_trades"),
        F.avg("price").alias("avg_price"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
    )


def intraday_pattern(trades: DataFrame, time_dim: DataFrame) -> DataFrame:
    df = joins.fixed_lookup(trades, _times(time_dim, "hour_of_day", "time_division"), "time_fk", "inner")
    return (
        df.groupBy("hour_of_day", "time_division")
        .agg(
            F.avg("quantity").alias("avg_quantity"),
            F.avg(_value()).alias("avg_trade_value"),
            F.sum(X.raw_trade_count()).alias("trade_frequency"),
        )
        .orderBy("hour_of_day")
    )


def large_trades(trades: DataFrame, date_dim: DataFrame, factor: float = 5) -> DataFrame:
    """Trades of at least ``factor`` times the mean quantity of a pair of the same asset and month.

    The averages are small (asset, pair, month) rows; their size is counted before a broadcast.
    """
    days = _days(date_dim, F.col("year").alias("trade_year"), F.col("month").alias("trade_month"))
    dated = joins.fixed_lookup(trades, days, "date_fk", "inner")
    means = dated.groupBy("base_asset_fk", "pair_symbol", "trade_year", "trade_month").agg(
        F.avg("quantity").alias("avg_quantity"), F.avg(_value()).alias("avg_trade_value")
    )
    both = joins.lookup_join(
        dated, means.drop("pair_symbol"), ["base_asset_fk", "trade_year", "trade_month"], "inner", computed=True
    )
    return (
        both.filter(F.col("quantity") >= F.col("avg_quantity") * factor)
        .select(
            "pair_symbol", "trade_year", "trade_month", F.col("quantity").alias("large_trades_quantity"), "price",
            _value().alias("trade_value_usdt"), "avg_quantity", "avg_trade_value",
        )
        .orderBy("trade_year", "trade_month", "pair_symbol")
    )


def trading_intensity(trades: DataFrame, time_dim: DataFrame, date_dim: DataFrame) -> DataFrame:
    df = joins.fixed_lookup(trades, _times(time_dim, "hour_of_day"), "time_fk")
    df = joins.fixed_lookup(df, _days(date_dim, "dayname"), "date_fk")
    return (
        df.groupBy("hour_of_day", "dayname", X.is_weekend("dayname").alias("is_weekend"), "pair_symbol")
        .agg(
            F.sum(X.raw_trade_count()).alias("trade_count"),
            F.sum("quantity").alias("hourly_volume"),
            F.avg("price").alias("avg_hourly_price"),
            F.stddev_samp("price").alias("price_volatility"),
        )
        .orderBy("pair_symbol", "is_weekend", "dayname", "hour_of_day")
    )


def trading_velocity(trades: DataFrame) -> DataFrame:
    n = F.sum(X.raw_trade_count())
    return (
        trades.groupBy(F.col("transaction_date").alias("trade_date"), S.hour_of("transaction_time").alias("trade_hour"))
        .agg(
            n.alias("trades_per_hour"),
            F.sum("quantity").alias("volume_per_hour"),
            F.sum(_value()).alias("value_per_hour"),
            (n.cast("double") / 60).alias("trades_per_minute"),
        )
        .orderBy("trade_date", "trade_hour")
    )


def volatility_rows(trades: DataFrame, n: int = 7, level: int | None = None, stored: bool = False) -> DataFrame:
    """Price stddev over the last n trades of a pair (rows, not days)."""
    slim = trades.select("transaction_date", "transaction_time", "agg_trade_id", "pair_symbol", "price")
    out = blocks.over_series(
        with_clock_seconds(slim), blocks.trade_series(), n - 1,
        lambda w: {"volatility_7_day": X.rolling_stddev("price", n, w)}, level, stored=stored,
    )
    return out.select("agg_trade_id", "transaction_date", "pair_symbol", "price", "volatility_7_day")


def volatility_days(trades: DataFrame, days: int = 7) -> DataFrame:
    """Price stddev per pair and day over the trailing calendar days, from mergeable daily moments."""
    daily = trades.groupBy("pair_symbol", "transaction_date").agg(
        F.count("price").alias("n"), F.avg("price").alias("mean"), F.var_pop("price").alias("var")
    )
    spread = daily.withColumn("day", F.explode(F.sequence(F.lit(0), F.lit(days - 1)))).withColumn(
        "day", F.date_add("transaction_date", F.col("day"))
    )
    n, m = F.col("n"), F.col("mean")
    total = spread.groupBy("pair_symbol", "day").agg(
        F.sum("n").alias("trades"),
        (F.sum(n * m) / F.sum(n)).alias("mean"),
        F.sum(n * (F.col("var") + m * m)).alias("_squares"),
    )
    kept = total.join(daily.select("pair_symbol", F.col("transaction_date").alias("day")), ["pair_symbol", "day"], "left_semi")
    variance = (F.col("_squares") - F.col("trades") * F.col("mean") * F.col("mean")) / (F.col("trades") - 1)
    return kept.select(
        "pair_symbol", F.col("day").alias("transaction_date"), "trades",
        F.when(F.col("trades") > 1, F.sqrt(F.greatest(variance, F.lit(0.0)))).alias("volatility_7_days"),
    )


def pair_value_rank(trades: DataFrame) -> DataFrame:
    return (
        trades.groupBy("pair_symbol").agg(F.sum(_value()).alias("total_value_traded")).orderBy(F.desc("total_value_traded"))
    )


def trade_size_label(trades: DataFrame) -> DataFrame:
    value = F.col("price") * F.col("quantity")
    return trades.select(
        "pair_symbol", value.alias("trade_value"), X.trade_size(value).alias("trade_size_category"),
        "quantity", "price", "transaction_date",
    )


def whale_neighbors(trades: DataFrame, threshold: float = 100) -> DataFrame:
    """Large trades with the prices of their pair on the day before and the day after.

    A neighbouring day is one row (trade count and price summary), so a trade yields one row and
    not one per combination of neighbouring trades.
    """
    sec = F.struct(S.second_of_day("transaction_time"), "agg_trade_id")
    daily = trades.groupBy("pair_symbol", "transaction_date").agg(
        F.count("*").alias("trades"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.avg("price").alias("avg_price"),
        F.max_by("price", sec).alias("last_price"),
        F.min_by("price", sec).alias("first_price"),
    )
    daily = stage(daily, "days")  # read for both sides
    measures = ["trades", "min_price", "max_price", "avg_price", "first_price", "last_price"]
    whales = trades.filter(F.col("quantity") > threshold).select(
        "agg_trade_id", "pair_symbol", F.col("price").alias("current_price"), F.col("quantity").alias("trade_quantity"),
        "transaction_date", "transaction_time",
    )
    for label, shift in (("previous", 1), ("next", -1)):
        side = daily.select(
            "pair_symbol", F.date_add("transaction_date", shift).alias("transaction_date"),
            *[F.col(m).alias(f"{label}_day_{m}") for m in measures],
        )
        whales = joins.lookup_join(whales, side, ["pair_symbol", "transaction_date"], salt_on=["agg_trade_id"])
    return whales.orderBy(F.desc("transaction_date"), F.desc("transaction_time"), "agg_trade_id")
