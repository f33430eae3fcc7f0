"""Dimensions: asset versions, calendar days, seconds of a day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.functions import expressions as X
from candlewick.functions import scalars as S

DATE_START, DATE_END = "2019-01-01", "2027-12-31"  # fixed values: default calendar bounds


def assets_dim(stg_assets: DataFrame) -> DataFrame:
    """One row per asset version."""
    plain = [c for c in stg_assets.columns if c not in ("dbt_valid_from", "dbt_valid_to")]
    return stg_assets.select(
        S.surrogate_key("asset_id", "dbt_valid_from").alias("asset_sk"),
        *plain,
        F.col("dbt_valid_from").alias("rank_valid_from"),
        F.col("dbt_valid_to").alias("rank_valid_to"),
    )


def date_seed(spark: SparkSession, start: str = DATE_START, end: str = DATE_END) -> DataFrame:
    """Calendar attributes of every day in [start, end]."""
    d = F.col("date")
    dom = F.dayofmonth(d)
    suffix = (
        F.when(dom.isin(11, 12, 13), "th")
        .when(dom % 10 == 1, "st")
        .when(dom % 10 == 2, "nd")
        .when(dom % 10 == 3, "rd")
        .otherwise("th")
    )
    quarter_names = F.array(*[F.lit(q) for q in ("First", "Second", "Third", "Fourth")])
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("date")
    )
    return days.select(
        S.date_key(d).alias("date_sk"),
        d,
        dom.alias("day"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("monthname"),
        F.year(d).alias("year"),
        suffix.alias("daysuffix"),
        F.date_format(d, "EEEE").alias("dayofweek"),
        F.floor((dom + 6) / 7).cast("int").alias("dowinmonth"),
        F.dayofyear(d).alias("dayofyear"),
        F.weekofyear(d).alias("weekofyear"),
        F.floor((dom + F.weekday(F.trunc(d, "month")) + 6) / 7).cast("int").alias("weekofmonth"),
        F.quarter(d).alias("quarter"),
        quarter_names[F.quarter(d) - 1].alias("quartername"),
    )


def date_dim(seed: DataFrame, start: str = DATE_START, end: str = DATE_END) -> DataFrame:
    renames = {"date": "full_date", "dayofweek": "dayname", "dowinmonth": "weekday_of_month"}
    return seed.select(
        *[F.col(c).alias(renames.get(c, c)) for c in seed.columns],
        F.lit(start).alias("dimension_start_date"),
        F.lit(end).alias("dimension_end_date"),
        F.current_timestamp().alias("created_at"),
    )


def calendar(spark: SparkSession, start: str = DATE_START, end: str = DATE_END) -> DataFrame:
    return date_dim(date_seed(spark, start, end), start, end)


def time_dim(spark: SparkSession) -> DataFrame:
    """86,400 rows, one per second of a day; the key is the second itself."""
    sec = F.col("id").cast("int")
    at = F.timestamp_seconds(F.col("id"))
    h, m, s = F.floor(sec / 3600).cast("int"), F.floor(sec % 3600 / 60).cast("int"), sec % 60
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    return spark.range(86400).select(
        sec.alias("time_sk"),
        S.clock(at).alias("time_of_day"),
        F.date_format(at, "hh:mm:ss a").alias("time_desc_12"),
        S.clock(at).alias("time_desc_24"),
        F.when(h < 12, "AM").otherwise("PM").alias("am_or_pm"),
        X.time_division(h).alias("time_division"),
        F.concat(two(h), two(m)).alias("military_time"),
        h.alias("hour_of_day"),
        (h * 60 + m).alias("minute_of_day"),
        m.alias("minute_of_hour"),
        sec.alias("second_of_day"),
        (m * 60 + s).alias("second_of_hour"),
        s.alias("second_of_minute"),
        F.current_timestamp().alias("created_at"),
    )
