"""CSV and JSON readers for landed files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.functions import scalars as S
from candlewick.sources.schemas import KLINE_ROW


def read_csv(spark: SparkSession, path, schema: str, header: bool = True, quoted: bool = True) -> DataFrame:
    reader = spark.read.schema(schema).option("header", header).option("escape", "\\").option("mode", "FAILFAST")
    return reader.option("quote", '"' if quoted else "").csv(path)


def read_csv_positional(spark: SparkSession, path, picks: dict[int, tuple[str, str]], width: int) -> DataFrame:
    """Columns of a wider file by 1-based position: {position: (name, type)}."""
    schema = ", ".join(f"_c{i} string" for i in range(width))
    raw = spark.read.schema(schema).option("header", True).option("quote", '"').option("escape", "\\").csv(path)
    return raw.select(*[F.col(f"_c{i - 1}").cast(t).alias(n) for i, (n, t) in picks.items()])


def read_csv_headerless(spark: SparkSession, path, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", False).csv(path)


def with_file_symbol(df: DataFrame, name: str = "asset_symbol", suffix: str = ".csv", first_part: bool = False) -> DataFrame:
    """A column from the name of the file each row came from."""
    stem = F.replace(F.col("_metadata.file_name"), F.lit(suffix), F.lit(""))
    return df.withColumn(name, S.split_part(stem, "-", 1) if first_part else stem)


def read_matching(spark: SparkSession, path, schema: str, regex: str) -> DataFrame:
    """Rows of the files whose path matches; the filter prunes whole files."""
    df = spark.read.schema(schema).option("header", True).option("recursiveFileLookup", True).csv(path)
    return df.filter(F.col("_metadata.file_path").rlike(regex))


QUOTE_FIELDS = {
    "price": "price_usdt",
    "volume_24h": "volume_24h_usdt",
    "volume_change_24h": "volume_change_24h_usdt",
    "percent_change_1h": "pct_change_1h_usdt",
    "percent_change_24h": "pct_change_24h_usdt",
    "percent_change_7d": "pct_change_7d_usdt",
    "percent_change_30d": "pct_change_30d_usdt",
    "percent_change_60d": "pct_change_60d_usdt",
    "percent_change_90d": "pct_change_90d_usdt",
    "market_cap": "market_cap_usdt",
    "market_cap_dominance": "market_cap_dominance_usdt",
    "fully_diluted_market_cap": "fully_diluted_market_cap_usdt",
    "last_updated": "last_updated_usdt",
}  # fixed values: listing fields and their column names

_QUOTE_TYPE = T.StructType(
    [T.StructField(k, T.StringType() if k == "last_updated" else T.DoubleType()) for k in QUOTE_FIELDS]
)
LISTING_TYPE = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("slug", T.StringType()),
        T.StructField("num_market_pairs", T.LongType()),
        T.StructField("date_added", T.StringType()),
        T.StructField("max_supply", T.DoubleType()),
        T.StructField("circulating_supply", T.DoubleType()),
        T.StructField("total_supply", T.DoubleType()),
        T.StructField("infinite_supply", T.BooleanType()),
        T.StructField("cmc_rank", T.LongType()),
        T.StructField("last_updated", T.StringType()),
        T.StructField("quote", T.StructType([T.StructField("USDT", _QUOTE_TYPE)])),
    ]
)


def read_listing(spark: SparkSession, path) -> DataFrame:
    return spark.read.schema(LISTING_TYPE).json(path)


def flatten_listing(listing: DataFrame) -> DataFrame:
    """Nested quote fields as flat dotted columns."""
    flat = [c for c in listing.columns if c != "quote"]
    return listing.select(*flat, *[F.col(f"quote.USDT.{f}").alias(f"quote.USDT.{f}") for f in QUOTE_FIELDS])


def normalize_assets(listing: DataFrame, ingested_at=None) -> DataFrame:
    """The 26-column asset table from a nested listing."""
    stamp = "yyyy-MM-dd HH:mm:ss"
    as_text = lambda c: F.date_format(F.to_timestamp(c), stamp)
    plain = ["id", "name", "slug", "num_market_pairs", "max_supply", "circulating_supply", "total_supply"]
    out = {c: (S.nan_to_null(c) if c.endswith("supply") else F.col(c)) for c in plain}
    out |= {
        "pair_symbol": F.col("symbol"),
        "infinite_supply": F.col("infinite_supply"),
        "cmc_rank": F.col("cmc_rank"),
        "date_added": as_text("date_added"),
        "last_updated": as_text("last_updated"),
    }
    for field, name in QUOTE_FIELDS.items():
        c = F.col(f"quote.USDT.{field}")
        out[name] = as_text(c) if field == "last_updated" else S.nan_to_null(c)
    out["timestamp"] = F.date_format(ingested_at if ingested_at is not None else F.current_timestamp(), stamp)
    order = [
        "id", "name", "pair_symbol", "slug", "num_market_pairs", "date_added", "max_supply", "circulating_supply",
        "total_supply", "infinite_supply", "cmc_rank", "last_updated", *QUOTE_FIELDS.values(), "timestamp",
    ]
    return listing.select(*[out[c].alias(c) for c in order])


def explode_klines(df: DataFrame, payload: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """JSON array of candle arrays to one typed row per candle."""
    rows = df.select(*keep, F.explode(F.from_json(payload, "array<array<string>>")).alias("r"))
    types = {"open_time": "ts", "close_time": "ts", "num_trades": "bigint", "ignore": "string"}
    cols = []
    for i, name in enumerate(KLINE_ROW):
        item, kind = F.col("r")[i], types.get(name, "double")
        cols.append((S.from_epoch_ms(item.cast("bigint")) if kind == "ts" else item.cast(kind)).alias(name))
    return rows.select(*keep, *cols)


def normalize_ohlcv(df: DataFrame, symbol) -> DataFrame:
    """Symbol first, UTC text times, NaN as NULL, fixed column order."""
    stamp = "yyyy-MM-dd HH:mm:ss"
    numeric = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    cols = [symbol.alias("asset_symbol")]
    for name in KLINE_ROW:
        c = F.col(name)
        if name in ("open_time", "close_time"):
            c = F.date_format(c, stamp)
        elif name in numeric:
            c = S.nan_to_null(name)
        cols.append(c.alias(name))
    return df.select(*cols)


API_TRADE = {
    "a": ("agg_trade_id", "bigint"),
    "p": ("price", "double"),
    "q": ("quantity", "double"),
    "f": ("first_trade_id", "bigint"),
    "l": ("last_trade_id", "bigint"),
    "T": ("transact_time", "bigint"),
}  # fixed values: short field names, case matters


def normalize_api_trades(df: DataFrame, payload: str, symbol) -> DataFrame:
    """Short-key JSON trades to typed named columns. Keys differ by case, so they are read by path."""
    v = df.withColumn("_v", S.parse_json(payload))
    cols = [S.json_path("_v", f"$.{k}", t).alias(n) for k, (n, t) in API_TRADE.items()]
    out = v.select(*cols, symbol.alias("pair_symbol"))
    return out.select(
        "agg_trade_id", "pair_symbol", "price", "quantity", "first_trade_id", "last_trade_id", "transact_time"
    )


def tradable_bases(info: DataFrame, quote: str = "USDT", status: str = "TRADING") -> DataFrame:
    """Distinct base assets of the symbols traded against a quote asset."""
    s = info.select(F.explode("symbols").alias("s"))
    return s.filter((F.col("s.quoteAsset") == quote) & (F.col("s.status") == status)).select("s.baseAsset").distinct()


def seed_csv(spark: SparkSession, path, overrides: dict[str, str]) -> DataFrame:
    """A small CSV with inferred types, some of them overridden.

    An overridden column is read with its type from the text itself, so a text keeps its leading zeros.
    """
    inferred = spark.read.option("header", True).option("inferSchema", True).csv(path).schema
    given = {c.lower(): t for c, t in overrides.items()}
    if unknown := set(given) - {f.name.lower() for f in inferred}:
        raise ValueError(f"no column {', '.join(sorted(unknown))} in the file")
    types = ", ".join(f"`{f.name}` {given.get(f.name.lower(), f.dataType.simpleString())}" for f in inferred)
    return spark.read.option("header", True).schema(types).csv(path)
