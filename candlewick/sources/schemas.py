"""Declared schemas of the landed tables."""

from __future__ import annotations

# Column names and types of the landed tables, in their order.
BRONZE_OHLCV = (
    "asset_symbol string, open_time timestamp_ntz, open double, high double, low double, close double, "
    "volume double, close_time timestamp_ntz, quote_asset_volume double, num_trades bigint, "
    "taker_buy_base_volume double, taker_buy_quote_volume double, ignore bigint"
)
BRONZE_AGG_TRADES = (
    "agg_trade_id bigint, pair_symbol string, price double, quantity double, "
    "first_trade_id bigint, last_trade_id bigint, transact_time bigint"
)
BRONZE_ASSETS = (
    "id bigint, name string, pair_symbol string, slug string, num_market_pairs bigint, date_added timestamp, "
    "max_supply double, circulating_supply double, total_supply double, infinite_supply boolean, cmc_rank bigint, "
    "last_updated timestamp, price_usdt double, volume_24h_usdt double, volume_change_24h_usdt double, "
    "pct_change_1h_usdt double, pct_change_24h_usdt double, pct_change_7d_usdt double, pct_change_30d_usdt double, "
    "pct_change_60d_usdt double, pct_change_90d_usdt double, market_cap_usdt double, "
    "market_cap_dominance_usdt double, fully_diluted_market_cap_usdt double, last_updated_usdt timestamp, "
    "timestamp timestamp_ntz"
)
TRADE_FILE = (
    "trade_id bigint, price double, quantity double, quote_qty double, timestamp bigint, "
    "is_buyer_maker boolean, is_best_match boolean"
)
KLINE_ROW = [
    "open_time", "open", "high", "low", "close", "volume", "close_time", "quote_asset_volume",
    "num_trades", "taker_buy_base_volume", "taker_buy_quote_volume", "ignore",
]  # fixed values: field order of a candle array
RAW_MESSAGE = "value string, offset bigint, partition int, timestamp timestamp"  # a message and where its topic has it
