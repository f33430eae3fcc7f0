"""Reusable column expressions for series and ratios. No Python UDF is involved."""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

# Labels and thresholds the results must carry.
TREND_UP, TREND_DOWN, TREND_FLAT = "UP/bullish", "DOWN/bearish", "SIDEWAYS/flat"
VOL_LOW, VOL_NORMAL, VOL_HIGH = "Low volatility", "Normal volatility", "High volatility"
GOLDEN, DEATH, NO_CROSS = "GOLDEN CROSS - BIG BULL SIGNAL", "DEATH CROSS - BIG BEAR SIGNAL", "NO BIG CROSS TODAY"
REGIME_BUYERS, REGIME_PASSIVE, REGIME_BALANCED = "Buyers Dominant", "Passive/Neutral Trades", "Balanced"
TRADE_SIZES = [
    (100, "Micro (<$100)"),
    (1000, "Small ($100-1K)"),
    (10000, "Medium ($1K-10K)"),
    (100000, "Large ($10K-100K)"),
]
TRADE_SIZE_TOP = "Whale (>$100K)"
DAY_PARTS = [(6, "Night"), (12, "Morning"), (17, "Afternoon"), (20, "Evening")]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_divide(num, den) -> Column:
    """num / den, NULL when the denominator is NULL or zero (also under ANSI mode)."""
    return F.try_divide(_col(num), _col(den))


def last_rows(w: WindowSpec, n: int) -> WindowSpec:
    return w.rowsBetween(-(n - 1), 0)


def sma(c, n: int, w: WindowSpec) -> Column:
    """Mean of the last n rows; a shorter prefix is averaged, not NULL."""
    return F.avg(_col(c)).over(last_rows(w, n))


def atr(true_range_col, n: int, w: WindowSpec) -> Column:
    return sma(true_range_col, n, w)


def rolling_stddev(c, n: int, w: WindowSpec) -> Column:
    return F.stddev_samp(_col(c)).over(last_rows(w, n))


def true_range(high, low, prev_close) -> Column:
    """Largest of the day's range and the two gaps to the previous close; NULL if high or low is NULL."""
    h, l, p = _col(high), _col(low), _col(prev_close)
    widest = F.greatest(F.coalesce(h - l, F.lit(0.0)), F.abs(h - F.coalesce(p, h)), F.abs(l - F.coalesce(p, l)))
    return F.when(h.isNotNull() & l.isNotNull(), widest)


def _crossed(short, long, w: WindowSpec) -> tuple[Column, Column]:
    s, l = _col(short), _col(long)
    prev_s, prev_l = F.lag(s).over(w), F.lag(l).over(w)
    return (s > l) & (prev_s <= prev_l), (s < l) & (prev_s >= prev_l)


def crossover(short, long, w: WindowSpec) -> Column:
    up, down = _crossed(short, long, w)
    return F.when(up, F.lit("golden_cross")).when(down, F.lit("death_cross"))


def crossover_event(short, long, w: WindowSpec) -> Column:
    up, down = _crossed(short, long, w)
    return F.when(up, F.lit(GOLDEN)).when(down, F.lit(DEATH)).otherwise(F.lit(NO_CROSS))


def trend_direction(return_pct) -> Column:
    r = _col(return_pct)
    return F.when(r > 0, F.lit(TREND_UP)).when(r < 0, F.lit(TREND_DOWN)).otherwise(F.lit(TREND_FLAT))


def pressure_regime(ratio) -> Column:
    r = _col(ratio)
    return (
        F.when(r >= 0.55, F.lit(REGIME_BUYERS))
        .when(r <= 0.40, F.lit(REGIME_PASSIVE))
        .when(r.isNotNull(), F.lit(REGIME_BALANCED))
    )


def trade_size(value) -> Column:
    """Size bucket of a traded value. A NULL value falls through to the top bucket, as defined."""
    v = _col(value)
    out = None
    for limit, label in TRADE_SIZES:
        out = F.when(v < limit, F.lit(label)) if out is None else out.when(v < limit, F.lit(label))
    return out.otherwise(F.lit(TRADE_SIZE_TOP))


def time_division(hour) -> Column:
    h = _col(hour)
    out = None
    for limit, label in DAY_PARTS:
        out = F.when(h < limit, F.lit(label)) if out is None else out.when(h < limit, F.lit(label))
    return out.otherwise(F.lit("Night"))


def is_weekend(dayname) -> Column:
    return F.when(_col(dayname).isin("Saturday", "Sunday"), F.lit(1)).otherwise(F.lit(0))


def supply_type(max_supply) -> Column:
    m = _col(max_supply)
    return F.when(m.isNull(), F.lit("Unlimited")).when(m.isNotNull(), F.lit("Fixed")).otherwise(F.lit("Unknown"))


def raw_trade_count(first_id="first_trade_id", last_id="last_trade_id") -> Column:
    return _col(last_id) - _col(first_id) + F.lit(1)
