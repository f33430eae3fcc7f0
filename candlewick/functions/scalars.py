"""Scalar building blocks: text, time, keys, JSON and arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUOTE = "USDT"  # fixed value: the quote asset every pair symbol is split on
NULL_KEY = "_null_"
SECONDS = {"second": 1, "minute": 60, "hour": 3600}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- text -------------------------------------------------------------------


def strip_quote(symbol) -> Column:
    """Base asset by suffix test; every occurrence of the quote text is removed."""
    s = _col(symbol)
    return F.when(s.endswith(QUOTE), F.replace(s, F.lit(QUOTE), F.lit(""))).otherwise(s)


def quote_of(symbol) -> Column:
    return F.when(_col(symbol).endswith(QUOTE), F.lit(QUOTE)).otherwise(F.lit("UNKNOWN"))


def pair_base(symbol) -> Column:
    """Text before the first quote marker; empty when there is none."""
    s = _col(symbol)
    return F.left(s, F.position(F.lit(QUOTE), s) - F.lit(1))


def pair_quote(symbol) -> Column:
    """Text from the first quote marker on; the whole symbol when there is none."""
    s = _col(symbol)
    return right(s, F.length(s) - F.position(F.lit(QUOTE), s) + F.lit(1))


def right(s, n) -> Column:
    n = F.lit(n) if isinstance(n, int) else n
    return F.when(n == 0, F.lit("")).otherwise(F.right(_col(s), n))


def split_part(s, delimiter: str, n: int) -> Column:
    return F.split_part(_col(s), F.lit(delimiter), F.lit(n))


def bool_to_text(c) -> Column:
    return _col(c).cast("string")


def nan_to_null(c) -> Column:
    v = _col(c)
    return F.when(~F.isnan(v), v)


# ---- keys -------------------------------------------------------------------


def surrogate_key(*cols) -> Column:
    """md5 over the text of the key columns; NULL has its own marker, so it differs from empty text."""
    return F.md5(F.concat_ws("-", *[F.coalesce(_col(c).cast("string"), F.lit(NULL_KEY)) for c in cols]))


def hash_text(c) -> Column:
    return F.md5(_col(c).cast("string"))


def history_key(*cols) -> Column:
    return F.md5(F.concat_ws("|", *[F.coalesce(_col(c).cast("string"), F.lit("")) for c in cols]))


# ---- time -------------------------------------------------------------------


def from_epoch_ms(ms) -> Column:
    return F.timestamp_millis(_col(ms)).cast("timestamp_ntz")


def clock(ts) -> Column:
    """Time of day as text; Spark has no enabled TIME type."""
    return F.date_format(_col(ts), "HH:mm:ss")


def second_of_day(clock_text) -> Column:
    """Seconds since midnight of an 'HH:mm:ss' text."""
    c = _col(clock_text)
    return (
        F.substring(c, 1, 2).cast("int") * 3600
        + F.substring(c, 4, 2).cast("int") * 60
        + F.substring(c, 7, 2).cast("int")
    )


def hour_of(clock_text) -> Column:
    return F.substring(_col(clock_text), 1, 2).cast("int")


def date_key(d) -> Column:
    """yyyymmdd as an integer."""
    v = _col(d)
    return F.year(v) * 10000 + F.month(v) * 100 + F.dayofmonth(v)


def date_add_units(part: str, n, ts) -> Column:
    n = F.lit(n) if isinstance(n, int) else n
    return F.timestamp_add(part.upper(), n, _col(ts))


def _epoch_seconds(ts) -> Column:
    return F.unix_seconds(_col(ts).cast("timestamp"))


def date_diff_units(part: str, first, second) -> Column:
    """Number of unit boundaries between two times (not elapsed whole units)."""
    a, b = _col(first), _col(second)
    if part in SECONDS:
        step = SECONDS[part]
        at = lambda c: F.floor(_epoch_seconds(c) / F.lit(step))
        return (at(b) - at(a)).cast("bigint")
    if part == "day":
        return F.datediff(F.to_date(b), F.to_date(a)).cast("bigint")
    if part == "week":
        days = F.datediff(F.to_date(F.date_trunc("week", b)), F.to_date(F.date_trunc("week", a)))
        return (days / 7).cast("bigint")
    index = {
        "month": lambda c: F.year(c) * 12 + F.month(c),
        "quarter": lambda c: F.year(c) * 4 + F.quarter(c),
        "year": lambda c: F.year(c),
    }[part]
    return (index(b) - index(a)).cast("bigint")


def last_day_of(part: str, d) -> Column:
    v = _col(d)
    if part == "month":
        return F.last_day(v)
    if part == "week":
        return F.date_add(F.trunc(v, "week"), 6)
    months = {"quarter": 3, "year": 12}[part]
    return F.date_sub(F.add_months(F.trunc(v, part), months), 1)


# ---- semi-structured --------------------------------------------------------


def parse_json(text) -> Column:
    """Text to VARIANT; malformed text gives NULL."""
    return F.try_parse_json(_col(text))


def json_path(variant, path: str, data_type: str) -> Column:
    """Case-sensitive path read; NULL for a missing path or an unreadable value."""
    return F.try_variant_get(_col(variant), path, data_type)


def to_message(*cols) -> Column:
    return F.to_json(F.struct(*cols))


# ---- arrays -----------------------------------------------------------------


def array_of(items, element_type: str) -> Column:
    return F.array(*[_col(i) for i in items]).cast(f"array<{element_type}>")


def first_joined(array, n: int, delimiter: str) -> Column:
    return F.array_join(F.slice(_col(array), 1, n), delimiter)


# ---- SQL functions ----------------------------------------------------------


def create_sql_function(spark, name: str, args: dict[str, str], returns: str, body: str) -> None:
    """A scalar SQL function; Catalyst inlines its body."""
    params = ", ".join(f"{a} {t}" for a, t in args.items())
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS {returns} RETURN {body}")


# ---- logical types ----------------------------------------------------------

# Names of the declared types.
LOGICAL_TYPES = {
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
    "float": T.DoubleType(),
    "numeric": T.DecimalType(28, 6),
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "boolean": T.BooleanType(),
}


def cast_to(c, logical: str) -> Column:
    return _col(c).cast(LOGICAL_TYPES[logical])


def try_cast_to(c, logical: str) -> Column:
    return _col(c).try_cast(LOGICAL_TYPES[logical])


def equals(a, b, null_safe: bool = False) -> Column:
    return _col(a).eqNullSafe(_col(b)) if null_safe else _col(a) == _col(b)
