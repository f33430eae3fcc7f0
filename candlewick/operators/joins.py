"""Lookups and joins whose physical form depends on a counted size."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.operators import blocks
from candlewick.operators.sets import concat
from candlewick.session import stage

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
SALTS = 64


def small_enough(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """True when the frame holds at most ``rows`` rows of ``size`` bytes together; reads no more rows than that.

    Texts count by their length, every other column for eight bytes.
    """
    texts = [f.name for f in df.schema if f.dataType.typeName() in ("string", "binary")]
    width = F.lit(8 * len(df.columns)).cast("bigint")
    for c in texts:
        width = width + F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0))
    found = df.limit(rows + 1).agg(F.count("*").alias("n"), F.sum(width).alias("size")).first()
    return found.n <= rows and (found["size"] or 0) <= size


def lookup_join(
    facts: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    salt_on: Sequence[str] | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    salts: int = SALTS,
    computed: bool = False,
    small: bool | None = None,
) -> DataFrame:
    """Join facts to a dimension on same-named keys.

    A dimension of counted size up to ``broadcast_rows`` is broadcast. A larger one is copied once
    per salt and the facts spread over the salts, so a key with a third of all facts is shared by
    ``salts`` tasks. Both ways give the same rows. A ``computed`` dimension (an aggregate of the
    facts, say) is written once first, so counting it does not compute it twice. ``small`` passes
    on the outcome of a count already made.
    """
    if computed:
        dim = stage(dim, "lookup")
    if small is None:
        small = small_enough(dim, broadcast_rows)
    columns = [*facts.columns, *[c for c in dim.columns if c not in keys]]
    if small:
        return facts.join(F.broadcast(dim), list(keys), how).select(*columns)
    salted = facts.withColumn("_salt", F.pmod(F.xxhash64(*(salt_on or facts.columns)), F.lit(salts)).cast("int"))
    copies = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [*keys, "_salt"], how).select(*columns)


def fixed_lookup(facts: DataFrame, dim: DataFrame, on, how: str = "left") -> DataFrame:
    """Join to a dimension whose size is fixed by its definition (calendar days, seconds of a day).

    The definition is held to it by the planner's size of the dimension; a larger one is refused.
    """
    size = int(str(dim._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size > BROADCAST_BYTES:
        raise ValueError(f"a fixed dimension of {size} bytes is too large to send to every task")
    return facts.join(F.broadcast(dim), on, how)


def absent(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of df whose key tuple does not occur in other (no null rules)."""
    return df.join(other.select(*keys), list(keys), "left_anti").select(*df.columns)


def _null_patterns(df: DataFrame, keys: Sequence[str]) -> list:
    """Which key columns are NULL together; at most 2^len(keys) rows."""
    return df.select(*[F.col(k).isNull().alias(k) for k in keys]).distinct().collect()


def _with_pattern(df: DataFrame, keys: Sequence[str], pattern) -> DataFrame:
    for k in keys:
        df = df.filter(F.col(k).isNull() if pattern[k] else F.col(k).isNotNull())
    return df


def not_in(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """SQL ``NOT IN`` over key tuples, NULL rules included, without a nested loop.

    A NULL makes a comparison unknown unless another member differs, so for each combination of
    NULL patterns an anti join on the members known on both sides decides.
    """
    keys = list(keys)
    right = other.select(*keys).distinct()
    right_patterns = _null_patterns(right, keys)
    parts = []
    for left in _null_patterns(df, keys):
        rows = _with_pattern(df, keys, left)
        for pattern in right_patterns:
            known = [k for k in keys if not left[k] and not pattern[k]]
            side = _with_pattern(right, keys, pattern)
            rows = absent(rows, side, known) if known else rows.filter(F.lit(False))
        parts.append(rows)
    return reduce(DataFrame.unionByName, parts) if parts else df


def as_of_version(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    at: str,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    broadcast_rows: int = BROADCAST_ROWS,
    small: bool | None = None,
) -> DataFrame:
    """Left join each fact to the version of its key that was valid at the fact's time.

    Versions of counted size are sent to every task; more of them are merged with the facts in order of time.
    """
    if small is None:
        small = small_enough(versions, broadcast_rows)
    inside: Column = (F.col(at) >= F.col(valid_from)) & (F.col(valid_to).isNull() | (F.col(at) < F.col(valid_to)))
    right = versions.withColumnRenamed(key, "_key")
    condition = (F.col(key) == F.col("_key")) & inside
    if small:
        return facts.join(F.broadcast(right), condition, "left").drop("_key")
    return as_of_merge(facts, versions, key, at, valid_from, valid_to)


def as_of_merge(
    facts: DataFrame, versions: DataFrame, key: str, at: str, valid_from: str = "valid_from", valid_to: str = "valid_to",
    block_rows: int = blocks.BLOCK_ROWS, stored: bool = False,
) -> DataFrame:
    """The same left join as a merge: facts and versions in one order by key and time, the last version carried on.

    Versions of a key must not overlap. A key is cut into blocks of time whose size is counted (whole, by month, day,
    hour or minute), and a block begins with the last version of the blocks before it, so a key with a large part of
    all facts is shared by many tasks and no row is copied. Facts are read up to four times and written once first
    unless they are ``stored``.
    """
    if not stored:
        facts = stage(facts, "facts")
    kind = facts.schema[at].dataType
    if versions.schema[valid_from].dataType != kind:
        kind = T.TimestampNTZType()
    when = F.col(at).cast(kind)
    extra = [c for c in versions.columns if c != key]
    usable = F.col(key).isNotNull() & F.col(valid_from).isNotNull() & (F.col(valid_to).isNull() | (F.col(valid_to) > F.col(valid_from)))
    known = versions.filter(usable).select(
        F.col(key).alias("_key"), F.col(valid_from).cast(kind).alias("_time"), F.struct(*extra).alias("_version"))
    placed = F.col(key).isNotNull() & F.col(at).isNotNull()
    rows = facts.filter(placed).select(F.col(key).alias("_key"), when.alias("_time"), F.struct(*facts.columns).alias("_fact"))
    levels = time_levels(F.col("_time"))
    level = blocks.pick_level(rows, blocks.Series(("_key",), ("_time",), levels), block_rows)
    rows, known = (df.withColumn("_block", levels[level]) for df in (rows, known))

    if level:
        # the last version of each block, carried to the later blocks that hold facts
        last = known.groupBy("_key", "_block").agg(F.max_by("_version", "_time").alias("_version"))
        held = rows.select("_key", "_block").distinct().withColumn("_version", F.lit(None).cast(last.schema["_version"].dataType))
        along = Window.partitionBy("_key").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
        marked = concat([last.withColumn("_held", F.lit(False)), held.withColumn("_held", F.lit(True))])
        merged = marked.groupBy("_key", "_block").agg(F.max("_held").alias("_held"), F.first("_version", True).alias("_version"))
        edges = merged.withColumn("_before", F.last("_version", True).over(along)).filter(F.col("_held") & F.col("_before").isNotNull())
        known = known.unionByName(edges.select("_key", F.lit(None).cast(kind).alias("_time"), F.col("_before").alias("_version"), "_block"))

    # a block's carried version has no time and comes first; a version precedes the facts of its first moment
    both = concat([known.withColumn("_fact", F.lit(None).cast(rows.schema["_fact"].dataType)),
                   rows.withColumn("_version", F.lit(None).cast(known.schema["_version"].dataType))])
    order = [F.asc_nulls_first("_time"), F.col("_fact").isNotNull()]
    upto = Window.partitionBy("_key", "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    carried = both.withColumn("_now", F.last("_version", True).over(upto)).filter(F.col("_fact").isNotNull())
    end = F.col(f"_now.{valid_to}")
    valid = F.when(end.isNull() | (F.col("_time") < end.cast(kind)), F.col("_now"))
    out = carried.withColumn("_now", valid).select("_fact.*", *[F.col("_now")[c].alias(c) for c in extra])
    missing = facts.filter(~placed).select("*", *[F.lit(None).cast(versions.schema[c].dataType).alias(c) for c in extra])
    return out.unionByName(missing)


def time_levels(t: Column) -> list[Column]:
    """Blocks of time from coarse to fine: all of it, months, days, hours, minutes."""
    seconds = F.unix_seconds(t.cast("timestamp"))
    month = (F.year(t) * 12 + F.month(t)).cast("bigint")
    return [F.lit(0).cast("bigint"), month, *[F.floor(seconds / s).cast("bigint") for s in (86_400, 3600, 60)]]


def against_group_mean(df: DataFrame, group: Sequence[str], value: str, factor: float) -> DataFrame:
    """Rows whose value is at least ``factor`` times the mean of their group.

    The mean is a pre-aggregated small side; the detail rows are not shuffled by group.
    """
    means = df.groupBy(*group).agg(F.avg(value).alias(f"avg_{value}"))
    return lookup_join(df, means, group, "inner", computed=True).filter(F.col(value) >= F.col(f"avg_{value}") * factor)
