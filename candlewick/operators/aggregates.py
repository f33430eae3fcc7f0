"""Aggregates that need more than one built-in call."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candlewick.operators.dedup import first_n_per_key
from candlewick.operators.sets import concat
from candlewick.session import stage


def joined_key(parts: Sequence[tuple[str | Column, int]]) -> Column:
    """Whole numbers as one decimal, each with its number of digits, most significant first.

    A fixed-width order key keeps first and last picks in hash aggregation; a struct would force
    every map task to sort its rows.
    """
    digits = sum(n for _, n in parts)
    if digits > 38:
        raise ValueError("an order key holds at most 38 digits")
    out, below = None, digits
    for part, n in parts:
        below -= n
        c = (F.col(part) if isinstance(part, str) else part).cast("bigint").cast("decimal(19,0)")
        term = c * F.lit("1" + "0" * below).cast(f"decimal({below + 1},0)") if below else c
        out = term if out is None else out + term
    return out.cast("decimal(38,0)")


def order_key(ts_micros: Column, id_col: Column) -> Column:
    """(time, id) as one order key."""
    return joined_key([(ts_micros, 19), (id_col, 19)])


def group_share(df: DataFrame, group: Sequence[str], period: Sequence[str], value: Column, name: str) -> DataFrame:
    """Group totals, the total of each period and the share in percent."""
    per_group = stage(df.groupBy(*group, *period).agg(F.sum(value).alias(name)), "totals")  # read twice
    per_period = per_group.groupBy(*period).agg(F.sum(name).alias("period_total"))
    return per_group.join(per_period, list(period)).withColumn(
        "share_pct", F.try_divide(F.col(name), F.col("period_total")) * 100
    )


def listagg(
    df: DataFrame, group: Sequence[str], measure: str, delimiter: str, order: Sequence[str], limit: int, name: str
) -> DataFrame:
    """Ordered text of the first ``limit`` rows of each group.

    The limit is applied before the shuffle and bounds what a group can collect. Where every group
    is known to be small, Spark's own ``listagg`` gives the unlimited form.
    """
    df = first_n_per_key(df, group, order, limit)
    items = F.sort_array(F.collect_list(F.struct(*order, F.col(measure).cast("string").alias("_text"))))
    return df.groupBy(*group).agg(F.array_join(F.transform(items, lambda x: x["_text"]), delimiter).alias(name))


def quantiles(df: DataFrame, column: str, points: Sequence[float]) -> list[float | None]:
    """Exact interpolated quantiles at any size; None for each without a value.

    Equal values are counted first, so a frequent one is one row; the distinct values are sorted by range, and only
    the ranges that hold a wanted rank are looked into.
    """
    values = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("v")).agg(F.count("*").alias("n"))
    ranges = stage(values.repartitionByRange("v").withColumn("part", F.spark_partition_id()), "ranges")
    totals = sorted((r.part, r.n) for r in ranges.groupBy("part").agg(F.sum("n").alias("n")).collect())
    count = sum(n for _, n in totals)
    if not count:
        return [None] * len(points)
    ranks = sorted({r for p in points for r in (int(p * (count - 1)), min(int(p * (count - 1)) + 1, count - 1))})
    wanted, before = {}, 0  # range: the ranks inside it
    for part, n in totals:
        for r in ranks:
            if before <= r < before + n:
                wanted.setdefault(part, []).append((r, r - before))
        before += n
    inside = ranges.filter(F.col("part").isin(list(wanted))).withColumn(
        "upto", F.sum("n").over(Window.partitionBy("part").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)))
    hit = F.lit(False)
    for part, places in wanted.items():
        for _, place in places:
            hit |= (F.col("part") == part) & (F.col("upto") - F.col("n") <= place) & (F.col("upto") > place)
    found = inside.filter(hit).collect()
    at = {rank: float(next(x.v for x in found if x.part == part and x.upto - x.n <= place < x.upto))
          for part, places in wanted.items() for rank, place in places}
    out = []
    for p in points:
        low = int(p * (count - 1))
        out.append(at[low] + (at[min(low + 1, count - 1)] - at[low]) * (p * (count - 1) - low))
    return out


def describe(df: DataFrame, column: str) -> DataFrame:
    """One-row summary: count, mean, stddev, min, interpolated quartiles, max."""
    c = F.col(column)
    points = (0.25, 0.5, 0.75)
    found = quantiles(df, column, points)
    return df.agg(
        F.count(c).alias("count"),
        F.avg(c).alias("mean"),
        F.stddev_samp(c).alias("stddev"),
        F.min(c).alias("min"),
        *[F.lit(v).cast("double").alias(f"p{int(q * 100)}") for q, v in zip(points, found, strict=True)],
        F.max(c).alias("max"),
    )


def freshness(df: DataFrame, loaded_at: str, where: str | None = None) -> DataFrame:
    if where:
        df = df.filter(where)
    return df.agg(F.max(loaded_at).alias("max_loaded_at"), F.current_timestamp().alias("snapshotted_at"))


def freshness_of_query(spark: SparkSession, query: str, **tables: DataFrame) -> DataFrame:
    """The same from a query of the caller's that gives one value; it names the tables as ``{name}``."""
    found = spark.sql(query, **tables)
    if len(found.columns) != 1:
        raise ValueError("a freshness query gives one column")
    return found.select(F.col(found.columns[0]).alias("max_loaded_at"), F.current_timestamp().alias("snapshotted_at")).limit(1)


def high_water(df: DataFrame, column: str, default=None) -> DataFrame:
    mark = F.max(column)
    return df.agg((F.coalesce(mark, F.lit(default)) if default is not None else mark).alias("high_water"))


#: Bins that a range of values is cut into per pass, and values of a range that are put in order by one task.
QUANTILE_BINS, QUANTILE_ROWS = 1024, 100_000


def quantiles_by_key(
    df: DataFrame, keys: Sequence[str], column: str, points: Sequence[float], bins: int = QUANTILE_BINS, rows: int = QUANTILE_ROWS,
) -> DataFrame:
    """Exact interpolated quantiles of every key: the keys, point, value. Rows without a value don't count.

    Ranks are searched for by refining histograms: each pass cuts the range that holds a wanted rank into bins, counts
    them (partial sums per task, so a key with a large part of all rows is no more work for one task than another), and
    goes on with the bin that the rank falls in, between the least and greatest value found there. A range of one value
    is an answer; one of at most ``rows`` values is put in order. Keys may be NULL, each combination is one key.
    """
    keys = list(keys)
    key = F.struct(*keys) if keys else F.struct(F.lit(1).alias("_all"))
    values = df.select(key.alias("_key"), F.col(column).cast("double").alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    values = stage(values, "values")
    ranges = values.groupBy("_key").agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    place = F.col("point") * (F.col("n") - 1)
    wanted = (
        ranges.withColumn("point", F.explode(F.array(*[F.lit(float(p)) for p in points])))
        .withColumn("rank", F.explode(F.array_distinct(F.array(F.floor(place), F.ceil(place)))))
        .select("_key", "rank", F.lit(0).cast("bigint").alias("below"), "n", "low", "high").distinct()
    )
    totals = ranges.select("_key", F.col("n").alias("total"))
    found: list[DataFrame] = []
    while True:
        wanted = stage(wanted, "ranks")
        exact = F.col("low") == F.col("high")
        found.append(wanted.filter(exact).select("_key", "rank", F.col("low").alias("v")))
        left = wanted.filter(~exact)
        found.append(_ranked(values, left.filter(F.col("n") <= rows)))
        wide = left.filter(F.col("n") > rows)
        if wide.isEmpty():
            break
        wanted = _narrowed(values, wide, bins)
    at = stage(concat(found), "found")
    place = F.col("point") * (F.col("total") - 1)
    asked = totals.withColumn("point", F.explode(F.array(*[F.lit(float(p)) for p in points])))
    asked = asked.withColumns({"_low": F.floor(place), "_high": F.ceil(place), "_rest": place - F.floor(place)})
    side = lambda name, value: at.select("_key", F.col("rank").alias(name), F.col("v").alias(value))
    both = asked.join(side("_low", "_a"), ["_key", "_low"]).join(side("_high", "_b"), ["_key", "_high"])
    value = F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_rest")
    return both.select(*[F.col("_key")[k].alias(k) for k in keys], "point", value.alias("value"))


def _inside(values: DataFrame, wanted: DataFrame) -> DataFrame:
    """Values inside a wanted range of their key, with the range. A key has few ranges, so they travel as one row."""
    ranges = wanted.select("_key", F.struct("below", "n", "low", "high").alias("_range")).distinct()
    per_key = ranges.groupBy(F.col("_key").alias("_of")).agg(F.collect_list("_range").alias("_ranges"))
    # whether it is sent to every task or both sides are shuffled and split where skewed is told by its size
    joined = values.join(per_key, F.col("_key").eqNullSafe(F.col("_of")))
    hit = F.filter("_ranges", lambda r: F.col("v").between(r["low"], r["high"]))
    return joined.select("_key", "v", F.explode(hit).alias("_range"))


def _ranked(values: DataFrame, wanted: DataFrame) -> DataFrame:
    """Values at the wanted ranks of small ranges. Equal values count once, with their number."""
    counted = _inside(values, wanted).groupBy("_key", "_range", "v").agg(F.count("*").alias("_times"))
    along = Window.partitionBy("_key", "_range").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    upto = counted.withColumn("_upto", F.col("_range.below") + F.sum("_times").over(along))
    ranks = wanted.select(F.col("_key").alias("_of"), "rank", F.struct("below", "n", "low", "high").alias("_in"))
    hit = (F.col("_key") == F.col("_of")) & (F.col("_range") == F.col("_in"))
    both = upto.join(ranks, hit).filter((F.col("rank") < F.col("_upto")) & (F.col("rank") >= F.col("_upto") - F.col("_times")))
    return both.select("_key", "rank", "v")


def _narrowed(values: DataFrame, wanted: DataFrame, bins: int) -> DataFrame:
    """Each wanted rank with the bin of its range that holds it."""
    r = F.col("_range")
    # halves first: the span of two large values of unlike sign has no double
    share = (F.col("v") / 2 - r["low"] / 2) / (r["high"] / 2 - r["low"] / 2)
    binned = _inside(values, wanted).withColumn("_bin", F.least(F.floor(share * bins), F.lit(bins - 1)))
    sizes = binned.groupBy("_key", "_range", "_bin").agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    along = Window.partitionBy("_key", "_range").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    before = r["below"] + F.coalesce(F.sum("n").over(along), F.lit(0))
    cut = sizes.withColumn("below", before)
    ranks = wanted.select(F.col("_key").alias("_of"), "rank", F.struct("below", "n", "low", "high").alias("_in"))
    both = cut.join(ranks, (F.col("_key") == F.col("_of")) & (F.col("_range") == F.col("_in")))
    held = both.filter((F.col("rank") >= F.col("below")) & (F.col("rank") < F.col("below") + F.col("n")))
    return held.select("_key", "rank", "below", "n", "low", "high")
