"""Aggregates that are kept up to date from changes alone.

A group keeps a state that takes rows in and gives them back: row number, and per measured column its values' number,
sum, sum of squares, least and greatest. Numbers are whole and sums exact decimals, so taking a row back leaves no trace;
squares are doubles, so a variance is right up to rounding. Least and greatest can't be taken back: a group that loses a
row at its extreme is computed again from its rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.session import stage
from candlewick.tables import incremental
from candlewick.tables.store import Table

GROUP = "_group"
EXACT = "decimal(38,9)"


class Maintained:
    """Count, sum, mean, variance, least and greatest per group, stored as states.

    ``rows_of`` gives the source's current rows of some groups (a frame of group columns) for groups that lost an
    extreme; the source must hold the changes by then. Values enter sums rounded to nine digits after the point.
    Batches may carry a number: one that is noted already is not taken in again.
    """

    def __init__(self, table_path: str, spark, keys: Sequence[str], measures: Sequence[str], rows_of: Callable[[DataFrame], DataFrame]):
        self.keys, self.measures, self.rows_of = list(keys), list(measures), rows_of
        self.table = Table(spark, table_path, key=[GROUP])

    def _group(self) -> Column:
        """The group as one text: NULLs are values, and a merge compares one column."""
        return F.to_json(F.struct(*self.keys)).alias(GROUP)

    def _states(self, rows: DataFrame) -> DataFrame:
        """States of signed rows (column _sign: 1 came, -1 went), with the extremes of both kinds."""
        sign, came = F.col("_sign"), F.col("_sign") > 0
        out = [F.sum(sign).cast("bigint").alias("n")]
        for m in self.measures:
            # NaN has no place in sums or order and counts as no value
            v = F.when(~F.isnan(F.col(m).cast("double")), F.col(m))
            x = v.cast(EXACT)
            out += [
                F.coalesce(F.sum(F.when(v.isNotNull(), sign)), F.lit(0)).cast("bigint").alias(f"{m}_n"),
                F.coalesce(F.sum(x * sign), F.lit(0)).cast(EXACT).alias(f"{m}_sum"),
                F.coalesce(F.sum(v.cast("double") * v.cast("double") * sign), F.lit(0.0)).alias(f"{m}_squares"),
                F.min(F.when(came, v)).alias(f"{m}_least"), F.max(F.when(came, v)).alias(f"{m}_greatest"),
                F.min(F.when(~came, v)).alias(f"_{m}_gone_least"), F.max(F.when(~came, v)).alias(f"_{m}_gone_greatest"),
            ]
        return rows.groupBy(self._group(), *self.keys).agg(*out)

    def _plain(self, states: DataFrame) -> DataFrame:
        return states.drop(*[f"_{m}_gone_{side}" for m in self.measures for side in ("least", "greatest")])

    def start(self, rows: DataFrame, number: int | None = None) -> None:
        """The states of all rows."""
        self.table.replace(self._plain(self._states(rows.withColumn("_sign", F.lit(1)))), notes=self._notes(number))

    def _notes(self, number: int | None) -> dict | None:
        return None if number is None else {"batch": number}

    def apply(self, came: DataFrame | None = None, went: DataFrame | None = None, number: int | None = None) -> None:
        """Brings in rows that came and rows that went; a corrected row is one of each.

        Only states of groups with a change are read and written. A batch is one merge, published with its number.
        """
        if number is not None and number <= self.table.notes().get("batch", -1):
            return
        signed = [df.select(*self.keys, *self.measures, F.lit(s).alias("_sign")) for df, s in ((came, 1), (went, -1)) if df is not None]
        if not signed:
            return
        change = stage(self._states(signed[0] if len(signed) == 1 else signed[0].unionByName(signed[1])), "change")
        old = self.table.of_files(self.table.files_with(change))
        both = change.alias("c").join(old.alias("o"), F.col(f"c.{GROUP}") == F.col(f"o.{GROUP}"), "left")
        add = lambda c, kind: (F.coalesce(F.col(f"o.{c}"), F.lit(0)) + F.col(f"c.{c}")).cast(kind).alias(c)
        columns, stale = [F.col(f"c.{GROUP}"), *[F.col(f"c.{k}") for k in self.keys], add("n", "bigint")], F.lit(False)
        for m in self.measures:
            columns += [add(f"{m}_n", "bigint"), add(f"{m}_sum", EXACT), add(f"{m}_squares", "double")]
            for side, pick in (("least", F.least), ("greatest", F.greatest)):
                now = pick(F.col(f"o.{m}_{side}"), F.col(f"c.{m}_{side}"))
                columns.append(now.alias(f"{m}_{side}"))
                gone = F.col(f"c._{m}_gone_{side}")
                # a row beyond what is left of the known values, or at their end, may have been the extreme
                stale |= gone.isNotNull() & F.coalesce(gone <= now if side == "least" else gone >= now, F.lit(True))
        merged = stage(both.select(*columns, (stale & (F.coalesce(F.col("o.n"), F.lit(0)) + F.col("c.n") > 0)).alias("_stale")), "states")
        fresh = merged.filter(~F.col("_stale")).drop("_stale")
        again = merged.filter("_stale").select(*self.keys)
        if not again.isEmpty():
            fresh = fresh.unionByName(self._plain(self._states(self.rows_of(again).withColumn("_sign", F.lit(1)))))
        incremental.load(self.table, fresh, "merge", [GROUP], notes=self._notes(number))

    def read(self) -> DataFrame:
        """The groups that have rows: keys, n, and per column n, sum, mean, variance (of a sample), least, greatest."""
        out = [*self.keys, "n"]
        for m in self.measures:
            n, total, squares = F.col(f"{m}_n"), F.col(f"{m}_sum").cast("double"), F.col(f"{m}_squares")
            least = lambda c, n=n: F.when(n > 0, F.col(c)).alias(c)
            spread = F.greatest(squares - total * total / n, F.lit(0.0)) / (n - 1)
            out += [
                f"{m}_n", F.when(n > 0, F.col(f"{m}_sum")).alias(f"{m}_sum"), F.when(n > 0, total / n).alias(f"{m}_mean"),
                F.when(n > 1, spread).alias(f"{m}_variance"), least(f"{m}_least"), least(f"{m}_greatest"),
            ]
        return self.table.read().filter("n > 0").select(*out)


def changed_groups(source: DataFrame, groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of a source in some groups, NULLs matched as values."""
    wanted = groups.distinct().select(*[F.col(k).alias(f"_{k}") for k in keys])
    hit = F.lit(True)
    for k in keys:
        hit &= F.col(k).eqNullSafe(F.col(f"_{k}"))
    return source.join(wanted, hit, "left_semi")
