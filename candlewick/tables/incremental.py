"""Incremental loading: which rows are new, and how they enter the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.operators import dedup, joins
from candlewick.operators.sets import concat
from candlewick.session import stage
from candlewick.tables import drift
from candlewick.tables.store import Table

STRATEGIES = ("append", "merge", "delete_insert", "insert_overwrite", "microbatch")


# ---- new rows ---------------------------------------------------------------


def is_incremental(table: Table, full_refresh: bool = False) -> bool:
    return table.exists() and not full_refresh


def mark_of(target: DataFrame, column: str) -> Column | None:
    """The target's largest value as a literal, so that a filter with it reaches the scan; None without a value."""
    mark = target.agg(F.max(column)).first()[0]
    return None if mark is None else F.lit(mark).cast(target.schema[column].dataType)


def above_mark(df: DataFrame, target: DataFrame, column: str, strict: bool = False) -> DataFrame:
    """Rows above the target's largest value.

    An empty target loads everything; ``strict`` keeps the comparison with an unknown mark, which
    loads nothing.
    """
    mark = mark_of(target, column)
    if mark is None:
        return df.filter(F.lit(False)) if strict else df
    return df.filter(F.col(column) > mark)


#: Bands of starts, and keys of a band that are told to the scan one by one.
BANDS, BAND_KEYS = 8, 1000


def in_bands(
    df: DataFrame, starts: DataFrame, key: Sequence[str], column: str, start: str, bands: int = BANDS, inclusive: bool = True, **lookup
) -> DataFrame:
    """Rows of df from the start of their own key on (without it unless ``inclusive``), joined to ``starts`` (stored, one row per key).

    Keys are put into bands by how far their start lies behind the newest one, each band half as far as the one
    before. A band is a scan of its own, with its least start as a literal bound and, if it has few keys, with them
    too, so one key that lags behind by years doesn't make the others be read that far back.
    """
    key, kind = list(key), starts.schema[start].dataType.typeName()
    number = {"date": F.unix_date, "timestamp": F.unix_micros, "timestamp_ntz": lambda c: F.unix_micros(c.cast("timestamp"))}.get(kind, lambda c: c)
    place = number(F.col(start)).cast("double")
    ends = starts.agg(F.min(place).alias("least"), F.max(place).alias("most")).first()
    if ends.least is None:
        return joins.lookup_join(df.filter(F.lit(False)), starts, key, "inner", **lookup)
    behind = (F.lit(ends.most) - place) / F.lit(max(ends.most - ends.least, 1e-300))
    band = F.least(F.when(behind > 0, F.floor(-F.log2(behind))).otherwise(bands - 1), F.lit(bands - 1)).cast("int")
    placed = starts.withColumn("_band", band)
    after = (lambda x: F.col(column) >= x) if inclusive else (lambda x: F.col(column) > x)
    out = []
    for b in placed.groupBy("_band").agg(F.min(start).alias("least"), F.count("*").alias("n")).collect():
        own = placed.filter(F.col("_band") == b["_band"]).drop("_band")
        rows = df.filter(after(F.lit(b.least).cast(df.schema[column].dataType)))
        if b.n <= BAND_KEYS:
            known = own.select(*key).collect()
            for k in key:
                rows = rows.filter(F.col(k).isin([v for v in {r[k] for r in known} if v is not None]))
        out.append(joins.lookup_join(rows, own, key, "inner", **lookup).filter(after(F.col(start))))
    return concat(out)


def above_own_mark(
    df: DataFrame, target: DataFrame, key: Sequence[str], column: str, strict: bool = False, inclusive: bool = False, **lookup
) -> DataFrame:
    """Rows above (``inclusive``: from) the largest stored value of their own key; a new key is loaded unless strict.

    Known keys are read in bands of marks (``in_bands``). Keys without a stored value are looked for among the key
    columns alone, and only where there are some are their rows read.
    """
    key = list(key)
    marks = stage(target.groupBy(*key).agg(F.max(column).alias("_mark")).filter(F.col("_mark").isNotNull()), "marks")
    if marks.isEmpty():
        return df.filter(F.lit(False)) if strict else df
    known = in_bands(df, marks, key, column, "_mark", inclusive=inclusive, **lookup).drop("_mark")
    if strict:
        return known
    fresh = stage(joins.absent(df.select(*key).distinct(), marks, key), "new-keys")
    if fresh.isEmpty():
        return known
    null_key = F.lit(False)
    for k in key:
        null_key |= F.col(k).isNull()
    whole = joins.lookup_join(df, fresh, key, "inner", **lookup)
    return known.unionByName(whole).unionByName(df.filter(null_key))


def unseen(df: DataFrame, target: DataFrame | Table, keys: Sequence[str]) -> DataFrame:
    """Rows of df whose key the target doesn't hold. Of a table with this key only files that hold some key are read."""
    if isinstance(target, Table):
        if has_key(target, keys):
            df = stage(df, "batch")
            target = target.of_files(target.files_with(df))
        else:
            target = target.read()
    return joins.absent(df, target, keys)


def has_key(table: Table, keys: Sequence[str]) -> bool:
    """Whether the table's files are described by this key."""
    return bool(table.key) and [k.lower() for k in table.key] == [k.lower() for k in keys]


# ---- row sets ---------------------------------------------------------------


def merged(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_columns: Sequence[str] | None = None,
    exclude_columns: Sequence[str] | None = None,
    predicate: Column | None = None,
) -> DataFrame:
    """The table after an upsert on keys.

    By default a matched row is replaced. With a column list only those change; with an excluded
    list all others do. A predicate narrows which target rows can be matched at all.
    """
    if update_columns and exclude_columns:
        raise ValueError("give the columns to update or the ones to exclude, not both")
    keys = list(keys)
    columns = target.columns
    open_rows = target if predicate is None else target.filter(predicate)
    fixed = None if predicate is None else target.filter(~F.coalesce(predicate, F.lit(False)))
    if update_columns or exclude_columns:
        lower = lambda cs: {c.lower() for c in cs}
        if update_columns:
            changed = lower(update_columns)
        else:
            changed = lower(columns) - lower(exclude_columns)
        changed -= lower(keys)
        old = open_rows.select(*keys, F.struct(*columns).alias("_old"))
        new = source.select(*keys, F.struct(*columns).alias("_new"))
        both = old.join(new, keys, "full")
        picked = []
        for c in columns:
            take_new = F.col("_new").isNotNull() & (F.col("_old").isNull() | F.lit(c.lower() in changed))
            picked.append(F.when(take_new, F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}")).alias(c))
        out = both.select(*picked)
    else:
        out = joins.absent(open_rows, source, keys).unionByName(source.select(*columns))
    return out if fixed is None else out.unionByName(fixed)


def delete_inserted(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key is in the batch go, the whole batch (duplicates included) comes."""
    return joins.absent(target, source.select(*keys).distinct(), keys).unionByName(source.select(*target.columns))


def period_replaced(target: DataFrame, batch: DataFrame, event_time: str, start, end) -> DataFrame:
    """Target without [start, end) of the event time, plus the batch."""
    t = F.col(event_time)
    inside = (t >= F.lit(start)) & (t < F.lit(end))
    return target.filter(~F.coalesce(inside, F.lit(False))).unionByName(batch.select(*target.columns))


# ---- writing ----------------------------------------------------------------


class DuplicateKeys(ValueError):
    """A batch holds several rows for one key, so it isn't known which of them to keep."""


def one_per_key(df: DataFrame, keys: Sequence[str], newest_by: Sequence[str] = ()) -> DataFrame:
    """The batch with one row per key: the newest by the given columns, or a refusal where there are several.

    Rows with a NULL in the key match nothing and each other neither; they are left alone.
    """
    known = F.lit(True)
    for k in keys:
        known &= F.col(k).isNotNull()
    if newest_by:
        newest = dedup.first_per_key(df.filter(known), keys, [F.desc_nulls_last(c) for c in newest_by])
        return newest.unionByName(df.filter(~known))
    several = df.filter(known).groupBy(*keys).count().filter("count > 1").agg(F.count("*").alias("n"), F.max("count").alias("most")).first()
    if several.n:
        raise DuplicateKeys(f"{several.n} keys ({', '.join(keys)}) occur up to {several.most} times in the batch")
    return df


def default_strategy(warehouse: bool = True) -> str:
    return "merge" if warehouse else "append"


def load(
    table: Table,
    df: DataFrame,
    strategy: str | None = None,
    unique_key: Sequence[str] = (),
    on_schema_change: str = "ignore",
    full_refresh: bool = False,
    update_columns: Sequence[str] | None = None,
    exclude_columns: Sequence[str] | None = None,
    predicate: Column | None = None,
    event_time: str | None = None,
    period: tuple | None = None,
    partition_in_key: bool = False,
    cluster_by: Sequence[str] = (),
    columns: Sequence[str] | None = None,
    newest_by: Sequence[str] = (),
    notes: dict | None = None,
) -> None:
    """Bring the rows of df into the table. ``notes`` appear with the new version.

    A merge needs one row per key: a batch with several is refused, or reduced to the newest by the columns of
    ``newest_by``. ``columns`` restricts an insert-overwrite or append to these columns of the batch; the table's
    others become NULL.

    ``partition_in_key`` states that the partition columns are part of, or computed from, the
    unique key. Then a merge reads and rewrites only the partitions present in the batch. Otherwise, in a
    table whose key is the unique key, it reads and rewrites only the files that hold a key of the batch;
    in any other one a new version of the whole table is written.
    """
    if not is_incremental(table, full_refresh):
        table.replace(df, cluster_by, notes)
        return
    strategy = strategy or default_strategy()
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy}")
    if columns is not None:
        if strategy not in ("append", "insert_overwrite"):
            raise ValueError("a column subset goes with append and insert_overwrite")
        named = {c.lower() for c in columns}
        if unknown := named - {f.name.lower() for f in table.schema()}:
            raise ValueError(f"the table has no column {', '.join(sorted(unknown))}")
        df = df.select(*[(F.col(f.name) if f.name.lower() in named else F.lit(None)).cast(f.dataType).alias(f.name) for f in table.schema()])
    df = drift.reconcile(table, df, on_schema_change)
    if strategy == "append" or (strategy in ("merge", "delete_insert") and not unique_key):
        table.append(df, notes)
        return
    if strategy == "insert_overwrite":
        table.replace(df, cluster_by, notes)
        return
    df = stage(df, "batch")  # the batch is read for its partitions, its keys and its rows
    if strategy == "microbatch":
        if not event_time or not period:
            raise ValueError("microbatch needs an event time column and a period")
        start, end = period
        if table.partition_by == [event_time]:
            t = F.col(event_time)
            old = table.read().filter((t >= F.lit(start)) & (t < F.lit(end)))
            touched = table.partitions(old.select(event_time).unionByName(df.select(event_time)))
            table.replace_partitions(period_replaced(table.only(touched), df, event_time, start, end), touched, notes=notes)
            return
        table.replace(period_replaced(table.read(), df, event_time, start, end), cluster_by, notes)
        return
    if strategy == "merge":
        df = one_per_key(df, unique_key, newest_by)
    touched = table.partitions(df) if partition_in_key and table.partition_by else None
    held = table.files_with(df) if touched is None and has_key(table, unique_key) else None
    if held is not None:
        target = table.of_files(held)
    else:
        target = table.read() if touched is None else table.only(touched)
    if strategy == "merge":
        rows = merged(target, df, unique_key, update_columns, exclude_columns, predicate)
    else:
        rows = delete_inserted(target, df, unique_key)
    if held is not None:
        table.replace_files(rows, held, cluster_by, notes)
    elif touched is None:
        table.replace(rows, cluster_by, notes)
    else:
        table.replace_partitions(rows, touched, notes=notes)
