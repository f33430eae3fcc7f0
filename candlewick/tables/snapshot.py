"""Row history: one row per version of a key, the open version without an end."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.functions.scalars import history_key
from candlewick.tables.store import Table

# Names of the history columns.
SCD_ID, UPDATED_AT = "dbt_scd_id", "dbt_updated_at"
VALID_FROM, VALID_TO, IS_DELETED = "dbt_valid_from", "dbt_valid_to", "dbt_is_deleted"
META = [SCD_ID, UPDATED_AT, VALID_FROM, VALID_TO]
HARD_DELETES = ("ignore", "invalidate", "new_record")


def _renamed(df: DataFrame, names: dict[str, str] | None, back: bool = False) -> DataFrame:
    """History columns under the caller's names, or back under the fixed ones."""
    if unknown := set(names or {}) - {*META, IS_DELETED}:
        raise ValueError(f"no history column {', '.join(sorted(unknown))}")
    return df.withColumnsRenamed({v: k for k, v in names.items()} if back else dict(names)) if names else df


def _open_end(marker) -> Column:
    return F.lit(marker).cast("timestamp_ntz")


def _versioned(source: DataFrame, keys: Sequence[str], updated_at: Column, marker, deletes: str) -> DataFrame:
    out = source.withColumn(UPDATED_AT, updated_at.cast("timestamp_ntz"))
    out = out.withColumns(
        {
            SCD_ID: history_key(*keys, UPDATED_AT),
            VALID_FROM: F.col(UPDATED_AT),
            VALID_TO: _open_end(marker),
        }
    )
    return out.withColumn(IS_DELETED, F.lit("False")) if deletes == "new_record" else out


def first_snapshot(
    source: DataFrame, keys: Sequence[str], updated_at: Column, open_marker=None, hard_deletes: str = "ignore",
    names: dict[str, str] | None = None,
) -> DataFrame:
    """Every row open, with its version id. ``names`` gives history columns other names."""
    return _renamed(_versioned(source, keys, updated_at, open_marker, hard_deletes), names)


def is_open(marker=None, valid_to: str = VALID_TO) -> Column:
    return F.col(valid_to).isNull() if marker is None else F.col(valid_to).eqNullSafe(_open_end(marker))


def snapshot(
    history: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    now,
    check_cols: Sequence[str] | str | None = None,
    updated_at: str | None = None,
    hard_deletes: str = "ignore",
    open_marker=None,
    names: dict[str, str] | None = None,
) -> DataFrame:
    """The history after comparing its open rows with the source.

    With ``check_cols`` a key gets a new version when one of them differs (NULLs compared as
    values; a column the history does not have yet changes every row); ``"all"`` means every column of the
    source but the keys. With ``updated_at`` alone it does when the source's stamp is later than the open
    version's start; beside check columns the stamp only dates the new version. ``names`` are the history's own
    names for its columns. Only open rows take part in the one full join by key; closed versions pass through.
    """
    if hard_deletes not in HARD_DELETES:
        raise ValueError(f"unknown mode {hard_deletes}")
    if check_cols is None and updated_at is None:
        raise ValueError("give check columns, an update stamp or both")
    keys = list(keys)
    history = _renamed(history, names, back=True)
    if isinstance(check_cols, str):
        if check_cols != "all":
            raise ValueError("check columns are a list, or 'all'")
        check_cols = [c for c in source.columns if c not in keys]
    now_col = F.lit(now).cast("timestamp_ntz")
    stamp = F.col(updated_at) if updated_at else now_col
    new = _versioned(source, keys, stamp, open_marker, hard_deletes)
    if hard_deletes == "new_record" and IS_DELETED not in history.columns:
        history = history.withColumn(IS_DELETED, F.lit("False"))
    extra = [f for f in new.schema if f.name not in history.columns]
    lost = [f for f in history.schema if f.name not in new.columns]
    fresh_checks = [c for c in (check_cols or []) if c not in history.columns]
    history = history.withColumns({f.name: F.lit(None).cast(f.dataType) for f in extra}) if extra else history
    new = new.withColumns({f.name: F.lit(None).cast(f.dataType) for f in lost}) if lost else new
    columns = history.columns
    new = new.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in history.schema])

    open_now = is_open(open_marker)
    closed = history.filter(~open_now)
    old = history.filter(open_now).select(*keys, F.struct(*columns).alias("_old"))
    now_rows = new.select(*keys, F.struct(*columns).alias("_new"))
    both = old.join(now_rows, keys, "full")

    has_old, has_new = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    if check_cols is None:
        differs = F.col(f"_old.{VALID_FROM}") < F.col(f"_new.{UPDATED_AT}")
    elif fresh_checks:
        differs = F.lit(True)
    else:
        differs = F.lit(False)
        for c in check_cols:
            differs = differs | ~F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}"))
    if hard_deletes == "new_record":
        differs = differs | (F.col(f"_old.{IS_DELETED}") == "True")
    changed = has_old & has_new & F.coalesce(differs, F.lit(False))

    vanished = has_old & ~has_new
    if hard_deletes == "ignore":
        vanished = F.lit(False)
    elif hard_deletes == "new_record":
        vanished = vanished & (F.col(f"_old.{IS_DELETED}") == "False")

    end = F.when(changed, F.col(f"_new.{UPDATED_AT}")).when(vanished, now_col)
    closing = F.col("_old").withField(VALID_TO, F.coalesce(end, F.col(f"_old.{VALID_TO}")))
    kept = F.when(has_old, F.array(closing))
    added = F.when(has_new & (~has_old | changed), F.array(F.col("_new")))
    parts = [kept, added]
    if hard_deletes == "new_record":
        # the tombstone repeats the last known values and is open itself
        tomb = (
            F.col("_old")
            .withField(UPDATED_AT, now_col)
            .withField(VALID_FROM, now_col)
            .withField(VALID_TO, _open_end(open_marker))
            .withField(SCD_ID, history_key(*keys, now_col))
            .withField(IS_DELETED, F.lit("True"))
        )
        parts.append(F.when(vanished, F.array(tomb)))
    empty = F.filter(F.array(F.col("_old")), lambda x: F.lit(False))
    rows = both.select(F.explode(F.concat(*[F.coalesce(p, empty) for p in parts])).alias("_row"))
    return _renamed(closed.unionByName(rows.select(*[F.col(f"_row.{c}").alias(c) for c in columns])), names)


#: Which part of a stored history a row is in.
PART = "_part"


class History:
    """A stored history in an open and a closed part.

    A run reads the open rows, replaces them, and adds the versions that it closes to the closed part, all in one
    version of the table; files of versions closed before are neither read nor written. A run that is repeated after
    a failure, or with the same source, gives the same history.
    """

    def __init__(
        self, spark: SparkSession, path: str, keys: Sequence[str], hard_deletes: str = "ignore", open_marker=None,
        names: dict[str, str] | None = None, **how,
    ):
        self.table = Table(spark, path, [PART])
        self.keys, self.hard_deletes, self.open_marker, self.names, self.how = list(keys), hard_deletes, open_marker, names, how

    def read(self) -> DataFrame:
        return self.table.read().drop(PART)

    def open_rows(self) -> DataFrame:
        return self.table.only({("open",)}).drop(PART)

    def _parted(self, rows: DataFrame) -> DataFrame:
        valid_to = (self.names or {}).get(VALID_TO, VALID_TO)
        return rows.withColumn(PART, F.when(is_open(self.open_marker, valid_to), "open").otherwise("closed"))

    def start(self, source: DataFrame, stamp: Column) -> None:
        self.table.replace(self._parted(first_snapshot(source, self.keys, stamp, self.open_marker, self.hard_deletes, self.names)))

    def run(self, source: DataFrame, now) -> None:
        """Brings the history up to date with the source at the time ``now``."""
        how = self.how | {"hard_deletes": self.hard_deletes, "open_marker": self.open_marker, "names": self.names}
        deleted = (self.names or {}).get(IS_DELETED, IS_DELETED)
        if self.hard_deletes == "new_record" and deleted not in self.table.schema().fieldNames():
            # closed rows get a flag that is not NULL: once, the whole history is written again
            self.table.replace(self._parted(snapshot(self.read(), source, self.keys, now, **how)))
            return
        rows = self._parted(snapshot(self.open_rows(), source, self.keys, now, **how))
        # new columns are NULL in the files of versions closed before
        self.table.replace_partitions(rows, {("open",)}, others="append", schema=rows.schema)
