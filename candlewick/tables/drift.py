"""What to do when a query's columns differ from its stored table."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.tables.store import Table

POLICIES = ("ignore", "append_new_columns", "sync_all_columns", "fail")


class SchemaChanged(ValueError):
    pass


@dataclass
class Diff:
    added: list[T.StructField] = field(default_factory=list)
    removed: list[T.StructField] = field(default_factory=list)
    retyped: list[T.StructField] = field(default_factory=list)

    def __bool__(self) -> bool:
        return bool(self.added or self.removed or self.retyped)


def diff(target: T.StructType, source: T.StructType) -> Diff:
    """Columns only in the source, only in the target, and present in both with another type."""
    t = {f.name.lower(): f for f in target}
    s = {f.name.lower(): f for f in source}
    return Diff(
        [f for n, f in s.items() if n not in t],
        [f for n, f in t.items() if n not in s],
        [f for n, f in s.items() if n in t and t[n].dataType != f.dataType],
    )


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of df in the order and types of schema; missing ones as typed NULLs."""
    have = {c.lower() for c in df.columns}
    return df.select(
        *[
            (F.col(f.name) if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def reconcile(table: Table, df: DataFrame, policy: str) -> DataFrame:
    """Apply the drift policy to the table and return df in the table's shape."""
    if policy not in POLICIES:
        raise ValueError(f"unknown policy {policy}")
    target = table.schema()
    d = diff(target, df.schema)
    if policy == "fail" and d:
        raise SchemaChanged(f"added {d.added}, removed {d.removed}, retyped {d.retyped}")
    if policy == "ignore":
        if d.removed:
            raise SchemaChanged(f"columns missing from the query: {[f.name for f in d.removed]}")
        return conform(df, target)
    if policy == "append_new_columns":
        if d.added:
            table.add_columns(d.added)
        return conform(df, table.schema())
    if policy == "sync_all_columns":
        if d.removed or d.retyped:
            gone = {f.name.lower() for f in d.removed}
            new = {f.name.lower(): f for f in d.retyped}
            fields = [new.get(f.name.lower(), f) for f in target if f.name.lower() not in gone] + d.added
            table.replace(conform(table.read(), T.StructType(fields)))
        elif d.added:
            table.add_columns(d.added)
        return conform(df, table.schema())
    return df
