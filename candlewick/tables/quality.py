"""Declarative checks. Each returns the failing rows; an empty frame is a pass."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def tested(df: DataFrame, where: str | None = None) -> DataFrame:
    return df.filter(F.expr(where)) if where else df


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    counted = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("unique_field"))
    return counted.agg(F.count("*").alias("n_records")).filter(F.col("n_records") > 1)


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n_records")).filter(F.col("n_records") > 1)


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the list with their count; NULL never fails."""
    counted = df.groupBy(F.col(column).alias("value_field")).agg(F.count("*").alias("n_records"))
    return counted.filter(~F.col("value_field").isin(list(values)))


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Non-null child values without a parent.

    Child values are reduced to distinct ones before the join, so a value that fills a third of
    the child is compared once.
    """
    values = child.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("from_field")).agg(
        F.count("*").alias("n_records")
    )
    keys = parent.select(F.col(parent_column).alias("from_field")).distinct()
    return values.join(keys, "from_field", "left_anti")


@dataclass(frozen=True)
class Severity:
    warn_if: str = "failures != 0"
    error_if: str = "failures != 0"
    limit: int | None = None
    fail_calc: str = "count(*)"  # what counts as the failures: an aggregate over the failing rows


def severity(failing: DataFrame, rule: Severity = Severity()) -> DataFrame:
    """One row: the failures (their count unless the rule says otherwise) and the two flags."""
    rows = failing.limit(rule.limit) if rule.limit is not None else failing
    counted = rows.agg(F.coalesce(F.expr(rule.fail_calc), F.lit(0)).alias("failures"))
    return counted.select(
        "failures", F.expr(rule.warn_if).alias("should_warn"), F.expr(rule.error_if).alias("should_error")
    )


def failures_view(failing: DataFrame, name: str) -> DataFrame:
    """The failing rows under a name, found again whenever they are read."""
    failing.createOrReplaceTempView(name)
    return failing.sparkSession.table(name)


def store_failures(failing: DataFrame, path: str) -> DataFrame:
    failing.write.mode("overwrite").parquet(path)
    return failing.sparkSession.read.schema(failing.schema).parquet(path)


def row_diff(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Rows on one side only, tagged, duplicates counted."""
    e = expected.select(*actual.columns)
    left = actual.exceptAll(e).withColumn("actual_or_expected", F.lit("actual"))
    right = e.exceptAll(actual).withColumn("actual_or_expected", F.lit("expected"))
    return left.unionByName(right)


class ContractBroken(ValueError):
    pass


def contract(df: DataFrame, declared: T.StructType) -> DataFrame:
    """Return df when names, types and number of columns match the declaration."""
    have = {f.name.lower(): f.dataType for f in df.schema}
    want = {f.name.lower(): f.dataType for f in declared}
    problems = [f"missing {n}" for n in want if n not in have]
    problems += [f"undeclared {n}" for n in have if n not in want]
    problems += [
        f"{n}: {have[n].simpleString()} is not {want[n].simpleString()}"
        for n in want
        if n in have and have[n] != want[n]
    ]
    if problems:
        raise ContractBroken("; ".join(problems))
    return df


def contract_report(df: DataFrame, declared: T.StructType) -> list[tuple[str, str | None, str | None]]:
    have = {f.name.lower(): f.dataType.simpleString() for f in df.schema}
    want = {f.name.lower(): f.dataType.simpleString() for f in declared}
    names = list(want) + [n for n in have if n not in want]
    return [(n, want.get(n), have.get(n)) for n in names if want.get(n) != have.get(n)]
