"""Generated rows: ranges, date spines, literal fixtures."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from candlewick.functions.scalars import date_diff_units


def rows(spark: SparkSession, n: int, name: str = "seq") -> DataFrame:
    return spark.range(n).withColumnRenamed("id", name)


def generate_series(spark: SparkSession, upper: int) -> DataFrame:
    """Integers 1..upper."""
    if upper <= 0:
        raise ValueError("upper bound must be positive")
    return spark.range(1, upper + 1).withColumnRenamed("id", "generated_number")


def intervals_between(part: str, start, end) -> Column:
    return date_diff_units(part, start, end)


def date_spine(bounds: DataFrame, part: str, start: str = "start", end: str = "end", inclusive: bool = False) -> DataFrame:
    """One row per period from start on, end exclusive by default.

    ``bounds`` is a one-row frame; its two values and the number of periods come to the driver, and the rows are
    made where they are used.
    """
    name = f"date_{part}"
    first, last = (F.col(c).cast("timestamp_ntz") for c in (start, end))
    found = bounds.select(first.alias("a"), last.alias("b"), F.timestamp_diff(part.upper(), first, last).alias("n")).first()
    spark = bounds.sparkSession
    if found is None or found.n is None or found.n < 0:
        return spark.range(0).select(F.lit(None).cast("timestamp_ntz").alias(name))
    at = F.timestamp_add(part.upper(), F.col("id").cast("int"), F.lit(found.a).cast("timestamp_ntz"))
    rows = spark.range(found.n + 2).select(at.alias(name))
    end_at = F.lit(found.b).cast("timestamp_ntz")
    return rows.filter(F.col(name) <= end_at if inclusive else F.col(name) < end_at)


def literal_rows(spark: SparkSession, data: list[dict], schema: T.StructType) -> DataFrame:
    """Rows from literals; missing columns are typed NULLs, unknown ones are an error."""
    known = set(schema.fieldNames())
    for row in data:
        extra = set(row) - known
        if extra:
            raise ValueError(f"unknown columns {sorted(extra)}; the table has {sorted(known)}")
    # an Arrow table becomes a local relation: its size is known to the optimizer and needs no job
    columns = {f.name: pa.array([row.get(f.name) for row in data], to_arrow_type(f.dataType)) for f in schema}
    return spark.createDataFrame(pa.table(columns), schema)


def empty_like(df: DataFrame) -> DataFrame:
    """Zero rows with the query's schema."""
    return df.filter(F.lit(False))
