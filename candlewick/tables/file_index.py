"""What the files of a table may hold: per file the least and greatest key and a filter of its keys' hashes.

Both are written beside a load, once, from its key columns alone. A look-up narrows the files in three steps: by the
bounds of the batch, by the filters (a batch of few keys only), and by the key columns of the files that are left. So it
gives exactly the files that hold a key of the batch, and reads the key columns of few others.

A filter is cut into buckets of 32,768 bits. A key's bits lie in one bucket, so every bucket is tested by itself.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.session import ship

FILE, ROWS = "_file", "_rows"
#: Bits of a filter per key, bits set for one key, bits of a bucket (fixed by Spark's bitmap functions).
KEY_BITS, PROBES, BUCKET_BITS = 16, 6, 32_768
#: Keys of a batch whose hashes are sent to the tasks: eight bytes each. Larger batches are compared without filters.
FILTER_KEYS = 1_000_000


def known(keys: Sequence[str]) -> Column:
    """Rows whose key has no NULL; the others match nothing."""
    out = F.lit(True)
    for k in keys:
        out &= F.col(k).isNotNull()
    return out


def probe_bits(h: Column) -> Column:
    """The places of a key inside its bucket, from the upper bits of its hash."""
    step = F.shiftrightunsigned(h, 49).bitwiseOR(F.lit(1))
    first = F.shiftrightunsigned(h, 34) % BUCKET_BITS
    return F.array(*[((first + step * i) % BUCKET_BITS).cast("bigint") for i in range(PROBES)])


def probe_places(h: np.ndarray) -> np.ndarray:
    """The same places for an array of hashes, one row each."""
    u = h.view(np.uint64)
    step, first = u >> np.uint64(49) | np.uint64(1), (u >> np.uint64(34)) % np.uint64(BUCKET_BITS)
    return (first[:, None] + step[:, None] * np.arange(PROBES, dtype=np.uint64)) % np.uint64(BUCKET_BITS)


def bounds_schema(keys: Sequence[T.StructField]) -> T.StructType:
    sides = [T.StructField(f"{side}_{i}", f.dataType) for i, f in enumerate(keys) for side in ("least", "greatest")]
    return T.StructType([T.StructField(FILE, T.StringType()), T.StructField(ROWS, T.LongType()), *sides])


FILTERS = T.StructType([T.StructField(FILE, T.StringType()), T.StructField("buckets", T.LongType()), T.StructField("bucket", T.LongType()),
                        T.StructField("bits", T.BinaryType())])


def bounds(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per file of `rows` (column _file): rows with a key, least and greatest value of each key column."""
    sides = [f(k).alias(f"{side}_{i}") for i, k in enumerate(keys) for side, f in (("least", F.min), ("greatest", F.max))]
    return rows.filter(known(keys)).groupBy(FILE).agg(F.count("*").alias(ROWS), *sides)


def filters(rows: DataFrame, sizes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per file and bucket the bits of its keys; the number of buckets, a power of two, follows the rows of a file."""
    needed = F.ceil(F.col(ROWS) * KEY_BITS / BUCKET_BITS)
    buckets = F.pow(2, F.ceil(F.log2(F.greatest(needed, F.lit(1))))).cast("bigint")
    counted = F.broadcast(sizes.select(FILE, buckets.alias("buckets")))  # one row per file of one load
    hashed = rows.filter(known(keys)).select(FILE, F.xxhash64(*keys).alias("_h")).join(counted, FILE)
    placed = hashed.select(FILE, "buckets", F.pmod("_h", "buckets").alias("bucket"), F.explode(probe_bits(F.col("_h"))).alias("_bit"))
    return placed.groupBy(FILE, "buckets", "bucket").agg(F.bitmap_construct_agg("_bit").alias("bits"))


def may_hold(found: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Files whose bounds (frame `found`) meet those of the batch in every key column."""
    sides = [f(k).alias(f"{side}_{i}") for i, k in enumerate(keys) for side, f in (("least", F.min), ("greatest", F.max))]
    ends = batch.filter(known(keys)).agg(*sides).first()
    for i, _ in enumerate(keys):
        if ends[f"least_{i}"] is None:
            return found.filter(F.lit(False))
        kind = found.schema[f"least_{i}"].dataType
        found = found.filter((F.col(f"greatest_{i}") >= F.lit(ends[f"least_{i}"]).cast(kind)) & (F.col(f"least_{i}") <= F.lit(ends[f"greatest_{i}"]).cast(kind)))
    return found


def hit(stored: DataFrame, hashes: np.ndarray) -> DataFrame:
    """Files (column _file) of the stored filters in which all bits of some hash are set."""

    def run(batches):
        sorted_by: dict[int, tuple] = {}
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                n = row["buckets"]
                if n not in sorted_by:  # buckets are powers of two, so there are few numbers of them
                    place = hashes % n
                    order = np.argsort(place, kind="stable")
                    sorted_by[n] = place[order], probe_places(hashes[order])
                place, probes = sorted_by[n]
                a, b = np.searchsorted(place, [row["bucket"], row["bucket"] + 1])
                if b > a:
                    bits = np.frombuffer(row["bits"], np.uint8)
                    p = probes[a:b]
                    if (bits[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8) & 1).all(1).any():
                        out.append(row[FILE])
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], [FILE])

    ship(stored.sparkSession)
    return stored.mapInArrow(run, f"{FILE} string").distinct()


def few_hashes(batch: DataFrame, keys: Sequence[str], most: int = FILTER_KEYS) -> np.ndarray | None:
    """Hashes of the batch's keys, None where there are more than `most` of them."""
    rows = batch.filter(known(keys)).select(F.xxhash64(*keys).alias("h")).distinct().limit(most + 1).toPandas()
    return None if len(rows) > most else rows["h"].to_numpy(np.int64)
