"""Shared pieces: Arrow maps over text in bounded blocks, and fixed-size tables summed over all tasks."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import candlewick
from candlewick.session import scratch_path

#: Text handled at once inside a task; a longer text forms a block of its own.
BLOCK_BYTES = 2 << 20

KINDS = {
    "bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "double": pa.float64(),
    "binary": pa.binary(), "array<int>": pa.list_(pa.int32()), "array<string>": pa.list_(pa.string()),
    "array<binary>": pa.list_(pa.binary()),
    "array<struct<first:int,last:int>>": pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())])),
    "array<struct<first:int,last:int,score:double>>":
        pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("score", pa.float64())])),
}

#: Turns ASCII letters to lower case and every byte that is not part of a word ([0-9a-z] or beyond ASCII) to a space.
WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def read(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark) -> None:
    """Sends this package to the Python workers, once per application, by way of the shared folder."""
    context = spark.sparkContext
    if getattr(context, "candlewick_shipped", False):
        return
    root, data = Path(candlewick.__file__).parent, io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for file in sorted(root.rglob("*.py")):
            z.write(file, file.relative_to(root.parent))
    path = scratch_path(spark, "code") + ".zip"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    out.write(bytearray(data.getvalue()))
    out.close()
    context.addPyFile(path)
    context.candlewick_shipped = True


def cuts(lengths: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of rows whose lengths add up to about `limit`; never an empty range."""
    ends, at = np.cumsum(lengths), 0
    while at < len(ends):
        done = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + limit, "right")))
        yield at, to
        at = to


def pieces(batch: pa.RecordBatch, columns: list[int], limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in slices whose texts add up to about `limit` bytes, so that few are Python objects at once."""
    lengths = sum(pc.fill_null(pc.binary_length(batch.column(c)), 0).to_numpy(zero_copy_only=False).astype(np.int64) for c in columns)
    if batch.num_rows:
        for a, b in cuts(lengths, limit):
            yield batch.slice(a, b - a)


def map_texts(df: DataFrame, texts: list[str], keep: list[str], outputs: list[tuple[str, str]],
              start: Callable[[], Callable], block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One output row per input row: the columns `keep`, then `outputs` (name, type).

    `start()` runs once per task and returns a function from lists of UTF-8 bytes (one list per text column; null
    becomes empty) to a list of output columns. Only the named columns are read, so other columns of the input
    cannot clash. A text column that is kept, too, goes to the task once.
    """
    ship(df.sparkSession)
    plain = [c for c in keep if c not in texts or df.schema[c].dataType.typeName() != "string"]
    n = len(plain)
    source = df.select(*[df[c].alias(f"k{i}") for i, c in enumerate(plain)],
                       *[df[c].cast("binary").alias(f"t{i}") for i, c in enumerate(texts)])
    place = [plain.index(c) if c in plain else n + texts.index(c) for c in keep]
    types = [df.schema[c].dataType.simpleString() for c in keep] + [t for _, t in outputs]
    schema = ", ".join(f"c{i} {t}" for i, t in enumerate(types))
    kinds = [KINDS[t] for _, t in outputs]

    def run(batches):
        work = start()
        for batch in batches:
            for piece in pieces(batch, [n + i for i in range(len(texts))], block_bytes):
                parts = [[x or b"" for x in piece.column(n + i).to_pylist()] for i in range(len(texts))]
                made = [pa.array(x, t) for x, t in zip(work(*parts), kinds, strict=True)]
                kept = [piece.column(i) for i in place]
                arrays = [x.cast(pa.string()) if i >= n else x for i, x in zip(place, kept, strict=True)] + made
                yield pa.RecordBatch.from_arrays(arrays, [f"c{i}" for i in range(len(arrays))])

    return source.mapInArrow(run, schema).toDF(*keep, *[o for o, _ in outputs])


def pack(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.tobytes())


def unpack(data: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype)


def sum_tables(df: DataFrame, columns: list, start: Callable, merge: Callable, segments: int, dtype) -> dict[int, np.ndarray]:
    """A table of fixed size over all rows: every task fills its own, and the pieces are merged segment by segment.

    `start()` gives an object with `add(batch)` and `pieces()` (segment number, array). Pieces of a segment meet
    in one task as a stream and are merged one by one with `merge(total, piece)` in place, so a task holds its
    segments and one piece. The result has `segments` arrays at most, whatever the number of rows.
    """

    ship(df.sparkSession)

    def fill(batches):
        table = start()
        for batch in batches:
            table.add(batch)
        for segment, values in table.pieces():
            yield pa.RecordBatch.from_arrays([pa.array([segment], pa.int32()), pa.array([pack(values)], pa.binary())], ["segment", "piece"])

    def meet(batches):
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for segment, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                values = unpack(piece, dtype)
                if segment in totals:
                    merge(totals[segment], values)
                else:
                    totals[segment] = values.copy()
        for segment, values in totals.items():
            yield pa.RecordBatch.from_arrays([pa.array([segment], pa.int32()), pa.array([pack(values)], pa.binary())], ["segment", "piece"])

    pieces = df.select(*columns).mapInArrow(fill, "segment int, piece binary")
    rows = pieces.repartition(segments, F.col("segment")).mapInArrow(meet, "segment int, piece binary").collect()
    return {row.segment: unpack(row.piece, dtype) for row in rows}
