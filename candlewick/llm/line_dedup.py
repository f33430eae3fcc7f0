"""Repeated lines: two Bloom filters find the suspects, only these shuffle for the exact count.

A first pass keeps two filters of fixed size: keys seen in one document and keys seen in two or more. A second pass
writes the rows with a line that the second filter has, each with a number of its own and those lines' 128-bit hashes, so
lines that occur once, which are most, never leave their task, and neither do texts without a suspect. Exact counts then
choose the keys to drop and the document that keeps them. Small filters only let more lines through; the result doesn't
depend on their size.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import pieces, ship, sum_tables
from candlewick.session import stage

SEGMENTS = 64


def line_keys(text: bytes, least: int) -> list[bytes | None]:
    """For each line its 128-bit key hash, None where the key has fewer than `least` code points."""
    out = []
    for line in text.split(b"\n"):
        key = line.strip().lower()
        long = len(key) >= least and (len(key) >= 4 * least or len(key.decode()) >= least)
        out.append(xxhash.xxh3_128_digest(key) if long else None)
    return out


def places(keys: list[bytes], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two filter positions of each key."""
    halves = np.frombuffer(b"".join(keys), np.uint64).reshape(-1, 2) & np.uint64((1 << bits) - 1)
    return halves[:, 0].astype(np.int64), halves[:, 1].astype(np.int64)


class SeenFilters:
    """Filters of one task: keys met in one document, and keys met in another one, too."""

    def __init__(self, least: int, bits: int):
        self.least, self.bits = least, bits
        self.once, self.twice = np.zeros(1 << bits, bool), np.zeros(1 << bits, bool)

    def add(self, batch: pa.RecordBatch) -> None:
        for piece in pieces(batch, [0]):
            keys = sorted(k for text in piece.column(0).to_pylist() if text
                          for k in {*line_keys(text, self.least)} - {None})
            if not keys:
                continue
            a, b = places(keys, self.bits)
            again = np.fromiter((x == y for x, y in zip(keys, [b"", *keys])), bool, len(keys))
            known = again | (self.once[a] & self.once[b])
            self.twice[a[known]] = self.twice[b[known]] = True
            self.once[a] = self.once[b] = True

    def pieces(self):
        size = (1 << self.bits) // SEGMENTS
        for s in range(SEGMENTS):
            part = slice(s * size, (s + 1) * size)
            if self.once[part].any():
                yield s, np.concatenate([np.packbits(self.once[part]), np.packbits(self.twice[part])])


def merge_filters(total: np.ndarray, piece: np.ndarray) -> None:
    """A bit set once on both sides was seen twice."""
    half = len(total) // 2
    total[half:] |= piece[half:] | (total[:half] & piece[:half])
    total[:half] |= piece[:half]


def repeated_filter(df: DataFrame, text: str, least: int, bits: int) -> bytes:
    """The filter of keys that may occur in two documents; 2**bits bits, whatever the number of lines."""
    if not 9 <= bits <= 30:
        raise ValueError("a filter has 2**9 to 2**30 bits")
    found = sum_tables(df, [df[text].cast("binary").alias("text")], lambda: SeenFilters(least, bits), merge_filters, SEGMENTS, np.uint8)
    size = (1 << bits) // SEGMENTS // 8
    return b"".join(found[s][size:].tobytes() if s in found else bytes(size) for s in range(SEGMENTS))


def lost_lines(suspects: DataFrame, documents: int) -> DataFrame:
    """Per row that loses lines: drop_row and drop_lines, the hashes of the keys that it loses; no more than its text has.

    `suspects` has the row's number, its key and its suspect lines, each once.
    """
    seen = suspects.select("row", "key", F.explode("lines").alias("line"))
    repeated = stage(seen.groupBy("line").agg(F.count("*").alias("n"), F.max("key").alias("keeper"))
                     .where(F.col("n") >= documents).select(F.col("line").alias("dropped"), "keeper"), "repeated-lines")
    # both sides are stored tables, so that Spark splits the rows of a line that a third of all documents holds
    lost = seen.join(repeated, seen.line == repeated.dropped).where(~F.col("key").eqNullSafe(F.col("keeper")))
    pairs = stage(lost.select(F.col("row").alias("drop_row"), "line"), "lost-lines")
    return pairs.groupBy("drop_row").agg(F.collect_list("line").alias("drop_lines"))


def dedup_lines(df: DataFrame, text: str = "text", key: str = "doc_id", least: int = 40, documents: int = 5,
                bits: int = 25, digest: bool = False) -> DataFrame:
    """Drops repeated lines: all columns with the new text, then n_lines (before) and n_dropped.

    A line's key is the line without ASCII white space at both ends, ASCII letters in lower case. Keys of `least`
    or more code points found in `documents` or more documents stay only in the document with the largest key
    column. With `digest` the result is the key, n_lines, n_dropped and kept_sha256 instead of texts.

    A null or empty text is one empty line and becomes an empty text. A null in the key column is never the largest
    (such a document keeps a line only if no document that holds it has a key). Each row counts as a document; rows
    with the same key share what they keep. An empty table gives an empty table. Columns named n_lines or n_dropped
    in the input are replaced.
    """
    ship(df.sparkSession)
    packed = repeated_filter(df, text, least, bits)
    outs = ["n_lines", "n_dropped", "kept_sha256"]
    others = [key] if digest else [c for c in df.columns if c != text and c not in outs[:2]]
    n = len(others)
    rows = df.select(*[df[c].alias(f"k{i}") for i, c in enumerate(others)], df[text].cast("binary").alias("text"))
    kinds = [df.schema[c].dataType.simpleString() for c in others]
    names = [f"c{i}" for i in range(n + 3)]
    result = ", ".join(f"c{i} {t}" for i, t in enumerate([*kinds, "string", "bigint", "bigint"]))

    def split(with_suspects: bool):
        """The rows that have suspect lines, with those; or the others, with their results."""
        def run(batches):
            twice = np.unpackbits(np.frombuffer(packed, np.uint8)).view(bool)
            for batch in (piece for batch in batches for piece in pieces(batch, [n])):
                keys = [[*{*line_keys(t, least)} - {None}] if t else [] for t in batch.column(n).to_pylist()]
                flat = [k for ks in keys for k in ks]
                if flat:
                    a, b = places(flat, bits)
                    hit = iter((twice[a] & twice[b]).tolist())
                    keys = [[k for k in ks if next(hit)] for ks in keys]
                part = batch.filter(pa.array([bool(ks) == with_suspects for ks in keys]))
                if with_suspects:
                    lines = pa.array([ks for ks in keys if ks], pa.list_(pa.binary()))
                    yield pa.RecordBatch.from_arrays([*part.columns, lines], [*part.schema.names, "lines"])
                else:
                    yield results(part, [None] * part.num_rows)

        return run

    def results(batch: pa.RecordBatch, drops: list) -> pa.RecordBatch:
        kept, total, gone = [], [], []
        for value, drop in zip(batch.column(n).to_pylist(), drops, strict=True):
            value = value or b""
            lines = stay = value.split(b"\n")
            if drop:
                drop = set(drop)
                stay = [x for x, k in zip(lines, line_keys(value, least), strict=True) if k not in drop]
            out = b"\n".join(stay)
            kept.append(hashlib.sha256(out).hexdigest() if digest else out.decode())
            total.append(len(lines))
            gone.append(len(lines) - len(stay))
        made = [pa.array(kept, pa.string()), pa.array(total, pa.int64()), pa.array(gone, pa.int64())]
        return pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(n)), *made], names)

    def without(batches):
        for batch in (piece for batch in batches for piece in pieces(batch, [n])):
            yield results(batch, batch.column(n + 1).to_pylist())

    held = ", ".join([*(f"k{i} {t}" for i, t in enumerate(kinds)), "text binary", "lines array<binary>"])
    touched = stage(rows.mapInArrow(split(True), held).withColumn("row", F.monotonically_increasing_id()), "suspect-rows")
    drops = lost_lines(touched.select("row", F.col(f"k{others.index(key)}").alias("key"), "lines"), documents)
    # a merge join at every size: neither side has a proven bound
    joined = touched.join(drops.hint("merge"), touched.row == drops.drop_row, "left")
    found = joined.select(*[f"k{i}" for i in range(n)], "text", "drop_lines").mapInArrow(without, result)
    made = rows.mapInArrow(split(False), result).unionAll(found)
    named = made.toDF(*others, outs[2] if digest else text, "n_lines", "n_dropped")
    return named if digest else named.select(*[c for c in df.columns if c not in outs[:2]], "n_lines", "n_dropped")


def op3_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Lines of all documents that repeat in five or more: counts and the digest of what stays."""
    return dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"), digest=True)


#: The same rows in DuckDB.
OP3_SQL = r"""
WITH rows AS (
    SELECT doc_id, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), lines AS (
    SELECT doc_id, r, i, line,
           translate(trim(line, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM (SELECT doc_id, r, unnest(generate_series(1, len(parts))) AS i, unnest(parts) AS line FROM rows)
), repeated AS (
    SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 40
    GROUP BY key HAVING count(DISTINCT r) >= 5
), marked AS (
    SELECT l.doc_id, l.r, l.i, l.line, p.key IS NOT NULL AND l.doc_id IS DISTINCT FROM p.keeper AS dropped
    FROM lines l LEFT JOIN repeated p ON l.key = p.key
)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE dropped) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY r, doc_id
"""
