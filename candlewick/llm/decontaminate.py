"""Benchmark passages in documents: an FM-index per shard of documents, searched for all windows at once.

A shard is a block of documents as word numbers. A word outside the benchmark's vocabulary cannot lie in an
occurrence, so the index holds the maximal runs of vocabulary words that are long enough for a window, each behind
a separator. Suffixes are sorted by prefix doubling; the last column stands in a wavelet matrix, whose ranks drive
backward search of all windows side by side; occurrences are located by walking back to sampled suffix positions;
their spans are merged per document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import KINDS, WORDS, cuts, ship
from candlewick.session import stage

SHARD_BYTES = 16 << 20
#: Benchmark text searched by one function; a larger benchmark is searched block by block.
QUERY_BYTES = 8 << 20
#: Blocks searched in one pass over the documents, each by a Python worker of its own; then the results are written.
BLOCKS_AT_ONCE = 4
SAMPLE = 8


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORDS).split()


def bits_for(values: int) -> int:
    return max(1, int(values).bit_length())


class WaveletMatrix:
    """Ranks of symbols in a sequence: one bit row per binary digit, stably parted from row to row."""

    def __init__(self, values: np.ndarray, digits: int):
        self.digits, self.zeros, self.ranks, self.ones = digits, [], [], []
        for d in range(digits - 1, -1, -1):
            bit = (values >> d) & 1
            self.ranks.append(np.append(0, np.cumsum(bit, dtype=np.int32)))  # ones before each place
            self.zeros.append(int(len(values) - bit.sum()))
            values = np.concatenate([values[bit == 0], values[bit == 1]])

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its place, for many at once."""
        low, place = np.zeros_like(place), place.copy()
        for d, ranks, zeros in zip(range(self.digits - 1, -1, -1), self.ranks, self.zeros, strict=True):
            one = (symbol >> d) & 1 == 1
            before, before_low = ranks[place], ranks[low]
            place = np.where(one, zeros + before, place - before)
            low = np.where(one, zeros + before_low, low - before_low)
        return place - low


def sorted_suffixes(values: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order. Zeros are separators, each smaller than any word and unlike the others."""
    n = len(values)
    gaps = values == 0
    rank = np.where(gaps, np.cumsum(gaps) - 1, values.astype(np.int64) + int(gaps.sum()))
    edges = np.flatnonzero(gaps)
    longest = int(np.diff(np.append(edges, n)).max(initial=1)) if n else 0
    size = 1
    while True:
        key = rank * (n + 1 + int(rank.max(initial=0)))
        key[:n - size] += rank[size:] + 1 if size < n else 0
        order = np.argsort(key, kind="stable")
        if size > longest or n <= 1:
            return order
        ahead = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.append(0, ahead[1:] != ahead[:-1]))
        if rank[order[-1]] == n - 1:
            return order
        size *= 2


class FmIndex:
    """Index over runs of word numbers (1 and up) that are separated by zeros; the sequence begins with a zero."""

    def __init__(self, values: np.ndarray):
        self.values = values
        order = sorted_suffixes(values)
        self.last = values[order - 1]  # the symbol before each suffix
        top = int(values.max(initial=0))
        self.first = np.append(0, np.cumsum(np.bincount(values, minlength=top + 1)))
        self.matrix = WaveletMatrix(self.last, bits_for(top))
        # every eighth word of a run and the run's first one: a walk back never meets a separator
        gap = np.maximum.accumulate(np.where(values == 0, np.arange(len(values)), 0))
        sampled = (np.arange(len(values)) - gap) % SAMPLE == 1
        self.sampled = sampled[order]
        self.positions = order[self.sampled]
        self.slot = np.cumsum(self.sampled) - 1

    def back(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        return self.first[symbol] + self.matrix.rank(symbol, place)

    def search(self, windows: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows (low, high) of each window, by backward search; windows are aligned to the right."""
        low, high = np.zeros(len(sizes), np.int64), np.full(len(sizes), len(self.values), np.int64)
        known = len(self.first) - 1
        alive = np.arange(len(sizes))
        for j in range(windows.shape[1] - 1, -1, -1):
            alive = alive[(low[alive] < high[alive])]
            turn = alive[windows.shape[1] - 1 - j < sizes[alive]]
            if not len(turn):
                break
            symbol = windows[turn, j]
            inside = symbol < known
            high[turn[~inside]] = low[turn[~inside]]
            turn, symbol = turn[inside], symbol[inside]
            low[turn], high[turn] = self.back(symbol, low[turn]), self.back(symbol, high[turn])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: steps back to a sampled row, plus the steps."""
        found = np.zeros(len(rows), np.int64)
        todo, rows, steps = np.arange(len(rows)), rows.copy(), 0
        while len(todo):
            there = self.sampled[rows]
            found[todo[there]] = self.positions[self.slot[rows[there]]] + steps
            todo, rows, steps = todo[~there], rows[~there], steps + 1
            rows = self.back(self.last[rows], rows)
        return found


class Windows:
    """The windows of a block of benchmark items as word numbers, each with its items."""

    def __init__(self, items: list[tuple[str, bytes]], size: int):
        self.number: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            ids = [self.number.setdefault(w, len(self.number) + 1) for w in words_of(text)]
            for i in range(max(1, len(ids) - size + 1) if ids else 0):
                owners.setdefault(tuple(ids[i:i + size]), set()).add(item)
        self.sizes = np.array([len(w) for w in owners], np.int64)
        self.ids = np.zeros((len(owners), size), np.int64)
        for row, w in zip(self.ids, owners, strict=True):
            row[size - len(w):] = w
        self.items = [sorted(s) for s in owners.values()]
        self.least = int(self.sizes.min(initial=size))


def search_shard(texts: list[bytes], windows: Windows) -> tuple[list[int], list[list[tuple[int, int]]], list[set[str]]]:
    """Words, merged spans of hit words, and items found, for each text."""
    counts, parts = [], []
    get = windows.number.get
    for text in texts:
        words = words_of(text)
        counts.append(len(words))
        parts.append(np.fromiter((get(w, 0) for w in words), np.int32, len(words)))
    spans: list[list[tuple[int, int]]] = [[] for _ in texts]
    items: list[set[str]] = [set() for _ in texts]
    # one zero before each text and one at the end, so that runs are told apart
    whole = np.concatenate([x for p in parts for x in (np.zeros(1, np.int32), p)] + [np.zeros(1, np.int32)])
    gaps = np.flatnonzero(whole == 0)
    sizes = np.diff(gaps) - 1
    good = np.flatnonzero(sizes >= windows.least) if len(windows.sizes) else []
    if not len(good):
        return counts, spans, items
    starts, lengths = gaps[good], sizes[good] + 1  # each run with the zero before it
    offsets = np.cumsum(lengths) - lengths
    where = np.repeat(starts - offsets, lengths) + np.arange(int(lengths.sum()))
    index = FmIndex(whole[where])
    low, high = index.search(windows.ids, windows.sizes)
    hits = np.maximum(high - low, 0)
    if not hits.any():
        return counts, spans, items
    window = np.repeat(np.arange(len(hits)), hits)
    rows = np.repeat(low - (np.cumsum(hits) - hits), hits) + np.arange(len(window))
    at = where[index.locate(rows)]
    change = np.zeros(len(whole) + 1, np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + windows.sizes[window], -1)
    covered = np.append(0, (np.cumsum(change) > 0).astype(np.int8))
    edge = np.diff(covered)
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    first = np.cumsum([0, *(len(p) + 1 for p in parts)]) + 1  # place of each text's first word
    for a, b, d in zip(begin.tolist(), end.tolist(), (np.searchsorted(first, begin, "right") - 1).tolist(), strict=True):
        spans[d].append((a - int(first[d]), b - int(first[d])))
    document = np.searchsorted(first, at, "right") - 1
    pairs = np.unique(document * len(hits) + window)
    for pair in pairs.tolist():
        items[pair // len(hits)].update(windows.items[pair % len(hits)])
    return counts, spans, items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def item_blocks(benchmark: DataFrame, item: str, text: str, limit: int) -> Iterator[list[tuple[str, bytes]]]:
    """Items in blocks of bounded size, one at a time on the driver. Items without a word are left out."""
    rows = benchmark.select(benchmark[item].cast("string").alias("item"), benchmark[text].cast("binary").alias("text")).where("text IS NOT NULL")
    block, size = [], 0
    for row in rows.toLocalIterator():
        if block and size + len(row.text) > limit:
            yield block
            block, size = [], 0
        block.append(("" if row.item is None else row.item, bytes(row.text)))
        size += len(row.text)
    if block:
        yield block


def find_passages(df: DataFrame, benchmark: DataFrame, text: str = "text", keep: list[str] | None = None,
                  size: int = 13, item: str = "item_id", item_text: str = "text", query_bytes: int = QUERY_BYTES) -> DataFrame:
    """Occurrences of benchmark windows: `keep`, n_words, n_hit, spans (first and last word), items. No shuffle.

    A window is `size` consecutive words of an item; an item with fewer words, but not none, is one window. Each
    task indexes its documents shard by shard and searches all windows of a block of the benchmark. A benchmark of many
    blocks takes several passes, each written to the shared folder, so plan, driver and tasks hold few blocks at once.

    Null and empty texts have no words; a null key passes through; repeated rows give repeated rows; items without
    a word have no window, a null item_id counts as an empty name, items with equal ids are one; an empty table of
    documents or of items gives an empty table or no hits. Columns that aren't named are not read.
    """
    ship(df.sparkSession)
    keep = ["doc_id"] if keep is None else keep
    plain = [c for c in keep if c != text or df.schema[c].dataType.typeName() != "string"]
    n = len(plain)
    found = df.select(*[df[c].alias(f"k{i}") for i, c in enumerate(plain)], df[text].cast("binary").alias("text"),
                      F.lit(0).cast("bigint").alias("n_words"),
                      F.expr("CAST(array() AS array<struct<first:int,last:int>>)").alias("spans"),
                      F.expr("CAST(array() AS array<string>)").alias("items"))
    schema = found.schema
    kinds = [pa.int64(), KINDS["array<struct<first:int,last:int>>"], KINDS["array<string>"]]

    def searching(items):
        def run(batches):
            windows = Windows(items, size)
            for batch in batches:
                lengths = pc.fill_null(pc.binary_length(batch.column(n)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                for a, b in cuts(lengths, SHARD_BYTES):
                    part = batch.slice(a, b - a)
                    counts, spans, names = search_shard([x or b"" for x in part.column(n).to_pylist()], windows)
                    old = [[(s["first"], s["last"] + 1) for s in x] for x in part.column(n + 2).to_pylist()]
                    spans = [[{"first": x, "last": y - 1} for x, y in merged(s + t)] for s, t in zip(spans, old, strict=True)]
                    names = [sorted({*s, *t}) for s, t in zip(names, part.column(n + 3).to_pylist(), strict=True)]
                    made = [pa.array(x, t) for x, t in zip([counts, spans, names], kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(n + 1)), *made], schema.names)

        return run

    blocks = 0
    for items in item_blocks(benchmark, item, item_text, query_bytes):
        if blocks and blocks % BLOCKS_AT_ONCE == 0:
            found = stage(found, "passages")
        found = found.mapInArrow(searching(items), schema)
        blocks += 1
    if not blocks:  # words are counted all the same
        found = found.mapInArrow(searching([]), schema)
    hit = F.expr("aggregate(spans, 0L, (n, s) -> n + s.last - s.first + 1)")
    kept = [F.col(f"k{plain.index(c)}") if c in plain else F.col("text").cast("string") for c in keep]
    return found.select(*[x.alias(c) for x, c in zip(kept, keep, strict=True)], "n_words", hit.alias("n_hit"), "spans", "items")


def contaminated():
    """The rule: some word is hit, and a twentieth of all words or more."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def op5_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Benchmark windows in all documents, and which documents are contaminated."""
    found = find_passages(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
                        contaminated().alias("contaminated"))


#: The same rows in DuckDB.
OP5_SQL = r"""
WITH doc_words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), item_words AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), item_windows AS (
    SELECT DISTINCT item_id, least(13, len(w)) AS size, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS words
    FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 12))) AS i FROM item_words WHERE len(w) > 0)
), sizes AS (
    SELECT DISTINCT size FROM item_windows
), doc_windows AS (
    SELECT doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') AS words
    FROM (SELECT doc_id, w, size, unnest(generate_series(1, len(w) - size + 1)) AS i
          FROM doc_words, sizes WHERE len(w) >= size)
), hits AS (
    SELECT d.doc_id, d.i, d.size, b.item_id FROM doc_windows d JOIN item_windows b ON d.size = b.size AND d.words = b.words
), hit_words AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT doc_id, unnest(generate_series(i, i + size - 1)) AS p FROM hits) GROUP BY doc_id
), hit_items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(t.n_items, 0) AS n_items,
       sha256(coalesce(t.items, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.w) AS contaminated
FROM doc_words d LEFT JOIN hit_words h USING (doc_id) LEFT JOIN hit_items t USING (doc_id)
"""
