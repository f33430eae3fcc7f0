"""Ranked lexical search over a length-stratified index.

A document's share of a score depends on its length only by a whole number m. The index cuts the documents into segments
of bounded text; inside a segment documents are numbered by m, so a stratum (the documents with one m) is a run of
numbers, and the postings of a term stand by stratum, then by the term's occurrences tf. Within a stratum all postings
with one tf have one impact, which is computed once.

A search bounds every stratum for every item, by the largest tf of each term in it, visits strata from the highest bound
down, and leaves out the items whose tenth score so far is above the bound. A task keeps those scores from segment to
segment. What leaves a task is at most ten rows an item; one ranking over all tasks ends the search.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from candlewick.llm.common import WORDS, cuts, map_texts, read, ship, sum_tables
from candlewick.session import scratch_path, stage

#: Fixed values of the score: the share of the length in m, the scale of impacts, the weight of m beside tf.
LENGTH_SHARE, IMPACT_SCALE, M_WEIGHT = 75, 1_000_000_000, 8
#: Text of a segment; items searched at once times bytes of their text, which bounds the table of their terms.
SEGMENT_BYTES, BLOCK_CELLS = 16 << 20, 1 << 26
#: Cells of a matrix that is held at once, and sums of whole numbers that doubles hold exactly.
CELLS, EXACT = 1 << 22, 1 << 53


def terms_of(text: bytes) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and signs beyond ASCII, A-Z lower-cased."""
    return text.translate(WORDS).split()


# ---- the index --------------------------------------------------------------


def squeeze(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(values).tobytes())


def spread(data: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype)


def totals(df: DataFrame, text: str) -> tuple[int, int]:
    """Documents with at least one term, and the terms of all of them."""
    counted = map_texts(df, [text], [], [("n", "bigint")], lambda: lambda texts: [[len(terms_of(t)) for t in texts]])
    row = counted.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"), F.sum("n").alias("terms")).first()
    return row.docs, row.terms or 0


def segment(texts: list[bytes], n_docs: int, n_terms: int) -> tuple[np.ndarray, dict]:
    """The order of the documents with terms, by m, and the segment's parts.

    Postings are sorted by (term, m, tf, document), so a document's place, m and the term's runs tell all of them.
    """
    number: dict[bytes, int] = {}
    term, doc, tf, lengths = [], [], [], np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        words = np.fromiter((number.setdefault(w, len(number)) for w in terms_of(text)), np.int64)
        lengths[i] = len(words)
        found, times = np.unique(words, return_counts=True)
        term.append(found.astype(np.int32))
        tf.append(times.astype(np.int32))
        doc.append(np.full(len(found), i, np.int32))
    with_terms = np.flatnonzero(lengths)
    m = normaliser(lengths, n_docs, n_terms)
    order = with_terms[np.argsort(m[with_terms], kind="stable")]
    place = np.zeros(len(texts), np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    names = sorted(number)
    rank = np.zeros(len(names), np.int32)
    rank[[number[w] for w in names]] = np.arange(len(names), dtype=np.int32)
    term, doc, tf = rank[np.concatenate(term)], place[np.concatenate(doc)], np.concatenate(tf)
    at = np.lexsort((doc, tf, m[order][doc], term))
    return order, {
        "terms": zstandard.ZstdCompressor(level=3).compress(b" ".join(names)), "df": squeeze(np.bincount(term, minlength=len(names)).astype("<i4")),
        "m": squeeze(m[order].astype("<i8")), "tf": squeeze(tf[at].astype("<i4")), "docs": squeeze(doc[at].astype("<i4")),
    }


def normaliser(lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """m of documents with these numbers of terms, in whole numbers that don't overflow."""
    if not n_terms:
        return np.full(len(lengths), 100 - LENGTH_SHARE, np.int64)
    if LENGTH_SHARE * int(lengths.max(initial=0)) * n_docs < 1 << 62:
        return 100 - LENGTH_SHARE + LENGTH_SHARE * lengths * n_docs // n_terms
    return np.array([100 - LENGTH_SHARE + LENGTH_SHARE * x * n_docs // n_terms for x in lengths.tolist()], np.int64)


INDEX_PARTS = ("terms", "df", "m", "tf", "docs")


def build_index(df: DataFrame, text: str = "text", key: str = "doc_id", segment_bytes: int = SEGMENT_BYTES) -> tuple[DataFrame, int, int]:
    """Writes the index of all rows; gives its segments, the number of documents with terms and of all their terms.

    A segment holds the keys of its documents by place, and its parts (INDEX_PARTS) as compressed arrays. Every task
    fills segments of about `segment_bytes` of text, a longer text is one of its own. Nothing is shuffled.
    """
    n_docs, n_terms = totals(df, text)
    kind = df.schema[key].dataType.simpleString()
    source = df.select(df[key].alias("key"), df[text].cast("binary").alias("text"))

    def run(batches):
        held, texts, size = [], [], 0

        def made():
            order, parts = segment(texts, n_docs, n_terms)
            keys = pa.concat_arrays(held).take(pa.array(order))
            lists = pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys)
            return pa.RecordBatch.from_arrays([lists, *(pa.array([parts[p]], pa.binary()) for p in INDEX_PARTS)], ["keys", *INDEX_PARTS])

        for batch in batches:
            lengths = np.array([len(x) if x else 0 for x in batch.column(1).to_pylist()], np.int64)
            for a, b in cuts(lengths, 1 << 20):
                held.append(batch.column(0).slice(a, b - a))
                texts += [x or b"" for x in batch.column(1).slice(a, b - a).to_pylist()]
                size += int(lengths[a:b].sum())
                if size >= segment_bytes:
                    yield made()
                    held, texts, size = [], [], 0
        if texts:
            yield made()

    ship(df.sparkSession)
    schema = f"keys array<{kind}>, " + ", ".join(f"{p} binary" for p in INDEX_PARTS)
    return stage(source.mapInArrow(run, schema), "lexical-index"), n_docs, n_terms


# ---- the search -------------------------------------------------------------


class Items:
    """A block of items: their terms, numbered, and how often each item holds them."""

    def __init__(self, texts: list[bytes]):
        words = [terms_of(t) for t in texts]
        self.terms = sorted(set().union(*words)) if words else []
        number = {w: i for i, w in enumerate(self.terms)}
        self.times = [Counter(number[x] for x in w) for w in words]

    def weights(self, frequencies: np.ndarray, n_docs: int) -> list[int]:
        """Weights of the terms; none is negative, as a term is in no more than all documents."""
        return [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in frequencies.tolist()]


def document_frequencies(index: DataFrame, terms: list[bytes]) -> np.ndarray:
    """In how many documents each of the terms occurs: the segments' own counts, summed."""
    wanted = pa.array(terms, pa.binary())

    class Counts:
        def __init__(self):
            self.n = np.zeros(len(terms), np.int64)

        def add(self, batch):
            for i in range(batch.num_rows):
                at, found = known_terms(batch.column(0)[i].as_py(), wanted)
                self.n[found] += spread(batch.column(1)[i].as_py(), "<i4")[at]

        def pieces(self):
            yield 0, self.n

    def merge(total, piece):
        total += piece

    return sum_tables(index, ["terms", "df"], Counts, merge, 1, np.int64).get(0, np.zeros(len(terms), np.int64))


def known_terms(data: bytes, wanted: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Places in a segment's sorted terms of those wanted that it has, and which those are."""
    names = zstandard.ZstdDecompressor().decompress(data)
    own = pa.array(names.split(b" ") if names else [], pa.binary())
    at = pc.index_in(wanted, value_set=own).to_numpy(zero_copy_only=False).astype(np.float64)
    found = np.flatnonzero(~np.isnan(at))
    return at[found].astype(np.int64), found


class Searcher:
    """Searches segment after segment for one block of items and keeps the best `top` documents of each."""

    def __init__(self, items: Items, weights: list[int], top: int):
        self.wanted = pa.array(items.terms, pa.binary())
        self.weights, self.top, self.come = np.array(weights, np.int64), top, 0
        #: Per item (-score, key is null, key, order of arrival), best first, and the least score that may enter.
        self.best: list[list[tuple]] = [[] for _ in items.times]
        self.least = np.ones(len(items.times), np.int64)
        most = max((sum(t.values()) for t in items.times), default=0) * int(self.weights.max(initial=0)) * (IMPACT_SCALE // 1000)
        # whole numbers either way; products of doubles are the faster ones
        self.times = np.zeros((len(items.times), len(items.terms)), np.float64 if most < EXACT else np.int64)
        for i, t in enumerate(items.times):
            self.times[i, list(t)] = list(t.values())
        self.scored = self.strata = 0  # pairs of an item and a stratum: scored ones, and all

    def segment(self, row: dict) -> None:
        at, found = known_terms(row["terms"], self.wanted)
        if not len(at):
            return
        df, m, tf, docs = (spread(row[p], t) for p, t in (("df", "<i4"), ("m", "<i8"), ("tf", "<i4"), ("docs", "<i4")))
        size, first = df[at].astype(np.int64), (np.cumsum(df, dtype=np.int64) - df)[at]
        where = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        term, tf, docs = np.repeat(np.arange(len(at)), size), tf[where].astype(np.int64), docs[where].astype(np.int64)
        edges = np.append(np.flatnonzero(np.append(True, m[1:] != m[:-1])), len(m))  # places where strata begin
        stratum = np.searchsorted(edges, docs, "right") - 1
        # one impact for each tf of a stratum
        shares, which = np.unique(stratum * (int(tf.max()) + 1) + tf, return_inverse=True)
        share_m, share_tf = m[edges[shares // (int(tf.max()) + 1)]], shares % (int(tf.max()) + 1)
        impact = IMPACT_SCALE * share_tf // (1000 * share_tf + M_WEIGHT * share_m)
        value = self.weights[found][term] * impact[which]
        times = np.ascontiguousarray(self.times[:, found])
        # a term's postings of a stratum end with its largest tf
        last = np.flatnonzero(np.append((term[1:] != term[:-1]) | (stratum[1:] != stratum[:-1]), True))
        bounds = self.bounds(times, term[last], stratum[last], value[last], len(edges) - 1)
        self.strata += bounds.size
        order = np.argsort(stratum, kind="stable")
        term, docs, value = term[order], docs[order], value[order]
        begin = np.searchsorted(stratum[order], np.arange(len(edges)))
        keys = row["keys"]
        rank = np.empty(len(keys), np.int64)
        rank[sorted(range(len(keys)), key=lambda i: (keys[i] is None, 0 if keys[i] is None else keys[i]))] = np.arange(len(keys))
        for s in np.argsort(-bounds.max(0, initial=0), kind="stable").tolist():
            active = np.flatnonzero(bounds[:, s] >= self.least)
            if len(active):
                self.scored += len(active)
                a, b = begin[s], begin[s + 1]
                self.stratum(times, active, term[a:b], docs[a:b], value[a:b], int(edges[s]), int(edges[s + 1]), keys, rank)

    def bounds(self, times, term, stratum, value, strata) -> np.ndarray:
        """The most that a document of each stratum can score for each item."""
        out = np.zeros((len(times), strata), times.dtype)
        step = max(1, CELLS // times.shape[1])
        order = np.argsort(stratum, kind="stable")
        term, stratum, value = term[order], stratum[order], value[order]
        for a in range(0, strata, step):
            i, j = np.searchsorted(stratum, [a, a + step])
            largest = np.zeros((times.shape[1], min(step, strata - a)), times.dtype)
            largest[term[i:j], stratum[i:j] - a] = value[i:j]
            out[:, a:a + step] = times @ largest
        return out

    def stratum(self, times, active, term, docs, value, first, end, keys, rank) -> None:
        """Scores the documents `first` … `end` - 1 for the active items."""
        own, local = np.unique(term, return_inverse=True)
        part = times[np.ix_(active, own)]
        step = max(1, CELLS // max(len(own), len(active)))
        for a in range(first, end, step):
            inside = (docs >= a) & (docs < a + step)
            impacts = np.zeros((len(own), min(step, end - a)), times.dtype)
            impacts[local[inside], docs[inside] - a] = value[inside]
            scores = part @ impacts
            for i in np.flatnonzero(scores.max(1) >= self.least[active]).tolist():
                enter = np.flatnonzero(scores[i] >= self.least[active[i]])
                if len(enter) > self.top:
                    enter = enter[np.lexsort((rank[a + enter], -scores[i][enter]))[:self.top]]
                self.offer(int(active[i]), [(int(scores[i][d]), keys[a + d]) for d in enter.tolist()])

    def offer(self, item: int, found: list[tuple]) -> None:
        rows = self.best[item]
        for score, key in found:
            self.come += 1
            rows.append((-score, key is None, 0 if key is None else key, self.come))
        rows.sort()
        del rows[self.top:]
        if len(rows) == self.top:
            self.least[item] = -rows[-1][0]

    def results(self) -> Iterator[tuple]:
        """(item, key, score) of all rows kept."""
        for item, rows in enumerate(self.best):
            for score, no_key, key, _ in rows:
                yield item, None if no_key else key, -score


def item_blocks(items: DataFrame, item: str, text: str) -> Iterator[list[tuple]]:
    """Items with a text in blocks whose table of terms stays small, one block at a time on the driver."""
    rows = items.select(items[item].alias("item"), items[text].cast("binary").alias("text")).where("text IS NOT NULL")
    block, size = [], 0
    for row in rows.toLocalIterator():
        if block and (len(block) + 1) * (size + len(row.text)) > BLOCK_CELLS:
            yield block
            block, size = [], 0
        block.append((row.item, bytes(row.text)))
        size += len(row.text)
    if block:
        yield block


def search(index: DataFrame, n_docs: int, items: DataFrame, item: str = "item_id", text: str = "text", key: str = "doc_id",
           top: int = 10) -> DataFrame:
    """The best documents of an index for every item: the item, rank (from 1), the key, score.

    Score above 0, the highest first; equal scores by ascending key, null keys last. Every row of `items` is an item
    of its own. Items are taken from the driver in blocks of bounded size, each block searched against all segments.
    """
    spark = index.sparkSession
    item_kind, key_kind = items.schema[item].dataType, index.schema["keys"].dataType.elementType
    item_type, key_type = to_arrow_type(item_kind), to_arrow_type(key_kind)
    schema = f"number bigint, item {item_kind.simpleString()}, key {key_kind.simpleString()}, score bigint"
    path = scratch_path(spark, "search")
    spark.createDataFrame([], schema).write.parquet(path)
    number = 0
    for block in item_blocks(items, item, text):
        names = [i for i, _ in block]
        terms = Items([t for _, t in block])
        weights = terms.weights(document_frequencies(index, terms.terms), n_docs)

        def run(batches, names=names, terms=terms, weights=weights, number=number):
            searcher = Searcher(terms, weights, top)
            for batch in batches:
                for i in range(batch.num_rows):
                    searcher.segment(batch.slice(i, 1).to_pylist()[0])
            rows = list(searcher.results())
            yield pa.RecordBatch.from_arrays([
                pa.array([number + i for i, _, _ in rows], pa.int64()), pa.array([names[i] for i, _, _ in rows], item_type),
                pa.array([k for _, k, _ in rows], key_type), pa.array([x for _, _, x in rows], pa.int64())], ["number", "item", "key", "score"])

        index.select("keys", *INDEX_PARTS).mapInArrow(run, schema).write.mode("append").parquet(path)
        number += len(block)
    best = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("key"))
    ranked = spark.read.schema(schema).parquet(path).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.select(F.col("item").alias(item), "rank", F.col("key").alias(key), "score")


def rank_documents(df: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id", item: str = "item_id",
                   item_text: str = "text", top: int = 10) -> DataFrame:
    """Indexes all rows of df and searches all items: the item, rank, the key, score.

    Null and empty texts hold no term and are in no result; neither are items without a term, or an empty table. Each
    row is a document of its own, also under a null or repeated key; each row of items is one, too. Columns that
    aren't named are not read. A text of any length is indexed whole.
    """
    index, n_docs, _ = build_index(df, text, key)
    return search(index, n_docs, items, item, item_text, key, top)


def op12_lexical_search(spark, sf_dir: str) -> DataFrame:
    """The ten best of all documents for every benchmark item."""
    return rank_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


#: The same rows in DuckDB.
OP12_SQL = r"""
WITH doc_terms AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term FROM documents
), item_terms AS (
    SELECT item_id, term, count(*) AS times FROM (
        SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term FROM benchmark)
    GROUP BY item_id, term
), lengths AS (
    SELECT doc_id, count(*) AS n FROM doc_terms GROUP BY doc_id
), totals AS (
    SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lengths
), normal AS (
    SELECT doc_id, 25 + (75 * n * docs) // terms AS m FROM lengths, totals
), postings AS (
    SELECT doc_id, term, count(*) AS tf FROM doc_terms GROUP BY doc_id, term
), weights AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM postings, totals GROUP BY term
), scores AS (
    SELECT i.item_id, p.doc_id, CAST(sum(i.times * w.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * d.m))) AS BIGINT) AS score
    FROM item_terms i JOIN postings p USING (term) JOIN weights w USING (term) JOIN normal d USING (doc_id)
    GROUP BY i.item_id, p.doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 10
"""
