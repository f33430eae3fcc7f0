"""Ranked search against a plain scoring of all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from candlewick.llm import lexical_search as ls
from tests.llm.helpers import ODD, ascii_lower, frame

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(ascii_lower(text))


def plain(rows, items, top=10):
    """Rows (item, rank, key, score), with how often they occur."""
    docs = [(d, Counter(terms(t))) for d, t in rows]
    docs = [(d, c) for d, c in docs if c]
    n_docs, n_terms = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in items:
        scored = []
        for d, c in docs:
            m = 25 + 75 * sum(c.values()) * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                        for t in terms(text) if c[t])
            if score > 0:
                scored.append((-score, d is None, 0 if d is None else d))
        out += [(item, r, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(scored)[:top], 1)]
    return Counter(out)


def counted(df):
    return Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect())


def case(seed, docs=150):
    rng = random.Random(seed)
    vocabulary = [f"w{int(i)}" for i in np.random.default_rng(seed).zipf(1.4, 400) % 90] + ["Été", "X9", "日本"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    rows = [(i, text(rng.choice([1, 3, 10, 10, 10, 40, 300]))) for i in range(docs)]
    rows += [(1000 + i, rows[5][1]) for i in range(docs // 2)]  # a third are copies: many equal scores
    items = [(i, text(rng.randint(1, 30))) for i in range(14)] + [(90, None), (91, "..."), (92, "unheard of"), (93, rows[5][1])]
    return rows, items


@pytest.mark.parametrize(("seed", "size", "cells"), [(1, 16 << 20, 1 << 26), (2, 2000, 1 << 26), (3, 200, 900), (4, 1, 1)])
def test_against_plain(spark, monkeypatch, seed, size, cells):
    rows, items = case(seed)
    monkeypatch.setattr(ls, "BLOCK_CELLS", cells)
    index, n_docs, _ = ls.build_index(frame(spark, rows).repartition(3), segment_bytes=size)
    got = ls.search(index, n_docs, spark.createDataFrame(items, "item_id bigint, text string"))
    assert counted(got) == plain(rows, items)


def test_odd_rows(spark):
    rows = ODD + [(None, "hello world"), (1, "hello hello world"), (50, "quick " * 5000)]
    items = [(1, "Hello, WORLD! hello"), (None, "same text"), (1, "fox fox id"), (2, ""), (3, "日本語 école")]
    bench = spark.createDataFrame([(i, t, "own", "own") for i, t in items], "item_id bigint, text string, rank string, score string")
    got = ls.rank_documents(frame(spark, rows), bench)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert counted(got) == plain(rows, items)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    some = spark.createDataFrame([(1, "the lazy dog")], "item_id bigint, text string")
    assert ls.rank_documents(frame(spark, []), some).collect() == []
    assert ls.rank_documents(frame(spark, ODD), none).collect() == []
    assert ls.rank_documents(frame(spark, [(1, None), (2, " .")]), some).collect() == []
    assert [r.doc_id for r in ls.rank_documents(frame(spark, ODD), some).collect()] == [4]


def test_text_keys(spark):
    rows = [(f"d{i}", "one two three") for i in range(30)] + [(None, "one two three")]
    df = spark.createDataFrame(rows + [("long", "one " + "x " * 50)], "doc_id string, text string")
    got = ls.rank_documents(df, spark.createDataFrame([("i", "two")], "item_id string, text string"), top=3)
    assert [(r.item_id, r["rank"], r.doc_id) for r in sorted(got.collect(), key=lambda r: r["rank"])] == [("i", 1, "d0"), ("i", 2, "d1"), ("i", 3, "d10")]


def segments(texts, parts):
    words = [len(ls.terms_of(t)) for t in texts]
    n_docs, n_terms = sum(n > 0 for n in words), sum(words)
    out = []
    for a in range(0, len(texts), -(-len(texts) // parts)):
        own = texts[a:a + -(-len(texts) // parts)]
        order, made = ls.segment(own, n_docs, n_terms)
        out.append(made | {"keys": [a + int(i) for i in order]})
    return out, n_docs


def test_index_and_bounds():
    """Postings stand by term, stratum and tf, and strata that can't matter are not scored."""
    rows, items = case(7, 900)
    texts = [t.encode() for _, t in rows]
    made, n_docs = segments(texts, 4)
    frequencies = Counter(t for _, x in rows for t in set(terms(x)))
    block = ls.Items([(t or "").encode() for _, t in items])
    searcher = ls.Searcher(block, block.weights(np.array([frequencies[t.decode()] for t in block.terms]), n_docs), 10)
    for part in made:
        df, m, tf, docs = (ls.spread(part[p], t) for p, t in (("df", "<i4"), ("m", "<i8"), ("tf", "<i4"), ("docs", "<i4")))
        assert (np.diff(m) >= 0).all()
        names = np.repeat(np.arange(len(df)), df)
        keys = list(zip(names.tolist(), m[docs].tolist(), tf.tolist(), docs.tolist(), strict=True))
        assert keys == sorted(keys)
        searcher.segment(part)
    got = Counter((items[i][0], r, k, -x) for i, found in enumerate(searcher.best) for r, (x, _, k, _) in enumerate(found, 1))
    assert got == plain([(i, t) for i, (_, t) in enumerate(rows)], items)
    assert searcher.scored < 0.8 * searcher.strata


def test_whole_numbers_beyond_doubles():
    """Scores that doubles can't hold are added up in longs."""
    texts = [b"a b", b"a", b"b " * 3000, b"c"]
    made, n_docs = segments(texts, 1)
    block = ls.Items([b"a " * 2_000_000])
    searcher = ls.Searcher(block, [6000], 10)
    assert searcher.times.dtype == np.int64
    searcher.segment(made[0])
    assert [k for _, _, k, _ in searcher.best[0]] == [0, 1] and searcher.best[0][0][0] % 2_000_000 == 0


def test_normaliser_of_large_numbers():
    lengths = np.array([0, 5, 10**12], np.int64)
    assert ls.normaliser(lengths, 10**10, 10**13).tolist() == [25, 25, 25 + 75 * 10**22 // 10**13]
    assert ls.normaliser(lengths, 0, 0).tolist() == [25, 25, 25]
