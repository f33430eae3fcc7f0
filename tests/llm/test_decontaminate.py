"""Benchmark passages against a plain search."""

import random
import re

import numpy as np
import pytest

from candlewick.llm import decontaminate as dc
from tests.llm.helpers import ODD, ascii_lower, frame, key

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(rows, items, size=13):
    windows = {}
    for item, text in items:
        w = WORD.findall(ascii_lower(text))
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[i:i + size]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in rows:
        w, hit, names = WORD.findall(ascii_lower(text)), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if found := windows.get(tuple(w[i:i + n])):
                    hit |= set(range(i, i + n))
                    names |= found
        out.append((doc, len(w), len(hit), sorted(names)))
    return sorted(out, key=key)


def case(seed, words=6):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(words)] + ["Été", "X9"]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(0, 20)))) for i in range(12)]
    items += [(3, "equal ids are one item"), (None, "an item without an id"), (90, None), (91, "..."), (92, items[0][1])]
    rows = [(i, " ".join(rng.choice(vocab + ["zz"]) for _ in range(rng.randint(0, 120)))) for i in range(40)]
    rows += [(100 + i, f"zz {rng.choice(items)[1]}, and {rng.choice(items)[1]} {rng.choice(items)[1]}!") for i in range(40)]
    return rows + rows[:3] + ODD, items


@pytest.mark.parametrize(("seed", "size", "limit"), [(1, 13, 1 << 20), (2, 4, 1 << 20), (3, 4, 60), (4, 2, 200)])
def test_against_plain(spark, seed, size, limit):
    rows, items = case(seed)
    got = dc.find_passages(frame(spark, rows), spark.createDataFrame(items, "item_id bigint, text string"), size=size, query_bytes=limit)
    assert sorted([(r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got.collect()], key=key) == plain(rows, items, size)


def test_plan_holds_few_blocks(spark):
    """A benchmark of many blocks is searched in several passes, with the same rows."""
    rows, items = case(5)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = dc.find_passages(frame(spark, rows), bench, size=3, query_bytes=1)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") <= dc.BLOCKS_AT_ONCE
    assert sorted([(r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got.collect()], key=key) == plain(rows, items, 3)


def test_spans(spark):
    bench = spark.createDataFrame([(1, "one two three four")], "item_id bigint, text string")
    rows = [(1, "zero one two three four five one two three four one two"), (2, "one two three")]
    got = {r.doc_id: r for r in dc.find_passages(frame(spark, rows), bench).collect()}
    assert [tuple(s) for s in got[1].spans] == [(1, 4), (6, 9)] and got[1].n_hit == 8 and got[2].spans == []


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert dc.find_passages(frame(spark, []), none).collect() == []
    got = dc.find_passages(frame(spark, ODD), none).collect()
    assert len(got) == len(ODD) and {r.n_hit for r in got} == {0} and max(r.n_words for r in got) > 30_000


@pytest.mark.parametrize("seed", range(10))
def test_index(seed):
    rng = np.random.default_rng(seed)
    values = np.concatenate([np.append(0, rng.integers(1, 4, rng.integers(1, 30))) for _ in range(6)])
    index = dc.FmIndex(values)
    for _ in range(30):
        n = int(rng.integers(1, 6))
        w = rng.integers(1, 5, n)
        want = [i for i in range(len(values) - n + 1) if (values[i:i + n] == w).all()]
        low, high = index.search(w[None, :], np.array([n]))
        assert sorted(index.locate(np.arange(low[0], max(low[0], high[0]))).tolist()) == want
