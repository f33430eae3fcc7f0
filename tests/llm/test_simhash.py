"""SimHash groups against all pairs."""

import random
import re

import pytest
import xxhash

from candlewick.llm import simhash as sh
from tests.llm.helpers import ODD, ascii_lower, frame, key


def plain_print(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text))
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] * bool(w)
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(nodes, linked):
    parent = list(range(len(nodes)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(nodes)):
        for j in range(i):
            if linked(nodes[i], nodes[j]):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(nodes))]


def rows():
    rng = random.Random(1)
    base = [" ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta iota".split()) for _ in range(300)) for _ in range(12)]
    out = [(i, t) for i, t in enumerate(base, 100)] + [(200 + i, t + " extra") for i, t in enumerate(base)] + [(300 + i, t) for i, t in enumerate(base)]
    out += [(400 + i, base[0].replace("alpha", f"alpha{i}", 1)) for i in range(8)]
    return out + ODD


def plain(data):
    prints = [plain_print(t) for _, t in data]
    find = groups(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for (i, _), g in zip(data, find, strict=True):
        if i is not None:
            least[g] = min(least.get(g, i), i)
    return sorted([(i, f"{p:016x}", least.get(g)) for (i, _), p, g in zip(data, prints, find, strict=True)], key=key)


def test_against_all_pairs(spark, tmp_path):
    frame(spark, rows()).write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted(map(tuple, sh.op6_simhash(spark, str(tmp_path)).collect()), key=key) == plain(rows())


def test_links_of_close_fingerprints(spark):
    rng = random.Random(4)
    prints = {0, 1, 3, 7, -1, -2, 1 << 62, -(1 << 63)}
    for _ in range(40):
        x = rng.getrandbits(64) - (1 << 63)
        prints.add(x)
        for _ in range(rng.randint(0, 4)):
            y = x & ((1 << 64) - 1)
            for _ in range(rng.randint(1, 3)):
                y ^= 1 << rng.randrange(64)
            prints.add(y - (1 << 64) if y >= 1 << 63 else y)
    nodes = sorted(prints)
    labels = {r.node: r.label for r in sh.components(sh.links(spark.createDataFrame([(p,) for p in nodes], "fp bigint"), 2)).collect()}
    find = groups(nodes, lambda a, b: ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 2)
    assert [labels.get(p, p) for p in nodes] == [nodes[g] for g in find]


def test_long_chain(spark):
    n = 150
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1001)], "a bigint, b bigint")
    got = {r.node: r.label for r in sh.components(edges).collect()}
    assert got == {i: 0 for i in range(n + 1)} | {1000: 1000, 1001: 1000}


def test_keep_one(spark):
    kept = sh.keep_one(frame(spark, rows()))
    want = {c for i, _, c in plain(rows()) if i is not None}
    assert kept.columns == frame(spark, []).columns
    got = sorted((r.doc_id for r in kept.collect()), key=lambda x: (x is not None, x))
    assert got == [None, *sorted(want)]


def test_keep_one_with_null_and_repeated_keys(spark):
    """One row of each group stays, whatever its key: repeated keys are no copies, rows without a key may be."""
    rng = random.Random(3)
    a, b, c, d, e = (" ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta iota".split()) for _ in range(300)) for _ in range(5))
    data = [(1, a), (1, b), (1, b), (2, b), (None, a), (None, c), (None, c), (None, c.upper()), (None, d), (3, e), (2, e), (2, None), (None, "")]
    got = [(r.doc_id, r.text) for r in sh.keep_one(frame(spark, data).repartition(3)).collect()]
    assert len(got) == 6 and {(i, t.lower() if t else t) for i, t in got} == {(1, a), (1, b), (None, c), (None, d), (2, e), (2, None)}
    again = [(r.doc_id, r.text) for r in sh.keep_one(frame(spark, data[::-1])).collect()]
    assert sorted(again, key=key) == sorted(got, key=key)


def test_odd_distance_is_refused(spark):
    with pytest.raises(ValueError):
        sh.links(spark.range(1).withColumnRenamed("id", "fp"), 3)


def test_empty_table(spark):
    assert sh.near_duplicates(frame(spark, [])).collect() == []
    assert sh.keep_one(frame(spark, [])).collect() == []
