"""Fingerprints: collision rates against the generalised Jaccard similarity, neighbours against a plain version."""

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa

from candlewick.llm import weighted_sampling as ws
from tests.llm.helpers import LONG, ODD, frame


def similarity(a, b):
    a, b = Counter(a), Counter(b)
    return sum((a & b).values()) / sum((a | b).values())


def test_collision_rate():
    rng, sampler = np.random.default_rng(5), ws.Sampler(2048)
    for _ in range(12):
        a = [f"w{x}".encode() for x in rng.zipf(1.4, 300) % 200]
        b = a[:150] + [f"w{x}".encode() for x in rng.zipf(1.4, 200) % 250]
        got = ws.likeness(sampler.signature(a), sampler.signature(b))
        assert abs(got - similarity(a, b)) < 0.05


def test_signature_does_not_depend_on_history():
    words = [[f"a{i * j % 37}".encode() for j in range(50)] for i in range(1, 40)]
    fresh = [ws.Sampler().signature(w).tobytes() for w in words]
    shared = ws.Sampler(max_words=20)
    assert [shared.signature(w).tobytes() for w in reversed(words)][::-1] == fresh
    assert fresh[0] == ws.Sampler().signature(words[0][::-1]).tobytes()


def plain(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))  # ids below are unique or of equal texts
    out = []
    for k, (i, text) in enumerate(rows):
        text, following = text or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(text) // 2
        out.append((i, len(text), hashlib.sha256((text[:len(text) - half] + following[:half]).encode()).hexdigest()))
    return sorted(out, key=str)


def test_neighbours(spark):
    rows = ODD + [(i, f"document {i} has some words and {i * 7} others") for i in range(20, 300)]
    got = ws.fingerprint_edits(frame(spark, rows).repartition(7)).collect()
    assert sorted([(r.doc_id, r.n_chars, r.edited_sha256) for r in got], key=str) == plain(rows)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    twins = [r for r in got if r.doc_id == 5]
    assert len({r.fingerprint for r in twins}) == 1 and max(r.near_next for r in twins) == 1
    assert {r.fingerprint for r in got if r.doc_id in (2, 3, 7)} == {"0" * 4 * ws.PLACES}


def test_small_tables(spark):
    assert ws.fingerprint_edits(frame(spark, [])).collect() == []
    only = ws.fingerprint_edits(frame(spark, [(1, "abcd efgh")])).collect()
    assert [(r.n_chars, r.near_next) for r in only] == [(9, 1.0)]
    assert only[0].edited_sha256 == hashlib.sha256(b"abcd abcd").hexdigest()


def plain_signature(words, places):
    """Consistent weighted sampling word by word: the least value wins each place."""
    made, best = ws.Sampler(places), [(np.inf, 0, 0)] * places
    for word, weight in Counter(words).items():
        fresh = ws.Sampler(places)
        fresh.learn([word])
        for p in range(places):
            r, beta, c = (float(x[0, p]) for x in (fresh.rate, fresh.offset, fresh.cost))
            t = int(np.floor(np.float32(np.log(weight)) / np.float32(r) + np.float32(beta))) if weight > 1 else 0
            value = fresh.light[0, p] if weight == 1 else fresh.cost[0, p] - fresh.rate[0, p] * (np.float32(t) - fresh.offset[0, p]) - fresh.rate[0, p]
            best[p] = min(best[p], (float(value), int(fresh.tag[0]), t))
    return made, best


def test_signatures_against_a_plain_version():
    """The sampled (word, step) of each place, also where words come in many slices."""
    words = [f"w{i % 40}".encode() for i in range(90)]
    _, best = plain_signature(words, 16)
    mixed = [((tag * 0x9E3779B97F4A7C15 + t) & (1 << 64) - 1) for _, tag, t in best]
    want = [((x ^ (x >> 29)) * ws.MIX[0] & (1 << 64) - 1) >> 48 for x in mixed]
    assert ws.Sampler(16).signature(words).tolist() == want


def test_slices_don_t_matter(monkeypatch):
    words = [f"w{i * i % 977}".encode() for i in range(3000)]
    whole = ws.Sampler().signature(words).tolist()
    monkeypatch.setattr(ws, "SLICE", 7)
    assert ws.Sampler(max_words=50).signature(words).tolist() == whole


def test_a_text_of_very_many_words():
    """Memory for draws is bounded by the slice, not by the text."""
    sampler = ws.Sampler(max_words=20_000)
    assert sampler.signature([f"{i}".encode() for i in range(150_000)]).any()
    assert len(sampler.row) <= 20_000 + ws.SLICE and len(sampler.tag) < 65_536


def test_rows_of_one_key(spark):
    """Many rows without an id, with unlike texts: neighbours by the hash of the text, over several partitions."""
    rows = [(None, f"text number {i} of many") for i in range(300)]
    got = ws.fingerprint_edits(frame(spark, rows).repartition(3)).collect()
    assert len(got) == 300 and len({r.fingerprint for r in got}) > 290
    made = {hashlib.sha256((a[:len(a) - len(a) // 2] + b[:len(a) // 2]).encode()).hexdigest() for _, a in rows for _, b in rows}
    assert {r.edited_sha256 for r in got} <= made


def test_a_group_is_learned_together(monkeypatch):
    """Signatures of many texts are those of each alone, and their new words are learned at once."""
    calls, learn = [], ws.Sampler.learn
    monkeypatch.setattr(ws.Sampler, "learn", lambda self, words: calls.append(len(words)) or learn(self, words))
    texts = [" ".join(f"w{i * j % 61 + i}" for j in range(i % 9 * 8)) for i in range(200)] + ["", "one", "one one"]
    got = ws.Reader(64).signatures(texts)
    assert len(calls) == 1
    assert [x.tobytes() for x in got] == [ws.Reader(64).signature(t).tobytes() for t in texts]


def test_groups_beyond_the_room():
    """Words that come again are kept when there is no more room; a group that is too large goes slice by slice."""
    sampler = ws.Sampler(max_words=60)
    groups = [[[f"g{g}-{i}-{j}".encode() for j in range(4)] + [b"the", b"of", b"the"] for i in range(n)] for g, n in enumerate([4, 5, 6, 40, 5, 6, 3])]
    for k, texts in enumerate(groups):
        want = [ws.Sampler().signature(t).tobytes() for t in texts]
        assert [x.tobytes() for x in sampler.signatures(texts)] == want
        if k == 2:
            assert b"the" in sampler.row and b"g0-0-0" not in sampler.row


def test_draws_beyond_the_room(monkeypatch):
    monkeypatch.setattr(ws, "SLICE", 5)
    sampler = ws.Sampler(max_words=40)
    for g in range(6):
        texts = [[f"g{g}-{j}".encode() for j in range(3)] * 2 + [b"z"] * (g + i) for i in range(5)]
        assert [x.tobytes() for x in sampler.signatures(texts)] == [ws.Sampler().signature(t).tobytes() for t in texts]
        assert sampler.drawn <= 10


def test_neighbours_over_many_groups(monkeypatch):
    """Rows of one partition in several batches and groups: each meets its successor, also where a group ends."""
    monkeypatch.setattr(ws, "TOGETHER", 100)
    monkeypatch.setattr(ws, "TaskContext", type("Task", (), {"get": classmethod(lambda cls: cls), "partitionId": staticmethod(lambda: 3)}))
    rows = [(i, f"document {i} has some words and {i * 7} others" if i % 11 else None) for i in range(70)] + [(70, LONG)]
    batches = [pa.record_batch([pa.array([i for i, _ in part], pa.int64()), pa.array([t for _, t in part], pa.string())], ["key", "text"])
               for part in (rows[:1], rows[1:1], rows[1:40], rows[40:])]
    got = [r for b in ws.rows_in_order(ws.PLACES, pa.int64())(batches) for r in b.to_pylist()]
    assert [(r["kind"], r["key"], r["text"]) for r in got if r["kind"] != ws.ROW] == [(ws.HEAD, 0, ""), (ws.TAIL, 70, LONG)]
    made = [r for r in got if r["kind"] == ws.ROW]
    assert [r["key"] for r in made] == list(range(70)) and {r["part"] for r in got} == {3}
    for r, (_, text), (_, following) in zip(made, rows, rows[1:]):
        text, following = text or "", following or ""
        changed = ws.edited(text, following)
        own, after, near = (ws.Reader(ws.PLACES).signature(t) for t in (text, changed, following))
        assert (r["own"], r["after"], r["n_chars"]) == (own.tobytes(), after.tobytes(), len(text))
        assert r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert (r["near_edited"], r["near_next"]) == (ws.likeness(own, after), ws.likeness(own, near))


def test_a_long_text_stays_out_of_its_group(monkeypatch):
    monkeypatch.setattr(ws, "TOGETHER", 50)
    groups, signatures = [], ws.Sampler.signatures
    monkeypatch.setattr(ws.Sampler, "signatures", lambda self, texts: groups.append(len(texts)) or signatures(self, texts))
    texts = ["a few words", "others", LONG, "", "words again"]
    got = ws.Reader(64).signatures(texts)
    assert groups == [4] and [x.tobytes() for x in got] == [ws.Reader(64).signature(t).tobytes() for t in texts]
