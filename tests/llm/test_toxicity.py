"""Toxicity: planted words are learned, held-out labels aren't, segments equal a brute-force search."""

import random
import zlib

import numpy as np
import pytest

from candlewick.llm import toxicity
from tests.llm.helpers import ODD, frame

WORDS = [f"word{i}" for i in range(300)]


def corpus(n=400, seed=3):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(WORDS) for _ in range(rng.randint(40, 120))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(4):
                words[rng.randrange(len(words))] = rng.choice(["grobian", "schuft"])
        rows.append((i, " ".join(words)))
        labels.append((i, 0, int(toxic)))
    return rows, labels


def test_planted_words(spark):
    rows, labels = corpus()
    docs, marks = frame(spark, rows + [(1000, None), (1001, ""), (None, "grobian schuft grobian")]), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    found = toxicity.score_toxicity(docs, toxicity.learnable(marks)).collect()
    score = {r.doc_id: r.score for r in found}
    assert len(found) == len(rows) + 3 and all(0 <= s <= 1 for s in score.values())
    held = [(i, y) for i, _, y in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all((score[i] >= 0.5) == bool(y) for i, y in held) and {y for _, y in held} == {0, 1}
    assert score[1000] == score[1001] < 0.5 <= score[None]
    texts = dict(rows)
    for r in found:
        for p in r.passages:
            words = toxicity.tokens((texts.get(r.doc_id) or "grobian schuft grobian").encode())[p.first:p.last + 1]
            assert {b"grobian", b"schuft"} & set(words)


def test_held_out_labels_teach_nothing(spark, tmp_path):
    rows, labels = corpus()
    turned = [(i, q, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, q, y in labels]
    scores = []
    for name, marks in (("a", labels), ("b", turned)):
        folder = f"{tmp_path}/{name}"
        frame(spark, rows).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        scores.append(sorted((r.doc_id, r.score, r.predicted) for r in toxicity.op2_toxicity(spark, folder).collect()))
    assert scores[0] == scores[1]


def best_segments(values):
    """All maximal scoring segments by definition: split at the best one, then look on both sides."""
    def search(a, b):
        best = None
        for i in range(a, b):
            total = 0.0
            for j in range(i, b):
                total += values[j]
                if total > 1e-9 and (best is None or total > best[0] + 1e-9):
                    best = total, i, j
        if best is None:
            return []
        return [*search(a, best[1]), (best[1], best[2], best[0]), *search(best[2] + 1, b)]

    return search(0, len(values))


@pytest.mark.parametrize("seed", range(30))
def test_segments_against_brute_force(seed):
    rng = np.random.default_rng(seed)
    values = np.round(rng.normal(-0.3, 1, rng.integers(1, 40)), 3)
    up = np.flatnonzero(values > 0)
    got = toxicity.maximal_segments(up, values[up], np.append(0.0, np.cumsum(values)))
    want = best_segments(values.tolist())
    assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
    assert np.allclose([s for *_, s in got], [s for *_, s in want])


def test_odd_rows_and_labels(spark):
    marks = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None), (99, 1), (4, 0)], "doc_id bigint, toxic int")
    found = toxicity.score_toxicity(frame(spark, ODD), marks).collect()
    assert len(found) == len(ODD) and all(0 <= r.score <= 1 for r in found)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert toxicity.score_toxicity(frame(spark, []), none).collect() == []
    assert {r.score for r in toxicity.score_toxicity(frame(spark, ODD), none).collect()} == {toxicity.NO_EVIDENCE}


def test_accuracy_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    marks = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    found = [(r.predicted, marks[r.doc_id]) for r in toxicity.op2_toxicity(spark, folder).collect() if r.held_out and r.doc_id in marks]
    assert sum(p == y for p, y in found) / len(found) > 0.93


def test_no_evidence_is_not_toxic(spark):
    marks = spark.createDataFrame([(i, 1) for i in range(1, 5)] + [(7, 0)], "doc_id bigint, toxic int")
    found = toxicity.score_toxicity(frame(spark, ODD), marks).collect()
    assert all(r.score < 0.5 for r in found if not r.passages)


def test_chance_of_counts():
    assert toxicity.minus_log_chance(1, 2.0) == 0.0
    assert abs(toxicity.minus_log_chance(2, 0.1) + np.log(1 - np.exp(-0.1) * 1.1)) < 1e-9


def test_segments_of_a_very_long_text():
    """Falling sums, under which every token would look back over all segments: linear all the same."""
    import time

    n = 1_500_000
    values = np.tile([1.0, -1.5], n)
    up = np.flatnonzero(values > 0)
    t0 = time.process_time()
    got = toxicity.maximal_segments(up, values[up], np.append(0.0, np.cumsum(values)))
    assert len(got) == n and time.process_time() - t0 < 20


def test_accuracy_by_class(spark):
    """On labels that were not learned: nearly all toxic documents are found, clean ones left alone."""
    folder = "/root/testdata/sf0.1"
    marks = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    found = [(r.predicted, marks[r.doc_id]) for r in toxicity.op2_toxicity(spark, folder).collect() if r.held_out and r.doc_id in marks]
    share = lambda y, p: sum(a == p for a, b in found if b == y) / sum(b == y for _, b in found)
    assert share(1, 1) > 0.85 and share(0, 1) < 0.02
