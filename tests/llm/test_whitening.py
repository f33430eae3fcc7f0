"""Whitening against plain linear algebra."""

import numpy as np
import pytest

from candlewick.llm import whitening as wh

SCHEMA = "vec_id bigint, embedding array<float>, x string, component string, n string, whitened string, k0 string, label int"


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, *["own"] * 5, 1) for i, v in rows], SCHEMA.replace("float", kind))


def usable(rows):
    return [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]


def plain(rows, most=16):
    """Per row: deviation and coordinates; explained; n."""
    rows = usable(rows)
    x = [[int(np.floor(64 * float(np.float32(c)))) + 1000000 for c in v] for _, v in rows]
    distinct = sorted({tuple(v) for v in x})
    n, s = len(distinct), [sum(c) for c in zip(*distinct)]
    centred = np.array([[(n * c - t) / n for c, t in zip(v, s)] for v in distinct])
    e, v = np.linalg.eigh(centred.T @ centred / n)
    e, v = e[::-1], v[:, ::-1]
    k = min(most, int((e > e[0] * 1e-12).sum())) if e[0] > 1e-9 else 0
    out = []
    for (i, _), row in zip(rows, x):
        exact = [n * c - t for c, t in zip(row, s)]
        out.append((i, sum(y * y for y in exact), (np.array([y / n for y in exact]) @ v[:, :k] / np.sqrt(e[:k]))))
    return out, (e / e.sum())[:k] if k else [], n


def compare(got, rows):
    want, explained, n = plain(rows)
    k = len(explained)
    by_row = {}
    for r in got:
        by_row.setdefault((r.vec_id, r.deviation), []).append(r)
    assert len(got) == k * len(want)
    sign = None
    for i, deviation, coordinates in want:
        mine = sorted(by_row[i, deviation], key=lambda r: (r.component, r.whitened))
        mine = mine[::len(mine) // k]
        assert [r.component for r in mine] == list(range(1, k + 1))
        assert {r.n for r in mine} == {n} and max(r.identity_error for r in mine) < 1e-8
        np.testing.assert_allclose([r.explained for r in mine], explained, rtol=1e-6)
        made = np.array([r.whitened for r in mine])
        if sign is None and (np.abs(coordinates) > 1e-3).all():
            sign = np.sign(made * coordinates)
        if sign is not None:
            np.testing.assert_allclose(made * sign, coordinates, atol=1e-7)
    assert sign is not None or not k


def random_rows(seed, n, d):
    rng = np.random.default_rng(seed)
    values = rng.normal(size=(n, d)) * np.linspace(3, 0.2, d) @ np.linalg.qr(rng.normal(size=(d, d)))[0]
    return [(i, v.astype(np.float32).tolist()) for i, v in enumerate(values)]


@pytest.mark.parametrize(("seed", "n", "d"), [(1, 300, 20), (2, 60, 5), (3, 12, 30)])
def test_against_plain(spark, seed, n, d):
    rows = random_rows(seed, n, d)
    odd = [(None, rows[3][1]), (900, None), (901, [float("nan")] + rows[0][1][1:]), (902, rows[0][1][:-1] + [float("inf")]),
           (903, [None] + rows[0][1][1:]), (904, [float("-inf")] * d)]
    rows += [(700 + i, rows[1][1]) for i in range(n // 2)] + odd  # a third of all rows are copies of one
    compare(wh.whiten(frame(spark, rows).repartition(4)).collect(), rows)


def test_large_entries_are_exact(spark):
    rows = random_rows(5, 40, 4) + [(99, [1e9, -3e8, 0.0, 5.0])]
    got = wh.whiten(frame(spark, rows)).collect()
    x = [[int(np.floor(64 * float(np.float32(c)))) + 1000000 for c in v] for _, v in rows]
    n, s = len({tuple(v) for v in x}), None
    s = [sum(c) for c in zip(*{tuple(v) for v in x})]
    want = {i: sum((n * c - t) ** 2 for c, t in zip(v, s)) for (i, _), v in zip(rows, x)}
    for r in got:
        assert r.deviation == (want[r.vec_id] if want[r.vec_id] < 1 << 63 else None)
    assert want[99] > 1 << 63


def test_rows_without_a_place(spark):
    rows = random_rows(6, 30, 3)
    mixed = rows + [(100, [1.0, 2.0]), (101, []), (102, [1.0, 2.0, 3.0, 4.0]), (103, [1e300, 1.0, 2.0])]
    got = wh.whiten(frame(spark, mixed, "double")).collect()
    assert {r.vec_id for r in got} == set(range(30)) and {r.n for r in got} == {30}


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, []), (2, [])]])
def test_no_variance(spark, rows):
    got = wh.whiten(frame(spark, rows))
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"] and got.collect() == []


def test_equal_eigenvalues(spark):
    """A square's corners have one eigenvalue twice: any basis will do, the same for all rows."""
    rows = [(i, [float(a), float(b), 5.0]) for i, (a, b) in enumerate([(1, 1), (1, -1), (-1, 1), (-1, -1)])]
    got = wh.whiten(frame(spark, rows)).collect()
    assert len(got) == 8 and {r.component for r in got} == {1, 2}
    w = np.array([[r.whitened for r in sorted(got, key=lambda r: (r.vec_id, r.component)) if r.vec_id == i] for i in range(4)])
    np.testing.assert_allclose(w.T @ w / 4, np.eye(2), atol=1e-12)
    assert {round(r.explained, 12) for r in got} == {0.5}


def test_row_width(spark):
    """Vectors of all packed widths meet as equal only if they are."""
    rows = [(1, [0.5, 100.0]), (2, [0.5, 1000.0]), (3, [0.5, 1e9]), (4, [0.5, 100.0]), (5, [-1000.0, 1e9])]
    got = wh.whiten(frame(spark, rows)).collect()
    assert {r.n for r in got} == {4} and {r.vec_id for r in got} == {1, 2, 3, 4, 5}


@pytest.mark.parametrize("seed", range(6))
def test_small_eigenvalues(seed):
    """A graded matrix: eigenvalues down to 1e-20 of the first keep their leading digits."""
    rng = np.random.default_rng(seed)
    grade = 10.0 ** np.linspace(0, -10, 12)
    b = np.eye(12) + 0.1 * rng.normal(size=(12, 12))
    factor = b * grade[:, None]
    exact = np.linalg.svd(b.T * grade, compute_uv=False) ** 2  # of scaled rows: accurate only for the larger ones
    values, vectors = wh.eigen(factor @ factor.T, 1e-30)
    assert len(values) == 12
    np.testing.assert_allclose(values[:5], exact[:5], rtol=1e-9)
    np.testing.assert_allclose(vectors.T @ vectors, np.eye(12), atol=1e-12)
    assert np.prod(values[6:]) * np.prod(values[:6]) == pytest.approx(np.linalg.det(b) ** 2 * np.prod(grade ** 2), rel=1e-6)


@pytest.mark.parametrize("n", [1, 2, 5, 8])
def test_rounds(n):
    pairs = [(int(a), int(b)) for i, j in wh.rounds(n) for a, b in zip(i, j)]
    assert sorted(pairs) == [(a, b) for a in range(n) for b in range(a + 1, n)]
    assert all(len({*i.tolist(), *j.tolist()}) == 2 * len(i) for i, j in wh.rounds(n))


def test_pivoted_cholesky_of_low_rank():
    rng = np.random.default_rng(1)
    b = rng.normal(size=(9, 4))
    order, lower = wh.pivoted_cholesky(b @ b.T, 1e-12)
    assert lower.shape == (9, 4) and (np.triu(lower[:4], 1) == 0).all()
    np.testing.assert_allclose(lower @ lower.T, (b @ b.T)[order][:, order], atol=1e-12)
    assert (np.diff(np.diag(lower)) <= 1e-12).all()
