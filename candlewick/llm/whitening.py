"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then one-sided Jacobi on the triangular factor.

Vectors become exact whole numbers, and each distinct one counts once in the fit. Sums are exact, so every difference to
the mean is an exact whole number over n before it is rounded. Each task adds up the products of its differences; the
scatter, whose size is fixed by the dimension, is factored as P L Lᵀ Pᵀ. Rotations that make the columns of L orthogonal
turn L into U·diag(s): s² are the eigenvalues and the columns of U the components, small ones with a small relative error,
too, which forming and rotating L Lᵀ would not give.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import read, ship, sum_tables
from candlewick.session import stage

#: A component becomes floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
#: Values a task turns into doubles at once, and the largest dimension whose scatter the driver factors.
BLOCK_VALUES, MOST_DIMENSIONS = 1 << 20, 2048
#: Beyond this a scaled entry has no exact place in a long and counts as not finite.
LARGEST = 2.0 ** 61


# ---- factorisation ----------------------------------------------------------


def pivoted_cholesky(a: np.ndarray, tolerance: float) -> tuple[np.ndarray, np.ndarray]:
    """Order p and lower trapezoid L with a[p][:, p] = L Lᵀ: the largest remaining diagonal entry comes next.

    It ends where no diagonal entry exceeds `tolerance` times the first one, so L has as many columns as the rank.
    """
    d = len(a)
    order, left = np.arange(d), np.zeros((d, d))
    rest = np.diag(a).astype(np.float64).copy()
    first = rest.max(initial=0.0)
    for k in range(d):
        at = k + int(np.argmax(rest[order[k:]]))
        if not rest[order[at]] > tolerance * first:
            return order, left[order, :k]
        order[[k, at]] = order[[at, k]]
        p = order[k]
        root = np.sqrt(rest[p])
        below = order[k + 1:]
        left[p, k] = root
        left[below, k] = (a[below, p] - left[below, :k] @ left[p, :k]) / root
        rest[below] -= left[below, k] ** 2
    return order, left[order]


def rounds(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """All pairs of n columns in rounds of disjoint pairs, as in a tournament."""
    seats = list(range(n)) + [-1] * (n % 2)
    out = []
    for _ in range(len(seats) - 1):
        half = len(seats) // 2
        pairs = [(a, b) for a, b in zip(seats[:half], reversed(seats[half:])) if a >= 0 and b >= 0]
        out.append((np.array([min(p) for p in pairs], np.int64), np.array([max(p) for p in pairs], np.int64)))
        seats = [seats[0], seats[-1], *seats[1:-1]]
    return out


def one_sided_jacobi(factor: np.ndarray, tolerance: float = 1e-15, sweeps: int = 60) -> np.ndarray:
    """The factor times rotations, its columns orthogonal to working precision. Disjoint pairs are rotated at once."""
    w = factor.copy()
    plan = rounds(w.shape[1])
    for _ in range(sweeps):
        worst = 0.0
        for i, j in plan:
            x, y = w[:, i], w[:, j]
            a, b, c = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            scale = np.sqrt(a * b)
            off = np.where(scale > 0, np.abs(c) / np.where(scale > 0, scale, 1), 0)
            worst = max(worst, float(off.max(initial=0)))
            turn = off > tolerance
            with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
                zeta = (b - a) / (2 * c)
                t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta))
            t = np.where(turn & np.isfinite(t), t, 0.0)
            cos = 1 / np.sqrt(1 + t * t)
            sin = cos * t
            w[:, i], w[:, j] = cos * x - sin * y, sin * x + cos * y
        if worst <= tolerance:
            break
    return w


def eigen(scatter: np.ndarray, tolerance: float | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues in falling order, and unit eigenvectors as columns; directions without variance are left out."""
    d = len(scatter)
    tolerance = d * np.finfo(float).eps if tolerance is None else tolerance
    order, lower = pivoted_cholesky(scatter, tolerance)
    w = one_sided_jacobi(lower)
    norms = np.sqrt((w * w).sum(0))
    rank = np.argsort(-norms, kind="stable")
    vectors = np.empty((d, len(rank)))
    vectors[order] = w[:, rank] / norms[rank]
    return norms[rank] ** 2, vectors


# ---- exact vectors ----------------------------------------------------------

#: Bytes per number of a packed vector; the first byte of a packed one tells which.
WIDTHS = (2, 4, 8)


def packed(column: pa.ListArray) -> list[bytes | None]:
    """Each vector as its exact whole numbers less OFFSET, in the narrowest width that holds all; None for bad ones."""
    values = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    known = ~np.isnan(sizes.astype(np.float64))
    sizes = np.where(known, np.nan_to_num(sizes.astype(np.float64)), 0).astype(np.int64)
    with np.errstate(invalid="ignore", over="ignore"):
        scaled = np.floor(values * SCALE)
        good = np.abs(scaled) < LARGEST  # False for nulls, which are NaN here, and for infinite values
    ends = np.append(0, np.cumsum(sizes))
    wrong = np.append(0, np.cumsum(~good))
    bad = wrong[ends[1:]] > wrong[ends[:-1]]
    whole = np.where(good, scaled, 0).astype(np.int64)
    out: list[bytes | None] = []
    for a, b, drop in zip(ends[:-1].tolist(), ends[1:].tolist(), (bad | ~known).tolist(), strict=True):
        if drop:
            out.append(None)
            continue
        x = whole[a:b]
        top = int(np.abs(x).max(initial=0))
        width = next(w for w in WIDTHS if top < 1 << (8 * w - 1))
        out.append(bytes([width]) + x.astype(f"<i{width}").tobytes())
    return out


def unpacked(vectors: list[bytes], d: int) -> np.ndarray:
    """Whole numbers of packed vectors, one row each, OFFSET added."""
    out = np.empty((len(vectors), d), np.int64)
    for width in WIDTHS:
        rows = [i for i, v in enumerate(vectors) if v[0] == width]
        if rows:
            out[rows] = np.frombuffer(b"".join([vectors[i][1:] for i in rows]), f"<i{width}").reshape(len(rows), d)
    return out + OFFSET


def pack_rows(df: DataFrame, vector: str, keep: list[str]) -> DataFrame:
    """`keep` and the packed vector (column x) of every row that has a usable one. Narrow."""
    ship(df.sparkSession)
    n = len(keep)
    source = df.select(*[df[c].alias(f"k{i}") for i, c in enumerate(keep)], df[vector].alias("v"))

    def run(batches):
        for batch in batches:
            made = packed(batch.column(n))
            good = pa.array([x is not None for x in made])
            names = [f"k{i}" for i in range(n)]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(n)), pa.array(made, pa.binary())], [*names, "x"]).filter(good)

    kinds = ", ".join(f"k{i} {df.schema[c].dataType.simpleString()}" for i, c in enumerate(keep))
    return source.mapInArrow(run, f"{kinds}, x binary" if kinds else "x binary")


def dimension() -> F.Column:
    """Dimension of a packed vector, from its length and first byte."""
    return F.expr("CAST((octet_length(x) - 1) div CAST(conv(hex(substr(x, 1, 1)), 16, 10) AS INT) AS INT)")


# ---- the fit ----------------------------------------------------------------


@dataclass(frozen=True)
class Whitening:
    """What a fit gives: vectors n, exact sums per dimension, eigenvalues in falling order, components, trace, error."""

    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float
    identity_error: float

    @property
    def d(self) -> int:
        return len(self.sums)

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n·x - S as exact whole numbers: longs, or Python's where a long may not hold them."""
        if self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums), default=0) < 1 << 62:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)

    def projected(self, deviations: np.ndarray) -> np.ndarray:
        return (deviations.astype(np.float64) / self.n) @ self.components / np.sqrt(self.values)


def blocks(batch: pa.RecordBatch, column: int, d: int):
    """Slices of a batch whose vectors have about BLOCK_VALUES numbers, with those numbers."""
    step = max(1, BLOCK_VALUES // max(1, d))
    for a in range(0, batch.num_rows, step):
        part = batch.slice(a, step)
        yield part, unpacked(part.column(column).to_pylist(), d)


def table_sum(df: DataFrame, size: int, add, dtype) -> np.ndarray:
    """A fixed-size sum over all packed vectors of df: `add(total, x)` changes a task's total in place."""
    band = 1 << 16  # numbers of a sum that one task merges

    class Total:
        def __init__(self):
            self.total = np.zeros(size, dtype)

        def add(self, batch):
            add(self.total, batch)

        def pieces(self):
            for i in range(0, size, band):
                yield i // band, self.total[i:i + band]

    def merge(total, piece):
        total += piece

    count = -(-size // band)
    parts = sum_tables(df, ["x"], Total, merge, count, dtype)
    return np.concatenate([parts.get(i, np.zeros(min(band, size - i * band), dtype)) for i in range(count)])


def fit(vectors: DataFrame, d: int, components: int = 16) -> Whitening:
    """The whitening of distinct packed vectors of dimension d (column x); `vectors` is read three times."""
    if d > MOST_DIMENSIONS:
        raise ValueError(f"a scatter of {d} dimensions is too large for the driver")
    limb, mask = 21, np.int64((1 << 21) - 1)

    def sums(total, batch):
        for _, x in blocks(batch, 0, d):  # the three parts of a long are added apart, so no sum overflows
            total[0] += len(x)
            for i, part in enumerate((x & mask, x >> limb & mask, x >> 2 * limb)):
                total[1 + i * d:1 + (i + 1) * d] += part.sum(0)

    total = [int(v) for v in table_sum(vectors, 3 * d + 1, sums, np.int64)]
    n, s = total[0], [sum(total[1 + i * d + j] << i * limb for i in range(3)) for j in range(d)]
    centre = Whitening(n, s, np.ones(0), np.zeros((d, 0)), 0.0, 0.0)

    def scatter(total, batch):
        square = total.reshape(d, d)
        for _, x in blocks(batch, 0, d):
            y = centre.deviations(x).astype(np.float64) / n
            square += y.T @ y

    product = table_sum(vectors, d * d, scatter, np.float64).reshape(d, d)
    covariance = (product + product.T) / (2 * max(n, 1))
    values, directions = eigen(covariance)
    k = min(components, len(values))
    fitted = Whitening(n, s, values[:k], directions[:, :k], float(np.trace(covariance)), 0.0)
    if not k:
        return fitted

    def again(total, batch):  # rows are centred exactly, so their whitened ones are, too
        square = total.reshape(k, k)
        for _, x in blocks(batch, 0, d):
            w = fitted.projected(fitted.deviations(x))
            square += w.T @ w

    error = float(np.abs(table_sum(vectors, k * k, again, np.float64).reshape(k, k) / n - np.eye(k)).max())
    return Whitening(n, s, fitted.values, fitted.components, fitted.trace, error)


def whiten(df: DataFrame, vector: str = "embedding", keep: list[str] | None = None, components: int = 16) -> DataFrame:
    """Whitened coordinates of every row with a usable vector, one row per component.

    Columns: `keep`, component (from 1, by falling eigenvalue), n (distinct vectors fitted), deviation (exact; null
    where a long can't hold it), whitened, explained, identity_error.

    Null vectors and vectors with null, infinite or NaN entries are dropped, entries beyond 2^61 / 64 count as infinite.
    Vectors whose dimension isn't the commonest among the distinct ones (of equally common ones the larger) have no
    place in the space and are dropped, too. A null key passes through; repeated rows give repeated rows and are fitted
    once; directions without variance have no component, so equal vectors, a single one or an empty table give no rows.
    Other columns aren't read. Vectors travel packed: the distinct ones through one shuffle, after a partial distinct.
    """
    keep = ["vec_id"] if keep is None else keep
    names = [f"k{i}" for i in range(len(keep))]
    rows = stage(pack_rows(df, vector, keep), "packed")
    vectors = stage(rows.select("x").distinct(), "distinct")
    sizes = vectors.groupBy(dimension().alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    d = sizes[0].d if sizes else 0
    model = fit(vectors.where(dimension() == d), d, components) if d else Whitening(0, [], np.ones(0), np.zeros((0, 0)), 0.0, 0.0)
    k, n = len(model.values), len(keep)
    explained = model.values / model.trace if k else model.values
    kinds = [*(rows.schema[c].dataType.simpleString() for c in names), "int", "bigint", "bigint", "double", "double", "double"]
    out = [*names, "component", "n", "deviation", "whitened", "explained", "identity_error"]

    def run(batches):
        for batch in batches:
            for part, x in (blocks(batch, n, d) if k else []):
                exact, m = model.deviations(x), len(x)
                near = (exact.astype(np.float64) ** 2).sum(1)
                if near.max(initial=0) < 2.0 ** 62:
                    squares = (exact * exact).sum(1).tolist()
                else:
                    squares = [v if (v := sum(int(y) ** 2 for y in row)) < 1 << 63 else None for row in exact.tolist()]
                repeat = np.repeat(np.arange(m), k)
                yield pa.RecordBatch.from_arrays([
                    *(part.column(i).take(pa.array(repeat)) for i in range(n)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, model.n, np.int64)), pa.array(squares, pa.int64()).take(pa.array(repeat)),
                    pa.array(model.projected(exact).reshape(-1)), pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, model.identity_error))], out)

    schema = ", ".join(f"{c} {t}" for c, t in zip(out, kinds, strict=True))
    return rows.where(dimension() == d).mapInArrow(run, schema).toDF(*keep, *out[n:])


def op11_whitening(spark, sf_dir: str) -> DataFrame:
    """Whitened coordinates of all embeddings along the first 16 components."""
    return whiten(read(spark, sf_dir, "embeddings"))
