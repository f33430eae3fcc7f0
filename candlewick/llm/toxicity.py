"""Toxic passages: token log-odds with Dirichlet priors, all maximal scoring segments, extreme-value calibration.

1. Token counts over all documents give the prior; counts over a bounded sample of labelled documents give each
   token's log-odds of the toxic against the clean class, shrunk by their own uncertainty.
2. A token's score is that log-odds less a small drift, so text without evidence scores below zero. One linear scan
   finds every maximal scoring segment of a document.
3. Extreme-value calibration: the number of segments of a clean text that reach a score is a Poisson variable whose
   mean falls with the score as the clean distribution says, and exponentially beyond the best single token, with
   the scale that the distribution implies. The least chance over the r best segments is a document's evidence,
   and a logistic curve fitted on the sample turns it into a probability.
Tokens are hashed to a fixed number of buckets, so all tables have a fixed size.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import WORDS, map_texts, pack, pieces, ship, sum_tables, unpack
from candlewick.session import stage

BITS = 20
SEGMENTS = 64
#: Labelled documents of each class that the classifier is fitted on, at most: those with the least hash of the key.
SAMPLE = 40_000
#: Weight of the prior, the corpus distribution, as a share of the sample's words.
PRIOR = 0.05
LEAST_Z = 2.0
#: Bytes of a token that count as its stem; a token without evidence of its own scores as its stem does.
STEM = 6
DRIFT = 0.35
#: The highest score of a text without evidence.
NO_EVIDENCE = 0.49
#: Segments below this score are no evidence.
LEAST_SCORE = 1.0


class Buckets(dict):
    """Buckets of a token and of its stem, in one number; bounded by clearing."""

    def __missing__(self, token: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        mask = (1 << BITS) - 1
        both = self[token] = zlib.crc32(token) & mask | (zlib.crc32(token[:STEM], 1) & mask) << BITS
        return both

    def of(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        both = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return both & (1 << BITS) - 1, both >> BITS


def tokens(text: bytes) -> list[bytes]:
    """Words of letters and digits in lower case."""
    return (text if text.isascii() else text.decode().lower().encode()).translate(WORDS).split()


class ClassCounts:
    """Documents with each token, of one task: all documents, toxic and clean ones of the sample."""

    def __init__(self):
        self.table = np.zeros((1 << BITS, 3), np.int64)
        self.buckets = Buckets()

    def add(self, batch: pa.RecordBatch) -> None:
        for piece in pieces(batch, [0]):
            for text, toxic in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True):
                words = tokens(text or b"")
                if words:
                    for buckets in self.buckets.of(words):
                        at = np.sort(buckets)
                        first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
                        self.table[at[first], 0] += 1
                        if toxic is not None:
                            self.table[at[first], 1 if toxic else 2] += 1

    def pieces(self):
        size = (1 << BITS) // SEGMENTS
        for s in range(SEGMENTS):
            part = self.table[s * size:(s + 1) * size]
            if part.any():
                yield s, part.reshape(-1)


def add_counts(total: np.ndarray, piece: np.ndarray) -> None:
    total += piece


def training_sample(labels: DataFrame, key: str, label: str, limit: int) -> DataFrame:
    """At most `limit` labelled keys of each class: those with the least hash. Ties and repeated keys count once."""
    rows = labels.where(f"`{key}` IS NOT NULL AND `{label}` IS NOT NULL").groupBy(key).agg((F.max(label) > 0).alias("toxic"))
    return rows.where("toxic").orderBy(F.xxhash64(key), key).limit(limit).unionAll(
        rows.where("NOT toxic").orderBy(F.xxhash64(key), key).limit(limit)).select(F.col(key).alias("sample_key"), F.col("toxic").alias("sample_toxic"))


class Scores:
    """Scores of all buckets, and the scale of the extreme-value law."""

    def __init__(self, counts: np.ndarray):
        everything, toxic, clean = (counts[:, i].astype(float) for i in range(3))
        prior = PRIOR * (toxic.sum() + clean.sum()) * everything / max(1.0, everything.sum()) + 1e-3
        n1, n0, n = toxic.sum(), clean.sum(), prior.sum()
        odds = np.log((toxic + prior) / (n1 + n - toxic - prior)) - np.log((clean + prior) / (n0 + n - clean - prior))
        z = odds / np.sqrt(1 / (toxic + prior) + 1 / (clean + prior))
        shrunk = odds * np.maximum(0.0, 1 - (LEAST_Z / np.maximum(np.abs(z), 1e-9)) ** 2)
        if not n1 or not n0:
            shrunk = np.zeros_like(odds)
        self.values = (np.minimum(shrunk, 8.0).clip(min=-DRIFT) - DRIFT).astype(np.float32)
        share = clean + 0.01 * prior
        self.law = ChanceLaw(self.values.astype(float), share / share.sum())


class ChanceLaw:
    """The mean number of segments per clean token that reach a score."""

    def __init__(self, values: np.ndarray, share: np.ndarray):
        order = np.argsort(-values, kind="stable")
        order = order[values[order] > 0]
        self.grid = np.linspace(0, 8, 161)
        reached = np.append(0.0, np.cumsum(share[order]))
        self.rate = reached[np.searchsorted(-values[order], -self.grid, "right")]
        self.top = float(values.max(initial=0))
        self.scale = extreme_value_scale(values, share)

    def mean(self, score: float) -> float:
        if score <= self.top:
            return float(self.rate[min(int(score * 20), len(self.grid) - 1)])
        return float(self.rate[min(int(self.top * 20), len(self.grid) - 1)]) * math.exp(-self.scale * (score - self.top))


def extreme_value_scale(values: np.ndarray, share: np.ndarray) -> float:
    """The positive root of sum(share * exp(scale * value)) = 1: how fast the best segment's tail falls."""
    up = values > 0
    if not up.any() or share[up].sum() <= 0:
        return 1.0
    low, high = 1e-6, 1.0
    mean = lambda t: float((share * np.exp(np.minimum(t * values, 60))).sum()) - 1
    while mean(high) < 0 and high < 64:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if mean(middle) < 0 else (low, middle)
    return low


def maximal_segments(at: np.ndarray, gains: np.ndarray, cost: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last, score) in one pass.

    `at` and `gains` are the tokens with a positive score; `cost` is the running sum of all scores before each token,
    one longer than the text. A candidate segment joins an earlier one that began lower and ended not higher. Each
    segment keeps the place of the nearest earlier one that began lower, so no segment is passed over twice: linear.
    """
    found: list[tuple] = []  # first, last, sum before, sum after, place of the nearest earlier one with a lower sum before
    for i, gain in zip(at.tolist(), gains.tolist(), strict=True):
        first, low = i, float(cost[i])
        high, j = low + gain, len(found) - 1
        while True:
            while j >= 0 and found[j][2] >= low:
                j = found[j][4]
            if j < 0 or found[j][3] >= high:
                found.append((first, i, low, high, j))
                break
            first, _, low, _, before = found[j]
            del found[j:]
            j = before
    return [(a, b, r - l) for a, b, l, r, _ in found]


def minus_log_chance(count: int, mean: float) -> float:
    """-ln P(a Poisson variable of this mean is `count` or more)."""
    mean = max(mean, 1e-12)
    if mean >= count:
        return 0.0
    term = total = 1.0
    for k in range(1, 40):
        term *= mean / (count + k)
        total += term
    return max(0.0, mean + math.lgamma(count + 1) - count * math.log(mean) - math.log(total))


def evidence(words: list[bytes], buckets: Buckets, values: np.ndarray, law: ChanceLaw) -> tuple[float, list[tuple[int, int, float]]]:
    """The evidence of a text, and the segments that make it up: the r best ones, for the r of the least chance."""
    if not words:
        return 0.0, []
    own, stem = buckets.of(words)
    score = values[own]
    score = np.where(score == np.float32(-DRIFT), values[stem], score)
    up = np.flatnonzero(score > 0)
    if not len(up):
        return 0.0, []
    sums = np.append(0.0, np.cumsum(score, dtype=np.float64))
    segments = sorted(maximal_segments(up, score[up].astype(float), sums), key=lambda x: (-x[2], x[0]))
    best, size = 0.0, 0
    for r, (_, _, s) in enumerate(segments, 1):
        if s < LEAST_SCORE:
            break
        x = minus_log_chance(r, len(words) * law.mean(s)) - 2 * math.log(r + 1)  # many r are tried
        if x > best:
            best, size = x, r
    return best, sorted(segments[:size])


def logistic_fit(x: np.ndarray, toxic: np.ndarray, clean: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve over binned values, by Newton's method with a small ridge."""
    w = np.zeros(2)
    rows = np.stack([x, np.ones_like(x)], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(rows @ w, -30, 30)))
        n = toxic + clean
        gradient = rows.T @ (n * p - toxic) + np.array([1e-3, 1e-3]) * w
        curve = (rows * (n * p * (1 - p))[:, None]).T @ rows + 1e-3 * np.eye(2)
        w -= np.clip(np.linalg.solve(curve, gradient), -2, 2)
    return float(max(w[0], 0.0)), float(w[1])


@dataclass
class Model:
    """What scoring needs: the buckets' scores, packed, the law of chance, and the curve from evidence to score."""

    values: bytes
    law: ChanceLaw
    slope: float = 0.0
    offset: float = 0.0

    def score(self, found: float) -> float:
        """The curve's probability; a text without evidence is never called toxic, whatever the share of labels."""
        score = 1 / (1 + math.exp(-max(-30.0, min(30.0, self.slope * math.log1p(found) + self.offset))))
        return score if found > 0 else min(score, NO_EVIDENCE)


def judged(df: DataFrame, model: Model, text: str, keep: list[str], passages: bool) -> DataFrame:
    """`keep`, evidence, score and passages of every text. Narrow."""

    def start():
        values, buckets = unpack(model.values, np.float32), Buckets()

        def block(texts):
            found = [evidence(tokens(t), buckets, values, model.law) for t in texts]
            return [[x for x, _ in found], [model.score(x) for x, _ in found],
                    [[{"first": a, "last": b, "score": x} for a, b, x in s] if passages else [] for _, s in found]]

        return block

    outputs = [("evidence", "double"), ("score", "double"), ("passages", "array<struct<first:int,last:int,score:double>>")]
    return map_texts(df, [text], keep, outputs, start)


def fit(df: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic", sample: int = SAMPLE) -> Model:
    """The prior from all texts; token scores and the curve from at most `sample` labelled keys of each class."""
    ship(df.sparkSession)
    chosen = stage(training_sample(labels, key, label, sample), "toxic-sample")
    small = F.broadcast(chosen)  # at most 2 * sample rows of a key and a flag
    rows = df.select(df[key].alias("key"), df[text].cast("binary").alias("text"))
    marked = rows.join(small, rows.key == chosen.sample_key, "left")
    counts = sum_tables(marked, ["text", "sample_toxic"], ClassCounts, add_counts, SEGMENTS, np.int64)
    size = (1 << BITS) // SEGMENTS
    scores = Scores(np.concatenate([counts.get(s, np.zeros(size * 3, np.int64)).reshape(-1, 3) for s in range(SEGMENTS)]))
    model = Model(pack(scores.values), scores.law)
    # the curve is fitted on the sample's counts per bin of log evidence: a small table, whatever the sample
    taught = judged(rows.join(small, rows.key == chosen.sample_key), model, "text", ["sample_toxic"], False)
    bins = taught.groupBy(F.least(F.floor(F.log1p("evidence") * 8), F.lit(80)).alias("bin")).agg(
        F.sum(F.col("sample_toxic").cast("int")).alias("toxic"), F.count("*").alias("n")).collect()
    if bins:
        x, toxic, n = (np.array([float(b[c]) for b in bins]) for c in ("bin", "toxic", "n"))
        model.slope, model.offset = logistic_fit((x + 0.5 * (x > 0)) / 8, toxic, n - toxic)
    return model


def score_toxicity(df: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic",
                   sample: int = SAMPLE, passages: bool = True, keep: list[str] | None = None) -> DataFrame:
    """One row per document: `keep` (else the key), score (0 to 1) and, with `passages`, the significant passages.

    A passage is its first and last word and its score. `labels` has the rows to learn from; only `sample` keys of
    each class are used. A null or empty text has no passage and gets the score of no evidence. Null keys and null
    labels teach nothing; a key labelled twice counts once, as toxic if any label is. Repeated rows give repeated
    rows; without labels of both classes no token scores, and no text is called toxic (a score of 0.49 at most);
    empty tables give empty tables. Columns that aren't named are not read. Once the model is fitted,
    scoring is narrow: each task judges its own rows.
    """
    model = fit(df, labels, text, key, label, sample)
    keep = [key] if keep is None else keep
    return judged(df, model, text, keep, passages).select(*keep, "score", *["passages"] * passages)


def learnable(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """The labels outside the held-out fold."""
    return labels.where(F.crc32(F.col(key).cast("string")) % 5 != 0)


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from the labels outside the held-out fold."""
    labels = learnable(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score_toxicity(spark.read.parquet(f"{sf_dir}/documents.parquet"), labels, passages=False)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
