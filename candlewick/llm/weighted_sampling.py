"""Document fingerprints by consistent weighted sampling.

A document is its words with their counts as weights. For each of the signature's places, every word draws gamma
variables from its own hash; the weight is cut to a step of a random grid, and the word with the least transformed
value is the place's sample, together with its grid step. Two documents agree in a place with a probability equal
to the generalised Jaccard similarity of their weights, sum(min) / sum(max).
"""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from itertools import chain, count, pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from candlewick.llm.common import pieces, ship
from candlewick.session import stage

PLACES = 64
#: Words of a text whose draws are held at once.
SLICE = 8192
#: Text whose words are learned together.
TOGETHER = 1 << 19
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)  # fixed values: multipliers of a 64-bit mixing function


def uniforms(hashes: np.ndarray, places: int, draws: int) -> list[np.ndarray]:
    """Numbers in (0, 1), `draws` arrays of (words, places): a counter mixed with each word's hash, two from each mix."""
    out = []
    for k in range(-(-draws // 2)):
        counter = np.arange(k * places + 1, (k + 1) * places + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x = hashes[:, None] ^ counter
        y = np.empty_like(x)
        for shift, factor in zip((30, 27), MIX, strict=True):
            x ^= np.right_shift(x, np.uint64(shift), out=y)
            x *= np.uint64(factor)
        x ^= np.right_shift(x, np.uint64(31), out=y)
        for shift in (40, 16)[:draws - 2 * k]:
            part = np.right_shift(x, np.uint64(shift), out=y).astype(np.int32)
            part &= np.int32(0xFFFFFF)
            u = part.astype(np.float32)
            u += np.float32(0.5)
            u *= np.float32(2.0**-24)
            out.append(u)
    return out


def grown(x: np.ndarray, size: int) -> np.ndarray:
    """The array, doubled until it has that many rows."""
    while len(x) < size:
        x = np.concatenate([x, np.empty_like(x)])
    return x


class Sampler:
    """Draws of the words met so far, and signatures of weighted word sets.

    Per word its values for weight 1 are kept, and the draws behind them only if it was met with a higher weight.
    """

    def __init__(self, places: int = PLACES, max_words: int = 120_000):
        self.places, self.max_words = places, max_words
        self.row: dict[bytes, int] = {}
        self.light = np.empty((4096, places), np.float32)
        self.hash, self.tag = np.empty(4096, np.uint64), np.empty(4096, np.uint32)
        self.again = np.empty(4096, bool)  # met in another group of texts
        self.at = np.empty(4096, np.int32)  # place of a word's draws, -1 without
        self.draws, self.drawn = np.empty((1024, 3, places), np.float32), 0

    def drawing(self, hashes: np.ndarray) -> np.ndarray:
        """Gamma(2, 1) draws r and the logarithms of such c, with a uniform grid offset between: (words, 3, places)."""
        u = uniforms(hashes, self.places, 5)
        out = np.empty((len(hashes), 3, self.places), np.float32)
        out[:, 0], out[:, 1], out[:, 2] = -np.log(u[0] * u[1]), u[4], np.log(-np.log(u[2] * u[3]))
        return out

    @property
    def rate(self) -> np.ndarray:
        return self.drawing(self.hash[:len(self.row)])[:, 0]

    @property
    def offset(self) -> np.ndarray:
        return self.drawing(self.hash[:len(self.row)])[:, 1]

    @property
    def cost(self) -> np.ndarray:
        return self.drawing(self.hash[:len(self.row)])[:, 2]

    def learn(self, words: list[bytes]) -> None:
        """The values of new words for weight 1."""
        a, b = len(self.row), len(self.row) + len(words)
        for name in ("light", "hash", "tag", "again", "at"):
            setattr(self, name, grown(getattr(self, name), b))
        self.hash[a:b] = hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        self.tag[a:b], self.again[a:b], self.at[a:b] = hashes >> np.uint64(32), False, -1
        for i in range(0, len(words), 128):  # so that a part's draws stay in the cache
            made = self.drawing(hashes[i:i + 128])
            r, beta, c = made[:, 0], made[:, 1], made[:, 2]
            self.light[a + i:a + i + len(made)] = c + r * beta - r  # the grid step is 0
        self.row.update(zip(words, range(a, b), strict=True))

    def draw(self, rows: np.ndarray) -> None:
        """Keeps the draws of words met with a higher weight, if there is room."""
        room = max(SLICE, self.max_words // 4)
        new = np.unique(rows[self.at[rows] < 0])
        if self.drawn + len(new) > room:
            new = np.unique(rows)
            if len(new) > room:
                return  # slice by slice, then
            self.at[:], self.drawn = -1, 0
        self.draws = grown(self.draws, self.drawn + len(new))
        for i in range(0, len(new), 128):
            part = new[i:i + 128]
            self.draws[self.drawn:self.drawn + len(part)] = self.drawing(self.hash[part])
            self.at[part] = np.arange(self.drawn, self.drawn + len(part))
            self.drawn += len(part)

    def forget(self) -> None:
        """Keeps the words that were met again since the last time, at most half of what there is room for."""
        kept = [(w, i) for w, i in self.row.items() if self.again[i]][:self.max_words // 2]
        rows = np.array([i for _, i in kept], np.int64)
        for x in (self.light, self.hash, self.tag, self.at):
            x[:len(rows)] = x[rows]
        self.row = {w: i for i, (w, _) in enumerate(kept)}
        self.again[:] = False

    def meet(self, words: list[bytes]) -> np.ndarray | None:
        """Rows of distinct words; new ones are learned together, as a few cost as much as a hundred. None without room."""
        known = list(map(self.row.get, words))
        new = [w for w, i in zip(words, known, strict=True) if i is None]
        self.again[[i for i in known if i is not None]] = True
        if len(self.row) + len(new) > self.max_words:
            self.forget()
            new = [w for w in words if w not in self.row]
            if len(self.row) + len(new) > self.max_words:
                return None
        self.learn(new)
        return np.array(list(map(self.row.get, words)), np.int32)

    def signature(self, words: list[bytes]) -> np.ndarray:
        """One sample of 16 bits per place; all zero without words."""
        if not words:
            return np.zeros(self.places, ">u2")
        counts = Counter(words)
        words, numbers = list(counts), np.fromiter(counts.values(), np.int64, len(counts))
        value, tag = np.full(self.places, np.inf, np.float32), np.zeros(self.places, np.uint32)
        step = np.zeros(self.places, np.int32)
        for i in range(0, len(words), SLICE):
            part = words[i:i + SLICE]
            if len(self.row) > self.max_words:
                self.row.clear()  # the arrays are filled anew
            new = [w for w in part if w not in self.row]
            if new:
                self.learn(new)
            v, t, s = self.least(np.array(list(map(self.row.get, part)), np.int32), numbers[i:i + SLICE])
            # the words' order must not matter: ties in value go to the least tag
            better = (v < value) | ((v == value) & (t < tag))
            value, tag, step = np.where(better, v, value), np.where(better, t, tag), np.where(better, s, step)
        return samples(tag, step)

    def signatures(self, texts: list[list[bytes]]) -> list[np.ndarray]:
        """The signatures of a group of texts, whose words are looked up once a group."""
        number: dict[bytes, int] = defaultdict(count().__next__)
        lengths = np.array([len(t) for t in texts])
        flat = np.fromiter(map(number.__getitem__, chain.from_iterable(texts)), np.int64, lengths.sum())
        rows = self.meet(list(number))
        if rows is None or not len(rows):
            return [self.signature(t) for t in texts]
        pairs, weight = np.unique(np.repeat(np.arange(len(texts)), lengths) * len(number) + flat, return_counts=True)
        text, word = np.divmod(pairs, len(number))
        row, ends = rows[word], np.searchsorted(text, np.arange(len(texts) + 1))
        self.draw(row[weight > 1])
        short = [i for i, n in enumerate(np.diff(ends)) if 0 < n <= SLICE]
        found = [self.least(row[a:b], weight[a:b]) for a, b in zip(ends[short], ends[1:][short], strict=True)]
        made = {}
        if found:
            made = dict(zip(short, samples(np.stack([t for _, t, _ in found]), np.stack([s for _, _, s in found])), strict=True))
        return [made[i] if i in made else self.signature(t) for i, t in enumerate(texts)]

    def least(self, rows: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of some words with their numbers the least value per place, its word's tag and its grid step."""
        tags = self.tag.take(rows)
        order = np.argsort(tags, kind="stable")
        rows, weight = rows[order], weight[order]
        value = self.light.take(rows, axis=0)
        heavy = np.flatnonzero(weight > 1)
        if len(heavy):
            at = self.at.take(rows[heavy])
            if at.min() < 0:
                self.draw(rows[heavy])
                at = self.at.take(rows[heavy])
            draws = self.draws.take(at, axis=0)
            rate, offset, cost = draws[:, 0], draws[:, 1], draws[:, 2]
            t = np.floor(np.log(weight[heavy]).astype(np.float32)[:, None] / rate + offset)
            value[heavy] = cost - rate * (t - offset) - rate
        best, places = value.argmin(axis=0), np.arange(self.places)
        step = np.zeros(self.places, np.int32)
        if len(heavy):
            won = np.flatnonzero(weight[best] > 1)
            step[won] = t[np.searchsorted(heavy, best[won]), won]
        return value[best, places], tags[order[best]], step


def samples(tag: np.ndarray, step: np.ndarray) -> np.ndarray:
    """16 bits of each word's tag and grid step."""
    sample = tag.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + step.astype(np.uint64)
    sample = (sample ^ (sample >> np.uint64(29))) * np.uint64(MIX[0])
    return (sample >> np.uint64(48)).astype(">u2")


def words_of(text: str) -> list[bytes]:
    return text.lower().encode().split()


def edited(text: str, following: str) -> str:
    """The last half of the code points (rounded down) replaced by the first as many of the following text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return np.count_nonzero(a == b) / len(a)


class Reader:
    """Signatures and edited texts of consecutive rows."""

    def __init__(self, places: int):
        self.sampler = Sampler(places)

    def signature(self, text: str) -> np.ndarray:
        return self.sampler.signature(words_of(text))

    def signatures(self, texts: list[str]) -> list[np.ndarray]:
        """Signatures of texts, in one group; long ones, or one or two, each for itself."""
        group, made = [i for i, t in enumerate(texts) if len(t) <= TOGETHER], {}
        if len(group) > 2:
            made = dict(zip(group, self.sampler.signatures([words_of(texts[i]) for i in group]), strict=True))
        return [made[i] if i in made else self.signature(t) for i, t in enumerate(texts)]

    def result(self, text: str, own: np.ndarray, changed: str, after: np.ndarray, next_own: np.ndarray) -> tuple:
        return (len(text), hashlib.sha256(changed.encode()).hexdigest(), own.tobytes(), after.tobytes(),
                likeness(own, after), likeness(own, next_own))


RESULT = [("n_chars", "bigint", pa.int64()), ("edited_sha256", "string", pa.string()), ("own", "binary", pa.binary()),
          ("after", "binary", pa.binary()), ("near_edited", "double", pa.float64()), ("near_next", "double", pa.float64())]
ROW, HEAD, TAIL = 0, 1, 2


def rows_in_order(places: int, key_type: pa.DataType):
    """Results of each row and its successor in the partition; the partition's first and last row as they are."""

    def run(batches):
        part, reader = TaskContext.get().partitionId(), Reader(places)
        last = None
        names = ["kind", "part", "key", "text", *[n for n, _, _ in RESULT]]
        kinds = [pa.int32(), pa.int32(), key_type, pa.string(), *[t for _, _, t in RESULT]]

        def made(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        none = (None,) * len(RESULT)
        for batch in (piece for batch in batches for piece in pieces(batch, [1], TOGETHER)):
            keys, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            row = texts if last is None else [last[1], *texts]
            changed = [edited(a, b) for a, b in pairwise(row)]
            signatures = reader.signatures(texts + changed)
            owns, afters = signatures[:len(texts)], signatures[len(texts):]
            if last is None:
                out = [(HEAD, part, keys[0], texts[0], *none)]
            else:
                keys, owns, out = [last[0], *keys], [last[2], *owns], []
            out += [(ROW, part, keys[i], None, *reader.result(row[i], owns[i], changed[i], afters[i], owns[i + 1])) for i in range(len(changed))]
            last = keys[-1], row[-1], owns[-1]
            yield made(out)
        if last is not None:
            yield made([(TAIL, part, last[0], last[1], *none)])

    return run


def fingerprint_edits(df: DataFrame, text: str = "text", key: str = "doc_id", places: int = PLACES) -> DataFrame:
    """Per document: the key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Documents stand in ascending order of the key (null first, then equal keys by the hash of their text, so that many rows of one key are many tasks' work); the edited text ends
    with the beginning of the next document's, and the last document is followed by the first. One range shuffle
    brings neighbours together; only the first and last row of each partition meet in a second, small join.

    A null text is empty; a text without words has a fingerprint of zeros, so two of them are alike. Repeated rows
    follow each other; a single document follows itself; an empty table gives an empty table; other columns of the
    input are not read.
    """
    ship(df.sparkSession)
    key_type = df.schema[key].dataType
    arrow = to_arrow_type(key_type)
    rows = df.select(df[key].alias("key"), df[text].alias("text")).withColumn("h", F.xxhash64("text"))
    rows = rows.repartitionByRange("key", "h").sortWithinPartitions("key", "h", "text").drop("h")
    schema = f"kind int, part int, key {key_type.simpleString()}, text string, " + ", ".join(f"{n} {t}" for n, t, _ in RESULT)
    done = stage(rows.mapInArrow(rows_in_order(places, arrow), schema), "fingerprints")
    # a row of numbers per partition
    tails = done.where(F.col("kind") == TAIL).select("part", "key", "text")
    heads = done.where(F.col("kind") == HEAD).select(F.col("part").alias("head"), F.col("text").alias("following"))
    order = tails.select("part", F.lead("part").over(Window.orderBy("part")).alias("to"))
    first = order.agg(F.min("part").alias("start"))
    order = order.withColumn("to", F.coalesce("to", F.lit((first.first() or [None])[0])))
    ends = tails.join(order, "part").join(heads, F.col("to") == F.col("head")).select("key", "text", "following")

    def close(batches):
        reader = Reader(places)
        for batch in (piece for batch in batches for piece in pieces(batch, [1, 2], TOGETHER)):
            keys, texts, following = (batch.column(i).to_pylist() for i in range(3))
            changed = [edited(a, b) for a, b in zip(texts, following, strict=True)]
            n, signatures = len(texts), reader.signatures(texts + changed + following)
            out = [(keys[i], *reader.result(texts[i], signatures[i], changed[i], signatures[n + i], signatures[2 * n + i])) for i in range(n)]
            if out:
                kinds = [arrow, *[t for _, _, t in RESULT]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)],
                                                 ["key", *[n for n, _, _ in RESULT]])

    names = [n for n, _, _ in RESULT]
    closed = ends.mapInArrow(close, f"key {key_type.simpleString()}, " + ", ".join(f"{n} {t}" for n, t, _ in RESULT))
    whole = done.where(F.col("kind") == ROW).select("key", *names).unionByName(closed)
    return whole.select(F.col("key").alias(key), "n_chars", "edited_sha256", F.lower(F.hex("own")).alias("fingerprint"),
                        F.lower(F.hex("after")).alias("edited_fingerprint"), "near_edited", "near_next")


def op4_fingerprints(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return fingerprint_edits(spark.read.parquet(f"{sf_dir}/documents.parquet"))
