"""Secret scans: fixed patterns, and a character convolutional network over every candidate with its context.

Findings of the patterns are the labels: their values are positive, other long tokens negative. All distinct labelled
windows count: three quarters train the network, the last quarter calibrates its scores and sets the threshold, which
keeps the wanted recall there with as few negatives as the highest such one. Spark packs the windows into blocks; in
each round every block trains from the common state, and the new common state is the blocks' mean. Held-out logits are
counted in a table of fixed size. Values are trained on and scored with what stands around them. Pattern findings
always stay; the network adds candidates that no pattern covers.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import map_texts, pieces, ship, sum_tables
from candlewick.session import stage

#: The patterns and least lengths of the contract.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "model")
LEAST = {"assign": 6, "access": 20, "hex": 24}
HINTS = ("passw", "secret", "token", "api")
#: Any token of 12 characters or more may be a secret, as may its parts between = / . of that length.
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{12,}")
SIDE = re.compile(r"[^=/.]{12,}")

BEFORE, INSIDE, AFTER = 16, 32, 16
#: Views of a longer candidate begin every so many characters, so any 16 of it lie within one view.
SLIDE = 16
WIDTH = BEFORE + INSIDE + AFTER
SIGNS = " \n\"'=:-_/+.@,;(){}[]<>"
CLASSES = 2 * 64
RECALL = 0.98
#: Windows that one task trains on at once, and of the rarer label as many in each block if need be, as copies.
BLOCK, RARE = 1 << 15, 128
#: Each window is trained on so often: more often where there are few.
PASSES, WINDOWS_SEEN = (4, 12), 480_000
#: Held-out logits are counted by steps of 1 / FINE between -BINS / FINE / 2 and BINS / FINE / 2.
BINS, FINE = 1 << 14, 128
#: Windows that a task remembers, so as not to send them twice.
REMEMBERED = 100_000


def base_spans(text: str) -> list[tuple[int, int, int, int, int]]:
    """(start, kind, end, value start, value end) of the patterns' findings, in the order of the contract."""
    out = []
    lower = text.lower()
    if any(h in lower for h in HINTS):
        out += [(m.start(), 0, m.end(), *m.span(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST["assign"]]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    out += [(m.start(), 2, m.end(), *m.span()) for m in HEX.finditer(text)]
    return sorted(out)


def other_candidates(text: str, base: list) -> list[tuple[int, int]]:
    """Long tokens that no finding of the patterns overlaps."""
    found = [m.span() for m in CANDIDATE.finditer(text)]
    if not base:
        return found
    out, at, reach = [], 0, 0
    for a, b in found:  # both lists are in order, so each is gone through once
        while at < len(base) and base[at][0] < b:
            reach = max(reach, base[at][2])
            at += 1
        if reach <= a:
            out.append((a, b))
    return out


def char_classes() -> np.ndarray:
    """Class of each Latin-1 character: letters without case, digits, signs, upper case and the rest."""
    table = np.full(256, 63, np.uint8)
    for i in range(26):
        table[ord("a") + i] = 1 + i
        table[ord("A") + i] = 1 + i
    table[48:58] = np.arange(27, 37)
    for i, c in enumerate(SIGNS):
        table[ord(c)] = 37 + i
    return table


TABLE = char_classes()
AROUND, WITHIN = TABLE.tobytes(), (TABLE + 64).tobytes()


def window(text: str, start: int, end: int) -> bytes:
    """Classes of the characters before, inside and behind a candidate; 0 pads, classes inside are moved up."""
    def part(a: int, b: int, table: bytes) -> bytes:
        return text[a:b].encode("latin-1", "replace").translate(table)

    return (part(max(0, start - BEFORE), start, AROUND).rjust(BEFORE, b"\0") + part(start, min(end, start + INSIDE), WITHIN).ljust(INSIDE, b"\0")
            + part(end, end + AFTER, AROUND).ljust(AFTER, b"\0"))


def views(text: str, start: int, end: int) -> list[bytes]:
    """Windows that cover a whole candidate: the 32-character view moved over it, and over its parts at = / . if it has any."""
    spans = [(start, end)]
    parts = [(start + m.start(), start + m.end()) for m in SIDE.finditer(text[start:end])]
    spans += [p for p in parts if p != (start, end)]
    out = []
    for a, b in spans:
        out.append(window(text, a, b))
        at = a
        while at + INSIDE < b:
            at = min(at + SLIDE, b - INSIDE)
            out.append(window(text, at, b))
    return list(dict.fromkeys(out))


def placed(windows: np.ndarray, others: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """The windows with the surroundings of others, drawn at random: their values as they stand in ordinary text."""
    if not len(others):
        return windows
    out, drawn = windows.copy(), others[rng.integers(0, len(others), len(windows))]
    out[:, :BEFORE], out[:, BEFORE + INSIDE:] = drawn[:, :BEFORE], drawn[:, BEFORE + INSIDE:]
    return out


def numbers(windows: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """The windows with a plain number of 12 to 32 digits inside, whole or in groups: order, card and phone numbers."""
    out = windows.copy()
    digits = 64 + TABLE[rng.integers(48, 58, (len(out), INSIDE))]
    group, mark = rng.integers(3, 6, len(out)), 64 + TABLE[np.frombuffer(b"--..////", np.uint8)]
    grouped = rng.random(len(out)) < 0.3
    places = np.arange(INSIDE)[None, :]
    split = grouped[:, None] & (places % (group[:, None] + 1) == group[:, None])
    digits = np.where(split, mark[rng.integers(0, len(mark), len(out))][:, None], digits)
    size = np.where(rng.random(len(out)) < 0.4, 16, rng.integers(12, INSIDE + 1, len(out)))
    out[:, BEFORE:BEFORE + INSIDE] = np.where(places < size[:, None], digits, 0)
    return out


@dataclass
class Network:
    """One convolution over character classes, the maximum over places, one linear layer; then scale and threshold."""

    filters: np.ndarray  # (span, classes, filters)
    offset: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0
    threshold: float = 2.0  # above 1: adds nothing
    recall: float = 0.0  # share of held-out values of findings, in the surroundings of others, at the threshold or above
    passed: float = 0.0  # share of held-out negatives there
    passed_numbers: float = 0.0  # share of plain numbers there

    def hidden(self, x: np.ndarray) -> np.ndarray:
        span = len(self.filters)
        places = x.shape[1] - span + 1
        out = np.broadcast_to(self.offset, (len(x), places, len(self.offset))).copy()
        for k in range(span):
            out += self.filters[k][x[:, k:k + places]]
        return out

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(self.hidden(x).max(axis=1), 0) @ self.weights + self.bias

    def scores(self, windows: list[bytes]) -> np.ndarray:
        out = [np.zeros(0)]
        for i in range(0, len(windows), 1024):
            x = np.frombuffer(b"".join(windows[i:i + 1024]), np.uint8).reshape(-1, WIDTH)
            out.append(1 / (1 + np.exp(-np.clip(self.slope * self.logits(x).astype(np.float64) + self.shift, -30, 30))))
        return np.concatenate(out)


def calibration(logits: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve over weighted logits, by gradient steps with a ridge towards slope 1."""
    a, b, weights = 1.0, 0.0, weights / weights.sum()
    for _ in range(300):
        error = weights * (1 / (1 + np.exp(-np.clip(a * logits + b, -30, 30))) - labels)
        a -= 0.05 * (float((error * logits).sum()) + 0.01 * (a - 1))
        b -= 0.05 * float(error.sum())
    return max(a, 0.05), b


@dataclass
class Block:
    """Some windows: those to train on and the held-out ones, with their labels."""

    number: int
    x: np.ndarray
    y: np.ndarray
    held_x: np.ndarray
    held_y: np.ndarray

    @staticmethod
    def of(number: int, x: bytes, y: bytes, held_x: bytes, held_y: bytes) -> Block:
        windows = [np.frombuffer(w, np.uint8).reshape(-1, WIDTH) for w in (x, held_x)]
        labels = [np.frombuffer(v, np.uint8).astype(np.float32) for v in (y, held_y)]
        return Block(number, windows[0], labels[0], windows[1], labels[1])


def some_numbers(negative: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Plain numbers in the surroundings of about a third of the negative windows."""
    return numbers(negative[rng.random(len(negative)) < 1 / 3], rng)


class Training:
    """The network in training: its parameters and their moments (Adam), which are one vector between rounds."""

    def __init__(self, filters: int = 24, span: int = 5, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.seed, self.step, self.round = seed, 0, 0
        self.shapes = [(span, CLASSES, filters), (filters,), (filters,), (1,)]
        self.values = [rng.normal(0, 0.1, self.shapes[0]).astype(np.float32), np.zeros(filters, np.float32),
                       rng.normal(0, 0.2, filters).astype(np.float32), np.zeros(1, np.float32)]
        self.first, self.second = ([np.zeros(s, np.float32) for s in self.shapes] for _ in range(2))

    def network(self) -> Network:
        filters, offset, weights, bias = self.values
        return Network(filters, offset, weights, float(bias[0]))

    def vector(self) -> np.ndarray:
        """All numbers and, at the end, the steps made."""
        return np.concatenate([x.ravel() for x in (*self.values, *self.first, *self.second)] + [[self.step]], dtype=np.float64)

    def after(self, vector: np.ndarray) -> Training:
        """The state of the next round, from its vector."""
        out = Training(self.shapes[1][0], self.shapes[0][0], self.seed)
        at = 0
        for part in (out.values, out.first, out.second):
            for i, shape in enumerate(self.shapes):
                part[i] = vector[at:at + np.prod(shape)].astype(np.float32).reshape(shape)
                at += int(np.prod(shape))
        out.step, out.round = round(float(vector[at])), self.round + 1
        return out

    def pass_over(self, block: Block) -> Training:
        """The state after one pass over a block's training windows.

        A token that is scored has no pattern's name beside it. So half of the positive windows stand in the
        surroundings of negative ones; a third as many plain numbers as there are negatives are negative, too. The
        rarer label's windows are repeated up to an eighth.
        """
        out = self.after(self.vector())
        rng = np.random.default_rng([self.seed, self.round, block.number])
        around = np.concatenate([block.x[block.y == 0], some_numbers(block.x[block.y == 0], rng)])
        tx = np.concatenate([block.x[block.y == 1], around])
        ty = np.repeat(np.float32([1, 0]), [len(tx) - len(around), len(around)])
        which = np.arange(len(tx))
        rare = which[ty == (2 * len(around) > len(tx))]
        if len(rare):
            which = np.concatenate([which, rng.choice(rare, max(0, (len(tx) - len(rare)) // 7 - len(rare)))])
        share = float(ty[which].mean()) if len(which) else 0.0
        balance = np.where(ty == 1, 0.5 / max(share, 1e-9), 0.5 / max(1 - share, 1e-9)).astype(np.float32)
        order = rng.permutation(which)
        for at in range(0, len(order), 128):
            pick = order[at:at + 128]
            bx = tx[pick]
            moved = (ty[pick] == 1) & (rng.random(len(pick)) < 0.5)
            bx[moved] = placed(bx[moved], around, rng)
            out.descend(bx, ty[pick], balance[pick])
        return out

    def descend(self, x: np.ndarray, y: np.ndarray, balance: np.ndarray) -> None:
        net = self.network()
        hidden = net.hidden(x)
        best = hidden.argmax(axis=1)  # (rows, filters)
        top = np.take_along_axis(hidden, best[:, None, :], 1)[:, 0]
        active = np.maximum(top, 0)
        p = 1 / (1 + np.exp(-np.clip(active @ net.weights + net.bias, -30, 30)))
        error = ((p - y) * balance / len(x)).astype(np.float32)
        back = error[:, None] * net.weights * (top > 0)
        gradient = np.zeros_like(net.filters)
        column = np.broadcast_to(np.arange(best.shape[1]), best.shape)
        for k in range(len(net.filters)):
            np.add.at(gradient[k], (np.take_along_axis(x, best + k, 1), column), back)
        self.step += 1
        for i, g in enumerate((gradient + 1e-5 * net.filters, back.sum(0), active.T @ error + 1e-4 * net.weights, error.sum(keepdims=True))):
            self.first[i] = 0.9 * self.first[i] + 0.1 * g
            self.second[i] = 0.999 * self.second[i] + 0.001 * g * g
            change = 0.01 * (self.first[i] / (1 - 0.9**self.step)) / (np.sqrt(self.second[i] / (1 - 0.999**self.step)) + 1e-8)
            self.values[i] = self.values[i] - change.astype(np.float32)


def counted(net: Network, block: Block, seed: int) -> np.ndarray:
    """Held-out windows by bin of their logit: positive ones in the surroundings of negative ones, negatives, plain numbers."""
    rng = np.random.default_rng([seed, block.number])
    negative = block.held_x[block.held_y == 0]
    out = np.zeros((3, BINS), np.int64)
    for row, x in zip(out, (placed(block.held_x[block.held_y == 1], negative, rng), negative, some_numbers(negative, rng)), strict=True):
        for at in range(0, len(x), 1024):
            place = np.floor(net.logits(x[at:at + 1024]).astype(np.float64) * FINE) + BINS // 2
            row += np.bincount(np.clip(place, 0, BINS - 1).astype(np.int64), minlength=BINS)
    return out


def settled(net: Network, table: np.ndarray, recall: float) -> Network:
    """The network with slope, shift, threshold and held-out figures, from the counts of all held-out logits.

    The threshold is the highest edge of a bin with this recall, lowered half-way to the next negative below: no more
    of them pass. Counts at an edge are exact.
    """
    edges = (np.arange(BINS) - BINS // 2) / FINE
    bad = table[1] + table[2]
    net.slope, net.shift = calibration(np.tile(edges + 0.5 / FINE, 2), np.repeat([1.0, 0.0], BINS), np.concatenate([table[0], bad]))
    p = 1 / (1 + np.exp(-np.clip(net.slope * edges + net.shift, -30, 30)))
    below = np.cumsum(table[0]) - table[0]  # positives under each edge
    highest = int(np.flatnonzero(below <= int((1 - recall) * table[0].sum()))[-1])
    under = np.flatnonzero(bad[:highest])
    least = int(under[-1]) + 1 if len(under) else 0
    middle = (p[highest] + (p[least] if least else 0.0)) / 2
    at = min(highest, least + int(np.searchsorted(p[least:highest], middle)))
    net.threshold = float(p[at])
    net.recall, net.passed, net.passed_numbers = (float(row[at:].sum() / max(1, row.sum())) for row in table)
    return net


def passes(windows: int) -> int:
    return min(PASSES[1], max(PASSES[0], -(-WINDOWS_SEEN // max(1, windows))))


def train(positive: list[bytes], negative: list[bytes], filters: int = 24, span: int = 5, epochs: int | None = None,
          recall: float = RECALL, seed: int = 7) -> Network:
    """As `fit`, on distinct windows at hand, which are one block.

    Without windows of both labels in both parts the network adds nothing.
    """
    rows = sorted([(xxhash.xxh3_64_intdigest(w), w, y) for y, ws in ((1, positive), (0, negative)) for w in ws])
    parts = [[(w, y) for h, w, y in rows if (h % 4 == 0) == held] for held in (False, True)]
    state = Training(filters, span, seed)
    if any(len({y for _, y in part}) < 2 for part in parts):
        return state.network()
    block = Block.of(0, *(data for part in parts for data in (b"".join(w for w, _ in part), bytes(y for _, y in part))))
    for _ in range(epochs or passes(len(block.x))):
        state = state.pass_over(block)
    return settled(state.network(), counted(state.network(), block, seed), recall)


def labelled_windows(df: DataFrame, text: str, limit: int | None = None) -> DataFrame:
    """(label, h, window) of all distinct labelled windows of all texts, h their hash; with a limit, to look at some,
    those of the least hashes of each label."""
    ship(df.sparkSession)

    def run(batches):
        seen: set[tuple[int, bytes]] = set()
        for batch in (piece for batch in batches for piece in pieces(batch, [0])):
            new = []
            for value in batch.column(0).to_pylist():
                if value:
                    base = base_spans(value)
                    made = [(1, window(value, a, b)) for _, _, _, a, b in base]
                    made += [(0, w) for a, b in other_candidates(value, base) for w in views(value, a, b)]
                    for row in made:
                        if row not in seen:
                            seen.add(row)
                            new.append(row)
            for at in range(0, len(new), 10_000):
                part = new[at:at + 10_000]
                h = np.array([xxhash.xxh3_64_intdigest(w) for _, w in part], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([y for y, _ in part], pa.int32()), pa.array(h), pa.array([w for _, w in part], pa.binary())],
                                                 ["label", "h", "window"])
            if len(seen) > REMEMBERED:
                seen.clear()

    found = df.select(df[text].alias("text")).mapInArrow(run, "label int, h bigint, window binary").distinct()
    if limit is None:
        return found
    found = stage(found, "labelled-windows")
    least = [found.where(F.col("label") == i).orderBy("h", "window").limit(limit) for i in (0, 1)]
    return least[0].unionAll(least[1])


def packed(found: DataFrame, trained: dict[int, int], blocks: int) -> DataFrame:
    """One row per block: number, training windows, their labels, held-out windows, their labels.

    Blocks are by hash. Where a label has too few training windows, each goes to several blocks.
    """
    copies = F.lit(1)
    for label, n in trained.items():
        if n < RARE * blocks:
            copies = F.when((F.col("label") == label) & ~F.col("held"), min(blocks, -(-RARE * blocks // n))).otherwise(copies)
    rows = found.withColumn("held", F.expr("pmod(h, 4) = 0"))
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(0), copies - 1)))
    rows = rows.select(F.pmod(F.pmod(F.xxhash64("h"), F.lit(blocks)) + F.col("copy"), F.lit(blocks)).alias("block"), "held", "label", "window")
    # a stated number of partitions, so that small blocks aren't put together into one task
    rows = rows.repartition(min(blocks, 20_000), "block").sortWithinPartitions("block", "held", "window", "label")

    def run(batches):
        number, x, y = None, [bytearray(), bytearray()], [bytearray(), bytearray()]

        def made():
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *(pa.array([bytes(c)], pa.binary()) for c in (x[0], y[0], x[1], y[1]))],
                                              ["block", "x", "y", "held_x", "held_y"])

        for batch in batches:
            for block, held, label, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if block != number:
                    if number is not None:
                        yield made()
                    number, x, y = block, [bytearray(), bytearray()], [bytearray(), bytearray()]
                x[held] += value
                y[held].append(label)
        if number is not None:
            yield made()

    return stage(rows.mapInArrow(run, "block bigint, x binary, y binary, held_x binary, held_y binary"), "window-blocks")


class Sums:
    """The sum of whole numbers that each block gives."""

    def __init__(self, of):
        self.of, self.total = of, None

    def add(self, batch: pa.RecordBatch) -> None:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            values = self.of(Block.of(*row))
            self.total = values if self.total is None else self.total + values

    def pieces(self):
        return [] if self.total is None else [(0, self.total)]


def summed(blocks: DataFrame, of) -> np.ndarray:
    def merge(total, piece):
        total += piece

    return sum_tables(blocks, blocks.columns, lambda: Sums(of), merge, 1, np.int64)[0]


def fit(df: DataFrame, text: str = "text", recall: float = RECALL, seed: int = 7) -> Network:
    """A network fitted on all distinct labelled windows: rounds over all blocks, then one count of the held-out ones.

    Sums are of whole numbers (steps of a fixed-point scale), so they don't depend on the order of tasks.
    """
    found = stage(labelled_windows(df, text), "labelled-windows")
    part = {(r.label, r.held): r["count"] for r in found.groupBy("label", F.expr("pmod(h, 4) = 0").alias("held")).count().collect()}
    state = Training(seed=seed)
    if len(part) < 4:
        return state.network()
    trained = {label: part[label, False] for label in (0, 1)}
    blocks = -(-sum(trained.values()) // BLOCK)
    table = packed(found, trained, blocks)
    n, scale = passes(sum(trained.values())), 2.0 ** (46 - blocks.bit_length())

    def after(state: Training, times: int):
        def of(block: Block) -> np.ndarray:
            now = state
            for _ in range(times):
                now = now.pass_over(block)
            return np.rint(now.vector() * scale).astype(np.int64)

        return of

    # a single block needs no mean between passes
    used = table.count()
    for times in [n] if used == 1 else [1] * n:
        state = state.after(summed(table, after(state, times)) / (used * scale))
    net = state.network()
    counts = summed(table, lambda block: counted(net, block, seed).ravel())
    return settled(net, counts.reshape(3, BINS), recall)


def spelled(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def scan(df: DataFrame, network: Network, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Secrets of every whole text: `keep`, n_assign, n_access, n_hex, base_sha256, spans (kind:start:end). Narrow.

    Positions are code points, the end exclusive. Null and empty texts have no spans (an empty string); a null key
    passes through; repeated rows give repeated rows; an empty table gives an empty table; other columns of the
    input are not read. Findings of several kinds may overlap; each counts.
    """

    def start():
        def block(texts):
            bases, owners, places, windows, first = [], [], [], [], []
            for i, value in enumerate(texts):
                value = value.decode()
                base = base_spans(value)
                bases.append([(s, k, e) for s, k, e, _, _ in base])
                if network.threshold <= 1:
                    for a, b in other_candidates(value, base):
                        owners.append(i)
                        places.append((a, 3, b))
                        first.append(len(windows))
                        windows += views(value, a, b)
            spans = [list(b) for b in bases]
            highest = np.maximum.reduceat(network.scores(windows), first).tolist() if first else []
            for i, place, score in zip(owners, places, highest, strict=True):
                if score >= network.threshold:
                    spans[i].append(place)
            counts = [[sum(k == kind for _, k, _ in b) for b in bases] for kind in range(3)]
            return [*counts, [hashlib.sha256(spelled(b).encode()).hexdigest() for b in bases], [spelled(s) for s in spans]]

        return block

    outputs = [("n_assign", "bigint"), ("n_access", "bigint"), ("n_hex", "bigint"), ("base_sha256", "string"), ("spans", "string")]
    return map_texts(df, [text], ["doc_id"] if keep is None else keep, outputs, start)


def op9_secrets(spark, sf_dir: str) -> DataFrame:
    """Secrets in all documents, by the patterns and a network fitted on the same documents' findings."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return scan(docs, fit(docs))
