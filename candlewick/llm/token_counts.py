"""Token counts by a finite-state transducer compiled from a byte-level BPE vocabulary.

Text is cut into pieces (words with their leading space, digits, signs, white space) by class rules over code
points. Inside a piece a deterministic transducer reads bytes: a state holds, for every suffix of the piece that
may still grow into a token, the last token of the encoding before that suffix and how many tokens fewer it has.
A transition is annotated with the change of the number of tokens, so the counts of a text are the sum of its
annotations. States and transitions are compiled when they are first met and kept in arrays.

A block of text is split into chunks. Each chunk is a map from the states it may be entered in to the state at its end;
the maps are made side by side, over all entry states that any run of the chunk before may end in. Composing them is
associative, so a prefix scan that doubles its reach gives the true entry state of every chunk, and a last run writes the
counts. A run from another entry state stops where it meets the run from the start state, at the next piece at the
latest; from there on both are the same.
"""

from __future__ import annotations

import json
import unicodedata
from array import array
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import map_texts

LETTER, NUMBER, SPACE, OTHER, EDGE = 0, 1, 2, 3, 4
#: The code points with the property White_Space, and the endings split off after an apostrophe.
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
SHORT_ENDINGS, LONG_ENDINGS = "stmd", ("re", "ve", "ll")

#: A transition is one number: the next state times SHIFT, plus the change of the count moved to the middle.
SHIFT = 512
#: Multiplier that spreads keys over slots.
SPREAD, MASK64 = 0x9E3779B97F4A7C15, (1 << 64) - 1


@lru_cache(maxsize=1)
def code_point_classes() -> np.ndarray:
    """Class of every code point, from its general category."""
    by = {"L": LETTER, "N": NUMBER}
    classes = np.fromiter((by.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    classes[WHITE] = SPACE
    return classes


@lru_cache(maxsize=1)
def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies, and back."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


def piece_starts(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Flags of the code points that begin a piece. `first` flags the first code point of each text."""
    n = len(points)
    kind = code_point_classes()[points]
    last = np.append(first[1:], True)
    before = np.where(first, EDGE, np.roll(kind, 1))
    after = np.where(last, EDGE, np.roll(kind, -1))
    blank_before = np.roll(points == 32, 1) & ~first
    white = kind == SPACE
    start = (before != kind) & (white | ~blank_before)
    start |= white & (after != SPACE) & (after != EDGE)
    for i in np.flatnonzero((points == 39) & start & (after == LETTER)).tolist():
        size = 2 if chr(points[i + 1]) in SHORT_ENDINGS else 0
        if not size and not last[i + 1] and chr(points[i + 1]) + chr(points[i + 2]) in LONG_ENDINGS:
            size = 3
        if size:
            start[i + 1] = False
            if not last[i + size - 1]:
                start[i + size] = True
    return start


class Transducer:
    """Transitions over (state, byte): the next state and the change of the token count. State 0 starts a piece."""

    def __init__(self, vocabulary: bytes, max_states: int = 250_000):
        model = json.loads(vocabulary)
        letters = byte_letters()
        self.special = [t["content"].encode() for t in model["added_tokens"]]
        vocab = {t: i for t, i in model["model"]["vocab"].items() if all(x in letters for x in t)}
        self.bytes = {i: bytes(letters[x] for x in t) for t, i in vocab.items()}
        self.rank, self.merged = {}, {}
        for r, pair in enumerate(model["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.rank[vocab[a], vocab[b]] = r
            self.merged[vocab[a], vocab[b]] = vocab[a + b]
        self.single = {v[0]: i for i, v in self.bytes.items() if len(v) == 1}
        self.trie, self.token, self.grows = {}, {}, set()
        for i, value in self.bytes.items():
            node = 0
            for byte in value:
                key = node * 256 + byte
                self.grows.add(node)
                node = self.trie.setdefault(key, len(self.trie) + 1)
            self.token[node] = i
        self.pairs: dict[tuple[int, int], bool] = {}
        self.max_states = max_states
        self.reset()

    def reset(self):
        start = array("i", (0, -1, 0)).tobytes()
        self.states, self.number = [start], {start: 0}
        self.keys, self.values = np.full(1 << 17, -1, np.int64), np.zeros(1 << 17, np.int32)
        self.filled = 0

    def put(self, key: int, value: int):
        """Open addressing: the next free slot from the key's own one."""
        if 2 * self.filled >= len(self.keys):
            known = self.keys >= 0
            pairs = list(zip(self.keys[known].tolist(), self.values[known].tolist(), strict=True))
            self.keys, self.values = np.full(2 * len(self.keys), -1, np.int64), np.zeros(2 * len(self.keys), np.int32)
            self.filled = 0
            for k, v in pairs:
                self.put(k, v)
        mask = len(self.keys) - 1
        slot = (key * SPREAD & MASK64) >> 32 & mask
        while self.keys[slot] >= 0 and self.keys[slot] != key:
            slot = slot + 1 & mask
        self.filled += int(self.keys[slot] < 0)
        self.keys[slot], self.values[slot] = key, value

    def look_up(self, keys: np.ndarray) -> np.ndarray:
        """Values of the keys, -1 where a transition isn't compiled yet."""
        mask = len(self.keys) - 1
        slot = (keys.astype(np.uint64) * np.uint64(SPREAD) >> np.uint64(32)).astype(np.int64) & mask
        there = self.keys.take(slot)
        out = self.values.take(slot)
        miss = np.flatnonzero(there != keys)
        while len(miss):
            empty = there[miss] < 0
            out[miss[empty]] = -1
            miss = miss[~empty]
            slot[miss] = slot[miss] + 1 & mask
            there[miss] = self.keys[slot[miss]]
            out[miss] = self.values[slot[miss]]
            miss = miss[there[miss] != keys[miss]]
        return out

    def encode(self, value: bytes) -> list[int]:
        """Plain merging of a short byte string: the lowest rank first, from the left."""
        ids = [self.single[b] for b in value]
        while len(ids) > 1:
            ranks = [self.rank.get(p, 1 << 60) for p in zip(ids, ids[1:])]
            best = min(ranks)
            if best == 1 << 60:
                break
            at = ranks.index(best)
            ids[at:at + 2] = [self.merged[ids[at], ids[at + 1]]]
        return ids

    def follows(self, left: int, right: int) -> bool:
        """Whether `right` may stand after `left` in an encoding (left -1: at the start of a piece)."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) > 300_000:
                self.pairs.clear()
            if (left, right) in self.rank:
                return False
            whole = self.bytes[right] if left < 0 else self.bytes[left] + self.bytes[right]
            known = self.pairs[left, right] = self.encode(whole) == ([right] if left < 0 else [left, right])
        return known

    def compile(self, state: int, byte: int):
        """Adds one transition: exactly one token ends an encoding, and its predecessor is known from the state."""
        entries = array("i")
        entries.frombytes(self.states[state])
        grown, found = [], None
        for node, before, count in zip(entries[::3], entries[1::3], entries[2::3], strict=True):
            child = self.trie.get(node * 256 + byte)
            if child is None:
                continue
            token = self.token.get(child)
            if token is not None and found is None and self.follows(before, token):
                found = token, count + 1
            if child in self.grows:
                grown.append((child, before, count))
        token, delta = found
        made = array("i", [x for node, before, count in grown for x in (node, before, count - delta)] + [0, token, 0]).tobytes()
        to = self.number.setdefault(made, len(self.states))
        if to == len(self.states):
            self.states.append(made)
        self.put(state * 256 + byte, to * SHIFT + delta + SHIFT // 2)

    def step(self, state: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = state.astype(np.int64) * 256 + data
        found = self.look_up(at)
        if len(found) and found.min() < 0:
            for x in set(at[found < 0].tolist()):
                self.compile(*divmod(x, 256))
            found = self.look_up(at)
        return found // SHIFT, found % SHIFT - SHIFT // 2

    def changes(self, data: np.ndarray, start: np.ndarray, chunk: int = 256) -> np.ndarray:
        """The change of the token count at every byte; `start` flags the first byte of each piece."""
        if len(self.states) > self.max_states:
            self.reset()
        n = len(data)
        lanes = max(1, -(-n // chunk))
        spare = lanes * chunk - n
        rows = np.ascontiguousarray(np.append(data, np.zeros(spare, np.uint8)).reshape(lanes, chunk).T)
        inside = np.ascontiguousarray(~np.append(start, np.ones(spare, bool)).reshape(lanes, chunk).T)
        path, change = np.empty((chunk, lanes), np.int32), np.empty((chunk, lanes), np.int16)
        state = np.zeros(lanes, np.int32)
        for j in range(chunk):
            state, change[j] = self.step(state * inside[j], rows[j])
            path[j] = state
        entry = self.entry_states(rows, inside, path)
        self.run_on(rows, inside, path, np.flatnonzero(entry), entry[entry > 0], change)
        return change.T.reshape(-1)[:n]

    def run_on(self, rows, inside, path, lane, state, change=None) -> np.ndarray:
        """End states of the lanes entered in these states. Runs stop where they meet the lane's path from the start state."""
        ends = path[-1][lane]
        at = np.arange(len(lane))
        for j in range(len(rows)):
            stay = inside[j][lane]
            at, lane, state = at[stay], lane[stay], state[stay]
            if not len(lane):
                return ends
            state, delta = self.step(state, rows[j][lane])
            if change is not None:
                change[j][lane] = delta
            apart = state != path[j][lane]
            at, lane, state = at[apart], lane[apart], state[apart]
        ends[at] = state
        return ends

    def entry_states(self, rows, inside, path) -> np.ndarray:
        """The state in which each lane is truly entered: the maps of all lanes, composed by a prefix scan.

        A map is a set of entries (lane, state) with the state at the end. It starts with the start state, whatever lane;
        a lane that begins a piece needs no other. Then ends of the lane before are added until all are entries.
        """
        lanes = rows.shape[1]
        lane, state, end = np.arange(lanes), np.zeros(lanes, np.int64), path[-1].astype(np.int64)
        made_lane, made_end = lane, end
        known = lane << 32
        while True:
            ahead = made_lane < lanes - 1
            to = made_lane[ahead] + 1
            new = np.setdiff1d(to << 32 | np.where(inside[0][to], made_end[ahead], 0), known)
            if not len(new):
                break
            made_lane, made_state = new >> 32, new & 0xFFFFFFFF
            made_end = self.run_on(rows, inside, path, made_lane, made_state.astype(np.int32)).astype(np.int64)
            lane, state, end = np.append(lane, made_lane), np.append(state, made_state), np.append(end, made_end)
            known = np.append(known, new)
        order = np.argsort(known)
        known, state, end, lane = known[order], state[order], end[order], lane[order]
        to = np.minimum(lane + 1, lanes - 1)
        jump = np.searchsorted(known, to << 32 | np.where(inside[0][to], end, 0))  # the next lane's entry; unused in the last one
        jump[lane == lanes - 1] = 0
        entry, reach = np.zeros(lanes, np.int64), 1  # entry 0 is that of the first lane in the start state
        while reach < lanes:
            size = min(reach, lanes - reach)
            entry[reach:reach + size] = jump[entry[:size]]
            jump, reach = jump[jump], 2 * reach
        return state[entry]

    def counts(self, texts: list[bytes]) -> np.ndarray:
        """Tokens of each text. The strings of special tokens inside a text count as one token each."""
        totals = np.zeros(len(texts), np.int64)
        parts, owner = [], []
        for i, text in enumerate(texts):
            pieces = [text]
            for special in self.special:
                if special in text:
                    pieces = [p for x in pieces for p in x.split(special)]
            totals[i] += len(pieces) - 1
            kept = [p for p in pieces if p]
            parts += kept
            owner += [i] * len(kept)
        if not parts:
            return totals
        data = np.frombuffer(b"".join(parts), np.uint8)
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        at = np.flatnonzero((data & 0xC0) != 0x80)  # the first byte of each code point
        ends = np.cumsum([len(p) for p in parts])
        begins = np.append(0, ends[:-1])
        first_byte = np.zeros(len(data), bool)
        first_byte[begins] = True
        start = np.zeros(len(data), bool)
        start[at] = piece_starts(points, first_byte[at])
        sums = np.add.reduceat(self.changes(data, start).astype(np.int64), begins)
        np.add.at(totals, owner, sums)
        return totals


@lru_cache(maxsize=2)
def transducer(vocabulary: bytes) -> Transducer:
    return Transducer(vocabulary)


def vocabulary_bytes(path: str | None, name: str, limit: int = 64 << 20) -> bytes:
    """The vocabulary file, sent to the tasks with the function; its size is checked."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(name)
    with open(path, "rb") as f:
        data = f.read(limit + 1)
    if len(data) > limit:
        raise ValueError(f"vocabulary over {limit} bytes: {path}")
    return data


def count_tokens(df: DataFrame, text: str = "text", keep: list[str] | None = None, vocabulary: str | None = None) -> DataFrame:
    """Tokens of every text under a byte-level BPE vocabulary: `keep`, n_bytes, n_tokens. Narrow: no shuffle.

    Null and empty texts have 0 bytes and 0 tokens; a null key passes through; repeated rows give repeated rows;
    an empty table gives an empty table; other columns of the input are not read. A text of any length is read
    whole, in chunks.
    """
    data = vocabulary_bytes(vocabulary, "byte_bpe_50k.json")

    def start():
        machine = transducer(data)
        return lambda texts: [[len(t) for t in texts], machine.counts(texts)]

    return map_texts(df, [text], ["doc_id"] if keep is None else keep, [("n_bytes", "bigint"), ("n_tokens", "bigint")], start)


def op10_token_counts(spark, sf_dir: str) -> DataFrame:
    """Token counts of all documents under byte_bpe_50k.json; over_limit beyond 512 tokens."""
    counts = count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 512)
