"""Token ids of whole corpora as compressed binary files, and reading them back, whole or by token position.

A canonical Huffman code whose lengths are limited is made from the global counts of the ids (package-merge), so
the code lengths alone describe it. Ids are stored in ascending order of the key, in chunks of whole documents; inside a
chunk every block of BLOCK_IDS ids has a checkpoint, the bit at which it begins. Blocks are decoded side by side with a
table of all bit patterns of the greatest length: one look-up gives the id and the bits to go on.

A store is a folder of three tables: ``codes`` (id, bits), ``chunks`` (part, seq, before, keys, sizes, checkpoints,
payload) and ``parts`` (part, start, n_tokens: where each part begins among all ids).
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candlewick.llm.common import map_texts, pieces, read, ship, sum_tables
from candlewick.llm.token_counts import LETTER, LONG_ENDINGS, NUMBER, SHORT_ENDINGS, SPACE, byte_letters, code_point_classes, vocabulary_bytes
from candlewick.session import scratch_path, stage

#: Ids between two checkpoints, ids after which a chunk is closed, and the longest code.
BLOCK_IDS, CHUNK_IDS, MAX_BITS = 256, 1 << 18, 18
#: Ids a code may have: bounds what is counted on the driver and sent to the tasks.
MOST_IDS = 1 << 22


class IdEncoder:
    """Ids of texts under a byte-level BPE vocabulary, as the tokenizers library gives them.

    Pieces are cut by explicit classes of code points, so no table of a newer Unicode version decides. Merging by the
    rank of the merged bytes gives the library's ids wherever every token is the encoding of its own bytes: a pair can
    only stand side by side if no merge crossed its outer bounds, and then it is the pair that the token is made of.
    """

    def __init__(self, vocabulary: bytes):
        import tiktoken

        spec, letters = json.loads(vocabulary), byte_letters()
        model, signs = spec["model"], {b: x for x, b in letters.items()}
        names, ranks = [signs[b] for b in range(256)], {bytes([b]): b for b in range(256)}
        for pair in model["merges"]:
            name = "".join(pair.split(" ") if isinstance(pair, str) else pair)
            ranks[bytes(letters[x] for x in name)] = len(names)
            names.append(name)
        self.vocabulary, self.ids = vocabulary, np.array([model["vocab"][x] for x in names], np.uint32)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split = re.compile("(" + "|".join(re.escape(s) for s in self.special) + ")") if self.special else None
        self.most = 1 + max([*model["vocab"].values(), *self.special.values()])
        letter, number, white = (class_ranges(x) for x in (LETTER, NUMBER, SPACE))
        endings = "|".join([f"[{SHORT_ENDINGS}]", *LONG_ENDINGS])
        pattern = f"'(?:{endings})| ?[{letter}]+| ?[{number}]+| ?[^{white}{letter}{number}]+|[{white}]+(?![^{white}])|[{white}]+"
        self.ranks = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def library(self):
        from tokenizers import Tokenizer

        made = Tokenizer.from_str(self.vocabulary.decode())
        made.no_truncation()
        made.no_padding()
        return made

    def part(self, text: str) -> np.ndarray:
        if text in self.special:
            return np.array([self.special[text]], np.uint32)
        try:
            return self.ids[self.ranks.encode_to_numpy(text, disallowed_special=())]
        except ValueError:  # the pattern gives up on runs of hundreds of thousands of white space signs
            return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)

    def encode(self, text: bytes) -> np.ndarray:
        """Ids of a whole text; special strings inside it are their ids."""
        parts = self.split.split(text.decode()) if self.split else [text.decode()]
        return np.concatenate([self.part(x) for x in parts]) if len(parts) > 1 else self.part(parts[0])


def class_ranges(kind: int) -> str:
    """The code points of a class as ranges of a pattern."""
    points = np.flatnonzero(code_point_classes() == kind)
    points = points[(points < 0xD800) | (points > 0xDFFF)]
    cut = np.flatnonzero(np.diff(points) != 1)
    first, last = np.append(points[:1], points[cut + 1]), np.append(points[cut], points[-1:])
    return "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in zip(first.tolist(), last.tolist(), strict=True))


def id_type(most: int) -> str:
    """The narrowest type of ids below `most`, as they are stored before they are coded."""
    return "<u2" if most <= 1 << 16 else "<u4"


@lru_cache(maxsize=2)
def id_encoder(vocabulary: bytes) -> IdEncoder:
    return IdEncoder(vocabulary)


# ---- the code ---------------------------------------------------------------


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Bits of each id in the best prefix code without longer words; 0 for ids that don't occur (package-merge)."""
    bits = np.zeros(len(counts), np.int64)
    used = np.flatnonzero(counts)
    n = len(used)
    if n <= 1:
        bits[used] = 1
        return bits
    max_bits = max(max_bits, int(n - 1).bit_length())
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.int64)
    row, levels = leaves, [np.ones(n, bool)]
    for _ in range(max_bits - 1):
        even = len(row) // 2 * 2
        row = np.concatenate([leaves, row[:even:2] + row[1:even:2]])
        at = np.argsort(row, kind="stable")
        row = row[at]
        levels.append(at < n)
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for leaf in reversed(levels):
        own = int(leaf[:take].sum())
        lengths[:own] += 1
        take = 2 * (take - own)
    bits[order] = lengths
    return bits


class Code:
    """Canonical code of given lengths: words of a length ascend with the id, shorter ones come first."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits = np.asarray(bits, np.int64)
        self.width = int(bits.max(initial=1))
        used = np.flatnonzero(bits)
        order = used[np.argsort(bits[used], kind="stable")]
        room = np.int64(1) << (self.width - bits[order])
        self.words = np.zeros(len(bits), np.uint64)
        self.words[order] = ((np.cumsum(room) - room) >> (self.width - bits[order])).astype(np.uint64)
        filled = int(room.sum())
        if filled > 1 << self.width:
            raise ValueError("these lengths don't make a prefix code")
        self.table = np.zeros(1 << self.width, np.int64)
        self.table[:filled] = np.repeat(order, room)

    def encode(self, ids: np.ndarray) -> tuple[np.ndarray, bytes]:
        """The first bit of every block of ids, and the payload: bits from the highest of each byte down."""
        size = self.bits[ids]
        begin = np.cumsum(size) - size
        place, shift = begin >> 5, (64 - (begin & 31) - size).astype(np.uint64)
        value = self.words[ids] << shift
        total = int(size.sum())
        n = total // 32 + 2
        # fields don't overlap, so sums stay below 2^32 and are exact in doubles
        high = np.bincount(place, (value >> np.uint64(32)).astype(np.float64), n)
        low = np.bincount(place + 1, (value & np.uint64(0xFFFFFFFF)).astype(np.float64), n)
        return begin[::BLOCK_IDS], (high + low).astype(">u4").tobytes()[:-(-total // 8)]

    def decode(self, checkpoints: np.ndarray, payload: bytes, n: int) -> np.ndarray:
        """The `n` ids of consecutive blocks that begin at these bits; all blocks advance together."""
        lanes = len(checkpoints)
        if not lanes:
            return np.zeros(0, np.int64)
        data = np.frombuffer(payload + bytes(12 - len(payload) % 4), ">u4").astype(np.uint64)
        pair = data[:-1] << np.uint64(32) | data[1:]
        at = checkpoints.astype(np.int64)
        steps = min(BLOCK_IDS, n)
        out = np.empty((steps, lanes), np.int64)
        down, last = np.uint64(64 - self.width), len(pair) - 1
        for j in range(steps):
            window = pair[np.minimum(at >> 5, last)] << (at & 31).astype(np.uint64) >> down
            out[j] = self.table[window]
            at += self.bits[out[j]]
        return out.T.reshape(-1)[:n] if lanes > 1 else out[:n, 0]


# ---- writing ----------------------------------------------------------------

CHUNK = "part int, seq bigint, before bigint, keys array<%s>, sizes array<bigint>, checkpoints array<bigint>, payload binary"


def count_ids(encoded: DataFrame, most: int, kind: str) -> np.ndarray:
    """How often every id below `most` occurs: one array per task, summed."""

    class Counts:
        def __init__(self):
            self.n = np.zeros(most, np.int64)

        def add(self, batch):
            for piece in pieces(batch, [0]):
                flat = np.frombuffer(b"".join(piece.column(0).to_pylist()), kind)
                self.n += np.bincount(flat, minlength=most)

        def pieces(self):
            yield 0, self.n

    def merge(total, piece):
        total += piece

    return sum_tables(encoded, ["ids"], Counts, merge, 1, np.int64).get(0, np.zeros(most, np.int64))


def chunk_rows(code_bits: np.ndarray, kind: str):
    """Sorted documents of one part as chunks; a chunk ends with the document that fills it."""

    def run(batches):
        code, part, width = Code(code_bits), TaskContext.get().partitionId(), np.dtype(kind).itemsize
        seq = before = n = 0
        keys, held, key_type = [], [], None

        def chunk():
            sizes = [len(x) // width for x in held]
            checkpoints, payload = code.encode(np.frombuffer(b"".join(held), kind))
            lists = [pa.array([keys], pa.list_(key_type)), pa.array([sizes], pa.list_(pa.int64())),
                     pa.array([checkpoints.tolist()], pa.list_(pa.int64()))]
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int64()), pa.array([before], pa.int64()), *lists,
                 pa.array([payload], pa.binary())], ["part", "seq", "before", "keys", "sizes", "checkpoints", "payload"])

        for batch in batches:
            key_type = batch.column(0).type
            for piece in pieces(batch, [1]):
                for key, ids in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True):
                    keys.append(key)
                    held.append(ids)
                    n += len(ids) // width
                    if n >= CHUNK_IDS:
                        yield chunk()
                        seq, before, n, keys, held = seq + 1, before + n, 0, [], []
        if keys:
            yield chunk()

    return run


def write_ids(df: DataFrame, path: str, text: str = "text", key: str = "doc_id", end_id: int | None = 2,
              vocabulary: str | None = None, max_bits: int = MAX_BITS) -> None:
    """Writes the ids of every whole text, in ascending order of the key, to a new folder.

    Every text is encoded without added tokens and closed by `end_id` (None: nothing). Null and empty texts have no
    other id; null keys come first; rows with equal keys stand in the order in which their encoding was written;
    repeated rows are written as often as they occur; an empty table makes a store without chunks. Only the two named
    columns are read. The counts of all rows make the code; every id that occurs has one.
    """
    spark = df.sparkSession
    data = vocabulary_bytes(vocabulary, "byte_bpe_50k.json")
    most = max(id_encoder(data).most, 1 + (end_id or 0))
    if most > MOST_IDS:
        raise ValueError(f"a code of {most} ids is too large to send to every task")
    width = id_type(most)
    end = b"" if end_id is None else np.array([end_id], width).tobytes()

    def start():
        machine = id_encoder(data)
        return lambda texts: [[machine.encode(t).astype(width).tobytes() + end for t in texts]]

    encoded = map_texts(df, [text], [key], [("ids", "binary")], start).toDF("key", "ids")
    encoded = stage(encoded.withColumn("row", F.monotonically_increasing_id()), "token-ids")
    bits = code_lengths(count_ids(encoded, most, width), max_bits)
    used = np.flatnonzero(bits)
    codes = spark.createDataFrame(list(zip(used.tolist(), bits[used].tolist(), strict=True)), "id int, bits int")
    codes.coalesce(1).write.parquet(f"{path}/codes")

    schema = CHUNK % encoded.schema["key"].dataType.simpleString()
    ordered = encoded.repartitionByRange("key", "row").sortWithinPartitions("key", "row").select("key", "ids")
    ordered.mapInArrow(chunk_rows(bits, width), schema).write.parquet(f"{path}/chunks")

    held = F.expr("aggregate(sizes, 0L, (n, x) -> n + x)")
    parts = spark.read.parquet(f"{path}/chunks").groupBy("part").agg(F.sum(held).alias("n_tokens"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part, whatever the ids
    starts = parts.select("part", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)).alias("start"), "n_tokens")
    starts.write.parquet(f"{path}/parts")


# ---- reading ----------------------------------------------------------------


def store_code(spark: SparkSession, path: str) -> np.ndarray:
    rows = spark.read.parquet(f"{path}/codes").collect()
    bits = np.zeros(max((r.id for r in rows), default=0) + 1, np.int64)
    for r in rows:
        bits[r.id] = r.bits
    return bits


def chunks(spark: SparkSession, path: str) -> DataFrame:
    """Chunks with the place of their first id among all; parts are as many as the tasks that wrote them."""
    parts = F.broadcast(spark.read.parquet(f"{path}/parts").select("part", F.col("start").alias("part_start")))
    found = spark.read.parquet(f"{path}/chunks").join(parts, "part")
    return found.withColumn("start", F.col("part_start") + F.col("before")).drop("part_start", "before", "seq", "part")


def read_ids(spark: SparkSession, path: str, key: str = "doc_id", digest: Callable[[bytes], int] | None = None) -> DataFrame:
    """Every stored document: the key, start (ids of all documents before it), n_tokens, ids (array of int).

    `digest` is applied to the ids as little-endian unsigned 32-bit integers inside the task; its number takes the
    place of the ids. An empty store gives an empty table.
    """
    ship(spark)
    bits, column = store_code(spark, path), "ids" if digest is None else "digest"
    source = chunks(spark, path).select("keys", "sizes", "checkpoints", "payload", "start")
    kind = source.schema["keys"].dataType.elementType.simpleString()

    def run(batches):
        code = Code(bits)
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                keys, sizes = row.column(0).flatten(), row.column(1).flatten().to_numpy()
                ids = code.decode(row.column(2).flatten().to_numpy(), row.column(3)[0].as_py(), int(sizes.sum()))
                ends = np.cumsum(sizes)
                starts = ends - sizes + row.column(4)[0].as_py()
                if digest is None:
                    made = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(ids, pa.int32()))
                else:
                    data, cuts = ids.astype("<u4").tobytes(), (4 * np.append(0, ends)).tolist()
                    made = pa.array([digest(data[a:b]) for a, b in zip(cuts, cuts[1:])], pa.int64())
                yield pa.RecordBatch.from_arrays([keys, pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()), made],
                                                 ["key", "start", "n_tokens", column])

    schema = f"key {kind}, start bigint, n_tokens bigint, {column} {'array<int>' if digest is None else 'bigint'}"
    return source.mapInArrow(run, schema).withColumnRenamed("key", key)


def read_range(spark: SparkSession, path: str, first: int, count: int) -> DataFrame:
    """The ids at places first … first + count - 1 among all: position, id. Only blocks that overlap are decoded."""
    ship(spark)
    bits = store_code(spark, path)
    size = F.expr("aggregate(sizes, 0L, (n, x) -> n + x)")
    source = chunks(spark, path).select("start", size.alias("n"), "checkpoints", "payload")
    source = source.where((F.col("start") < first + count) & (F.col("start") + F.col("n") > first))

    def run(batches):
        code = Code(bits)
        for batch in batches:
            for row in batch.to_pylist():
                a, b = max(0, first - row["start"]), min(row["n"], first + count - row["start"])
                block, stop = a // BLOCK_IDS, -(-b // BLOCK_IDS)
                n = min(row["n"], stop * BLOCK_IDS) - block * BLOCK_IDS
                ids = code.decode(np.array(row["checkpoints"][block:stop], np.int64), row["payload"], n)
                ids = ids[a - block * BLOCK_IDS:b - block * BLOCK_IDS]
                yield pa.RecordBatch.from_arrays([pa.array(row["start"] + np.arange(a, b), pa.int64()), pa.array(ids, pa.int32())],
                                                 ["position", "id"])

    return source.mapInArrow(run, "position bigint, id int")


def op13_token_files(spark, sf_dir: str) -> DataFrame:
    """Ids of all documents under byte_bpe_50k.json, written as files, read back and digested."""
    path = scratch_path(spark, "token-files")
    write_ids(read(spark, sf_dir, "documents"), path)
    return read_ids(spark, path, digest=zlib.crc32).withColumnRenamed("digest", "ids_crc32")
