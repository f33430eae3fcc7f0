"""Token-id files against the tokenizers library, and the code against exhaustive search."""

import heapq
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from candlewick.llm import token_files as tf
from candlewick.session import scratch_path
from tests.llm.helpers import LONG, ODD, frame, key

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
TEXTS = ["don't  stop\n\n now", "<|endoftext|>x<|endoftext|>", "a" * 300 + " " * 300 + "b", "tab\tand nbsp   em", "é́ ǅ ½ Ⅷ ٣ 𝔘", "'ll 've '9",
         (LONG + "<|endoftext|>") * 8, "日本語" * 50, "word-" * 1000, "՘࢏\U0001f9ff x"]


def ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [2]


def crc(values):
    return zlib.crc32(np.array(values, "<u4").tobytes())


def plain(rows):
    out, at = [], 0
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        made = ids(t)
        out.append((d, at, len(made), crc(made)))
        at += len(made)
    return out


def store(spark, df, **options):
    path = scratch_path(spark, "test-files")
    tf.write_ids(df, path, **options)
    return path


@pytest.fixture(scope="module")
def odd(spark):
    rows = ODD + [(100 - i, t) for i, t in enumerate(TEXTS)]
    return rows, store(spark, frame(spark, rows).repartition(5))


def test_round_trip(spark, odd):
    rows, path = odd
    got = tf.read_ids(spark, path).collect()
    assert sorted([(r.doc_id, r.start, r.n_tokens, crc(r.ids)) for r in got], key=key) == sorted(plain(rows), key=key)
    digests = tf.read_ids(spark, path, digest=zlib.crc32).collect()
    assert {(r.doc_id, r.start, r.digest) for r in digests} == {(r.doc_id, r.start, crc(r.ids)) for r in got}


@pytest.mark.parametrize(("first", "count"), [(0, 1), (0, 10), (250, 12), (256, 256), (1000, 5000), (-5, 8), (10**9, 5)])
def test_range(spark, odd, first, count):
    rows, path = odd
    whole = [x for _, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)) for x in ids(t)]
    got = sorted(tuple(r) for r in tf.read_range(spark, path, first, count).collect())
    assert got == [(p, whole[p]) for p in range(max(0, first), min(len(whole), max(0, first + count)))]


def test_rows_of_one_key(spark):
    rows = [(7, f"text number {i % 3}") for i in range(400)] + [(None, "x")] * 100 + [(8, None)]
    got = tf.read_ids(spark, store(spark, frame(spark, rows).repartition(3))).collect()
    assert sorted((r.doc_id or 0, crc(r.ids)) for r in got) == sorted((d or 0, crc(ids(t))) for d, t in rows)
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens


def test_empty_table_and_no_end(spark):
    assert tf.read_ids(spark, store(spark, frame(spark, []))).collect() == []
    path = store(spark, frame(spark, [(1, ""), (2, None), (3, "one")]), end_id=None)
    assert sorted((r.doc_id, r.start, r.n_tokens) for r in tf.read_ids(spark, path).collect()) == [(1, 0, 0), (2, 0, 0), (3, 0, 1)]
    nothing = store(spark, frame(spark, [(1, ""), (2, None)]), end_id=None)
    assert sorted((r.doc_id, r.ids) for r in tf.read_ids(spark, nothing).collect()) == [(1, []), (2, [])]


def huffman_cost(counts):
    heap = [c for c in counts if c]
    heapq.heapify(heap)
    total = 0
    while len(heap) > 1:
        a = heapq.heappop(heap) + heapq.heappop(heap)
        total += a
        heapq.heappush(heap, a)
    return total


def limited_cost(counts, most):
    """The least cost over all ways to give n ids lengths up to `most`, by dynamic programming over used code space."""
    counts = sorted((c for c in counts if c), reverse=True)
    best = {0: 0}
    for c in counts:  # lengths don't fall along falling counts in some best code, so any order of lengths may be tried
        step = {}
        for room, cost in best.items():
            for size in range(1, most + 1):
                r = room + (1 << (most - size))
                if r <= 1 << most:
                    step[r] = min(step.get(r, 1 << 60), cost + c * size)
        best = step
    return min(best.values())


@pytest.mark.parametrize("seed", range(8))
def test_code_lengths(seed):
    rng = np.random.default_rng(seed)
    counts = (rng.pareto(0.5, 12) * 10).astype(np.int64) * rng.integers(0, 2, 12)
    counts[:2] = [1, 5]
    n = int((counts > 0).sum())
    free = tf.code_lengths(counts, 30)
    assert int((counts * free).sum()) == huffman_cost(counts.tolist())
    most = max(2, (n - 1).bit_length())
    tight = tf.code_lengths(counts, most)
    assert tight.max() <= most and (tight[counts == 0] == 0).all()
    assert int((counts * tight).sum()) == limited_cost(counts.tolist(), most)


@pytest.mark.parametrize("size", [1, 2, 255, 256, 257, 5000])
def test_code(size):
    rng = np.random.default_rng(size)
    values = (rng.pareto(0.7, size) * 3).astype(np.int64) % 9000
    code = tf.Code(tf.code_lengths(np.bincount(values, minlength=9001)))
    checkpoints, payload = code.encode(values)
    assert len(checkpoints) == -(-size // tf.BLOCK_IDS) and len(payload) == -(-int(code.bits[values].sum()) // 8)
    assert (code.decode(checkpoints, payload, size) == values).all()
    assert (code.decode(checkpoints[-1:], payload, size - (len(checkpoints) - 1) * tf.BLOCK_IDS) == values[(len(checkpoints) - 1) * tf.BLOCK_IDS:]).all()


def test_one_long_text():
    """A text of some megabytes gives the library's ids."""
    text = "".join(f"line {i} isn't like line {i * i};  see\n" for i in range(60_000))
    machine = tf.id_encoder(open(public_tokenizers.path("byte_bpe_50k.json"), "rb").read())
    assert machine.encode(text.encode()).tolist() == ids(text)[:-1]


def test_every_token_is_the_encoding_of_its_bytes():
    """What merging by the rank of the merged bytes rests on."""
    machine = tf.id_encoder(open(public_tokenizers.path("byte_bpe_50k.json"), "rb").read())
    letters = tf.byte_letters()
    names = {i: t for t, i in LIBRARY.get_vocab().items() if i not in machine.special.values()}
    for i, name in names.items():
        assert machine.ids[machine.ranks._encode_single_piece(bytes(letters[x] for x in name))].tolist() == [i]
    assert sorted(names) == sorted(machine.ids.tolist())


@pytest.mark.parametrize("text", [" " * 1_200_000 + "b", "\n \t" * 300_000, "a" * 400_000, "=" * 300_000 + " x"])
def test_long_runs(text):
    machine = tf.id_encoder(open(public_tokenizers.path("byte_bpe_50k.json"), "rb").read())
    assert machine.encode(text.encode()).tolist() == ids(text)[:-1]


def test_every_code_point():
    """Pieces are cut as the library cuts them, whatever the code point and its neighbours."""
    machine = tf.id_encoder(open(public_tokenizers.path("byte_bpe_50k.json"), "rb").read())
    texts = []
    for a in range(0, 0x20000, 512):
        points = [chr(c) for c in range(a, a + 512) if not 0xD800 <= c < 0xE000]
        texts.append("".join(f"{c}x{c} {c}9{c}{c}" for c in points))
    texts = [t for t in texts if t]
    want = [e.ids for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]
    assert [machine.encode(t.encode()).tolist() for t in texts] == want
