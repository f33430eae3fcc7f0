"""BPE against the tokenizers library."""

import hashlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from candlewick.llm import bpe
from tests.llm.helpers import ODD, frame, key

LIBRARY = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def expected(text):
    ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
    return len(ids), " ".join(map(str, ids)), LIBRARY.decode(ids, skip_special_tokens=False)


def test_odd_rows(spark):
    got = sorted(map(tuple, bpe.encode(frame(spark, ODD)).collect()), key=key)
    assert got == sorted([(i, *expected(t)) for i, t in ODD], key=key)


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in bpe.op1_bpe(spark, sf).collect():
        n, ids, decoded = expected(texts[r.doc_id])
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (ids, decoded)]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (n, *digests)


def test_round_trip(spark):
    encoded = bpe.encode(frame(spark, ODD))
    whole = {r.ids: r.decoded for r in encoded.collect()}
    for r in bpe.decode(encoded, keep=["ids"]).collect():
        assert r.decoded == whole[r.ids]


@pytest.mark.parametrize("text", ["a" * 999, "ab" * 500, "<|startoftext|>x<|endoftext|>Y", "don't 'S 've're", "\x1c\x85 ", "İ ẞ ΟΔΟΣ", "é ́x", "½Ⅷ٣"])
def test_single_texts(text):
    coder = bpe.tokenizer(bpe.vocabulary_bytes(None, "word_bpe_49k.json"))
    words = coder.encode([text])[0]
    ids = " ".join(coder.ids[w] for w in words)
    assert (ids, " ".join(coder.tokens[w] for w in words)) == expected(text)[1:]


def test_empty_table(spark):
    assert bpe.encode(frame(spark, [])).collect() == []


def test_every_code_point():
    """Words are cut, composed and lower-cased as the library does it, whatever the code point."""
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    machine = bpe.tokenizer(open(public_tokenizers.path("word_bpe_49k.json"), "rb").read())
    for a in range(0, len(points), 40_000):
        texts = [f"{c}x{c} a{c}9{c}{c}é" for c in points[a:a + 40_000]]
        want = [e.ids for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]
        got = [[int(i) for w in words for i in machine.ids[w].split()] for words in machine.encode(texts)]
        assert got == want
