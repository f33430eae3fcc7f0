"""Token counts against the tokenizers library."""

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from candlewick.llm import token_counts
from tests.llm.helpers import ODD, frame, key

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
MACHINE = token_counts.transducer(token_counts.vocabulary_bytes(None, "byte_bpe_50k.json"))


def expected(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


def test_odd_rows(spark):
    got = sorted(map(tuple, token_counts.count_tokens(frame(spark, ODD)).collect()), key=key)
    assert got == sorted([(i, len((t or "").encode()), expected(t)) for i, t in ODD], key=key)


def test_documents(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in token_counts.op10_token_counts(spark, sf).collect():
        n = expected(texts[r.doc_id])
        assert (r.n_tokens, r.over_limit, r.n_bytes) == (n, n > 512, len(texts[r.doc_id].encode()))


@pytest.mark.parametrize("text", [
    "don't 's 'sun x'sy ''s  's", "\n\nfoo  bar \n x", "<|endoftext|>hi<|endoftext|><|endoftext|> there", "   ", "x   ", "a" * 5000,
    "the" * 2000, "\t\t x\r\n\r\n y", "'", "x're", "x'r", "́á", "½ Ⅷ x²", " " * 700 + "x", "\x1c\x85a"])
def test_single_texts(text):
    assert MACHINE.counts([text.encode()]).tolist() == [expected(text)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab e's t\n'r19.é日😀-LlVv"), max_size=600), max_size=4))
def test_any_texts(texts):
    assert MACHINE.counts([t.encode() for t in texts]).tolist() == [expected(t) for t in texts]


def test_chunks_agree():
    data = ("pneumonoultramicroscopic" * 200).encode()
    start = np.zeros(len(data), bool)
    start[0] = True
    bytes_ = np.frombuffer(data, np.uint8)
    assert {int(MACHINE.changes(bytes_, start, c).sum()) for c in (7, 64, 256, 10_000)} == {expected(data.decode())}


@pytest.mark.parametrize("text", ["a" * 3000, "ab" * 1500, "pneumonoultra" * 150, "some words, here 12 x" * 60, "qzjxkvbwpf" * 200])
@pytest.mark.parametrize("chunk", [3, 16, 97])
def test_composed_maps_are_the_states_of_one_run(text, chunk):
    """The prefix scan over chunk maps against one step after the other."""
    data = np.frombuffer(text.encode(), np.uint8)
    start = token_counts.piece_starts(data.astype(np.uint32), np.arange(len(data)) == 0)
    state, states, changes = np.zeros(1, np.int32), [], []
    for byte, begins in zip(data, start, strict=True):
        states.append(0 if begins else int(state[0]))
        state, change = MACHINE.step(np.array(states[-1:], np.int32), np.array([byte]))
        changes.append(int(change[0]))
    n = len(data) // chunk * chunk
    rows, inside = data[:n].reshape(-1, chunk).T, ~start[:n].reshape(-1, chunk).T
    path, now = np.empty(rows.shape, np.int32), np.zeros(n // chunk, np.int32)
    for j in range(chunk):
        now, _ = MACHINE.step(now * inside[j], rows[j])
        path[j] = now
    assert (MACHINE.entry_states(rows, inside, path) * inside[0]).tolist() == states[:n:chunk]
    assert MACHINE.changes(data, start, chunk).tolist() == changes


def test_small_cache_of_states():
    small = token_counts.Transducer(token_counts.vocabulary_bytes(None, "byte_bpe_50k.json"), max_states=50)
    for text in ["some words here", "other words there", "some words here"]:
        assert small.counts([text.encode()]).tolist() == [expected(text)]


def test_empty_table(spark):
    assert token_counts.count_tokens(frame(spark, [])).collect() == []
