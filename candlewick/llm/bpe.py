"""BPE encoding and decoding with word ends: merge rounds over many words at once.

The symbols of all new words of a block stand in one flat array. In each round every adjacent pair is looked up by
binary search among the sorted pair keys of the vocabulary, each word merges all occurrences of its lowest-ranked
pair from the left, and words without a pair leave. Encoded words are kept, so a word is merged once per worker.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Callable
from functools import cached_property, lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame

from candlewick.llm.common import map_texts
from candlewick.llm.token_counts import LETTER, NUMBER, WHITE, byte_letters, code_point_classes, vocabulary_bytes

NO_RANK = np.iinfo(np.int64).max
#: Fixed value: the word pattern of the vocabulary's pre-tokenizer.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^%s\p{L}\p{N}]+" % "".join(f"\\u{c:04x}" for c in WHITE)
WORD_END = "</w>"


@lru_cache(maxsize=1)
def unsure_points() -> np.ndarray:
    """Flags of the code points on which tables of different Unicode versions may disagree: unassigned ones, by either table here.

    Python's own table, the one of the pattern module and the library's are of different versions; a code point that
    the older two of them know has its class and case for good.
    """
    every = "".join(map(chr, range(0xD800))) + " " * 0x800 + "".join(map(chr, range(0xE000, 0x110000)))
    kinds, apart = code_point_classes(), np.zeros(0x110000, bool)
    for name, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER)):
        named = np.zeros(len(kinds), bool)
        for m in regex.finditer(name, every):
            named[m.start():m.end()] = True
        apart |= named != (kinds == kind)
    apart |= np.fromiter((unicodedata.category(c) == "Cn" for c in every), bool, len(every))
    apart[0xD800:0xE000] = False
    return apart


class WordBpe:
    """The vocabulary's merges as sorted arrays, and the words encoded so far."""

    def __init__(self, vocabulary: bytes, max_words: int = 200_000):
        spec = json.loads(vocabulary)
        model, letters = spec["model"], byte_letters()
        if model.get("end_of_word_suffix") != WORD_END:
            raise ValueError("a BPE vocabulary with word ends is expected")
        self.vocab = model["vocab"]
        self.size = max(self.vocab.values()) + 1
        self.names = {i: t for t, i in self.vocab.items()}
        inner, final = np.zeros(256, np.int64), np.zeros(256, np.int64)
        for letter, byte in letters.items():
            inner[byte], final[byte] = self.vocab[letter], self.vocab[letter + WORD_END]
        self.inner, self.final = inner, final
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left, right, made = (np.array([f(a, b) for a, b in pairs], np.int64) for f in (
            lambda a, b: self.vocab[a], lambda a, b: self.vocab[b], lambda a, b: self.vocab[a + b]))
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order, made[order]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names |= {i: t for t, i in self.special.items()}
        self.split = regex.compile("(" + "|".join(regex.escape(t) for t in self.special) + ")") if self.special else None
        self.pattern, self.unsure, self.sure = regex.compile(WORD_PATTERN), unsure_points(), set()
        self.vocabulary, self.letters = vocabulary, letters
        self.max_words = max_words
        self.ids: dict[str, str] = {}
        self.tokens: dict[str, str] = {}

    def merge(self, symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of words, one after another, after all merges, with the words' new starts."""
        count = len(starts)
        word = np.repeat(np.arange(count), np.diff(np.append(starts, len(symbols))))
        done_symbols, done_words = [], []
        while len(symbols):
            pair = symbols[:-1] * self.size + symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
            hit = (self.keys[at] == pair) & (word[:-1] == word[1:])
            rank = np.append(np.where(hit, self.ranks[at], NO_RANK), NO_RANK)
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            sizes = np.diff(np.append(first, len(symbols)))
            best = np.repeat(np.minimum.reduceat(rank, first), sizes)
            over = best == NO_RANK
            if over.any():
                done_symbols.append(symbols[over])
                done_words.append(word[over])
            chosen = np.flatnonzero((rank == best) & ~over)
            if len(chosen):  # of pairs that overlap, as in a run of one letter, every other one from the left
                run = np.append(True, np.diff(chosen) != 1)
                begin = np.maximum.accumulate(np.where(run, np.arange(len(chosen)), 0))
                chosen = chosen[(np.arange(len(chosen)) - begin) % 2 == 0]
                symbols[chosen] = self.made[at[chosen]]
                over[chosen + 1] = True
            symbols, word = symbols[~over], word[~over]
        symbols, word = np.concatenate(done_symbols or [symbols]), np.concatenate(done_words or [word])
        order = np.argsort(word, kind="stable")
        return symbols[order], np.searchsorted(word[order], np.arange(count))

    def learn(self, words: list[str]) -> None:
        """Encodes words that aren't kept yet."""
        data = [w.encode() for w in words]
        flat = np.frombuffer(b"".join(data), np.uint8)
        ends = np.cumsum([len(d) for d in data])
        symbols = self.inner[flat]
        symbols[ends - 1] = self.final[flat[ends - 1]]
        symbols, starts = self.merge(symbols, np.append(0, ends[:-1]))
        parts, bounds = symbols.tolist(), np.append(starts, len(symbols)).tolist()
        for word, a, b in zip(words, bounds, bounds[1:]):
            ids = parts[a:b]
            self.ids[word] = " ".join(map(str, ids))
            self.tokens[word] = " ".join([self.names[i] for i in ids])

    def normal(self, text: str) -> str:
        """Composed and lower-cased letter by letter (so a final sigma is an ordinary one)."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower()

    def words(self, text: str) -> list[str]:
        """The words of a text without special strings. The library itself cuts texts with unsure code points."""
        if not text.isascii() and not self.is_sure(text):
            cut = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
            return [bytes([self.letters[x] for x in piece]).decode() for piece, _ in cut]
        return self.pattern.findall(self.normal(text))

    def is_sure(self, text: str) -> bool:
        """Whether no code point is unsure; those met before are remembered, so a text costs one set of its characters."""
        new = set(text) - self.sure
        if any(self.unsure[ord(c)] for c in new):
            return False
        self.sure |= new
        return True

    @cached_property
    def library(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_str(self.vocabulary.decode())

    def pieces(self, text: str) -> list[str]:
        """The words of a text; special strings inside it stay as they are."""
        if self.split is None or "<|" not in text:
            return self.words(text)
        out: list[str] = []
        for i, part in enumerate(self.split.split(text)):
            out += [part] if i % 2 else self.words(part)
        return out

    def encode(self, texts: list[str]) -> list[list[str]]:
        """The words of each text, all of them encoded in `ids` and `tokens`."""
        if len(self.ids) > self.max_words:
            self.ids.clear()
            self.tokens.clear()
        for name, i in self.special.items():
            self.ids[name], self.tokens[name] = str(i), name
        split = [self.pieces(t) for t in texts]
        new = [w for w in set().union(*split) if w not in self.ids]
        if new:
            self.learn(new)
        return split

    def decode(self, ids: list[int]) -> str:
        """The vocabulary has no decoder: its token strings joined by a space. Unknown ids are left out."""
        return " ".join([self.names[i] for i in ids if i in self.names])


@lru_cache(maxsize=2)
def tokenizer(vocabulary: bytes) -> WordBpe:
    return WordBpe(vocabulary)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def encode(df: DataFrame, text: str = "text", keep: list[str] | None = None, vocabulary: str | None = None,
           digest: Callable | None = None) -> DataFrame:
    """Encodes and decodes every text: `keep`, n_tokens, ids (decimal, joined by one space), decoded. Narrow.

    `digest` is applied to ids and decoded inside the task, so that digests instead of whole texts leave it. Null
    and empty texts have no tokens and empty strings; a null key passes through; repeated rows give repeated rows;
    an empty table gives an empty table; other columns aren't read. A text of any length is encoded whole.
    """
    data = vocabulary_bytes(vocabulary, "word_bpe_49k.json")
    names = ("ids", "decoded") if digest is None else ("ids_sha256", "decoded_sha256")
    wrap = digest or (lambda x: x)

    def start():
        bpe = tokenizer(data)

        def block(texts):
            count, ids, decoded = [], [], []
            for words in bpe.encode([t.decode() for t in texts]):
                line = " ".join(map(bpe.ids.__getitem__, words))
                count.append(line.count(" ") + 1 if line else 0)
                ids.append(wrap(line))
                decoded.append(wrap(" ".join(map(bpe.tokens.__getitem__, words))))
            return [count, ids, decoded]

        return block

    outputs = [("n_tokens", "bigint"), (names[0], "string"), (names[1], "string")]
    return map_texts(df, [text], ["doc_id"] if keep is None else keep, outputs, start)


def decode(df: DataFrame, ids: str = "ids", keep: list[str] | None = None, vocabulary: str | None = None) -> DataFrame:
    """Texts of id lists as `encode` writes them: `keep`, decoded. Null and empty lists give an empty text."""
    data = vocabulary_bytes(vocabulary, "word_bpe_49k.json")

    def start():
        bpe = tokenizer(data)
        return lambda lines: [[bpe.decode([int(x) for x in line.split()]) for line in lines]]

    return map_texts(df, [ids], ["doc_id"] if keep is None else keep, [("decoded", "string")], start)


def op1_bpe(spark, sf_dir: str) -> DataFrame:
    """Token numbers, ids and decoded texts of all documents under word_bpe_49k.json, as digests."""
    return encode(spark.read.parquet(f"{sf_dir}/documents.parquet"), digest=sha)
