"""BPE encoding and decoding with a segment tree over the ranks of adjacent pairs.

The tree's leaves are the symbols of one word, each with the rank of the merge with its right
neighbour. The root is the smallest rank, the leftmost of equals, so each step reads the root,
merges, and updates the at most three leaves that change: O(log n) a merge, until the root holds no
rank. A word's result is kept for when the word comes again; that memory is bounded.

The vocabulary is a `tokenizers` JSON file of the kind with word ends (BPE, end_of_word_suffix),
whose normalizer is NFC and lower case and whose pre-tokenizer takes the matches of one pattern.
Python's and the library's tables of characters are of different Unicode versions: `unsettled` finds
the characters that they may treat differently, and a text with one of them is normalized and split,
not merged, by the library itself.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shapelog.llm import spans
from shapelog.llm.common import release_memory, table

#: Words whose encoding is remembered, in each Python worker: up to twice as many.
CACHED_WORDS = 250_000
#: No merge: larger than any rank.
NONE = 1 << 62


def byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def lowered(text: str) -> str:
    """One character at a time has no final sigma, unlike str.lower."""
    return unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3").lower()


def unsettled(content: str) -> list[tuple[int, int]]:
    """Ranges of the characters that Python's tables don't know, or lower or split otherwise than the library."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_str(content)
    pattern = regex.compile(json.loads(content)["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
    whole = np.array([unicodedata.category(chr(c)) for c in range(0x110000)])
    every, odd = np.flatnonzero((whole != "Cn") & (whole != "Cs")).tolist(), np.flatnonzero(whole == "Cn").tolist()
    for i in range(0, len(every), 1 << 14):
        part = [chr(c) for c in every[i : i + (1 << 14)]]
        # How many pieces a letter, the character twice and a letter make tells the character's class.
        text = "".join(f" a{c}{c}a" for c in part)
        theirs, ours = (np.bincount([at // 5 for at in found], minlength=len(part)) for found in ([at for _, (at, _) in library.pre_tokenizer.pre_tokenize_str(text)], [m.start() for m in pattern.finditer(text)]))
        new = [library.normalizer.normalize_str(c) != (" " if c.isspace() else lowered(c)) for c in part]
        odd += np.asarray(every[i : i + (1 << 14)])[(theirs != ours) | np.array(new)].tolist()
    odd = np.sort(odd)
    cuts = np.flatnonzero(np.diff(odd) != 1) + 1
    return [(int(run[0]), int(run[-1])) for run in np.split(odd, cuts) if len(run)]


#: A leaf of the tree: rank, position and the merged symbol's id, in so many bits of one integer, so
#: that the smallest integer is the lowest rank, the leftmost of equals.
RANK_BITS, PLACE_BITS, ID_BITS = 16, 27, 17
PLACE = ((1 << PLACE_BITS) - 1) << ID_BITS
ID = (1 << ID_BITS) - 1


def raise_minimum(nodes: list[int], i: int, key: int) -> None:
    """Set a leaf of the tree and the minima above it, as far as they change."""
    nodes[i] = key
    while i > 1:
        other = nodes[i ^ 1]
        if other < key:
            key = other
        i >>= 1
        if nodes[i] == key:
            return
        nodes[i] = key


class Bpe:
    """Encoder and decoder of one vocabulary file's content."""

    def __init__(self, content: str, odd: list[tuple[int, int]]):
        """odd: what `unsettled` gives for the content."""
        self.content, self.library, self.odd = content, None, odd
        #: Characters seen that both treat alike.
        self.settled: set[str] = set()
        spec = json.loads(content)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.specials = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.tokens = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.specials.items()}
        self.end = model["end_of_word_suffix"]
        self.merges: dict[int, int] = {}
        for rank, (x, y) in enumerate(model["merges"]):
            key = rank << PLACE_BITS + ID_BITS | self.vocab[x + y]
            self.merges.setdefault(self.vocab[x] << ID_BITS | self.vocab[y], key)
        chars = byte_characters()
        self.inner = [self.vocab.get(chars[b]) for b in range(256)]
        self.last = [self.vocab.get(chars[b] + self.end) for b in range(256)]
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pattern = regex.compile(split)
        #: The same pattern over ASCII texts, whose letters and digits `re` can name.
        self.ascii_pattern = re.compile(split.replace(r"\p{L}", "A-Za-z").replace(r"\p{N}", "0-9"), re.ASCII)
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, self.specials)) + ")")
        self.special_mark = os.path.commonprefix(list(self.specials))
        #: Of two generations, so that words in use stay when the memory is full.
        self.cache: dict[str, tuple[str, int, str]] = {}
        self.older: dict[str, tuple[str, int, str]] = {}

    def merge_word(self, word: bytes) -> list[int]:
        inner = self.inner
        symbols = [inner[b] for b in word]
        symbols[-1] = self.last[word[-1]]
        if None in symbols:  # dropped, as there is no unknown token
            symbols = [s for s in symbols if s is not None]
        n, get = len(symbols), self.merges.get
        size = 1 << max(0, n - 2).bit_length()
        nodes = [NONE] * size
        nodes += [get(x << ID_BITS | y, NONE) + (i << ID_BITS) for i, (x, y) in enumerate(zip(symbols, symbols[1:], strict=False))]
        nodes += [NONE] * (2 * size - len(nodes))
        for i in range(size - 1, 0, -1):
            a, b = nodes[2 * i], nodes[2 * i + 1]
            nodes[i] = a if a < b else b
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        while (top := nodes[1]) < NONE:
            i = (top & PLACE) >> ID_BITS
            j = after[i]
            symbols[i] = x = top & ID
            symbols[j] = -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                raise_minimum(nodes, size + j, NONE)
                raise_minimum(nodes, size + i, get(x << ID_BITS | symbols[k], NONE) + (i << ID_BITS))
            else:
                raise_minimum(nodes, size + i, NONE)
            h = before[i]
            if h >= 0:
                raise_minimum(nodes, size + h, get(symbols[h] << ID_BITS | x, NONE) + (h << ID_BITS))
        return [s for s in symbols if s >= 0]

    def word(self, word: str) -> tuple[str, int, str]:
        """A word's ids as text, their number, and what they decode to."""
        if (known := self.older.get(word)) is not None:
            return self.remember(word, known)
        ids = self.merge_word(word.encode())
        out = " ".join(map(str, ids)), len(ids), self.decode(ids)
        return self.remember(word, out)

    def remember(self, word: str, out: tuple[str, int, str]) -> tuple[str, int, str]:
        if len(self.cache) >= CACHED_WORDS:
            self.older, self.cache = self.cache, {}
        self.cache[word] = out
        return out

    def split(self, text: str) -> list[str]:
        if text.isascii():
            return self.ascii_pattern.findall(text.lower())
        fresh = set(text) - self.settled
        if fresh and any(map(self.is_odd, fresh)):
            return self.split_by_library(text)
        self.settled |= fresh
        return self.pattern.findall(lowered(text))

    def is_odd(self, char: str) -> bool:
        at = bisect_right(self.odd, (ord(char), 0x110000)) - 1
        return at >= 0 and ord(char) <= self.odd[at][1]

    def split_by_library(self, text: str) -> list[str]:
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_str(self.content)
        text = self.library.normalizer.normalize_str(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def pieces(self, text: str) -> list[tuple[str, int, str]]:
        parts = self.special_pattern.split(text) if self.specials and self.special_mark in text else [text]
        out: list[tuple[str, int, str]] = []
        for i, part in enumerate(parts):
            if i % 2:
                out.append((str(self.specials[part]), 1, part))
            else:
                get = self.cache.get
                out += [get(w) or self.word(w) for w in self.split(part)]
        return [x for x in out if x[1]]

    def encode(self, text: str) -> list[int]:
        return [int(i) for x in self.pieces(text) for i in x[0].split()]

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by spaces, word ends and special tokens included, as without a decoder."""
        return " ".join(self.tokens[i] for i in ids)


def encode_decode(docs: DataFrame, vocab_path: str) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids (decimal, joined by one space), decoded.

    vocab_path is read on the driver only and sent to the executors (a vocabulary is some 2 MB).
    Null and empty texts have no tokens, empty ids and an empty decoded text. Text of any length is
    encoded whole. Rows may repeat; columns other than doc_id and text are ignored.
    """
    with open(vocab_path, encoding="utf-8") as f:
        content = f.read()
    shared = docs.sparkSession.sparkContext.broadcast((content, unsettled(content)))
    release_memory()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(*shared.value)
        for whole in batches:
            for batch in spans.slices(whole, "text"):
                count, ids, decoded = [], [], []
                for text in batch["text"].to_pylist():
                    found = bpe.pieces(text or "")
                    numbers, sizes, texts = zip(*found, strict=True) if found else ((), (), ())
                    ids.append(" ".join(numbers))
                    count.append(sum(sizes))
                    decoded.append(" ".join(texts))
                columns = [batch["doc_id"], pa.array(count, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids", "decoded"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long, ids string, decoded string")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    digest = {f"{x}_sha256": F.sha2(F.col(x).cast("binary"), 256) for x in ("ids", "decoded")}
    return out.select("doc_id", "n_tokens", *(v.alias(k) for k, v in digest.items()))
