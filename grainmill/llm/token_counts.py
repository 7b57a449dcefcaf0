"""Token counts by byte-pair merging with a heap and a linked list.

A pre-token starts as a doubly linked list of its bytes. A heap holds the adjacent pairs
that have a merge rank; the lowest rank (leftmost first) is popped again and again and its
two symbols become one. The count is the initial number of symbols minus the merges made;
no token identifiers are formed. Counts of pre-tokens are kept in a bounded cache of the
Python worker, since natural text repeats them.

Edge cases: null and empty texts have 0 tokens and 0 bytes. A special token's string
inside a text counts as one token, which is the library's default. Repeated rows each get
their row; other columns of the input are ignored.
"""

from __future__ import annotations

import heapq
import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from grainmill.llm.arrow import map_texts

#: The fixed pre-token pattern of byte-level byte-pair vocabularies of this kind.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space other than the space and the line feed, as an RE2 class.
OTHER_SPACE = r"[\t\v\f\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: Pre-tokens remembered by a worker; beyond it the cache starts afresh.
CACHE_ENTRIES = 600_000
#: Symbols are numbered below 2**SYMBOL_BITS, so that a pair of them is one integer.
SYMBOL_BITS = 20


def printable_bytes() -> dict[str, int]:
    """The byte for each character that byte-level vocabulary files write it as.

    Printable bytes stand for themselves; the others are moved past U+00FF in order.
    """
    plain = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    moved = (b for b in range(256) if b not in plain)
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(moved)}


class MergeCounter:
    """Counts tokens of whole texts under one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        of = printable_bytes()
        number = {c: b for c, b in of.items()}
        self.pairs: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            whole = number.setdefault(left + right, len(number))
            self.pairs[number[left] << SYMBOL_BITS | number[right]] = (rank, whole)
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.split = regex.compile(PRE_TOKENS)
        self.cache: dict[str, int] = {}
        #: Texts in which single spaces and line feeds are not all between two other characters.
        self.uneven = "|".join([r"^[ \n]", r"[ \n][ \n]", r"[ \n]$", OTHER_SPACE, *map(regex.escape, special)])

    def merged(self, token: str) -> int:
        """Tokens of one pre-token."""
        symbol = list(token.encode())
        n = len(symbol)
        if n < 2:
            return n
        pairs = self.pairs
        heap = [r[0] << 32 | i for i in range(n - 1) if (r := pairs.get(symbol[i] << SYMBOL_BITS | symbol[i + 1]))]
        heapq.heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        merges = 0
        while heap:
            top = heapq.heappop(heap)
            i = top & 0xFFFFFFFF
            j = after[i]
            if j >= n or symbol[i] < 0:
                continue
            found = pairs.get(symbol[i] << SYMBOL_BITS | symbol[j])
            if not found or found[0] != top >> 32:
                continue  # one of the two has been merged into something else since
            symbol[i], symbol[j] = found[1], -1
            after[i] = k = after[j]
            merges += 1
            if k < n:
                before[k] = i
                if r := pairs.get(symbol[i] << SYMBOL_BITS | symbol[k]):
                    heapq.heappush(heap, r[0] << 32 | i)
            if (h := before[i]) >= 0 and (r := pairs.get(symbol[h] << SYMBOL_BITS | symbol[i])):
                heapq.heappush(heap, r[0] << 32 | h)
        return n - merges

    def pre_tokenised(self, text: str) -> int:
        """Tokens of a text without special tokens, split by the pattern."""
        total = 0
        for token in self.split.findall(text):
            n = self.cache.get(token)
            if n is None:
                if len(self.cache) >= CACHE_ENTRIES:
                    self.cache.clear()
                n = self.cache[token] = self.merged(token)
            total += n
        return total

    def count(self, text: str) -> int:
        """Tokens of any text."""
        if self.special is not None and self.special.search(text):
            parts = self.special.split(text)
            return len(parts) - 1 + sum(map(self.pre_tokenised, parts))
        return self.pre_tokenised(text)

    def word(self, word: str) -> int:
        """Tokens of a word with the space, or the line feed it starts with, before it."""
        if word[0] == "\n":
            return 1 + self.pre_tokenised(word[1:])
        word = " " + word
        n = self.cache.get(word)
        return self.pre_tokenised(word) if n is None else n

    def count_all(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text.

        A pre-token never crosses from a non-space into a single space or line feed that
        another non-space follows. So even texts are cut there, each distinct word of the
        batch is counted once, with the space before it, and each line feed is a token.
        """
        texts = texts.fill_null("")
        uneven = pc.match_substring_regex(texts, self.uneven)
        slow = pc.or_(uneven, pc.equal(texts, "")).to_numpy(zero_copy_only=False)
        out = np.zeros(len(texts), np.int64)
        for i in np.flatnonzero(slow):
            out[i] = self.count(texts[i].as_py())
        if not slow.all():
            marked = pc.replace_substring(texts.filter(pa.array(~slow)), "\n", " \n")
            words = pc.split_pattern(pc.binary_join_element_wise("\n", marked, ""), " ")
            coded = words.flatten().dictionary_encode()
            of = np.fromiter(map(self.word, coded.dictionary.to_pylist()), np.int64, len(coded.dictionary))
            starts = words.offsets.to_numpy()
            out[~slow] = np.add.reduceat(of[coded.indices.to_numpy()], starts[:-1] - starts[0]) - 1
        return out


@lru_cache(maxsize=4)
def counter(path: str) -> MergeCounter:
    """One counter for each Python worker and file."""
    return MergeCounter(path)


def count_tokens(df: DataFrame, vocabulary: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_bytes, n_tokens, over_limit`` of every whole text; no shuffle.

    ``vocabulary`` is the path of a byte-level vocabulary file on every machine.
    """

    def measure(texts: pa.Array) -> dict:
        tokens = counter(vocabulary).count_all(texts)
        return {"n_bytes": pc.binary_length(texts).fill_null(0), "n_tokens": tokens, "over_limit": tokens > limit}

    fields = [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())]
    return map_texts(df, [id_col], text_col, measure, fields)
