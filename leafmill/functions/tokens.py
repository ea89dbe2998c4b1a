"""Subword token counts by a byte-level vocabulary of merge ranks.

A text is cut into words by the vocabulary's pattern, and a word's bytes are
merged pair by pair, the lowest rank first and the leftmost of equals. A heap
finds the pairs, so a word of n bytes (a long run of letters without a space)
takes n log n steps. The vocabulary is read once a worker, and short words are
kept, since a corpus repeats them.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types
from pyspark.sql.functions import pandas_udf

#: The default vocabulary: lines of a token's bytes (base64) and its rank.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how the vocabulary's words are cut.
WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words of at most so many bytes are kept, at most so many of them.
SHORT, KEPT = 48, 1 << 17


@lru_cache(maxsize=2)
def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class Encoder:
    def __init__(self, path: str = VOCABULARY, pattern: str = WORDS):
        self.ranks, self.words = read_ranks(path), regex.compile(pattern)
        self.longest = max(map(len, self.ranks))
        self.kept = lru_cache(maxsize=KEPT)(self.merge)

    def merge(self, word: bytes) -> tuple[int, ...]:
        """Token ids of one word."""
        ranks, n = self.ranks, len(word)
        if word in ranks:
            return (ranks[word],)
        # Piece i is word[i:after[i]]; a piece that was merged into the one ahead of it has after 0.
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pairs: list[tuple[int, int, int]] = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < n and after[after[i]] - i <= self.longest:
                rank = ranks.get(word[i : after[after[i]]])
                if rank is not None:
                    heapq.heappush(pairs, (rank, i, after[after[i]]))

        for i in range(n - 1):
            offer(i)
        while pairs:
            _, i, end = heapq.heappop(pairs)
            right = after[i]
            # Passed by where either piece has changed since.
            if not right or right >= n or after[right] != end:
                continue
            after[i], after[right] = end, 0
            if end < n:
                before[end] = i
            offer(i)
            offer(before[i])
        found, i = [], 0
        while i < n:
            found.append(ranks[word[i : after[i]]])
            i = after[i]
        return tuple(found)

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        for match in self.words.finditer(text or ""):
            word = match[0].encode("utf-8", "replace")
            out += self.kept(word) if len(word) <= SHORT else self.merge(word)
        return out


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


def token_count(c: Column, path: str = VOCABULARY, pattern: str = WORDS) -> Column:
    """Tokens of a text by the vocabulary at path, a file that every executor can read; null and empty texts have none."""

    @pandas_udf(types.LongType())
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoder(path, pattern)
        for texts in batches:
            yield texts.map(lambda t: len(enc.encode(t)), na_action="ignore").fillna(0).astype("int64")

    return counted(F.coalesce(c, F.lit("")))
