"""Token counters: what a limit is counted in. White space by default, a subword vocabulary where one is given.

A counter has ``name``, ``joint`` (tokens that a blank line between two trimmed texts adds), ``column`` (counts of a
Column), ``count`` (of one text) and ``pieces`` (a text in parts of at most so many tokens). Any object with these serves.
"""

from __future__ import annotations

import base64
from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache
from typing import Protocol

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from vellumflow.functions.text import count_words


class TokenCounter(Protocol):
    name: str
    joint: int

    def column(self, c: Column) -> Column: ...

    def count(self, text: str) -> int: ...

    def pieces(self, text: str, size: int) -> list[str]: ...


@dataclass(frozen=True)
class WordCounter:
    """Runs without white space; counted in the JVM. The count of joined texts is the sum of their counts."""

    name: str = "words"
    joint: int = 0

    def column(self, c: Column) -> Column:
        return count_words(c)

    def count(self, text: str) -> int:
        return len(text.split())

    def pieces(self, text: str, size: int) -> list[str]:
        words = text.split()
        return [" ".join(words[i : i + size]) for i in range(0, len(words), size)]


#: Fixed value: the pattern that splits text before merges in the byte-level vocabularies this reads.
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=4)
def _encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@dataclass(frozen=True)
class SubwordCounter:
    """Tokens of a byte-level vocabulary in a rank file that every worker can read; without special tokens.

    Texts cut by it end at whole characters: a piece has at most ``size`` tokens by the counting of the text it is
    cut from, and one character at least. A missing file or library is an error when counting begins.
    """

    path: str
    pattern: str = BYTE_LEVEL
    name: str = "subwords"
    #: The two line feeds between paragraphs are one token each.
    joint: int = 2

    def column(self, c: Column) -> Column:
        @F.pandas_udf("int")
        def run(texts: pd.Series) -> pd.Series:
            return pd.Series(self.counts(texts.tolist()), dtype="int32")

        return run(c)

    def counts(self, texts: Sequence[str | None]) -> list[int]:
        found = _encoding(self.path, self.pattern).encode_ordinary_batch([t or "" for t in texts], num_threads=1)
        return [len(ids) for ids in found]

    def count(self, text: str) -> int:
        return len(_encoding(self.path, self.pattern).encode_ordinary(text))

    def pieces(self, text: str, size: int) -> list[str]:
        enc = _encoding(self.path, self.pattern)
        raw = text.encode("utf-8", "surrogatepass")
        sizes = [len(enc.decode_single_token_bytes(i)) for i in enc.encode_ordinary(text)]
        out, start, end, n = [], 0, 0, 0
        for k, width in enumerate(sizes):
            end += width
            n += 1
            if n < size and k < len(sizes) - 1:
                continue
            cut = end
            while cut > start and cut < len(raw) and raw[cut] & 0xC0 == 0x80:  # not inside a character
                cut -= 1
            if cut == start:
                continue  # one character of more tokens than a piece may have: it goes on to its end
            out.append(raw[start:cut].decode("utf-8", "surrogatepass"))
            start, n = cut, 0 if cut == end else 1
        if start < len(raw):
            out.append(raw[start:].decode("utf-8", "surrogatepass"))
        return [p for p in (x.strip() for x in out) if p]


WORDS = WordCounter()
