"""Problem 4: cutting oversized texts at natural boundaries, with overlap.

Method: pointer doubling. Every boundary of a text (end of a sentence or line, end of a token, and inside
overlong tokens a grid of characters) is joined to its farthest legal successor: the farthest boundary at
which a piece that begins with the overlap before this boundary is still within both limits. Natural
boundaries are preferred, then ends of tokens, then the grid. The successor table is then squared again and
again; with the tables for 1, 2, 4, ... steps the first 1, 2, 4, ... cuts of all texts of a batch follow
at once, so a text of n pieces takes log2(n) array operations.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellumflow.llm.tokens import token_count
from vellumflow.runtime import ship_package


@dataclass(frozen=True)
class Limits:
    """Most tokens and characters of a piece, and the tokens that two neighbouring pieces share.

    The shared part takes at most half of ``chars``: where 64 tokens are longer than that, as many whole
    tokens as fit are shared.
    """

    tokens: int = 768
    chars: int = 6144
    overlap: int = 64

    def __post_init__(self) -> None:
        if not 0 <= self.overlap < self.tokens or self.chars < 8:
            raise ValueError("overlap must be below the token limit, and a piece must hold at least 8 characters")


#: Marks that end a sentence, and closing quotes and brackets that may follow them.
_ENDS = ".!?…。！？｡।॥؟۔"
_CLOSERS = "\"'”’»“」』】）)]›"


def oversized(text: Column, limits: Limits = Limits()) -> Column:
    """Whether a text is over a limit; null texts aren't. Tokens are counted only where the length leaves it open."""
    return (F.length(text) > limits.chars) | ((F.length(text) > 2 * limits.tokens) & (token_count(text) > limits.tokens))


def _marks(text: str) -> np.ndarray:
    """Code points of a text."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def _boundaries(code: np.ndarray, limits: Limits) -> tuple[np.ndarray, ...]:
    """Token starts, token ends, natural boundaries and grid boundaries of a text, as positions."""
    gap = (code == 32) | (code == 9) | (code == 10) | (code == 13)
    solid = np.concatenate([[False], ~gap, [False]])
    edge = np.flatnonzero(solid[1:] != solid[:-1])
    starts, ends = edge[0::2], edge[1::2]
    stops = np.isin(code, np.array([ord(c) for c in _ENDS], dtype=np.uint32))
    closes = np.isin(code, np.array([ord(c) for c in _CLOSERS], dtype=np.uint32))
    wide = stops & (code > 0x2FFF)
    # a sentence ends at a token's end behind a stop and any closing marks, or behind a stop of a script without spaces
    place = np.arange(len(code))
    last_open = np.maximum.accumulate(np.where(closes, -1, place)) if len(code) else place
    natural = np.zeros(len(code) + 1, dtype=bool)
    if len(ends):
        tip = last_open[ends - 1]
        natural[ends[(tip >= 0) & stops[np.maximum(tip, 0)]]] = True
        line_end = np.zeros(len(ends), dtype=bool)
        after = np.concatenate([starts[1:], [len(code)]])
        breaks = np.concatenate([[0], np.cumsum(code == 10)])
        line_end = (breaks[after] - breaks[ends] > 0) | (after == len(code))
        natural[ends[line_end]] = True
        inside = np.flatnonzero(wide[:-1] & ~closes[1:] & ~wide[1:]) + 1
        natural[inside] = True
    step = max(1, limits.chars // 8)
    long_tokens = np.flatnonzero(ends - starts > step)
    grid = [np.arange(starts[i] + step, ends[i], step) for i in long_tokens]
    return starts, ends, np.flatnonzero(natural), np.concatenate(grid) if grid else np.empty(0, dtype=np.int64)


def successors(code: np.ndarray, limits: Limits) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Boundaries of one text in order, where the piece after each begins, the farthest legal successor of each, token starts and ends."""
    starts, ends, natural, grid = _boundaries(code, limits)
    first = starts[:1] if len(starts) else np.zeros(1, dtype=np.int64)
    states = np.unique(np.concatenate([first, ends, natural, grid]))
    # the piece after a boundary begins `overlap` tokens before it, or later where these are too long; its first token is new at least
    done = np.searchsorted(ends, states, side="right")
    inside = np.searchsorted(starts, states, side="left") > done
    back = np.maximum(done - limits.overlap, 0)
    lead = starts[np.minimum(back, len(starts) - 1)] if limits.overlap else states
    far = states - lead > limits.chars // 2
    if far.any():
        near = np.searchsorted(starts, states[far] - limits.chars // 2, side="left")
        lead = lead.copy()
        lead[far] = np.where(near < len(starts), starts[np.minimum(near, len(starts) - 1)], states[far])
    fresh = starts[np.minimum(done, len(starts) - 1)]
    begin = np.where(lead < states, lead, np.where(inside, states, np.maximum(fresh, states)))
    begin[0] = first[0]
    # a piece from `begin` may end where it has at most `tokens` tokens and `chars` characters
    nxt = np.full(len(states), -1, dtype=np.int64)
    for again in (False, True):
        if again:
            # behind a run of separators too long for any successor the overlap is given up
            stuck = (nxt < 0) & (done < len(starts))
            if not stuck.any():
                break
            begin = np.where(stuck, np.where(inside, states, np.maximum(fresh, states)), begin)
        token_of = np.searchsorted(ends, begin, side="right")
        last_token = np.minimum(token_of + limits.tokens, len(ends)) - 1
        reach = np.minimum(ends[last_token], begin + limits.chars)
        for kind in (natural, ends, grid):
            if len(kind):
                at = np.searchsorted(kind, reach, side="right") - 1
                target = kind[np.maximum(at, 0)]
                ok = (nxt < 0) & (at >= 0) & (target > states)
                nxt[ok] = np.searchsorted(states, target[ok])
    return states, begin, nxt, starts, ends


def all_cuts(nexts: list[np.ndarray]) -> list[np.ndarray]:
    """For each text the boundaries reached from its first one, by squaring the successor tables of all texts together."""
    sizes = np.array([len(n) for n in nexts])
    offset = np.cumsum(sizes) - sizes
    sink = int(sizes.sum())
    table = np.concatenate([np.where(n < 0, sink, n + o) for n, o in zip(nexts, offset, strict=True)] + [np.array([sink])])
    reached, text = offset.copy(), np.arange(len(nexts))
    while True:
        more = table[reached]
        live = more < sink
        if not live.any():
            break
        reached, text = np.concatenate([reached, more[live]]), np.concatenate([text, text[live]])
        table = table[table]
    order = np.lexsort((reached, text))
    reached, text = reached[order], text[order]
    at = np.searchsorted(text, np.arange(len(nexts) + 1))
    return [reached[a:b] - o for a, b, o in zip(at[:-1], at[1:], offset, strict=True)]


def split_texts(texts: list[str], limits: Limits = Limits()) -> list[list[tuple[int, int, int, int]]]:
    """For each text its pieces as (start, end, tokens, tokens shared with the piece before). A text without tokens is cut by characters alone."""
    todo = [successors(_marks(t), limits) if t.strip(" \t\r\n") else None for t in texts]
    cuts = iter(all_cuts([x[2] for x in todo if x]) if any(todo) else [])
    out = []
    for t, x in zip(texts, todo, strict=True):
        if x is None:
            out.append([(i, min(i + limits.chars, len(t)), 0, 0) for i in range(0, len(t), limits.chars)])
            continue
        states, begin, _, starts, ends = x
        path = next(cuts)
        s, e = begin[path[:-1]], states[path[1:]]
        if not len(s):
            s, e = states[:1], ends[-1:]
        n = np.searchsorted(starts, e, side="left") - np.searchsorted(ends, s, side="right")
        before = np.concatenate([s[:1], e[:-1]])
        shared = np.where(s < before, np.searchsorted(starts, before, side="left") - np.searchsorted(ends, s, side="right"), 0)
        out.append(list(zip(s.tolist(), e.tolist(), n.tolist(), shared.tolist(), strict=True)))
    return out


_PIECE = T.ArrayType(
    T.StructType(
        [
            T.StructField("start_pos", T.IntegerType()),
            T.StructField("end_pos", T.IntegerType()),
            T.StructField("token_count", T.IntegerType()),
            T.StructField("overlap_tokens", T.IntegerType()),
        ]
    )
)


def _kernel(at: int, limits: Limits):
    def go(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            name = f.columns[at]
            for part in (f.iloc[i : i + 200] for i in range(0, len(f), 200)):
                done = split_texts(part[name].tolist(), limits)
                yield part.assign(pieces=[[dict(zip(("start_pos", "end_pos", "token_count", "overlap_tokens"), p, strict=True)) for p in ps] for ps in done])

    return go


def split_oversized(df: DataFrame, keys: list[str], text: str = "text", keep: list[str] | None = None, limits: Limits = Limits()) -> DataFrame:
    """Ordered pieces of every text over a limit: ``keys``, piece_index, n_pieces, start_pos, end_pos, token_count, overlap_tokens, piece, and the ``keep`` columns.

    Texts within the limits, null and empty ones included, give no rows; repeated rows (equal keys and text)
    give their pieces once, with the ``keep`` values of one of them. Only the few oversized rows leave the JVM
    or are shuffled. Columns that aren't named don't matter.
    """
    keep = keep or []
    ship_package(df.sparkSession)
    rows = df.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keys)], *[F.col(f"`{c}`").alias(f"v{i}") for i, c in enumerate(keep)], F.col(f"`{text}`").alias("t"))
    ks, vs = [f"k{i}" for i in range(len(keys))], [f"v{i}" for i in range(len(keep))]
    large = rows.where(oversized(F.col("t"), limits)).groupBy(*ks, "t").agg(*[F.min(v).alias(v) for v in vs], F.count(F.lit(1)).alias("n")).drop("n")
    schema = T.StructType([*large.schema.fields, T.StructField("pieces", _PIECE)])
    cutted = large.mapInPandas(_kernel(large.columns.index("t"), limits), schema)
    flat = cutted.select(*ks, *vs, "t", F.size("pieces").alias("n_pieces"), F.posexplode("pieces").alias("piece_index", "p"))
    return flat.select(
        *[F.col(k).alias(c) for k, c in zip(ks, keys, strict=True)],
        "piece_index",
        "n_pieces",
        "p.start_pos",
        "p.end_pos",
        "p.token_count",
        "p.overlap_tokens",
        F.substring(F.col("t"), F.col("p.start_pos") + 1, F.col("p.end_pos") - F.col("p.start_pos")).alias("piece"),
        *[F.col(v).alias(c) for v, c in zip(vs, keep, strict=True)],
    )
