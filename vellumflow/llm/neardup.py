"""Problem 3: records that share most of their content but for small edits.

Method: MinHash with Bayesian pruning of candidates. Each record's set of word runs gets a signature of
16-bit MinHash values. Bands of four values give candidate pairs. The values of a candidate are compared a
few at a time; with a uniform prior on the similarity, the posterior probability that it reaches the
threshold follows from the matches so far, and a pair is dropped once it falls below the tolerance. Pairs
that remain are verified exactly on their texts.

Records with equal sets form one class and take part as one, whatever their number. A band value that many
classes share is cut into blocks (operators.pairs). With the defaults a pair of similarity 0.6 meets in no
band with probability 0.001, of 0.65 with 0.00005; the tolerance adds at most that much again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumflow.operators.pairs import group_pairs, spread_pairs, within
from vellumflow.runtime import cut, ship_package

BANDS, ROWS = 50, 4
VALUES = BANDS * ROWS
#: Values compared between two looks at the posterior, and the posterior below which a pair is dropped.
STEP, TOLERANCE = 20, 1e-5
_MULTIPLIERS = np.random.default_rng(20_240_601).integers(1, 2**32, size=(2, VALUES), dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_MIX1, _MIX2, _MIX3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))

_PLACES = np.arange(1, 17, dtype=np.uint64) * _MIX2


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mixing of 64-bit values."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class WordRuns:
    """Sets of runs of consecutive words, as 64-bit hashes; words are those of the lower-cased text split at space, tab, LF and CR."""

    def __init__(self, run: int):
        import xxhash

        if not 1 <= run <= len(_PLACES):
            raise ValueError(f"runs have 1 to {len(_PLACES)} words")
        self.run, self.digest, self.known = run, xxhash.xxh3_64_intdigest, {}

    def words(self, text: str | None) -> list[str]:
        return [w for w in (text or "").lower().replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]

    def sets(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Distinct run hashes of the texts, each text's sorted, one after the other, and how many each has."""
        known, digest = self.known, self.digest
        if len(known) > 500_000:
            known.clear()
        split = [self.words(t) for t in texts]
        for w in {w for ws in split for w in ws}.difference(known):
            known[w] = digest(w)
        n_words = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
        h = np.fromiter((known[w] for ws in split for w in ws), dtype=np.uint64, count=int(n_words.sum()))
        n_runs = np.maximum(n_words - self.run + 1, 0)
        owner = np.repeat(np.arange(len(texts)), n_runs)
        first = np.concatenate([[0], np.cumsum(n_words)])[:-1]
        at = np.arange(len(owner)) - np.repeat(np.cumsum(n_runs) - n_runs - first, n_runs)
        value = np.zeros(len(at), dtype=np.uint64)
        for i in range(self.run):
            value = mixed(value * _MIX1 + h[at + i] + _PLACES[i])
        order = np.lexsort((value, owner))
        value, owner = value[order], owner[order]
        new = np.ones(len(value), dtype=bool)
        new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
        return value[new], np.bincount(owner[new], minlength=len(texts))


def signatures(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A row of VALUES 16-bit MinHash values for each set, none of which may be empty."""
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    folded = (values ^ (values >> np.uint64(32))).astype(np.uint32)
    out = np.empty((len(counts), VALUES), dtype=np.uint16)
    for i in range(VALUES):
        x = (folded ^ _MULTIPLIERS[0, i]) * _MULTIPLIERS[1, i]
        least = np.minimum.reduceat(x ^ (x >> np.uint32(15)), starts)
        out[:, i] = (least * np.uint32(0x9E3779B1)) >> np.uint32(16)
    return out


def set_classes(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A 64-bit key of each set's content."""
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    total = np.add.reduceat(mixed(values + _MIX3), starts)
    return mixed(total ^ (counts.astype(np.uint64) * _MIX1)).view(np.int64)


def posterior_limits(threshold: float, tolerance: float = TOLERANCE) -> np.ndarray:
    """For 0, STEP, 2 STEP ... compared values the least number of matches a pair needs in order to stay.

    Uniform prior over similarities; two values that stand for different runs agree with probability 2**-16.
    """
    grid = np.linspace(0.0005, 0.9995, 1000)
    match = grid + (1 - grid) / 65536
    limits = []
    for n in range(0, VALUES + 1, STEP):
        m = np.arange(n + 1)[:, None]
        like = m * np.log(match) + (n - m) * np.log1p(-match)
        like = np.exp(like - like.max(axis=1, keepdims=True))
        post = like[:, grid >= threshold].sum(axis=1) / like.sum(axis=1)
        limits.append(int(np.argmax(post >= tolerance)))
    return np.array(limits)


def likely(a: np.ndarray, b: np.ndarray, threshold: float, tolerance: float = TOLERANCE) -> np.ndarray:
    """Which pairs of signatures survive the incremental comparison."""
    limits, alive, matches = posterior_limits(threshold, tolerance), np.arange(len(a)), np.zeros(len(a), dtype=np.int64)
    for k, at in enumerate(range(0, VALUES, STEP), start=1):
        matches[alive] += (a[alive, at : at + STEP] == b[alive, at : at + STEP]).sum(axis=1)
        alive = alive[matches[alive] >= limits[k]]
    out = np.zeros(len(a), dtype=bool)
    out[alive] = True
    return out


SIGNED = pa.schema([("id", pa.string()), ("cls", pa.int64()), ("runs", pa.int32()), ("sig", pa.binary())])


def _sign(run: int, least_runs: int):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, seen = WordRuns(run), set()
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for at in range(0, len(texts), 500):
                values, counts = sets.sets(texts[at : at + 500])
                owner_ok = counts >= least_runs
                kept = np.flatnonzero(owner_ok)
                if not len(kept):
                    continue
                values, counts = values[np.repeat(owner_ok, counts)], counts[kept]
                cls = set_classes(values, counts)
                sig = signatures(values, counts)
                blobs = []
                for i, c in enumerate(cls.tolist()):  # copies in this partition send their signature once
                    blobs.append(None if c in seen else sig[i].tobytes())
                    seen.add(c)
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(kept + at)), pa.array(cls), pa.array(counts, type=pa.int32()), pa.array(blobs, type=pa.binary())], schema=SIGNED)

    return go


def _prune(threshold: float, tolerance: float):
    def go(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                a, b = (np.frombuffer(b"".join(f[c]), dtype=np.uint16).reshape(len(f), VALUES) for c in ("sig_a", "sig_b"))
                f = f[likely(a, b, threshold, tolerance)]
            yield f[["a", "b"]]

    return go


def _verify(run: int, threshold: float):
    def go(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sets = WordRuns(run)
        for f in frames:
            share = np.zeros(len(f))
            for at in range(0, len(f), 500):
                part = f.iloc[at : at + 500]
                sides = []
                for c in ("text_a", "text_b"):
                    values, counts = sets.sets(part[c].tolist())
                    sides.append(np.split(values, np.cumsum(counts)[:-1]))
                for i, (x, y) in enumerate(zip(*sides, strict=True)):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    share[at + i] = both / max(1, len(x) + len(y) - both)
            ok = share >= threshold
            yield pd.DataFrame({"a": f["a"][ok], "b": f["b"][ok], "similarity": share[ok]})

    return go


def near_duplicates(df: DataFrame, id_col: str = "id", text: str = "text", run: int = 5, threshold: float = 0.8, least_runs: int = 1, tolerance: float = TOLERANCE) -> tuple[DataFrame, DataFrame]:
    """Membership (id, cls, runs) and links (a, b, similarity), a < b, between classes whose similarity reaches the threshold.

    A class holds the records with equal sets of runs; records with fewer than ``least_runs`` runs, null and
    empty texts among them, are in none. Repeated rows of an id count once if their texts are equal; an id
    with several texts is a member of several classes. A null id is left out. Only the two named columns are read.
    """
    ship_package(df.sparkSession)
    rows = df.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text}`").alias("text")).where("id is not null and text is not null")
    signed = cut(rows.mapInArrow(_sign(run, least_runs), "id string, cls long, runs int, sig binary"))
    firsts = signed.where("sig is not null").select("cls", "sig", "id")
    keys = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(F.substring(F.col("sig"), i * (2 * ROWS) + 1, F.lit(2 * ROWS)), i))
    banded = firsts.select("cls", F.explode(keys).alias("band"))
    met = cut(group_pairs(banded, "band", "cls").select("a", "b").distinct())
    classes = cut(met.select(F.explode(F.array("a", "b")).alias("cls")).distinct())
    mine = within(classes, firsts, "cls").groupBy("cls").agg(F.min("id").alias("id"), F.first("sig").alias("sig"))
    sides = met.join(mine.select(F.col("cls").alias("a"), F.col("sig").alias("sig_a")), "a").join(mine.select(F.col("cls").alias("b"), F.col("sig").alias("sig_b")), "b")
    left = cut(sides.mapInPandas(_prune(threshold, tolerance), "a long, b long"))
    firsts_of = cut(left.select(F.explode(F.array("a", "b")).alias("cls")).distinct().join(mine.select("cls", "id"), "cls"))
    texts = within(firsts_of.select("id").distinct(), rows, "id").groupBy("id").agg(F.collect_set("text").alias("texts"))
    of_class = firsts_of.join(texts, "id").select("cls", F.explode("texts").alias("text"))
    pairs = left.join(of_class.select(F.col("cls").alias("a"), F.col("text").alias("text_a")), "a").join(of_class.select(F.col("cls").alias("b"), F.col("text").alias("text_b")), "b")
    links = pairs.mapInPandas(_verify(run, threshold), "a long, b long, similarity double").groupBy("a", "b").agg(F.max("similarity").alias("similarity"))
    return signed.select("id", "cls", "runs"), links


def near_duplicate_pairs(members: DataFrame, links: DataFrame) -> DataFrame:
    """Pairs of ids (a, b), a < b, spread out from classes: members of linked classes and of one class.

    A class of any number of copies is cut into blocks, so no task holds all its members.
    """
    of = cut(members.select("id", "cls").distinct())
    between = spread_pairs(links.select("a", "b"), of).where("x <> y")
    inside = group_pairs(of, "cls", "id").select(F.col("a").alias("x"), F.col("b").alias("y"))
    both = between.unionByName(inside)
    return both.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def near_duplicate_classes(members: DataFrame, links: DataFrame) -> DataFrame:
    """(id, cls, n_links): each record's class and the number of other classes linked with it; no pair of records is made."""
    ends = links.select(F.explode(F.array("a", "b")).alias("cls")).groupBy("cls").agg(F.count(F.lit(1)).alias("n_links"))
    return members.select("id", "cls").distinct().join(ends, "cls", "left").select("id", "cls", F.coalesce("n_links", F.lit(0)).alias("n_links"))
