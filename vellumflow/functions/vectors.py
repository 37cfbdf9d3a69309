"""Dense and sparse vector kernels on arrays and maps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vellumflow.functions.visual import let


def dot(a: Column, b: Column) -> Column:
    """Dot product in doubles, summed in order; null where a vector is."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def unit(a: Column) -> Column:
    """The vector over its length plus 1e-9."""
    n = norm(a) + 1e-9
    return F.transform(a, lambda x: x.cast("double") / n)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; null where a vector has no length."""
    n = norm(a) * norm(b)
    return F.when(n > 0, dot(a, b) / n)


def lexical_weights(tokens: Column, weights: Column, special: tuple[int, ...] = (0, 1, 2, 3)) -> Column:
    """Map of token (as string) to its largest weight; special tokens and weights of 0 or less are dropped, different lengths are an error."""
    pairs = F.when(F.size(tokens) == F.size(weights), F.arrays_zip(tokens.alias("t"), weights.alias("w"))).otherwise(F.raise_error(F.lit("tokens and weights differ in number")))
    kept = F.filter(pairs, lambda p: (p["w"] > 0) & ~p["t"].isin(*special))
    names = F.array_distinct(F.transform(kept, lambda p: p["t"]))
    return F.map_from_entries(F.transform(names, lambda t: F.struct(t.cast("string").alias("key"), F.array_max(F.transform(F.filter(kept, lambda p: p["t"] == t), lambda p: p["w"])).alias("value"))))


def sparse_parts(m: Column) -> Column:
    """struct(indices, values) of a lexical map, by index."""
    entries = F.array_sort(F.transform(F.map_entries(m), lambda e: F.struct(e["key"].cast("long").alias("i"), e["value"].alias("v"))))
    return F.struct(F.transform(entries, lambda e: e["i"]).alias("indices"), F.transform(entries, lambda e: e["v"]).alias("values"))


def hashed_embedding(words: Column, dims: int = 32) -> Column:
    """A deterministic stand-in for an embedding model: word counts in hashed dimensions, made unit length."""
    slots = F.transform(words, lambda w: F.pmod(F.crc32(w), F.lit(dims)))
    count = lambda found: F.transform(F.sequence(F.lit(0), F.lit(dims - 1)), lambda d: F.size(F.filter(found, lambda s: s == d)).cast("double"))
    return let(let(slots, count), unit)


def absent_safe_not(p: Column) -> Column:
    """Not p, true where p is unknown: rows without the key stay."""
    return ~F.coalesce(p, F.lit(False))
