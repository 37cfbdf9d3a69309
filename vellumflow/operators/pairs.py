"""Pairs within groups of any size, without a group ever being gathered in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vellumflow.runtime import cut

#: Members of a group that meet under one join key; larger groups are cut into blocks of about this many.
BLOCK_MEMBERS = 2048
#: One of so many members is counted to find hot groups, and the estimated size from which a group is hot.
SAMPLED, HOT_MEMBERS = 64, 32_768


def _blocks_met(placed: DataFrame) -> DataFrame:
    """Pairs (k, a, b) of members placed in blocks (k, m, blocks, own): each two blocks meet under a key of their own."""
    left = placed.select("k", F.col("m").alias("x"), F.col("own").alias("i"), F.explode(F.sequence("own", F.col("blocks") - 1)).alias("j"))
    right = placed.select("k", F.col("m").alias("y"), F.explode(F.sequence(F.lit(0), "own")).alias("i"), F.col("own").alias("j"))
    met = left.join(right, ["k", "i", "j"]).where((F.col("i") < F.col("j")) & (F.col("x") != F.col("y")) | (F.col("i") == F.col("j")) & (F.col("x") < F.col("y")))
    return met.select("k", F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def _placed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("own", F.pmod(F.xxhash64("m"), F.col("blocks")).cast("int"))


def group_pairs(df: DataFrame, key: str, member: str, block_members: int = BLOCK_MEMBERS, sampled: int = SAMPLED, hot_members: int = HOT_MEMBERS) -> DataFrame:
    """Rows (key, a, b), a < b: each two different members of each group once a group.

    Hot groups are told from a count of one of ``sampled`` members, which only decides how they run: their members
    are spread by key and member, never by the key alone, and cut into blocks of about ``block_members`` that meet
    under join keys of their own. Other groups, of ``hot_members`` or little more, are sized in one shuffle by the
    key; groups of one vanish there. A null key or member makes no pair; repeated rows count once. ``df`` is read
    twice: give it from a checkpoint.
    """
    rows = df.select(F.col(key).alias("k"), F.col(member).alias("m")).where("k is not null and m is not null")
    few = rows.where(F.pmod(F.xxhash64("m"), F.lit(sampled)) == 0).groupBy("k").agg((F.count(F.lit(1)) * sampled).alias("n"))
    hot = cut(few.where(F.col("n") >= hot_members).select("k", F.ceil(F.col("n") / block_members).cast("int").alias("blocks")))
    n_hot, held = sized(hot)
    cold = rows
    if n_hot:
        listed = F.broadcast(hot) if held <= BROADCAST_BYTES else hot
        cold = rows.join(listed, "k", "left_anti")
    # one shuffle by the key serves the removal of repeats, the count and, for small groups, the join
    counted = cold.repartition("k").dropDuplicates(["k", "m"]).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("k"))).where("n > 1")
    out = _blocks_met(_placed(counted.withColumn("blocks", F.ceil(F.col("n") / block_members).cast("int"))))
    if n_hot:
        out = out.unionByName(_blocks_met(_placed(rows.join(listed, "k").repartition("k", "m").dropDuplicates(["k", "m"]))))
    return out.withColumnRenamed("k", key)


def spread_pairs(links: DataFrame, members: DataFrame, block_members: int = BLOCK_MEMBERS) -> DataFrame:
    """(x, y) for every link (a, b) between classes and each two of their members (cls, id).

    Members of a class beyond ``block_members`` are cut into blocks by their ids; a link meets each block under a join
    key of its own, so no task holds a class. Classes are counted with partial sums. Repeated members and links are
    repeated in the result; null classes and ids make no pair. ``members`` is read several times: give it from a checkpoint.
    """
    once = members.where("cls is not null and id is not null")
    large = cut(once.groupBy("cls").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block_members).select("cls", F.ceil(F.col("n") / block_members).cast("int").alias("blocks")))
    if (size := sized(large))[0]:
        listed = F.broadcast(large) if size[1] <= BROADCAST_BYTES else large
        placed = once.join(listed, "cls", "left").withColumn("own", F.coalesce(F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"), F.lit(0)))
        for side in ("a", "b"):
            count = listed.select(F.col("cls").alias(side), F.col("blocks").alias(f"n{side}"))
            links = links.join(count, side, "left").withColumn(f"o{side}", F.explode(F.sequence(F.lit(0), F.coalesce(f"n{side}", F.lit(1)) - 1)))
    else:
        placed = once.withColumn("own", F.lit(0))
        links = links.withColumns({"oa": F.lit(0), "ob": F.lit(0)})
    left = placed.select(F.col("cls").alias("a"), F.col("own").alias("oa"), F.col("id").alias("x"))
    right = placed.select(F.col("cls").alias("b"), F.col("own").alias("ob"), F.col("id").alias("y"))
    return links.select("a", "b", "oa", "ob").join(left, ["a", "oa"]).join(right, ["b", "ob"]).select("x", "y")


#: Most bytes of a table that is broadcast.
BROADCAST_BYTES = 64 << 20


def sized(df: DataFrame) -> tuple[int, int]:
    """Rows of ``df`` and about the bytes they take in memory: 16 a column and what strings, binaries and arrays hold."""
    long = [f.name for f in df.schema.fields if f.dataType.simpleString() in ("string", "binary")]
    nested = [f.name for f in df.schema.fields if f.dataType.simpleString().startswith(("array", "struct", "map"))]
    held = sum((F.coalesce(F.octet_length(f"`{c}`"), F.lit(0)) for c in long), F.lit(0)) + sum((F.coalesce(F.octet_length(F.to_json(F.struct(f"`{c}`"))), F.lit(0)) for c in nested), F.lit(0))
    row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(held), F.lit(0)).alias("held")).first()
    return row.n, row.n * 16 * len(df.columns) + row.held


def within(small: DataFrame, large: DataFrame, on: str, limit_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Rows of ``large`` whose ``on`` is in ``small``, whose rows must be distinct and cheap to count.

    A list of at most ``limit_bytes`` is broadcast, so that the large side isn't shuffled; beyond that it is
    a shuffled semi join. ``small`` is measured for this: give it from a checkpoint.
    """
    if sized(small)[1] <= limit_bytes:
        return large.join(F.broadcast(small), on, "left_semi")
    return large.join(small.hint("shuffle_hash"), on, "left_semi")
