"""Running values over ordered rows of a group, without one task per group.

A document may hold a tenth of all rows. Rows are therefore cut into buckets of order numbers: each bucket is
summed up, the few bucket rows are scanned in a window, and the rows of each bucket continue from what the
buckets before it leave. Only bucket rows of a group ever meet in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET = 4096


def running(df: DataFrame, keys: Sequence[str], order: str, tie: str | None = None, sums: Mapping[str, Column] | None = None, lasts: Mapping[str, Column] | None = None, maxima: Mapping[str, Column] | None = None, bucket: int = BUCKET, exclusive: bool = False) -> DataFrame:
    """``df`` with running values up to and including each row (``exclusive``: up to the row before): sums, last non-null values and maxima.

    ``order`` is a number; rows with equal order go by ``tie``, and must lie in one bucket, which they do. Null
    orders come first. Null keys form a group of their own.
    """
    sums, lasts, maxima = dict(sums or {}), dict(lasts or {}), dict(maxima or {})
    b = F.floor(F.coalesce(F.col(order), F.lit(-1)) / bucket)
    place = F.struct(F.coalesce(F.col(order), F.lit(-1)).alias("o"), (F.col(tie) if tie else F.lit(0)).alias("t"))
    rows = df.withColumn("__b", b).withColumns({f"__s_{k}": v for k, v in sums.items()} | {f"__l_{k}": v for k, v in lasts.items()} | {f"__m_{k}": v for k, v in maxima.items()})
    held = [F.sum(f"__s_{k}").alias(f"__ps_{k}") for k in sums] + [F.max(F.when(F.col(f"__l_{k}").isNotNull(), F.struct(place.alias("p"), F.col(f"__l_{k}").alias("v")))).alias(f"__pl_{k}") for k in lasts] + [F.max(f"__m_{k}").alias(f"__pm_{k}") for k in maxima]
    buckets = rows.groupBy(*keys, "__b").agg(*held)
    before = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    carried = buckets.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col("__b").alias("__kb"), *[F.sum(f"__ps_{k}").over(before).alias(f"__ps_{k}") for k in sums], *[F.max(f"__pl_{k}").over(before)["v"].alias(f"__pl_{k}") for k in lasts], *[F.max(f"__pm_{k}").over(before).alias(f"__pm_{k}") for k in maxima])
    same = F.col("__b") == F.col("__kb")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    inside = Window.partitionBy(*keys, "__b").orderBy(F.col(order).asc_nulls_first(), *([F.col(tie)] if tie else [])).rowsBetween(Window.unboundedPreceding, -1 if exclusive else 0)
    out = rows.join(carried, same, "left")
    values = {k: F.coalesce(F.col(f"__ps_{k}"), F.lit(0)) + F.coalesce(F.sum(f"__s_{k}").over(inside), F.lit(0)) for k in sums}
    values |= {k: F.coalesce(F.last(f"__l_{k}", ignorenulls=True).over(inside), F.col(f"__pl_{k}")) for k in lasts}
    values |= {k: F.greatest(F.max(f"__m_{k}").over(inside), F.col(f"__pm_{k}")) for k in maxima}
    added = [F.col(k) for k in df.columns if k not in values]
    return out.select(*added, *[v.alias(k) for k, v in values.items()])
