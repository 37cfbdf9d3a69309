"""Collections of points: created with a number of dimensions, filled by runs, and read as the last whole run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def with_vectors(chunks: DataFrame, dense: DataFrame, sparse: DataFrame, key: str = "chunk_id") -> tuple[DataFrame, DataFrame]:
    """(chunks with the columns dense and sparse, chunks without one of them): given vectors joined by the chunk's key.

    ``dense`` and ``sparse`` have the key and a column of their name; of repeated keys one row counts, that of the largest
    vector for dense ones. Null keys have no vectors.
    """
    d = dense.where(F.col(key).isNotNull()).groupBy(key).agg(F.max("dense").alias("dense"))
    s = sparse.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by("sparse", F.to_json("sparse")).alias("sparse"))
    both = chunks.join(d, key, "left").join(s, key, "left")
    whole = F.col("dense").isNotNull() & F.col("sparse").isNotNull()
    return both.where(whole), both.where(~whole).select(*chunks.columns)


def index_statistics(points: DataFrame, *by: str, seconds: float | None = None) -> DataFrame:
    """Points, mean number of sparse tokens (2 digits), characters, and characters a second of a run's duration, over all or by groups."""
    rate = [F.round(F.sum(F.length("text")) / F.lit(seconds), 2).alias("chars_per_second")] if seconds else []
    return points.groupBy(*by).agg(F.count(F.lit(1)).alias("n_points"), F.round(F.avg(F.size("sparse").cast("double")), 2).alias("avg_sparse_tokens"), F.sum(F.length("text")).alias("n_chars"), *rate)


def replace_documents(points: DataFrame, names: DataFrame, new: DataFrame, document: str = "document_id") -> DataFrame:
    """The older way to index again: all points of the named documents go first, whether or not new ones come; then the new ones are put in."""
    return points.join(names.select(document).distinct(), document, "left_anti").unionByName(new, allowMissingColumns=True)


def _pointer(folder: str) -> str:
    return f"{folder}/current"


def create(spark: SparkSession, folder: str, dims: int, reset: bool = False) -> bool:
    """Makes a collection for dense vectors of ``dims`` numbers; True when it is new or was reset. One that is there with other dimensions is an error unless it is reset."""
    if dims < 1:
        raise ValueError("a vector has a dimension at least")
    there = _read_pointer(spark, folder)
    if there is not None and not reset:
        if there[0] != dims:
            raise ValueError(f"the collection has {there[0]} dimensions")
        return False
    _write_pointer(spark, folder, dims, "")
    return True


def write_run(points: DataFrame, folder: str, run_id: str) -> DataFrame:
    """Writes all points of a collection as one run and then points to it, so readers see whole runs only; returns what was written.

    A dense vector of another length than the collection's is an error before anything is written. Writing a run again
    replaces it.
    """
    spark = points.sparkSession
    there = _read_pointer(spark, folder)
    if there is None:
        raise ValueError("no collection here")
    if not run_id or "/" in run_id:
        raise ValueError("a run needs a name without slashes")
    if points.where(F.coalesce(F.size("dense") != there[0], F.lit(True))).limit(1).count():
        raise ValueError(f"vectors of other than {there[0]} dimensions")
    points.write.mode("overwrite").parquet(f"{folder}/runs/{run_id}")
    _write_pointer(spark, folder, there[0], run_id)
    return spark.read.parquet(f"{folder}/runs/{run_id}")


def read(spark: SparkSession, folder: str) -> DataFrame | None:
    """Points of the last whole run; None before the first."""
    there = _read_pointer(spark, folder)
    return spark.read.parquet(f"{folder}/runs/{there[1]}") if there and there[1] else None


def _write_pointer(spark: SparkSession, folder: str, dims: int, run_id: str) -> None:
    spark.createDataFrame([(dims, run_id)], "dims int, run_id string").coalesce(1).write.mode("overwrite").json(_pointer(folder))


def _read_pointer(spark: SparkSession, folder: str) -> tuple[int, str] | None:
    path = spark._jvm.org.apache.hadoop.fs.Path(_pointer(folder))
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    row = spark.read.schema("dims int, run_id string").json(_pointer(folder)).first()
    return (row.dims, row.run_id) if row else None
