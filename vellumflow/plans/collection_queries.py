"""Queries of collections and queues: vectors joined, statistics of an index, orphans, flags of failure."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumflow.operators import state
from vellumflow.runtime import table
from vellumflow.sources import collections


def _points(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Documents as chunks, with the embeddings of the same number as dense vectors and their signs as sparse ones."""
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("chunk_id"), "text", "lang", "source")
    e = table(spark, sf, "embeddings")
    sparse = F.map_from_entries(F.filter(F.transform("embedding", lambda x, i: F.struct(i, x.cast("double").alias("w"))), lambda p: p["w"] > 0))
    return collections.with_vectors(d, e.select(F.col("vec_id").alias("chunk_id"), F.col("embedding").alias("dense")), e.select(F.col("vec_id").alias("chunk_id"), sparse.alias("sparse")))


def joined_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with their vectors, by number of dimensions, and those without."""
    whole, without = _points(spark, sf)
    return whole.groupBy(F.size("dense").alias("dims")).agg(F.count(F.lit(1)).alias("n_docs")).unionByName(without.groupBy().agg(F.lit(0).alias("dims"), F.count(F.lit(1)).alias("n_docs")).where("n_docs > 0"))


def index_statistics(spark: SparkSession, sf: str) -> DataFrame:
    return collections.index_statistics(_points(spark, sf)[0], "lang")


def replaced_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Chunks by document after the older way of indexing documents of the first half of the digits again with their first chunks alone."""
    c = table(spark, sf, "chunks").select("chunk_id", "document_id", "chunk_index").distinct()
    names = c.where("substring(document_id, 1, 1) < '8'")
    return collections.replace_documents(c, names, names.where("chunk_index = 0")).groupBy("document_id").agg(F.count(F.lit(1)).alias("n_points"))


def queue_orphans(spark: SparkSession, sf: str) -> DataFrame:
    """Jobs waiting for documents, as queue entries: whether their document has a manifest."""
    queue = table(spark, sf, "job_records").where("job_id is not null").select("job_id", "document_id").distinct()
    rows, orphans = state.queue_entries(queue, table(spark, sf, "manifests"), "document_id")
    return rows.select("job_id", "document_id", F.lit(False).alias("orphan")).unionByName(orphans.select("job_id", "document_id", F.lit(True).alias("orphan")))


def failed_flags(spark: SparkSession, sf: str) -> DataFrame:
    """Every job and whether an index error was recorded for it."""
    j = table(spark, sf, "job_records").where("job_id is not null")
    return state.flagged(j.select("job_id").distinct(), j.where("index_error is not null"), "job_id", "has_failure")


_WHOLE = "w as (select d.doc_id, d.text, d.lang, e.embedding from (select doc_id, text, lang from documents) d left join embeddings e on e.vec_id = d.doc_id)"
QUERIES = {
    "joined_vectors": (joined_vectors, f"with {_WHOLE} select coalesce(len(embedding), 0)::integer as dims, count(*) as n_docs from w group by 1"),
    "index_statistics": (index_statistics, f"with {_WHOLE} select lang, count(*) as n_points, round(avg(len(list_filter(embedding, lambda x: x > 0))::double), 2) as avg_sparse_tokens, sum(length(text))::bigint as n_chars from w where embedding is not null group by 1"),
    "replaced_documents": (replaced_documents, "with c as (select distinct chunk_id, document_id, chunk_index from chunks) select document_id, count(*) as n_points from c where substr(document_id, 1, 1) >= '8' or chunk_index = 0 group by 1"),
    "queue_orphans": (queue_orphans, "select distinct job_id, document_id, document_id is null or document_id not in (select document_id from manifests where document_id is not null) as orphan from job_records where job_id is not null"),
    "failed_flags": (failed_flags, "select job_id, max((index_error is not null)::int) = 1 as has_failure from job_records where job_id is not null group by 1"),
}
