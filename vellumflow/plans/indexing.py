"""From blocks to searchable points: chunk, set faulty documents aside, embed, replace what was indexed before."""

from __future__ import annotations

import uuid
import zlib
from collections import Counter
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumflow.functions import ids, vectors
from vellumflow.functions.text import words
from vellumflow.operators import chunking, retrieval, state
from vellumflow.runtime import ship_package

NAMESPACE = uuid.UUID("6ba7b812-9dad-11d1-80b4-00c04fd430c8")


@dataclass(frozen=True)
class IndexRun:
    """Points after a run, the documents set aside with their reason, and the documents the run took up."""

    points: DataFrame | None
    quarantine: DataFrame | None
    documents: DataFrame


def embed(chunks: DataFrame, dims: int = 32, text: str = "contextualized_text") -> DataFrame:
    """Chunks with a dense vector and a map of token weights. The vectors are a deterministic stand-in; a model's come in the same columns."""
    ship_package(chunks.sparkSession)

    @F.pandas_udf("map<string,double>")
    def weights(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: {str(zlib.crc32(w.encode())): float(n) for w, n in Counter((t or "").lower().split()).items()})

    shown = F.coalesce(F.col(text), F.col("text"))
    return chunks.withColumns({"dense": vectors.hashed_embedding(words(F.lower(shown)), dims), "sparse": weights(shown)})


def index_documents(blocks: DataFrame, run_id: str, points: DataFrame | None = None, titles: DataFrame | None = None, cfg: chunking.ChunkConfig = chunking.ChunkConfig(), force: bool = False, only: list[str] | None = None, dims: int = 32, dry_run: bool = False, limit: int | None = None) -> IndexRun:
    """Indexes the documents of ``blocks`` that aren't indexed under this configuration yet, or all with ``force``.

    A document with a chunk above the hard limit is set aside as a whole and keeps its old points. Of documents
    taken up only the new points stay. Running it again takes up nothing and changes nothing. ``only`` restricts
    the run to named documents, ``limit`` to the first so many by name of those that it would take up. A ``dry_run`` only
    says which: its points are those of before and nothing is set aside.
    """
    documents = blocks.select("document_id").distinct().withColumn("config_hash", F.lit(cfg.hash))
    if only is not None:
        documents = documents.where(F.col("document_id").isin(*only))
    if points is not None and not force:
        documents = state.not_indexed(documents, points, version="config_hash")
    if limit is not None:
        documents = documents.orderBy("document_id").limit(limit)
    if dry_run:
        return IndexRun(points, None, documents)
    todo = blocks.join(documents.select("document_id"), "document_id", "left_semi")
    good, bad = chunking.chunks(todo, titles, cfg, rejected_texts=False)
    faulty = bad.where("reason = 'too_large'").groupBy("document_id").agg(F.max("token_count").alias("largest_chunk")).withColumn("reason", F.lit("chunk above the hard limit"))
    kept = good.join(faulty.select("document_id"), "document_id", "left_anti")
    r = retrieval.retrieval_class(F.col("content_type"), F.col("section_kind"))
    made = embed(kept.withColumn("r", r), dims).select("*", "r.normalized_type", "r.profiles", "r.searchable", "r.weight", "r.is_table", "r.is_reference", "r.is_appendix", F.lit(run_id).alias("run_id"), ids.uuid5(NAMESPACE, F.col("chunk_id")).alias("id")).drop("r")
    after = made if points is None else state.replace_run(points, made)
    return IndexRun(after, faulty, documents)
