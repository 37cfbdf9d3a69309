"""Search over points: retrieval classes, null-aware filters, dense, sparse and fused top-k."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellumflow.functions.vectors import absent_safe_not
from vellumflow.operators.chunking import NAVIGATION
from vellumflow.operators.pairs import BROADCAST_BYTES, sized
from vellumflow.runtime import cut, ship_package

#: Queries and points that meet in one task, and postings of a token in one block.
QUERY_BLOCK, POINT_BLOCK, HOT_POSTINGS = 4096, 65_536, 100_000
RRF_C = 60
PROFILES = ("general", "quantitative", "methodological", "bibliographic")


def retrieval_class(content_type: Column, section_kind: Column, origin: Column | None = None, confident: Column | None = None) -> Column:
    """struct(normalized_type, profiles, searchable, weight, is_table, is_chart, is_reference, is_appendix) of a chunk."""
    origin = F.lit(None).cast("string") if origin is None else origin
    sure = F.coalesce(F.lit(False) if confident is None else confident, F.lit(False))
    kind, section = F.coalesce(content_type, F.lit("")), F.coalesce(section_kind, F.lit(""))
    reference = (kind == "references") | (section == "bibliography")
    appendix = section.isin("analytical_appendix", "administrative_appendix")
    table = kind == "table"
    chart = (F.coalesce(origin, F.lit("")) == "chart") | (kind == "chart")
    navigation = section.isin(*NAVIGATION)
    normal = (
        F.when(reference, "bibliographic_reference").when(table, "structured_table").when(chart, "chart").when(kind == "list", F.when(navigation, "navigation_list").otherwise("semantic_list"))
        .when(kind == "figure_caption", "figure_caption").when(kind.isin("formula", "equation"), "equation").when(kind == "paragraph", "body_paragraph").when(kind == "", "unknown").otherwise(kind)
    )
    hidden = (section == "front_matter") | navigation | (section == "bibliography") | (section == "administrative_appendix") | reference | table | chart
    names = lambda *n: F.array(*map(F.lit, n)) if n else F.array().cast("array<string>")
    profiles = (
        F.when(reference, names("bibliographic"))
        .when((section == "front_matter") | navigation | (section == "administrative_appendix"), names())
        .when(table, names("quantitative", "methodological"))
        .when(chart, F.when(sure, names("quantitative")).otherwise(names()))
        .when(normal == "equation", names("methodological"))
        .when(section == "analytical_appendix", names("general", "methodological"))
        .when(normal == "semantic_list", names("general"))
        .when(normal == "body_paragraph", names("general", "quantitative", "methodological"))
        .otherwise(F.when(~hidden, names("general")).otherwise(names()))
    )
    weight = F.when(section == "analytical_appendix", 0.85).when(section == "administrative_appendix", 0.40)
    return F.struct(normal.alias("normalized_type"), profiles.alias("profiles"), (~hidden).alias("searchable"), weight.alias("weight"), table.alias("is_table"), chart.alias("is_chart"), reference.alias("is_reference"), appendix.alias("is_appendix"))


def profile_filter(profile: str | None, searchable: Column, is_reference: Column, section_kind: Column) -> Column:
    """Which points a profile searches. What must hold must be known to hold; what must not hold may be unknown."""
    if profile == "bibliographic":
        return is_reference.eqNullSafe(F.lit(True))
    if profile in ("quantitative", "methodological"):
        return absent_safe_not(is_reference) & absent_safe_not(section_kind.isin("front_matter", *NAVIGATION, "administrative_appendix", "bibliography"))
    if profile in (None, "general"):
        return searchable.eqNullSafe(F.lit(True))
    raise ValueError(f"unknown profile {profile!r}")


def search_filter(columns: list[str], item: str | None = None, document: str | None = None, profile: str | None = None, filtering: bool = True, min_visual_confidence: float | None = 0.8) -> Column:
    """All pre-filters of a search; blank arguments are ignored, profiles act only where filtering is on or one is named."""
    out = F.lit(True)
    if item and item.strip():
        out = out & (F.col("item_uuid") == item.strip())
    if document and document.strip():
        out = out & (F.col("document_id") == document.strip())
    if filtering or profile:
        out = out & profile_filter(profile, F.col("searchable"), F.col("is_reference"), F.col("section_kind"))
    if min_visual_confidence is not None and "chart_data_confidence" in columns:
        out = out & absent_safe_not(F.col("chart_data_confidence") < min_visual_confidence)
    return out


def check_limit(limit: int, largest: int = 50) -> int:
    if not 1 <= limit <= largest:
        raise ValueError(f"limit must be 1 to {largest}")
    return limit


def dense_topk(points: DataFrame, queries: DataFrame, k: int, id_col: str = "id", vector: str = "vector", query_id: str = "query_id", query_vector: str = "vector", digits: int = 9, query_block: int = QUERY_BLOCK, point_block: int = POINT_BLOCK) -> DataFrame:
    """(query_id, id, score, rank): the ``k`` most similar points of each query by cosine, ties by id; exact.

    Queries are a stated set. Points and queries are cut into blocks by hashes, and each block of points meets each block of
    queries under a join key of its own, so a task holds one block of each whatever the sizes; it keeps its best ``k`` a
    query, and these are ranked. Nothing goes through the driver but two counts. Points are read once and sent as often as
    there are blocks of queries. Null vectors and those without length match nothing; vectors of another length than the
    query's neither. Equal (query, vector) rows count once.
    """
    check_limit(k, 100_000)
    ship_package(points.sparkSession)
    id_type, query_type = points.schema[id_col].dataType, queries.schema[query_id].dataType
    schema = T.StructType([T.StructField("query_id", query_type), T.StructField("id", id_type), T.StructField("score", T.DoubleType())])
    listed = queries.where(F.col(query_vector).isNotNull()).select(F.col(query_id).alias("q"), F.col(query_vector).cast("array<double>").alias("v")).distinct()
    rows = points.where(F.col(vector).isNotNull()).select(F.col(id_col).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    n_queries, n_points = (max(1, -(-df.count() // size)) for df, size in ((listed, query_block), (rows, point_block)))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.withColumn("pb", F.pmod(F.xxhash64("id", "v"), F.lit(n_points)).cast("int")).withColumn("qb", every(n_queries))
    right = listed.withColumn("qb", F.pmod(F.xxhash64("q", "v"), F.lit(n_queries)).cast("int")).withColumn("pb", every(n_points))

    def go(p: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        found = []
        p_sizes, q_sizes = p["v"].map(len), q["v"].map(len)
        for n in q_sizes.unique():
            own, asked = p[p_sizes == n], q[q_sizes == n]
            if not len(own) or not n:
                continue
            x, y = (np.stack(f["v"].to_numpy()).astype(np.float64) for f in (own, asked))
            with np.errstate(divide="ignore", invalid="ignore"):
                unit = y / np.linalg.norm(y, axis=1)[:, None]
                scores = np.round((x / np.sqrt((x * x).sum(axis=1))[:, None]) @ unit.T, digits)
            ids = own["id"].to_numpy()
            for j, name in enumerate(asked["q"]):
                s = scores[:, j]
                ok = np.flatnonzero(~np.isnan(s))
                if len(ok) > k:
                    edge = np.partition(s[ok], len(ok) - k)[len(ok) - k]
                    ok = ok[s[ok] >= edge]
                best = pd.DataFrame({"query_id": name, "id": ids[ok], "score": s[ok]})
                found.append(best.sort_values(["score", "id"], ascending=[False, True]).head(k))
        return pd.concat(found) if found else pd.DataFrame({"query_id": [], "id": [], "score": []})

    out = left.groupBy("pb", "qb").cogroup(right.groupBy("pb", "qb")).applyInPandas(go, schema)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("id")))
    return out.withColumn("rank", rank).where(F.col("rank") <= k)


def term_weights(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, token, weight): how often each word of letters and digits, in small letters, stands in a text."""
    words = F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    return df.select(F.col(id_col).alias("id"), F.explode(words).alias("token")).groupBy("id", "token").agg(F.count(F.lit(1)).cast("double").alias("weight"))


def sparse_topk(points: DataFrame, queries: DataFrame, k: int, hot_postings: int = HOT_POSTINGS) -> DataFrame:
    """(query_id, id, score, rank) from postings (id, token, weight): sums of products over shared tokens, ties by id. Only points sharing a token are candidates.

    Queries' postings are broadcast where their bytes are few. Beyond that a token with more than ``hot_postings`` points is
    cut into blocks of them, which its queries meet under keys of their own.
    """
    check_limit(k, 100_000)
    q = queries.select(F.col("id").alias("query_id"), "token", F.col("weight").alias("qw"))
    if sized(q)[1] <= BROADCAST_BYTES:
        met = points.join(F.broadcast(q), "token")
    else:
        hot = points.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_postings).select("token", F.ceil(F.col("n") / hot_postings).cast("int").alias("blocks"))
        hot = cut(hot)
        listed = F.broadcast(hot) if sized(hot)[1] <= BROADCAST_BYTES else hot
        mine = points.join(listed, "token", "left").withColumn("b", F.coalesce(F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"), F.lit(0))).drop("blocks")
        asked = q.join(listed, "token", "left").withColumn("b", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1))).drop("blocks")
        met = mine.join(asked, ["token", "b"])
    scored = met.groupBy("query_id", "id").agg(F.sum(F.col("weight") * F.col("qw")).alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("id")))
    return scored.withColumn("rank", rank).where(F.col("rank") <= k)


def fuse(dense: DataFrame, sparse: DataFrame, k: int, c: int = RRF_C) -> DataFrame:
    """(query_id, id, score, rank): reciprocal rank fusion of two ranked lists; a list without the point adds nothing. Ranks count from 0 in the formula."""
    a = dense.select("query_id", "id", F.col("rank").alias("dense_rank"))
    b = sparse.select("query_id", "id", F.col("rank").alias("sparse_rank"))
    part = lambda r: F.coalesce(1.0 / (F.lit(c) + F.col(r) - 1), F.lit(0.0))
    both = a.join(b, ["query_id", "id"], "full").withColumn("score", part("dense_rank") + part("sparse_rank"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("id")))
    return both.withColumn("rank", rank).where(F.col("rank") <= k)


def fuse_all(points: DataFrame, queries: DataFrame, postings: DataFrame, query_postings: DataFrame, k: int, c: int = RRF_C, depth: int = 100_000) -> DataFrame:
    """Reciprocal rank fusion where both legs rank all points, not twice the limit alone (query_id, id, score, rank).

    The dense leg ranks every point of up to ``depth``; the sparse one every point that shares a token, and those without
    one follow it by id with a score of 0.
    """
    dense = dense_topk(points, queries, depth)
    scored = sparse_topk(postings, query_postings, depth).select("query_id", "id", "score")
    all_rows = dense.select("query_id", "id").join(scored, ["query_id", "id"], "left").na.fill(0.0, ["score"])
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("id")))
    return fuse(dense, all_rows.withColumn("rank", rank), k, c)


def search(points: DataFrame, queries: DataFrame, kind: str, limit: int, postings: DataFrame | None = None, query_postings: DataFrame | None = None, where: Column | None = None) -> DataFrame:
    """Ranked points of each query: dense, sparse or hybrid (both legs to twice the limit, then fused). An unknown kind is dense. Filters act before ranking."""
    check_limit(limit)
    kept = points if where is None else points.where(where)
    if kind in ("sparse", "hybrid"):
        if postings is None or query_postings is None:
            raise ValueError("sparse search needs postings of points and queries")
        mine = postings.join(kept.select("id"), "id", "left_semi")
        legs = sparse_topk(mine, query_postings, limit if kind == "sparse" else 2 * limit)
        if kind == "sparse":
            return legs
        return fuse(dense_topk(kept, queries, 2 * limit), legs, limit)
    return dense_topk(kept, queries, limit)


def result_rows(ranked: DataFrame, payload: DataFrame) -> DataFrame:
    """Ten result fields: structural names, else the older ones; the score on 4 digits."""
    has = set(payload.columns)
    pick = lambda *names: F.coalesce(*[F.col(n).cast("string") for n in names if n in has], F.lit(None).cast("string"))
    rows = ranked.join(payload, "id")
    return rows.select("query_id", "rank", "id", F.bround("score", 4).alias("score"), pick("document_id", "doc_id").alias("doc_id"), pick("text", "content").alias("text"), pick("section_title", "section").alias("section"), pick("page_start", "page").alias("page"), pick("content_type", "type").alias("type"), pick("item_uuid").alias("item_uuid"))


def payload(chunks: DataFrame, extra: DataFrame | None = None, key: str = "document_id") -> DataFrame:
    """Chunk columns with document metadata of the same key; a metadata column never hides a chunk column but comes beside it as meta_<name>."""
    if extra is None:
        return chunks
    renamed = extra.select(key, *[F.col(c).alias(f"meta_{c}" if c in chunks.columns else c) for c in extra.columns if c != key])
    return chunks.join(renamed, key, "left")
