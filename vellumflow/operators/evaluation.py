"""Retrieval evaluation: relevance, precision, recall, hits, reciprocal ranks, gains; by group and between strategies; gold sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellumflow.functions.text import match_key, squash_ws
from vellumflow.operators.pairs import BROADCAST_BYTES, sized
from vellumflow.operators.phrases import phrases_in
from vellumflow.operators.running import running

KS = (1, 3, 5, 10)


def _key(c: Column) -> Column:
    return F.lower(squash_ws(F.coalesce(c, F.lit(""))))


def is_relevant(chunk_doc: Column, chunk_blocks: Column, chunk_text: Column, gold_doc: Column, gold_blocks: Column, span: Column) -> Column:
    """Same document, and a shared block or the answer within the text, both normalised."""
    overlap = F.coalesce(F.arrays_overlap(chunk_blocks, gold_blocks), F.lit(False))
    return (chunk_doc == gold_doc) & (overlap | (F.coalesce(span, F.lit("")) != "") & _key(chunk_text).contains(_key(span)))


def relevant_pairs(chunks: DataFrame, gold: DataFrame) -> DataFrame:
    """(qid, chunk_id): the chunks (chunk_id, document_id, text, block_ids) relevant to each question (qid, gold_doc, gold_block_ids, answer_span).

    The pairs of ``is_relevant``, without a chunk being held against every question of its document: blocks meet by an equal
    join, and all answers are found in one pass over the texts (``phrases.phrases_in``), which are normalised once and
    stay where they are. Rows may be repeated.
    """
    light = lambda df: F.broadcast(df) if sized(df)[1] <= BROADCAST_BYTES else df
    asked = gold.select("qid", F.col("gold_doc").alias("grp"), F.when(F.col("answer_span") != "", _key(F.col("answer_span")).cast("binary")).alias("phrase"))
    blocks = gold.select("qid", F.col("gold_doc").alias("document_id"), F.explode("gold_block_ids").alias("block")).distinct()
    by_block = chunks.select("chunk_id", "document_id", F.explode("block_ids").alias("block")).join(light(blocks), ["document_id", "block"]).select("qid", "chunk_id")
    texts = chunks.select(F.col("chunk_id").alias("id"), F.col("document_id").alias("grp"), "text")
    documents = asked.where("phrase is not null").select("grp").distinct()
    if sized(documents)[1] <= BROADCAST_BYTES:
        texts = texts.join(F.broadcast(documents), "grp", "left_semi")
    found = phrases_in(texts.select("id", "grp", _key(F.col("text")).cast("binary").alias("text")), asked.select("grp", "phrase"))
    by_answer = found.join(light(asked.where("phrase is not null")), ["grp", "phrase"]).select("qid", F.col("id").alias("chunk_id"))
    return by_block.unionByName(by_answer).distinct()


def query_metrics(ranked: DataFrame, totals: DataFrame, ks: tuple[int, ...] = KS) -> DataFrame:
    """A row for each query of ``totals`` (query_id, total_rel): P, R and hit at each k, the first relevant rank and nDCG at the largest k. ``ranked`` has query_id, rank (from 1) and relevant."""
    rel = F.when(F.col("relevant"), 1.0).otherwise(0.0)
    top = max(ks)
    gain = F.sum(F.when(F.col("rank") <= top, rel / F.log2(F.col("rank") + 1.0)).otherwise(0.0))
    found = F.sum(F.when(F.col("rank") <= top, rel).otherwise(0.0))
    sums = [F.sum(F.when(F.col("rank") <= k, rel).otherwise(0.0)).alias(f"s{k}") for k in ks]
    per = totals.join(ranked.groupBy("query_id").agg(*sums, gain.alias("dcg"), found.alias("found"), F.min(F.when(F.col("relevant"), F.col("rank"))).alias("first_rank")), "query_id", "left").na.fill(0.0, [f"s{k}" for k in ks] + ["dcg", "found"])
    ideal = F.aggregate(F.sequence(F.lit(1), F.greatest(F.col("found").cast("int"), F.lit(1))), F.lit(0.0), lambda s, i: s + 1.0 / F.log2(i + 1.0))
    columns = []
    for k in ks:
        columns += [(F.col(f"s{k}") / k).alias(f"p_at_{k}"), F.when(F.col("total_rel") > 0, F.col(f"s{k}") / F.col("total_rel")).otherwise(0.0).alias(f"r_at_{k}"), F.when(F.col(f"s{k}") > 0, 1.0).otherwise(0.0).alias(f"hit_at_{k}")]
    reciprocal = F.when((F.col("first_rank") > 0) & (F.col("first_rank") <= top), 1.0 / F.col("first_rank")).otherwise(0.0)
    return per.select(*totals.columns, *columns, reciprocal.alias("reciprocal_rank"), F.when(F.col("found") > 0, F.col("dcg") / ideal).otherwise(0.0).alias("ndcg"), F.col("first_rank"))


def averages(per_query: DataFrame, *by: str, ks: tuple[int, ...] = KS, digits: int = 4) -> DataFrame:
    """Means of the metrics, over all queries or by groups."""
    names = [f"{m}_at_{k}" for k in ks for m in ("p", "r", "hit")] + ["reciprocal_rank", "ndcg"]
    return per_query.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *[F.round(F.avg(n), digits).alias("mrr" if n == "reciprocal_rank" else n) for n in names])


def averages_by_each(per_query: DataFrame, *by: str, ks: tuple[int, ...] = KS, digits: int = 4) -> DataFrame:
    """Means overall and by each grouping column, in one pass over grouping sets: columns, grouping_name, metrics."""
    names = [f"{m}_at_{k}" for k in ks for m in ("p", "r", "hit")] + ["reciprocal_rank"]
    sets = [[], *[[F.col(c)] for c in by]]
    grouped = per_query.groupingSets(sets, *[F.col(c) for c in by]).agg(F.grouping_id().alias("__g"), F.count(F.lit(1)).alias("n"), *[F.round(F.avg(n), digits).alias("mrr" if n == "reciprocal_rank" else n) for n in names])
    label = F.lit("all")
    for i, c in enumerate(by):
        label = F.when(F.col("__g") == (1 << len(by)) - 1 - (1 << (len(by) - 1 - i)), F.lit(c)).otherwise(label)
    return grouped.withColumn("grouping_name", label).drop("__g")


def compare(first: DataFrame, second: DataFrame, key: str = "query_id") -> DataFrame:
    """Per query what two strategies found first: gained, lost, better, worse or same."""
    a, b = first.select(key, F.col("first_rank").alias("first_a")), second.select(key, F.col("first_rank").alias("first_b"))
    both = a.join(b, key)
    change = (
        F.when(F.col("first_a").isNull() & F.col("first_b").isNotNull(), "gained")
        .when(F.col("first_a").isNotNull() & F.col("first_b").isNull(), "lost")
        .when(F.col("first_b") < F.col("first_a"), "better")
        .when(F.col("first_b") > F.col("first_a"), "worse")
        .otherwise("same")
    )
    return both.withColumn("change", change)


def eligible_passages(chunks: DataFrame, low: int = 60, high: int = 420, kinds: tuple[str, ...] = ("body_paragraph", "structured_table")) -> DataFrame:
    return chunks.where(fit_length(F.col("token_count"), low, high) & F.col("normalized_type").isin(*kinds))


def fit_length(tokens: Column, low: int = 60, high: int = 420) -> Column:
    return tokens.between(low, high)


def stated_well(question: Column, span: Column) -> Column:
    """Whether a question and its answer are long enough to be judged."""
    return (F.length(F.trim(question)) >= 12) & (F.length(F.trim(span)) >= 6)


def spread(df: DataFrame, k: int, order: str) -> DataFrame:
    """``k`` rows evenly spread over the order, a column of different numbers: those at floor(i * n / k)."""
    if k < 1:
        raise ValueError("k must be positive")
    counted = running(df.withColumn("__all", F.lit(0)), ["__all"], order, sums={"__r": F.lit(1)}).withColumn("__r", (F.col("__r") - 1).cast("int")).drop("__all")
    n = df.count()
    if n <= k:
        return counted.drop("__r")
    places = df.sparkSession.range(k).select(F.floor(F.col("id") * n / k).cast("int").alias("__r")).distinct()
    return counted.join(F.broadcast(places), "__r", "left_semi").drop("__r")


def acceptable_gold(gold: DataFrame, passages: DataFrame, key: str = "chunk_id") -> DataFrame:
    """Gold questions of 12 characters or more whose answer has 6 or more and stands in the passage, accents and punctuation aside."""
    rows = gold.join(passages.select(key, F.col("text").alias("__text")), key)
    good = stated_well(F.col("question"), F.col("answer_span")) & match_key(F.col("__text")).contains(match_key(F.col("answer_span")))
    return rows.where(F.coalesce(good, F.lit(False))).drop("__text")
