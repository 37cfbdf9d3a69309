"""Queries of single kernels and small aggregates that no other query covers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumflow.functions import ids, text
from vellumflow.operators import chunking, state
from vellumflow.plans.chunk_sql import capitals_sql
from vellumflow.runtime import table
from vellumflow.sources import stores

_WS = text.WS[1:-1]


def _once(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    return table(spark, sf, "chunks").select("chunk_id", *columns).distinct()


def block_histogram(spark: SparkSession, sf: str) -> DataFrame:
    """Blocks of each document by type, as the report counts them."""
    b = table(spark, sf, "blocks").select("document_id", "block_id", F.lower("block_type").alias("block_type")).distinct()
    return chunking.blocks_by_type(b).withColumnRenamed("k", "type").withColumnRenamed("count", "n_blocks")


def context_hashes(spark: SparkSession, sf: str) -> DataFrame:
    """Chunks with their section before the text, as they go to an embedding model."""
    c = table(spark, sf, "chunks").groupBy("chunk_id").agg(F.min("text").alias("text"), F.max("section_path").alias("path"))
    full = chunking.contextualised(F.col("text"), F.lit(None).cast("string"), F.col("path"))
    return c.select("chunk_id", full.isNotNull().alias("has_context"), F.sha2(chunking.embedding_input(F.col("text"), full), 256).alias("input_sha256"))


_CONTEXT_SQL = """with c as (select chunk_id, min(text) as t, max(section_path) as p from chunks group by 1)
select chunk_id, coalesce(len(p), 0) > 0 as has_context, sha256(case when coalesce(len(p), 0) > 0 then 'Seção: ' || array_to_string(p, ' > ') || chr(10) || chr(10) || t else t end) as input_sha256 from c"""


def artifact_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Artifacts of manifests by bucket and kind: how many, how large, and how many have a key that is refused."""
    a = table(spark, sf, "manifests").select(F.explode("artifacts").alias("name", "a")).select("name", F.col("a.uri").alias("uri"), F.col("a.size_bytes").alias("size"))
    p = ids.parse_uri(F.col("uri"))
    return a.groupBy(p["bucket"].alias("bucket"), "name").agg(F.count(F.lit(1)).alias("n_artifacts"), F.sum("size").alias("total_bytes"), F.count_if(ids.object_key_problem(p["key"]).isNotNull()).alias("n_refused"))


_KEYS_SQL = r"""with a as (select unnest(map_entries(artifacts)) as e from manifests), k as (select e.key as name, e.value.size_bytes as size, regexp_extract(e.value.uri, '^s3://([^/]+)/(.+)$', 1) as bucket, regexp_extract(e.value.uri, '^s3://([^/]+)/(.+)$', 2) as key, e.value.uri as uri from a)
select case when uri is not null then bucket end as bucket, name, count(*) as n_artifacts, sum(size)::bigint as total_bytes, count_if(coalesce(trim(case when uri is not null then key end), '') = '' or regexp_matches(key, '^[/\\]|^[A-Za-z]:') or regexp_matches(key, '(^|[/\\])\.\.([/\\]|$)') or regexp_matches(key, '[\x00-\x1f]')) as n_refused from k group by all"""


def sentence_ends(spark: SparkSession, sf: str) -> DataFrame:
    """Chunks by type that look complete, and that end in the middle of a sentence."""
    c = _once(spark, sf, "text", "content_type")
    return c.groupBy("content_type").agg(F.count(F.lit(1)).alias("n_chunks"), F.count_if(text.looks_complete(F.col("text"))).alias("n_complete"), F.count_if(text.cut_mid_sentence(F.col("text"))).alias("n_cut"))


_ENDS_SQL = rf"""with c as (select distinct chunk_id, text, content_type from chunks), k as (select content_type, right(regexp_replace(coalesce(text, ''), '[{_WS}]+$', ''), 1) as e from c)
select content_type, count(*) as n_chunks, count_if(e in ('.', '!', '?', '…', '”', '"', ')')) as n_complete, count_if(e <> '' and not regexp_matches(e, '[.!?…:;”"''»)\]|]')) as n_cut from k group by 1"""


def event_properties(spark: SparkSession, sf: str) -> DataFrame:
    """JSON properties of events, by type: how many can be read, their sum and their length in bytes."""
    e = table(spark, sf, "events").select("event_type", F.from_json("props", "k BIGINT").alias("p"))
    return e.groupBy("event_type").agg(F.count("p.k").alias("n_read"), F.sum("p.k").alias("total"), F.sum(ids.json_bytes(F.col("p"))).alias("json_bytes"))


_PROPS_SQL = "with e as (select event_type, try_cast(json_extract(props, '$.k') as bigint) as k from events) select event_type, count(k) as n_read, sum(k)::bigint as total, sum(octet_length(encode('{\"k\":' || k || '}')))::bigint as json_bytes from e group by 1"


def clean_capitals(spark: SparkSession, sf: str) -> DataFrame:
    """Documents whose spaced capitals the older cleaning joins, and the length of what is left."""
    t = text.spaced_capitals(F.col("text"))
    return table(spark, sf, "documents").groupBy("source").agg(F.sum(F.length(t)).alias("n_chars"), F.count_if(t != text.squash_ws(F.coalesce("text", F.lit("")))).alias("n_joined"))


def clamped_priorities(spark: SparkSession, sf: str) -> DataFrame:
    """Events by their value read as a priority within bounds."""
    p = state.clamp_priority(F.floor("value").cast("int"), 10, 60, 50)
    return table(spark, sf, "events").groupBy(p.alias("priority")).agg(F.count(F.lit(1)).alias("n_events"))


def review_flags(spark: SparkSession, sf: str) -> DataFrame:
    """Whether a chunk needs a look: by the mean of what is known of its quality, and where nothing is."""
    q = table(spark, sf, "chunk_quality").select("chunk_id", F.when((F.col("quality_score") >= 0) & (F.col("quality_score") <= 1), F.col("quality_score")).alias("a"), F.when((F.col("ocr_noise_score") >= 0) & (F.col("ocr_noise_score") <= 1), 1 - F.col("ocr_noise_score")).alias("b"), "needs_llm_repair").distinct()
    have = {"title_confidence": F.col("a"), "authors_confidence": F.col("b"), "needs_review": F.col("needs_llm_repair")}
    stated = F.struct(*[have.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in stores.METADATA.fields])
    return q.select(stated.alias("m")).groupBy(stores.needs_review(F.col("m")).alias("review")).agg(F.count(F.lit(1)).alias("n_rows"))


_REVIEW_SQL = """with q as (select distinct chunk_id, case when not isnan(quality_score) and quality_score between 0 and 1 then quality_score end as a, case when not isnan(ocr_noise_score) and ocr_noise_score between 0 and 1 then 1 - ocr_noise_score end as b, needs_llm_repair from chunk_quality)
select coalesce(needs_llm_repair, case when a is null and b is null then true else (coalesce(a, 0) + coalesce(b, 0)) / ((a is not null)::int + (b is not null)::int) < 0.6 end) as review, count(*) as n_rows from q group by 1"""


def stored_text_heads(spark: SparkSession, sf: str) -> DataFrame:
    """First 64 characters of stored texts by source, as a bounded read gives them, by their digests."""
    d = table(spark, sf, "documents").where("text is not null")
    return d.select("doc_id", F.octet_length(F.encode("text", "utf-8")).cast("bigint").alias("size_bytes"), F.sha2("text", 256).alias("sha256"), F.sha2(F.left(stores.as_text(F.encode("text", "utf-8")), F.lit(64)), 256).alias("head_sha256"))


_CAPITALS_SQL = f"with d as (select source, {capitals_sql('text')} as t, trim(regexp_replace(coalesce(text, ''), '[{_WS}]+', ' ', 'g')) as plain from documents) select source, sum(length(t))::bigint as n_chars, count_if(t <> plain) as n_joined from d group by 1"


QUERIES = {
    "block_histogram": (block_histogram, "select document_id, coalesce(lower(block_type), 'unknown') as type, count(distinct block_id) as n_blocks from blocks group by 1, 2"),
    "context_hashes": (context_hashes, _CONTEXT_SQL),
    "artifact_keys": (artifact_keys, _KEYS_SQL),
    "sentence_ends": (sentence_ends, _ENDS_SQL),
    "event_properties": (event_properties, _PROPS_SQL),
    "clean_capitals": (clean_capitals, _CAPITALS_SQL),
    "clamped_priorities": (clamped_priorities, "select least(greatest(coalesce(floor(value)::int, 50), 10), 60)::int as priority, count(*) as n_events from events group by 1"),
    "review_flags": (review_flags, _REVIEW_SQL),
    "stored_text_heads": (stored_text_heads, "select doc_id, octet_length(encode(text))::bigint as size_bytes, sha256(text) as sha256, sha256(left(text, 64)) as head_sha256 from documents where text is not null"),
}
