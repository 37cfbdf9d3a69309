"""Queries on blocks and chunks: furniture, sections, page merges, chunks, verdicts, classes, ids, contents."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumflow.functions import ids, quality, vectors, visual
from vellumflow.functions.text import count_words
from vellumflow.operators import chunking, retrieval, structure, toc
from vellumflow.plans.chunk_sql import legacy_sql, page_merge_sql, report_sql, structural_sql
from vellumflow.plans.text_queries import _STRIP, _WORDS, _noise_sql, _sql, _sub
from vellumflow.runtime import table

NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


def _blocks(spark: SparkSession, sf: str) -> DataFrame:
    """Blocks once each, types in small letters; of a block delivered twice the copy ingested first."""
    b = table(spark, sf, "blocks")
    columns = [c for c in b.columns if c not in ("document_id", "block_id")]
    once = b.groupBy("document_id", "block_id").agg(F.min_by(F.struct(*columns), F.struct("ingested_at", F.lower(F.coalesce("block_type", F.lit(""))), "page_number")).alias("r")).select("document_id", "block_id", "r.*")
    return once.withColumn("block_type", F.lower("block_type"))


def repeated_furniture(spark: SparkSession, sf: str) -> DataFrame:
    b = table(spark, sf, "blocks").withColumn("type", F.lower("block_type"))
    return structure.repeated_furniture(b, page="page_number").withColumnRenamed("key", "furniture_key")


_FURNITURE_SQL = r"""with b as (select document_id, lower(block_type) as type, coalesce(text, '') as text, page_number from blocks), p as (select document_id, greatest(count(distinct page_number), 1) as pages from b group by 1),
f as (select document_id, type, lower(trim(regexp_replace(text, '[\t-\r\x1c-\x20\x85\p{Z}]+', ' ', 'g'))) as furniture_key, count(distinct coalesce(page_number, 0)) as pages from b where type in ('header', 'footer') group by all)
select f.document_id, f.type, f.furniture_key, f.pages from f join p using (document_id) where f.pages >= least(3, greatest(2, floor(p.pages * 0.5)))"""


def section_state(spark: SparkSession, sf: str) -> DataFrame:
    b = table(spark, sf, "blocks").select("document_id", "block_id", "order_index", F.lower("block_type").alias("type"), "text", "heading_level").distinct()
    b = b.groupBy("document_id", "block_id").agg(F.min("order_index").alias("position"), F.min("type").alias("type"), F.min("text").alias("text"), F.min("heading_level").alias("level"))
    s = structure.assign_sections(b)
    return s.select("document_id", "block_id", "heading_level", "section_kind", F.array_join("section_path", " > ").alias("section_path"), "effective_type")


def _section_sql() -> str:
    from vellumflow.plans.text_queries import _HEADING_SQL

    kind = _HEADING_SQL[_HEADING_SQL.index("case when regexp_matches(t, '(?i)^\\s*(refer") : _HEADING_SQL.index(" as special")]
    last = ", ".join(f"max(case when h and lev = {k} then {{'o': position, 't': t}} end) over w as h{k}" for k in range(1, 7))
    parts = ", ".join(f"case when h{k} is not null" + "".join(f" and (h{j} is null or h{k}.o > h{j}.o)" for j in range(1, k)) + f" then h{k}.t end" for k in range(1, 7))
    return rf"""with b as (select document_id, block_id, min(order_index) as position, min(lower(block_type)) as type, trim(min(text)) as t, min(heading_level) as level from blocks group by 1, 2 having trim(coalesce(min(text), '')) <> ''),
k as (select *, coalesce(type in ('heading', 'title'), false) as h, {kind} as special, regexp_extract(t, '^\s*(\d+(?:\.\d+)*)\.?\s+\S', 1) as m from b),
l as (select *, least(case when m <> '' then len(string_split(m, '.')) when level >= 1 then level else 1 end, 6)::integer as lev from k),
w as (select *, max(case when h then {{'o': position, 'v': special}} end) over w as ls, max(case when h and special in ('analytical_appendix', 'administrative_appendix') then {{'o': position, 'v': special}} end) over w as la, max(case when h and special is null and m <> '' then 1 end) over w as body, {last}
 from l window w as (partition by document_id order by position, block_id rows unbounded preceding)),
s as (select *, coalesce(ls.v, la.v, case when body = 1 then 'body' end, 'front_matter') as section_kind from w)
select document_id, block_id, case when h then lev end as heading_level, section_kind, array_to_string(list_filter([{parts}], lambda x: x is not null), ' > ') as section_path,
 case when not h and section_kind = 'bibliography' and type in ('paragraph', 'list', 'footnote') then 'reference' else type end as effective_type from s"""


def page_merges(spark: SparkSession, sf: str) -> DataFrame:
    return structure.merge_over_pages(_blocks(spark, sf)).where("merged").select("document_id", "order_index", F.array_join("block_ids", ",").alias("block_ids"), F.array_join("pages", ",").alias("pages"), "text")


def _chunk_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """Blocks with the markdown and caption of tables, as chunking reads them."""
    return _blocks(spark, sf).withColumns({"table_markdown": F.col("metadata.table_markdown"), "caption": F.col("metadata.table_caption")})


def structural_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Chunks of all blocks, lists as strings, and the digest of what goes to an embedding model."""
    good, _ = chunking.chunks(_chunk_blocks(spark, sf), rejected_texts=False)
    joined = {c: F.array_join(c, ",") for c in ("block_ids", "page_numbers", "overlap_block_ids")} | {"section_path": F.array_join("section_path", " > ")}
    fed = F.sha2(chunking.embedding_input(F.col("text"), F.col("contextualized_text")), 256)
    kept = ["document_id", "chunk_index", "chunk_id", "previous_chunk_id", "text", "token_count", "character_count", "content_type", "split_method", "section_kind", "heading_level", "page_start", "page_end", "overlap_token_count", "is_continuation", "first_item", "last_item"]
    return good.select(*kept, fed.alias("input_sha256"), *[v.alias(k) for k, v in joined.items()])


def indexed_points(spark: SparkSession, sf: str) -> DataFrame:
    """Points of one indexing run over all blocks."""
    from vellumflow.plans.indexing import index_documents

    p = index_documents(_chunk_blocks(spark, sf), "run-1").points
    return p.select("id", "chunk_id", "document_id", "chunk_index", "normalized_type", "searchable", F.size("dense").alias("dims"), F.size("sparse").alias("n_tokens"), F.round(vectors.norm(F.col("dense")), 6).alias("length"))


def chunk_report(spark: SparkSession, sf: str) -> DataFrame:
    b = _chunk_blocks(spark, sf)
    good, bad = chunking.chunks(b, rejected_texts=False)
    r = chunking.chunk_report(good, bad, b)
    listed = lambda c: F.array_join(F.transform(F.map_entries(c), lambda e: F.concat_ws("=", e["key"], e["value"])), ",").alias(c)
    return r.select(*[c for c in r.columns if c not in ("blocks_by_type", "rejected_by_reason")], listed("blocks_by_type"), listed("rejected_by_reason"))


def legacy_chunks(spark: SparkSession, sf: str) -> DataFrame:
    b = _blocks(spark, sf).select("document_id", F.col("order_index").alias("position"), chunking.legacy_type(F.col("block_type")).alias("type"), "text")
    return chunking.legacy_chunks(b)


def chunk_verdicts(spark: SparkSession, sf: str) -> DataFrame:
    reason = quality.chunk_reason(F.col("text"), F.col("content_type"), count_words(F.col("text")))
    once = table(spark, sf, "chunks").select("chunk_id", "text", "content_type").distinct()
    return once.select(reason.alias("reason"), "content_type").groupBy("content_type", "reason").agg(F.count(F.lit(1)).alias("n_chunks"))


_VERDICT_SQL = _sub(
    r"""with c as (select distinct chunk_id, text, content_type from chunks), k as (select content_type, coalesce(text, '') as t, @strip@ as s, coalesce(content_type in ('table', 'list', 'figure_caption', 'references', 'formula', 'quote', 'footnote'), false) as exempt, coalesce(content_type in ('paragraph', 'references', 'quote', 'footnote'), false) as noisy from c)
select content_type, case when s = '' then 'vazio' when not exempt and length(regexp_replace(t, '[^a-zA-ZÀ-ÿ0-9]', '', 'g')) < 10 then 'sem_corpo_textual' when noisy and round_even(@noise@, 2) >= 0.65 then 'ruido_ocr_excessivo'
 when not exempt and @words@ < 10 and not (length(s) >= 20 and regexp_matches(s, '^[A-ZÀ-ÚÄ-Ü0-9"''(\[]') and regexp_matches(s, '[.!?;:]$') and len(regexp_extract_all(s, '[^\t-\r\x1c-\x20\x85\p{Z}]+')) >= 5) then 'abaixo_do_minimo_de_tokens' else 'aprovado' end as reason, count(*) as n_chunks from k group by all""",
    strip=_sql(_STRIP, "text"), noise=_noise_sql("t"), words=_sql(_WORDS, "t"),
)


def retrieval_classes(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "chunks").select("chunk_id", F.lower("content_type").alias("kind"), "section_kind").distinct()
    r = retrieval.retrieval_class(F.col("kind"), F.col("section_kind"))
    return c.select("chunk_id", "kind", "section_kind", r.alias("r")).select("chunk_id", "kind", "section_kind", "r.normalized_type", F.array_join("r.profiles", ",").alias("profiles"), "r.searchable", "r.weight", "r.is_table", "r.is_reference", "r.is_appendix")


_CLASS_SQL = """with c as (select distinct chunk_id, lower(content_type) as kind, section_kind from chunks), k as (select *, coalesce(kind, '') as t, coalesce(section_kind, '') as s from c),
f as (select *, t = 'references' or s = 'bibliography' as is_reference, t = 'table' as is_table, t = 'chart' as is_chart, s in ('analytical_appendix', 'administrative_appendix') as is_appendix, s in ('table_of_contents', 'list_of_figures', 'list_of_tables', 'list_of_charts', 'acronym_list') as nav from k),
n as (select *, case when is_reference then 'bibliographic_reference' when is_table then 'structured_table' when is_chart then 'chart' when t = 'list' then case when nav then 'navigation_list' else 'semantic_list' end when t = 'figure_caption' then 'figure_caption' when t in ('formula', 'equation') then 'equation' when t = 'paragraph' then 'body_paragraph' when t = '' then 'unknown' else t end as normalized_type,
 not (s = 'front_matter' or nav or s in ('bibliography', 'administrative_appendix') or is_reference or is_table or is_chart) as searchable from f)
select chunk_id, kind, section_kind, normalized_type, case when is_reference then 'bibliographic' when s = 'front_matter' or nav or s = 'administrative_appendix' then '' when is_table then 'quantitative,methodological' when is_chart then '' when normalized_type = 'equation' then 'methodological' when s = 'analytical_appendix' then 'general,methodological' when normalized_type = 'semantic_list' then 'general' when normalized_type = 'body_paragraph' then 'general,quantitative,methodological' when searchable then 'general' else '' end as profiles,
 searchable, case s when 'analytical_appendix' then 0.85::double when 'administrative_appendix' then 0.40::double end as weight, is_table, is_reference, is_appendix from n"""


def chunk_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Deterministic ids of documents taken as one chunk each, and point ids by name."""
    d = table(spark, sf, "documents")
    made = ids.chunk_id(F.col("doc_id"), F.lit(None), F.sha2(F.coalesce("text", F.lit("")), 256), F.lit("2"), F.lit(chunking.ChunkConfig().hash), F.lit(0), F.col("text"))
    return d.select("doc_id", made.alias("chunk_id"))


_ID_SQL = f"""select doc_id, sha256(concat_ws('|', doc_id::varchar, '', sha256(coalesce(text, '')), '2', '{chunking.ChunkConfig().hash}', '0', sha256(trim(regexp_replace(coalesce(text, ''), '[\\t-\\r\\x1c-\\x20\\x85\\p{{Z}}]+', ' ', 'g'))))) as chunk_id from documents"""


def point_ids(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "chunks").select("chunk_id").distinct().select("chunk_id", ids.uuid5(NAMESPACE, F.col("chunk_id")).alias("point_id"))


_POINT_SQL = f"""with c as (select distinct chunk_id from chunks), h as (select chunk_id, sha1(from_hex('{NAMESPACE.hex}') || encode(chunk_id)) as x from c)
select chunk_id, substr(x, 1, 8) || '-' || substr(x, 9, 4) || '-5' || substr(x, 14, 3) || '-' || lower(to_hex((('0x' || substr(x, 17, 2))::int & 63) | 128)) || substr(x, 19, 2) || '-' || substr(x, 21, 12) as point_id from h"""


def page_spans(spark: SparkSession, sf: str) -> DataFrame:
    """Pages of each chunk, from its numbers."""
    pages = F.array_sort(F.array_distinct(F.filter(F.coalesce("page_numbers", F.array().cast("array<int>")), lambda p: p.isNotNull())))
    c = table(spark, sf, "chunks").select("chunk_id", pages.alias("p")).groupBy("chunk_id").agg(F.max("p").alias("p"))
    return c.select("chunk_id", F.size("p").alias("n_pages"), F.array_min("p").alias("first_page"), F.array_max("p").alias("last_page"))


_PAGES_SQL = "with c as (select chunk_id, max(list_sort(list_distinct(list_filter(coalesce(page_numbers, []), lambda p: p is not null)))) as p from chunks group by 1) select chunk_id, len(p) as n_pages, list_min(p) as first_page, list_max(p) as last_page from c"


def table_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Quality of the tables among the blocks, and their text by rows."""
    b = table(spark, sf, "blocks").where("lower(block_type) = 'table'").select("document_id", "block_id", "section_kind", "text", F.col("metadata.table_caption").alias("caption"), F.col("metadata.table_html").alias("html"), F.col("metadata.table_footnote").alias("note")).distinct()
    return b.select("document_id", "block_id", visual.table_quality(F.col("html"), F.col("caption"), F.col("note"), F.col("section_kind"), F.col("text")).alias("quality"), F.sha2(visual.table_rows_text(F.col("text"), F.col("caption")), 256).alias("rows_sha256"))


def equation_confidence(spark: SparkSession, sf: str) -> DataFrame:
    b = table(spark, sf, "blocks").where("lower(block_type) = 'formula'")
    return b.groupBy(visual.equation_confidence(F.col("text")).alias("confidence")).agg(F.countDistinct("document_id", "block_id").alias("n_blocks"))


_EQUATION_SQL = r"""with b as (select distinct document_id, block_id, regexp_replace(coalesce(text, ''), '^[\t-\r\x1c-\x20\x85\p{Z}]+|[\t-\r\x1c-\x20\x85\p{Z}]+$', '', 'g') as s from blocks where lower(block_type) = 'formula')
select case when s = '' then 0.0::double when regexp_matches(s, '^\s*[_^]?\s*\{?\s*\d{1,3}\s*[\^_]?\s*\{?\s*[oaºª°0]\s*\}?\s*\}?\s*$') or contains(s, 'textdegree') then 0.25
 when regexp_matches(s, '[=<>+×·]|\\(frac|sum|int|prod|sqrt|underbrace|overbrace|times|cdot|le|ge|neq|approx|partial|nabla|alpha|beta|lambda|sigma|mu|log|ln|exp|min|max)\b') and length(s) >= 6 then 0.9 when length(regexp_replace(s, '[\s{}\\]', '', 'g')) < 5 then 0.3 else 0.6 end as confidence, count(*) as n_blocks from b group by 1"""


def toc_entries(spark: SparkSession, sf: str) -> DataFrame:
    """Entries of lists that read as tables of contents."""
    lists = _blocks(spark, sf).where("block_type = 'list'")
    return toc.entries(lists).select("document_id", "block_id", "entry_no", "title", "page", "level", "numbering", "lines")


_TOC_SQL = r"""with b as (select document_id, block_id, min(coalesce(text, '')) as text, arg_min(lower(block_type), (ingested_at, lower(coalesce(block_type, '')), page_number)) as type from blocks group by 1, 2),
l as (select document_id, block_id, generate_subscripts(string_split(text, chr(10)), 1) as k, trim(unnest(string_split(text, chr(10))), ' ' || chr(13)) as x from b where type = 'list'),
m as (select *, regexp_matches(x, '^[\s.·…_–-]*(\d{1,4})\s*$') as alone, regexp_matches(x, '^[\s.·…_–-]*(\d{1,4})\s*$') or regexp_matches(x, '^(.*?)[\s.·…_–-]*[\s.](\d{1,4})\s*$') as closes from l where x <> ''),
g as (select *, coalesce(sum(closes::int) over (partition by document_id, block_id order by k rows between unbounded preceding and 1 preceding), 0) as g from m),
f as (select *, row_number() over (partition by document_id, block_id, g order by k) = 1 as head from g),
p as (select document_id, block_id, g, k, closes, case when alone and not head then '' when closes then regexp_extract(x, '^(.*?)[\s.·…_–-]*[\s.](\d{1,4})\s*$', 1) else x end as part, case when alone then regexp_extract(x, '^[\s.·…_–-]*(\d{1,4})\s*$', 1) when closes then regexp_extract(x, '^(.*?)[\s.·…_–-]*[\s.](\d{1,4})\s*$', 2) end as num from f),
e as (select document_id, block_id, g, list(part order by k) filter (part <> '') as parts, max(try_cast(num as integer)) as page from p group by 1, 2, 3 having max(closes::int) = 1),
t as (select document_id, block_id, g, page, len(parts) as lines, trim(regexp_replace(array_to_string(parts, ' '), '[\t-\r\x1c-\x20\x85\p{Z}]+', ' ', 'g')) as title from e where len(parts) > 0),
q as (select *, count(*) over (partition by document_id, block_id) as n, avg(regexp_matches(title, '(?i)^\s*(tabelas?|quadros?|gr[áa]ficos?|figuras?|mapas?|imagens?|box|ilustra[çc][ãa]o)\s*\d')::int) over (partition by document_id, block_id) as ill from t where title <> '')
select document_id, block_id, (row_number() over (partition by document_id, block_id order by g) - 1)::integer as entry_no, title, page, (case when regexp_extract(title, '^\s*(\d+(?:\.\d+)*)\.?\s+\S', 1) <> '' then least(len(string_split(regexp_extract(title, '^\s*(\d+(?:\.\d+)*)\.?\s+\S', 1), '.')), 6) else 1 end)::integer as level, nullif(regexp_extract(title, '^\s*(\d+(?:\.\d+)*)\.?\s+\S', 1), '') as numbering, lines from q where n >= 3 and ill <= 0.5"""


def _contents(blocks: DataFrame) -> DataFrame:
    """Lists, and the index blocks and paragraphs that may hold a table of contents."""
    return blocks.where("block_type = 'list'").unionByName(toc.contents_blocks(blocks).where("block_type <> 'list'"))


def contents_entries(spark: SparkSession, sf: str) -> DataFrame:
    """As ``toc_entries``, whose SQL knows only lists, but of index blocks and the paragraphs of a contents section too."""
    return toc.entries(_contents(_blocks(spark, sf))).select("document_id", "block_id", "entry_no", "title", "page", "level", "numbering", "lines")


def toc_report(spark: SparkSession, sf: str) -> DataFrame:
    b = _blocks(spark, sf)
    report, findings = toc.validate(b, toc.entries(_contents(b)))
    return toc.summary(report, findings)


QUERIES = {
    "repeated_furniture": (repeated_furniture, _FURNITURE_SQL),
    "section_state": (section_state, _section_sql()),
    "page_merges": (page_merges, page_merge_sql()),
    "structural_chunks": (structural_chunks, structural_sql()),
    "indexed_points": (indexed_points, None),
    "chunk_report": (chunk_report, report_sql()),
    "legacy_chunks": (legacy_chunks, legacy_sql()),
    "chunk_verdicts": (chunk_verdicts, _VERDICT_SQL),
    "retrieval_classes": (retrieval_classes, _CLASS_SQL),
    "chunk_ids": (chunk_ids, _ID_SQL),
    "point_ids": (point_ids, _POINT_SQL),
    "page_spans": (page_spans, _PAGES_SQL),
    "table_texts": (table_texts, None),
    "equation_confidence": (equation_confidence, _EQUATION_SQL),
    "toc_entries": (toc_entries, _TOC_SQL),
    "contents_entries": (contents_entries, None),
    "toc_report": (toc_report, None),
}
