"""Queries on texts: cleaning, counting, scoring, rejecting, hashing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumflow.functions import ids, quality, text
from vellumflow.operators.chunking import token_statistics
from vellumflow.runtime import table
from vellumflow.sources import documents as readers

#: DuckDB spellings of patterns shared by several queries.
_STRIP = r"regexp_replace(coalesce({0}, ''), '^[\t-\r\x1c-\x20\x85\p{Z}]+|[\t-\r\x1c-\x20\x85\p{Z}]+$', '', 'g')"
_CLEAN = quality.CLEAN.replace("'", "''")
_WORDS = r"len(regexp_extract_all(coalesce({0}, ''), '[^\t-\r\x1c-\x20\x85\p{Z}]+'))"
_URLS = r"""length(list_aggregate(regexp_extract_all(coalesce({0}, ''), '(?i)https?://[^\s<>"'']+|www\.[^\s<>"'']+') || [''], 'string_agg', ''))"""


def _sql(pattern: str, column: str) -> str:
    return pattern.replace("{0}", column)


def _sub(sql: str, **parts: str) -> str:
    for k, v in parts.items():
        sql = sql.replace(f"@{k}@", v)
    return sql


def _noise_sql(t: str) -> str:
    w = r"[\p{L}\p{N}_]"
    s = r"[\t-\r\x1c-\x20\x85\p{Z}]"
    sized = lambda p: f"length(list_aggregate(regexp_extract_all({t}, '{p}') || [''], 'string_agg', ''))"
    count = lambda p: f"len(regexp_extract_all({t}, '{p}'))"
    noise = f"({count(f'[^{_CLEAN}]')} + {count(w + s + w + s + w + s + w)} + {sized(r'\|{2,}')} + {sized('_{3,}')} + {sized(r'\.{4,}')} + 2 * {count(rf'(?:\p{{Nd}}{s}){{5,}}')})"
    return f"(case when length({t}) = 0 then 0.0 else least({noise}::double / length({t}) * 0.5::double + (1.0::double - {count(r'\p{L}')}::double / length({t})) * 0.3::double + {count(r'[^\x00-\x7F\p{L}]')}::double / length({t}) * 0.2::double, 1.0) end)"


def _paragraphs(spark: SparkSession, sf: str) -> DataFrame:
    return readers.paragraphs(table(spark, sf, "documents"))


_PARAGRAPH_SQL = r"""paragraphs as (select document_id, text from (select doc_id as document_id, regexp_replace(unnest(string_split_regex(regexp_replace(text, '\r\n?', chr(10), 'g'), '\n\s*\n')), '^[\t-\r\x1c-\x20\x85\p{Z}]+|[\t-\r\x1c-\x20\x85\p{Z}]+$', '', 'g') as text from documents where text is not null) where text <> '')"""


def rejection_reasons(spark: SparkSession, sf: str) -> DataFrame:
    """Documents by language and the first rule that rejects them."""
    d = table(spark, sf, "documents")
    reason = quality.first_reason(quality.document_rules(F.col("text"), F.lit("paragraph")))
    return d.select("lang", reason.alias("reason")).groupBy("lang", "reason").agg(F.count(F.lit(1)).alias("n_docs"))


_REJECT_SQL = _sub(
    r"""with d as (select lang, coalesce(text, '') as t, @strip@ as s from documents),
k as (select lang, t, s, length(regexp_replace(t, '[^a-zA-ZÀ-ÿ0-9]', '', 'g')) as body, length(regexp_replace(t, '[\t-\r\x1c-\x20\x85\p{Z}]', '', 'g')) as solid, @urls@ as urls, @words@ as words, round_even(@noise@, 2) as noise from d)
select lang, case when body < 10 then 'sem_corpo_textual' when s = '' then 'vazio' when solid > 0 and urls / solid::double > 0.85 then 'apenas_urls'
 when length(s) <= 120 and not contains(s, chr(10)) and not regexp_matches(s, '[.!?;:]$') then 'apenas_titulo' when noise >= 0.65 then 'ruido_ocr_excessivo' when words < 10 then 'abaixo_do_minimo_de_tokens'
 when length(t) < 300 and not (length(s) >= 20 and regexp_matches(s, '^[A-ZÀ-ÚÄ-Ü0-9"''(\[]') and regexp_matches(s, '[.!?;:]$') and len(regexp_extract_all(s, '[^\t-\r\x1c-\x20\x85\p{Z}]+')) >= 5) then 'abaixo_do_minimo_de_caracteres' else 'aprovado' end as reason, count(*) as n_docs from k group by all""",
    strip=_sql(_STRIP, "text"), urls=_sql(_URLS, "t"), words=_sql(_WORDS, "t"), noise=_noise_sql("t"),
)


def token_stats_by_lang(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select("lang", text.count_words(F.col("text")).alias("token_count"))
    return token_statistics(d, "lang").select("lang", "chunk_count", "avg_tokens", "median_tokens", "min_tokens", "max_tokens", "p95_tokens", "below_min", "above_max")


_TOKEN_STATS_SQL = _sub(
    """with t as (select lang, @words@ as n from documents), r as (select *, row_number() over (partition by lang order by n) - 1 as r, count(*) over (partition by lang) as c from t)
select lang, count(*) as chunk_count, round_even(avg(n), 2) as avg_tokens, median(n) as median_tokens, min(n) as min_tokens, max(n) as max_tokens, max(case when r = floor(c * 0.95) then n end) as p95_tokens, count_if(n < 80) as below_min, count_if(n > 768) as above_max from r group by lang""",
    words=_sql(_WORDS, "text"),
)


def ocr_noise(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", F.round(quality.ocr_noise(F.col("text"), None), 9).alias("noise"))


def quality_score(spark: SparkSession, sf: str) -> DataFrame:
    t = F.col("text")
    score = quality.quality_score(t, quality.ocr_noise(t, None), quality.is_heading_only(t), F.lit("paragraph"), None)
    return table(spark, sf, "documents").select("doc_id", F.round(score, 9).alias("quality"))


_QUALITY_SQL = _sub(
    r"""with d as (select doc_id, coalesce(text, '') as t, @strip@ as s from documents), k as (select *, @noise@ as noise, @urls@ as urls, @words@ as words from d)
select doc_id, round(greatest(0.0, 1.0 - (noise * 0.35::double + case when s <> '' and length(s) <= 120 and not contains(s, chr(10)) and not regexp_matches(s, '[.!?;:]$') then 0.30::double else 0.0 end
 + case when length(t) < 200 then (1.0::double - length(t) / 200::double) * 0.20::double else 0.0 end + case when words < 15 then 0.4::double else 0.0 end + case when length(t) > 0 and urls / length(t)::double > 0.6 then 0.25::double else 0.0 end)), 9) as quality from k""",
    strip=_sql(_STRIP, "text"), noise=_noise_sql("t"), urls=_sql(_URLS, "t"), words=_sql(_WORDS, "t"),
)


def normalized_text_hash(spark: SparkSession, sf: str) -> DataFrame:
    t = text.normalize_text(F.col("text"))
    return table(spark, sf, "documents").select("doc_id", F.length(t).alias("n_chars_clean"), ids.text_hash(t).alias("text_sha256"))


_NORMALIZE_SQL = _sub(
    r"""with a as (select doc_id, regexp_replace(regexp_replace(coalesce(text, ''), '\r\n?', chr(10), 'g'), '[@inv@]', '', 'g') as t from documents),
b as (select doc_id, translate(regexp_replace(t, '([A-Za-zÀ-ÿ])-\n([a-zà-ÿ])', '\1\2', 'g'), '@src@', '@dst@') as t from a),
c as (select doc_id, regexp_replace(regexp_replace(regexp_replace(t, '[\x00-\x08\x0b-\x1f\x7f-\x9f]', '', 'g'), '\n', ' ', 'g'), '[ \t]+', ' ', 'g') as t from b),
d as (select doc_id, regexp_replace(regexp_replace(t, '([A-Za-zÀ-ÿ])\s+([,.;:!?])', '\1\2', 'g'), '^[\t-\r\x1c-\x20\x85\p{Z}]+|[\t-\r\x1c-\x20\x85\p{Z}]+$', '', 'g') as t from c)
select doc_id, length(t) as n_chars_clean, sha256(trim(regexp_replace(t, '[\t-\r\x1c-\x20\x85\p{Z}]+', ' ', 'g'))) as text_sha256 from d""",
    inv=text.INVISIBLE, src="".join(text.QUOTES) + text.ODD_SPACES, dst="".join(text.QUOTES.values()).replace("'", "''") + " " * len(text.ODD_SPACES),
)


def sentence_split_counts(spark: SparkSession, sf: str) -> DataFrame:
    parts = text.split_sentences(F.coalesce(F.col("text"), F.lit("")))
    return table(spark, sf, "documents").select("doc_id", F.size(parts).alias("n_sentences"), F.array_max(F.transform(parts, F.length)).alias("longest"))


_SENTENCE_SQL = r"""with s as (select doc_id, string_split(regexp_replace(regexp_replace(coalesce(text, ''), '([.!?…])\s+([A-ZÀ-Ú0-9"''(\[])', '\1␞\2', 'g'), '([.!?…])\s+([A-ZÀ-Ú0-9"''(\[])', '\1␞\2', 'g'), '␞') as p from documents)
select doc_id, len(p) as n_sentences, list_max(list_transform(p, lambda x: length(x))) as longest from s"""


def paragraph_lengths(spark: SparkSession, sf: str) -> DataFrame:
    return _paragraphs(spark, sf).groupBy("document_id").agg(F.count(F.lit(1)).alias("n_paragraphs"), F.sum(F.length("text")).alias("n_chars"))


def markdown_line_classes(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "documents").where("text is not null").select("doc_id", F.explode(F.split(F.regexp_replace("text", r"\r\n?", "\n"), "\n")).alias("line"))
    return lines.groupBy("doc_id", readers.line_class(text.strip_ws(F.col("line"))).alias("kind")).agg(F.count(F.lit(1)).alias("n_lines"))


_LINE_SQL = r"""with l as (select doc_id, regexp_replace(unnest(string_split(regexp_replace(text, '\r\n?', chr(10), 'g'), chr(10))), '^[\t-\r\x1c-\x20\x85\p{Z}]+|[\t-\r\x1c-\x20\x85\p{Z}]+$', '', 'g') as x from documents where text is not null)
select doc_id, case when regexp_matches(x, '^#{1,6}\s+') then 'heading' when length(x) - length(replace(x, '|', '')) >= 2 then 'table' when regexp_matches(x, '^([-*+]|\d+[.)])\s+.+$') then 'list' when x = '' then 'blank' else 'text' end as kind, count(*) as n_lines from l group by all"""


def markdown_blocks(spark: SparkSession, sf: str) -> DataFrame:
    return readers.markdown_blocks(table(spark, sf, "documents"))


_MARKDOWN_SQL = r"""with l as (select doc_id as document_id, generate_subscripts(string_split(regexp_replace(coalesce(text, ''), '\r\n?', chr(10), 'g'), chr(10)), 1) as k, unnest(string_split(regexp_replace(coalesce(text, ''), '\r\n?', chr(10), 'g'), chr(10))) as y from documents),
m as (select document_id, k, regexp_replace(y, '^[\t-\r\x1c-\x20\x85\p{Z}]+|[\t-\r\x1c-\x20\x85\p{Z}]+$', '', 'g') as x from l),
c as (select *, contains(x, '|') as pipe, case when regexp_matches(x, '^#{1,6}\s+') then 'heading' when length(x) - length(replace(x, '|', '')) >= 2 then 'table' when regexp_matches(x, '^([-*+]|\d+[.)])\s+.+$') then 'list' when x = '' then 'blank' else 'paragraph' end as own from m),
t as (select *, max(case when own = 'table' then k end) over w as last_table, max(case when not pipe then k end) over w as last_bare from c window w as (partition by document_id order by k rows unbounded preceding)),
n as (select *, case when pipe and last_table > coalesce(last_bare, 0) then 'table' else own end as type from t),
o as (select *, case when type = 'heading' or type is distinct from lag(type) over (partition by document_id order by k) then 1 else 0 end as opens from n),
g as (select *, sum(opens) over (partition by document_id order by k rows unbounded preceding) as g from o),
b as (select document_id, g, type, min(length(regexp_extract(x, '^(#{1,6})', 1))) as level, list(case type when 'heading' then regexp_replace(x, '^#{1,6}[\s\p{Z}]+', '') when 'list' then '- ' || regexp_replace(x, '^([-*+]|\d+[.)])[\s\p{Z}]+', '') else x end order by k) as xs from g where type <> 'blank' group by 1, 2, 3),
r as (select *, row_number() over (partition by document_id order by g) - 1 as position, case when type = 'paragraph' then trim(regexp_replace(array_to_string(xs, ' '), '[\t-\r\x1c-\x20\x85\p{Z}]+', ' ', 'g')) else array_to_string(xs, chr(10)) end as text from b)
select document_id, position::integer as position, type, case when type = 'heading' then level::integer end as level, text, case when type = 'list' then len(xs)::integer end as items from r where text <> ''"""


def word_pieces(spark: SparkSession, sf: str) -> DataFrame:
    """Texts in pieces of 128 words."""
    return table(spark, sf, "documents").select("doc_id", F.posexplode(text.word_pieces(F.col("text"), 128)).alias("piece_no", "piece")).select("doc_id", "piece_no", F.sha2("piece", 256).alias("piece_sha256"))


_PIECES_SQL = r"""with w as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\t-\r\x1c-\x20\x85\p{Z}]+') as w from documents), p as (select doc_id, w, unnest(range(0, ((len(w) + 127) // 128))) as i from w)
select doc_id, i::integer as piece_no, sha256(array_to_string(w[i * 128 + 1 : i * 128 + 128], ' ')) as piece_sha256 from p"""


def heading_numbers(spark: SparkSession, sf: str) -> DataFrame:
    b = table(spark, sf, "blocks").where("lower(block_type) in ('heading', 'title')")
    t = F.col("text")
    return b.select("document_id", "block_id", text.numbering_of(t).alias("numbering"), text.heading_level(t, F.col("heading_level")).alias("level"), text.special_section(t).alias("special"), text.is_short_title(t).alias("short_title")).distinct()


_HEADING_SQL = r"""with h as (select distinct document_id, block_id, coalesce(text, '') as t, heading_level from blocks where lower(block_type) in ('heading', 'title')),
k as (select *, regexp_extract(t, '^\s*(\d+(?:\.\d+)*)\.?\s+', 1) as n, regexp_extract(t, '^\s*(\d+(?:\.\d+)*)\.?\s+\S', 1) as m, regexp_replace(t, '^[\t-\r\x1c-\x20\x85\p{Z}]+|[\t-\r\x1c-\x20\x85\p{Z}]+$', '', 'g') as s from h)
select document_id, block_id, nullif(n, '') as numbering, (case when m <> '' then least(len(string_split(m, '.')), 6) when heading_level >= 1 then heading_level else 1 end)::integer as level,
 case when regexp_matches(t, '(?i)^\s*(refer[êe]ncias?|bibliografia|references|bibliography|obras\s+citadas)([^\p{L}\p{N}_]|$)') then 'bibliography' when regexp_matches(t, '(?i)(lista|[íi]ndice)\s+de\s+figuras') then 'list_of_figures'
 when regexp_matches(t, '(?i)(lista|[íi]ndice)\s+de\s+(tabelas|quadros)') then 'list_of_tables' when regexp_matches(t, '(?i)(lista|[íi]ndice)\s+de\s+gr[áa]ficos') then 'list_of_charts'
 when regexp_matches(t, '(?i)lista\s+de\s+(siglas|abreviaturas|abreviaç[õo]es|s[íi]mbolos)|siglas\s+e\s+abreviaturas|lista\s+de\s+acr[ôo]nimos') then 'acronym_list'
 when regexp_matches(t, '(?i)^\s*(sum[áa]rio|conte[úu]do)([^\p{L}\p{N}_]|$)') or (regexp_matches(t, '(?i)^\s*[íi]ndice([^\p{L}\p{N}_]|$)') and not regexp_matches(t, '(?i)^\s*[íi]ndice\s+de')) then 'table_of_contents'
 when regexp_matches(t, '(?i)^\s*(ap[êe]ndices?|anexos?)([^\p{L}\p{N}_]|$)') then case when regexp_matches(t, '(?i)(^|[^\p{L}\p{N}_])(instrumento|formul[áa]rio|question[áa]rio|roteiro|termo\s+de\s+refer[êe]ncia|participantes?|entrevistad|lista\s+de\s+presen|documentos?\s+consultad|cronograma|matriz\s+de|of[íi]cio|portaria|ata)([^\p{L}\p{N}_]|$)') then 'administrative_appendix' else 'analytical_appendix' end end as special,
 length(s) <= 15 and len(regexp_extract_all(t, '[^\t-\r\x1c-\x20\x85\p{Z}]+')) <= 2 as short_title from k"""


def match_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Comparable forms of document titles, by how many documents share one: only titles of characters up to U+024F, which its SQL folds alike; ``title_keys`` takes all."""
    return table(spark, sf, "documents").where(F.col("title").rlike("^[\\x00-\\u024F]*$")).groupBy(text.match_key(F.col("title")).alias("title_key")).agg(F.count(F.lit(1)).alias("n_docs"))


_KEY_SQL = r"""select trim(regexp_replace(regexp_replace(lower(strip_accents(title)), '[^\p{L}\p{N}_\s]', ' ', 'g'), '[\t-\r\x1c-\x20\x85\p{Z}]+', ' ', 'g')) as title_key, count(*) as n_docs from documents where regexp_full_match(title, '[\x00-\x{024F}]*') group by 1"""


def title_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Comparable forms of all document titles in any script, by how many documents share one; the key is empty without a title."""
    return table(spark, sf, "documents").groupBy(text.match_key(F.col("title")).alias("title_key")).agg(F.count(F.lit(1)).alias("n_docs"))


def strange_words(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", F.size(text.strange_words(F.col("text"))).alias("n_strange"))


_FOUR_TIMES = "|".join(c + "{4,}" for c in "abcdefghijklmnopqrstuvwxyz0123456789-")
_STRANGE_SQL = rf"""with w as (select doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[\p{{L}}\p{{N}}_÷×-]+')) as w from documents), k as (select doc_id, regexp_replace(strip_accents(lower(w)), '^[^\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_]+$', '', 'g') as n from w),
s as (select doc_id, count_if(length(n) > 2 and (regexp_matches(n, '[^a-z0-9\-]') or length(n) > 28 or regexp_matches(n, '[bcdfghjklmnpqrstvwxyz]{{5,}}') or (length(n) >= 8 and length(regexp_replace(n, '[^aeiou]', '', 'g')) / length(n)::double < 0.25) or regexp_matches(n, '{_FOUR_TIMES}') or regexp_matches(n, '[a-z]+\d+[a-z]+|\d+[a-z]+\d+'))) as n from k group by 1)
select doc_id, coalesce(n, 0)::integer as n_strange from documents left join s using (doc_id)"""


def broken_words(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", F.size(text.broken_words(F.col("text"))).alias("n_broken"))


def acronym_lines(spark: SparkSession, sf: str) -> DataFrame:
    """First expansion of each acronym in the blocks of a document."""
    from vellumflow.operators.structure import acronyms

    return acronyms(table(spark, sf, "blocks").dropDuplicates(["document_id", "block_id"]), order="order_index")


_ACRONYM_SQL = r"""with b as (select distinct document_id, block_id, order_index, text from blocks where text is not null),
l as (select document_id, order_index, generate_subscripts(string_split(text, chr(10)), 1) as k, unnest(string_split(text, chr(10))) as x from b),
m as (select document_id, order_index, k, regexp_replace(x, '^[\t-\r\x1c-\x20\x85\p{Z}]+|[\t-\r\x1c-\x20\x85\p{Z}]+$', '', 'g') as x from l),
e as (select document_id, order_index, k, trim(regexp_extract(x, '^\s*(?:[-•*]\s*)?([A-ZÀ-Ú][A-ZÀ-Ú0-9./&-]{1,15})\s*(?:[—–:\-]|\s{2,})\s*([A-Za-zÀ-ÿ].{3,})$', 1), ' .—–:-') as sigla, trim(regexp_extract(x, '^\s*(?:[-•*]\s*)?([A-ZÀ-Ú][A-ZÀ-Ú0-9./&-]{1,15})\s*(?:[—–:\-]|\s{2,})\s*([A-Za-zÀ-ÿ].{3,})$', 2)) as expansion from m)
select document_id, sigla, arg_min(expansion, (order_index, k)) as expansion from e where length(sigla) >= 2 and expansion <> '' group by 1, 2"""


QUERIES = {
    "rejection_reasons": (rejection_reasons, _REJECT_SQL),
    "token_stats_by_lang": (token_stats_by_lang, _TOKEN_STATS_SQL),
    "ocr_noise": (ocr_noise, f"select doc_id, round({_noise_sql('t')}, 9) as noise from (select doc_id, coalesce(text, '') as t from documents)"),
    "quality_score": (quality_score, _QUALITY_SQL),
    "normalized_text_hash": (normalized_text_hash, _NORMALIZE_SQL),
    "sentence_split_counts": (sentence_split_counts, _SENTENCE_SQL),
    "paragraph_lengths": (paragraph_lengths, f"with {_PARAGRAPH_SQL} select document_id, count(*) as n_paragraphs, sum(length(text)) as n_chars from paragraphs group by 1"),
    "markdown_line_classes": (markdown_line_classes, _LINE_SQL),
    "markdown_blocks": (markdown_blocks, _MARKDOWN_SQL),
    "word_pieces": (word_pieces, _PIECES_SQL),
    "heading_numbers": (heading_numbers, _HEADING_SQL),
    "match_keys": (match_keys, _KEY_SQL),
    "title_keys": (title_keys, None),
    "strange_words": (strange_words, _STRANGE_SQL),
    "broken_words": (broken_words, None),
    "acronym_lines": (acronym_lines, _ACRONYM_SQL),
}
