"""Queries of retrieval and its evaluation. Query sets are the rows whose id is divisible by 50, against all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumflow.functions import vectors
from vellumflow.functions.text import query_profile
from vellumflow.operators import evaluation, retrieval
from vellumflow.runtime import table

K = 10


def _points(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label")


def _vector_queries(spark: SparkSession, sf: str) -> DataFrame:
    return _points(spark, sf).where("id % 50 = 0").select(F.col("id").alias("query_id"), "vector", "label")


def _dense(spark: SparkSession, sf: str, k: int = K) -> DataFrame:
    return retrieval.dense_topk(_points(spark, sf), _vector_queries(spark, sf), k)


_DENSE_SQL = """dense as (select q.vec_id as query_id, p.vec_id as id, round(list_dot_product(p.embedding::double[], q.embedding::double[]) / (sqrt(list_dot_product(p.embedding::double[], p.embedding::double[])) * sqrt(list_dot_product(q.embedding::double[], q.embedding::double[]))), 9) as score from embeddings q, embeddings p where q.vec_id % 50 = 0),
dense_ranked as (select *, row_number() over (partition by query_id order by score desc, id) as rank from dense)"""


def dense_topk(spark: SparkSession, sf: str) -> DataFrame:
    return _dense(spark, sf).select("query_id", "id", F.round("score", 6).alias("score"), "rank")


def _terms(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Word counts of all chunks and of the questions of the query set."""
    chunks = table(spark, sf, "chunks").select("chunk_id", "text").distinct()
    questions = table(spark, sf, "gold_questions").where("qid % 50 = 0").select("qid", "question").distinct()
    return retrieval.term_weights(chunks, "chunk_id", "text"), retrieval.term_weights(questions, "qid", "question")


_SPARSE_SQL = r"""ct as (select chunk_id as id, unnest(regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+')) as token from (select distinct chunk_id, text from chunks)), cw as (select id, token, count(*)::double as w from ct group by 1, 2),
qt as (select qid as query_id, unnest(regexp_extract_all(lower(coalesce(question, '')), '[\p{L}\p{N}]+')) as token from (select distinct qid, question from gold_questions where qid % 50 = 0)), qw as (select query_id, token, count(*)::double as w from qt group by 1, 2),
sparse as (select query_id, id, sum(cw.w * qw.w) as score from cw join qw using (token) group by 1, 2), sparse_ranked as (select *, row_number() over (partition by query_id order by score desc, id) as rank from sparse)"""


def sparse_topk(spark: SparkSession, sf: str) -> DataFrame:
    points, queries = _terms(spark, sf)
    return retrieval.sparse_topk(points, queries, K)


def _label_postings(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """A sparse side for the embeddings: their coordinates above 0.1 as weighted tokens."""
    p = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.posexplode("embedding").alias("token", "w")).where("w > 0.1").select("id", "token", F.round(F.col("w").cast("double"), 4).alias("weight"))
    return p, p.where("id % 50 = 0")


def hybrid_topk(spark: SparkSession, sf: str) -> DataFrame:
    postings, query_postings = _label_postings(spark, sf)
    fused = retrieval.search(_points(spark, sf), _vector_queries(spark, sf), "hybrid", K, postings, query_postings)
    return fused.select("query_id", "id", F.round("score", 9).alias("score"), "rank")


_HYBRID_SQL = f"""with {_DENSE_SQL}, po as (select vec_id as id, i as token, round(embedding[i]::double, 4) as w from (select vec_id, embedding, unnest(range(1, len(embedding) + 1)) as i from embeddings) where embedding[i] > 0.1),
sp as (select b.id as query_id, a.id as id, round(sum(a.w * b.w), 9) as score from po a join po b using (token) where b.id % 50 = 0 group by 1, 2), sr as (select *, row_number() over (partition by query_id order by score desc, id) as rank from sp),
f as (select coalesce(d.query_id, s.query_id) as query_id, coalesce(d.id, s.id) as id, coalesce(1.0::double / (60 + d.rank - 1), 0) + coalesce(1.0::double / (60 + s.rank - 1), 0) as score from (select * from dense_ranked where rank <= 20) d full join (select * from sr where rank <= 20) s on d.query_id = s.query_id and d.id = s.id),
r as (select *, row_number() over (partition by query_id order by score desc, id) as rank from f) select query_id, id, round(score, 9) as score, rank from r where rank <= 10"""


def filtered_search(spark: SparkSession, sf: str) -> DataFrame:
    """General, quantitative and bibliographic search over flags of which some are unknown."""
    flagged = _points(spark, sf).withColumns(
        {
            "searchable": F.when(F.col("id") % 7 != 0, F.col("id") % 3 != 0),
            "is_reference": F.when(F.col("id") % 5 != 0, F.col("id") % 4 == 0),
            "section_kind": F.when(F.col("id") % 6 == 0, F.lit("front_matter")).when(F.col("id") % 6 == 1, F.lit("bibliography")).when(F.col("id") % 6 == 2, F.lit("body")),
            "chart_data_confidence": F.when(F.col("id") % 8 == 0, F.lit(0.5)).when(F.col("id") % 8 == 1, F.lit(0.9)),
        }
    )
    out = None
    for profile in ("general", "quantitative", "bibliographic"):
        kept = flagged.where(retrieval.search_filter(flagged.columns, profile=profile))
        found = retrieval.dense_topk(kept, _vector_queries(spark, sf), 5).select(F.lit(profile).alias("profile"), "query_id", "id", "rank")
        out = found if out is None else out.unionByName(found)
    return out


_FILTER_SQL = f"""with {_DENSE_SQL}, p as (select vec_id as id, case when vec_id % 7 <> 0 then vec_id % 3 <> 0 end as searchable, case when vec_id % 5 <> 0 then vec_id % 4 = 0 end as is_reference, case vec_id % 6 when 0 then 'front_matter' when 1 then 'bibliography' when 2 then 'body' end as section_kind, case vec_id % 8 when 0 then 0.5 when 1 then 0.9 end as conf from embeddings),
a as (select 'general' as profile, id from p where searchable and not coalesce(conf < 0.8, false) union all select 'quantitative', id from p where not coalesce(is_reference, false) and not coalesce(section_kind in ('front_matter', 'bibliography'), false) and not coalesce(conf < 0.8, false) union all select 'bibliographic', id from p where is_reference and not coalesce(conf < 0.8, false)),
r as (select profile, query_id, id, row_number() over (partition by profile, query_id order by score desc, id) as rank from dense join a using (id)) select profile, query_id, id, rank from r where rank <= 5"""


def _per_query(spark: SparkSession, sf: str) -> DataFrame:
    points, queries = _points(spark, sf), _vector_queries(spark, sf)
    ranked = _dense(spark, sf, K + 1).where("query_id <> id")
    labelled = ranked.join(points.select("id", "label"), "id").join(queries.select("query_id", F.col("label").alias("query_label")), "query_id")
    judged = labelled.select("query_id", (F.row_number().over(_by_score())).alias("rank"), (F.col("label") == F.col("query_label")).alias("relevant"))
    sizes = points.groupBy("label").agg((F.count(F.lit(1)) - 1).alias("total_rel"))
    totals = queries.join(sizes, "label").select("query_id", "total_rel", "label")
    return evaluation.query_metrics(judged.where(F.col("rank") <= K), totals)


def _by_score():
    from pyspark.sql import Window

    return Window.partitionBy("query_id").orderBy(F.desc("score"), "id")


_METRIC_SQL = f"""with {_DENSE_SQL}, own as (select query_id, id, row_number() over (partition by query_id order by score desc, id) as rank from (select *, row_number() over (partition by query_id order by score desc, id) as r0 from dense) where r0 <= 11 and query_id <> id),
j as (select o.query_id, o.rank, a.label = b.label as rel from own o join embeddings a on a.vec_id = o.id join embeddings b on b.vec_id = o.query_id where o.rank <= 10), t as (select vec_id as query_id, label, (select count(*) - 1 from embeddings x where x.label = e.label) as total_rel from embeddings e where vec_id % 50 = 0),
m as (select t.query_id, t.label, t.total_rel, count_if(rel and rank <= 1) as s1, count_if(rel and rank <= 3) as s3, count_if(rel and rank <= 5) as s5, count_if(rel) as s10, min(case when rel then rank end) as first from t left join j using (query_id) group by all)"""
_MEANS = "count(*) as n, " + ", ".join(f"round(avg(s{k} / {k}.0::double), 4) as p_at_{k}, round(avg(case when total_rel > 0 then s{k} / total_rel::double else 0 end), 4) as r_at_{k}, round(avg((s{k} > 0)::int), 4) as hit_at_{k}" for k in (1, 3, 5, 10)) + ", round(avg(coalesce(1.0::double / first, 0)), 4) as mrr"


def retrieval_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.averages(_per_query(spark, sf)).drop("ndcg")


def metrics_by_group(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.averages_by_each(_per_query(spark, sf), "label")


def gain_at_ten(spark: SparkSession, sf: str) -> DataFrame:
    return _per_query(spark, sf).select("query_id", F.round("ndcg", 6).alias("ndcg"))


_GAIN_SQL = _METRIC_SQL + ", g as (select t.query_id, coalesce(sum(case when rel then 1 / log2(rank + 1) end), 0) as dcg, count_if(rel) as found from t left join j using (query_id) group by 1) select query_id, round(case when found > 0 then dcg / list_sum(list_transform(range(1, found::bigint + 1), lambda i: 1 / log2(i + 1))) else 0 end, 6) as ndcg from g"


def strategy_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Dense search over all points as against over the points that a general search sees: first relevant ranks by query."""
    points, queries = _points(spark, sf), _vector_queries(spark, sf)

    def first(kept: DataFrame) -> DataFrame:
        found = retrieval.dense_topk(kept, queries, 20).where("query_id <> id").join(points.select("id", "label"), "id").join(queries.select("query_id", F.col("label").alias("ql")), "query_id")
        return queries.select("query_id").join(found.groupBy("query_id").agg(F.min(F.when(F.col("label") == F.col("ql"), F.col("rank"))).alias("first_rank")), "query_id", "left")

    return evaluation.compare(first(points), first(points.where("id % 3 <> 0"))).select("query_id", "first_a", "first_b", "change")


_CHANGE_SQL = f"""with {_DENSE_SQL}, a as (select query_id, min(case when x.label = y.label then rank end) as first_a from dense_ranked d join embeddings x on x.vec_id = d.id join embeddings y on y.vec_id = d.query_id where rank <= 20 and query_id <> id group by 1),
br as (select query_id, id, row_number() over (partition by query_id order by score desc, id) as rank from dense where id % 3 <> 0), b as (select query_id, min(case when x.label = y.label then rank end) as first_b from br d join embeddings x on x.vec_id = d.id join embeddings y on y.vec_id = d.query_id where rank <= 20 and query_id <> id group by 1),
q as (select vec_id as query_id from embeddings where vec_id % 50 = 0) select query_id, first_a, first_b, case when first_a is null and first_b is not null then 'gained' when first_a is not null and first_b is null then 'lost' when first_b < first_a then 'better' when first_b > first_a then 'worse' else 'same' end as change from q left join a using (query_id) left join b using (query_id)"""


def query_profiles(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "gold_questions").groupBy(query_profile(F.col("question")).alias("profile")).agg(F.count(F.lit(1)).alias("n_questions"))


_PROFILE_SQL = r"""with q as (select coalesce(question, '') as q from gold_questions) select case
 when regexp_matches(q, '(?i)quais?\s+(?:os\s+|as\s+)?autor|\bque\s+autores?\b|\bautoria\b|quem\s+(?:escreveu|é\s+o\s+autor|são\s+os\s+autores)|(?:obras?|trabalhos?|estudos?|autores?|refer[êe]ncias?|artigos?|pesquisas?)\s+citad|refer[êe]ncias?\s+bibliogr|\bbibliografia\b|fonte\s+bibliogr|cita[çc][õo]es\s+bibliogr')
  and not regexp_matches(q, '(?i)(segundo|conforme|de\s+acordo\s+com|para|na\s+vis[ãa]o\s+d[eo]s?|de\s+autores?\s+como)\s+os?\s+autor|os\s+autores?\s+(afirm|apont|conclu|mostr|defend|identific|observ|sugere|indic)') then 'bibliographic'
 when regexp_matches(q, '(?i)(^|[^\p{L}\p{N}_])(metodolog|m[ée]todo|modelo|econom[ée]tric|regress|estimativ|amostra|vari[áa]vel|c[áa]lculo|como\s+(foi|foram|se)\s+[\p{L}\p{N}_]*(calcul|estim|avali|model))([^\p{L}\p{N}_]|$)') then 'methodological'
 when regexp_matches(q, '(?i)(^|[^\p{L}\p{N}_])(quant[oa]s?|qual\s+foi|quanto\s+custou|valor(es)?|percentu|propor[çc]|m[ée]dia|total|n[úu]mero\s+de)([^\p{L}\p{N}_]|$)|(^|[^\p{L}\p{N}_])R\$|\d%|%|(^|[^\p{L}\p{N}_])(19|20)\d{2}([^\p{L}\p{N}_]|$)') then 'quantitative' else 'general' end as profile, count(*) as n_questions from q group by 1"""


def gold_relevance(spark: SparkSession, sf: str) -> DataFrame:
    """Chunks of a question's document that hold its answer or a gold block."""
    g = table(spark, sf, "gold_questions").select("qid", F.col("doc_id").alias("gold_doc"), "gold_block_ids", "answer_span").distinct()
    c = table(spark, sf, "chunks").select("chunk_id", "document_id", "text", "block_ids")
    return evaluation.relevant_pairs(c, g)


_RELEVANT_SQL = r"""with g as (select distinct qid, doc_id, gold_block_ids, lower(trim(regexp_replace(coalesce(answer_span, ''), '[\t-\r\x1c-\x20\x85\p{Z}]+', ' ', 'g'))) as span, answer_span from gold_questions), c as (select distinct chunk_id, document_id, lower(trim(regexp_replace(coalesce(text, ''), '[\t-\r\x1c-\x20\x85\p{Z}]+', ' ', 'g'))) as t, block_ids from chunks)
select distinct qid, chunk_id from c join g on c.document_id = g.doc_id where coalesce(list_has_any(block_ids, gold_block_ids), false) or (coalesce(answer_span, '') <> '' and contains(t, span))"""


def lexical_maxima(spark: SparkSession, sf: str) -> DataFrame:
    """Largest weight by token of the embeddings read as token weights, special tokens and weights of 0 or less dropped."""
    e = table(spark, sf, "embeddings")
    n = F.size("embedding")
    m = vectors.lexical_weights(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.pmod(i, F.lit(20))), F.transform("embedding", lambda x: F.round(x.cast("double"), 4)))
    parts = vectors.sparse_parts(m)
    return e.select("vec_id", F.size(parts["indices"]).alias("n_tokens"), F.round(F.aggregate(parts["values"], F.lit(0.0), lambda s, x: s + x), 4).alias("total"), F.round(F.coalesce(F.array_max(parts["values"]), F.lit(0.0)), 4).alias("largest"))


_LEXICAL_SQL = """with x as (select vec_id, (i - 1) % 20 as token, round(embedding[i]::double, 4) as w from (select vec_id, embedding, unnest(range(1, len(embedding) + 1)) as i from embeddings)), m as (select vec_id, token, max(w) as w from x where w > 0 and token > 3 group by 1, 2)
select e.vec_id, count(m.token)::integer as n_tokens, round(coalesce(sum(w), 0), 4) as total, round(coalesce(max(w), 0), 4) as largest from embeddings e left join m using (vec_id) group by 1"""


QUERIES = {
    "dense_topk": (dense_topk, f"with {_DENSE_SQL} select query_id, id, round(score, 6) as score, rank from dense_ranked where rank <= 10"),
    "sparse_topk": (sparse_topk, f"with {_SPARSE_SQL} select query_id, id, score, rank from sparse_ranked where rank <= 10"),
    "hybrid_topk": (hybrid_topk, _HYBRID_SQL),
    "filtered_search": (filtered_search, _FILTER_SQL),
    "retrieval_metrics": (retrieval_metrics, f"{_METRIC_SQL} select {_MEANS} from m"),
    "metrics_by_group": (metrics_by_group, f"{_METRIC_SQL} select label, {_MEANS}, case when grouping(label) = 1 then 'all' else 'label' end as grouping_name from m group by grouping sets ((), (label))"),
    "gain_at_ten": (gain_at_ten, _GAIN_SQL),
    "strategy_changes": (strategy_changes, _CHANGE_SQL),
    "query_profiles": (query_profiles, _PROFILE_SQL),
    "gold_relevance": (gold_relevance, _RELEVANT_SQL),
    "lexical_maxima": (lexical_maxima, _LEXICAL_SQL),
}
