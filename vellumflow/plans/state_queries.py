"""Queries on job records, queues, manifests, gold samples and replaced runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumflow.functions import ids
from vellumflow.operators import evaluation, state
from vellumflow.runtime import table

_ACTIVE = "('na_fila', 'processando', 'queued', 'running')"
_DONE = "('concluido', 'succeeded')"
_FAILED = "('erro', 'failed')"


def job_latest(spark: SparkSession, sf: str) -> DataFrame:
    return state.latest_jobs(table(spark, sf, "job_records")).select("job_id", "seq", "document_id", "status", "stage", "index_error", "n_chunks")


_LATEST_SQL = "select job_id, max(seq) as seq, " + ", ".join(f"arg_max({c}, seq) as {c}" for c in ("document_id", "status", "stage", "index_error", "n_chunks")) + " from job_records where job_id is not null group by 1"


def job_indexes(spark: SparkSession, sf: str) -> DataFrame:
    return state.job_indexes(table(spark, sf, "job_records"))


_INDEX_SQL = f"""with r as (select distinct on (job_id, seq) * from job_records where job_id is not null order by job_id, seq), s as (select job_id, max(case when status is not null and status not in {_ACTIVE} then seq end) as stop from r group by 1),
m as (select job_id, arg_max(status, seq) as status, min(case when status in {_ACTIVE} and (stop is null or seq > stop) then updated_at end) as since, max(coalesce(index_error, '') <> '') as broken, arg_max({{'t': updated_at}}, seq).t as last_time from r join s using (job_id) group by 1)
select job_id, status, case when status in {_ACTIVE} then since end as active_since, case when status in {_DONE} and not broken then last_time end as succeeded_at, coalesce(status in {_FAILED}, false) or broken as failed from m"""


def job_listing(spark: SparkSession, sf: str) -> DataFrame:
    """The hundred jobs that succeeded last and have a record naming a document."""
    records = table(spark, sf, "job_records")
    rows, _ = state.listed(state.job_indexes(records), "succeeded_at", records.where("document_id is not null"), 100)
    return rows.select("job_id", "succeeded_at")


_LISTING_SQL = f"with i as ({_INDEX_SQL}), t as (select job_id, succeeded_at from i where succeeded_at is not null order by succeeded_at desc, job_id limit 100) select * from t where job_id in (select job_id from job_records where document_id is not null)"


def job_tallies(spark: SparkSession, sf: str) -> DataFrame:
    return state.job_tallies(state.latest_jobs(table(spark, sf, "job_records")), "status", None, "stage")


def _requests(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(F.col("event_type").alias("resource"), F.col("event_id").alias("request_id"), (F.col("user_id") % 10).alias("priority"), F.col("ts").alias("enqueued_at"), F.col("event_id").alias("sequence"))


_NOW = "2100-01-01 00:00:00"


def queue_order(spark: SparkSession, sf: str) -> DataFrame:
    """Events as requests of a queue for each type; every tenth day of waiting lifts a request by one."""
    r = state.queue_order(_requests(spark, sf), F.lit(_NOW).cast("timestamp"), interval=864_000.0)
    return r.select("resource", "request_id", F.round("waited_seconds", 3).alias("waited_seconds"), F.col("effective_priority").cast("bigint").alias("effective_priority"), "position")


_QUEUE_SQL = f"""with r as (select event_type as resource, event_id as request_id, user_id % 10 as p, (epoch_us(timestamp '{_NOW}') - epoch_us(ts)) / 1e6 as w from events),
e as (select *, greatest(0, p - floor(greatest(w, 0) / 864000.0))::bigint as effective_priority from r) select resource, request_id, round(w, 3) as waited_seconds, effective_priority, row_number() over (partition by resource order by effective_priority, request_id) as position from e"""


def queue_status(spark: SparkSession, sf: str) -> DataFrame:
    ordered = state.queue_order(_requests(spark, sf), F.lit(_NOW).cast("timestamp"), interval=864_000.0)
    return state.queue_status(ordered).select("resource", "queue_length", "next_request", F.round("longest_wait", 3).alias("longest_wait"))


def event_histogram(spark: SparkSession, sf: str) -> DataFrame:
    h = state.event_counts(table(spark, sf, "events"), "event_type", value="value", bounds=(1, 5, 30, 60, 300))
    return h.withColumn("sum", F.round("sum", 4)).withColumnsRenamed({"count": "n_values", "sum": "total"})


def manifest_latest(spark: SparkSession, sf: str) -> DataFrame:
    """Last revision of each manifest, its number of stages and artifacts and their size."""
    m = table(spark, sf, "manifests")
    last = state.latest_manifests(m.select("document_id", "revision", "pipeline_id", "stages", "artifacts", "updated_at").withColumn("stages", F.map_entries("stages")).withColumn("artifacts", F.map_entries("artifacts")).dropDuplicates(["document_id", "revision"]))
    size = F.aggregate(F.coalesce("artifacts", F.array().cast(last.schema["artifacts"].dataType)), F.lit(0).cast("bigint"), lambda s, x: s + F.coalesce(x["value"]["size_bytes"], F.lit(0)))
    return last.select("document_id", "revision", F.coalesce(F.size("stages"), F.lit(0)).alias("n_stages"), F.coalesce(F.when(F.col("artifacts").isNotNull(), F.size("artifacts")), F.lit(0)).alias("n_artifacts"), size.alias("total_bytes"))


_MANIFEST_SQL = """with m as (select distinct on (document_id, revision) * from manifests order by document_id, revision), l as (select * from m qualify row_number() over (partition by document_id order by revision desc) = 1)
select document_id, revision, coalesce(cardinality(stages), 0)::integer as n_stages, coalesce(cardinality(artifacts), 0)::integer as n_artifacts, coalesce(list_sum(list_transform(map_values(artifacts), lambda x: coalesce(x.size_bytes, 0))), 0)::bigint as total_bytes from l"""


def manifest_pending(spark: SparkSession, sf: str) -> DataFrame:
    """Documents none of whose manifests has every stage completed."""
    m = table(spark, sf, "manifests")
    done = F.coalesce(F.forall(F.map_values("stages"), lambda s: F.lower(s["status"]).isin(*state.COMPLETED)), F.lit(False)) & (F.coalesce(F.size("stages"), F.lit(0)) > 0)
    return m.groupBy("document_id").agg(F.bool_or(done).alias("done")).where("not done").select("document_id")


_PENDING_SQL = "select document_id from manifests group by 1 having not bool_or(coalesce(cardinality(stages), 0) > 0 and coalesce(len(list_filter(map_values(stages), lambda s: not coalesce(lower(s.status) in ('completed', 'succeeded'), false))) = 0, false))"


def reindex_replace(spark: SparkSession, sf: str) -> DataFrame:
    """Points of chunks after documents with an odd first digit were indexed again by a second run."""
    c = table(spark, sf, "chunks").select("chunk_id", "document_id").distinct()
    old = c.withColumn("run_id", F.lit("run-1"))
    again = F.conv(F.substring("document_id", 1, 1), 16, 10).cast("int") % 2 == 1
    new = c.where(again & (F.col("chunk_id") >= "4")).withColumn("run_id", F.lit("run-2"))
    return state.replace_run(old, new).groupBy("document_id", "run_id").agg(F.count(F.lit(1)).alias("n_points"))


_REPLACE_SQL = """with c as (select distinct chunk_id, document_id from chunks), n as (select * from c where ('0x' || substr(document_id, 1, 1))::int % 2 = 1 and chunk_id >= '4'), u as (select document_id, 'run-2' as run_id from n union all select document_id, 'run-1' from c where document_id not in (select document_id from n))
select document_id, run_id, count(*) as n_points from u group by 1, 2"""


def not_indexed(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of manifests without any chunk."""
    return state.not_indexed(table(spark, sf, "manifests").select("document_id").distinct(), table(spark, sf, "chunks"))


def upsert_quality(spark: SparkSession, sf: str) -> DataFrame:
    """One quality row a chunk: of the deliveries the one evaluated last."""
    q = table(spark, sf, "chunk_quality").where("chunk_id is not null").select("chunk_id", F.coalesce("token_count", F.lit(-1)).alias("token_count"), F.coalesce("char_count", F.lit(-1)).alias("char_count"), "evaluated_at")
    rows = q.withColumn("version", F.struct(F.coalesce("evaluated_at", F.lit("1900-01-01").cast("timestamp_ntz")), "token_count", "char_count"))
    return state.upsert(rows.where("evaluated_at is null"), rows.where("evaluated_at is not null"), "chunk_id", "version").select("chunk_id", "token_count", "char_count")


_UPSERT_SQL = "select chunk_id, r.b as token_count, r.c as char_count from (select chunk_id, max({'a': coalesce(evaluated_at, timestamp '1900-01-01'), 'b': coalesce(token_count, -1), 'c': coalesce(char_count, -1)}) as r from chunk_quality where chunk_id is not null group by 1)"


def message_guard(spark: SparkSession, sf: str) -> DataFrame:
    """Why documents' descriptions couldn't travel as messages between stages."""
    d = table(spark, sf, "documents")
    message = ids.drop_nulls(F.create_map(F.lit("doc"), F.col("doc_id").cast("string"), F.lit("source"), F.col("source"), F.lit("summary"), F.col("text")))
    return d.groupBy(F.coalesce(ids.message_problem(message, 4096), F.lit("fine")).alias("problem")).agg(F.count(F.lit(1)).alias("n_docs"))


_SAID = "octet_length(encode(to_json({0})::varchar))"
_GUARD_SQL = (
    "with m as (select doc_id::varchar as a, source as b, text as c from documents), k as (select *, list_filter([a, b, c], lambda v: v is not null) as vs, "
    + "(1 + " + " + ".join(f"case when {v} is null then 0 else {len(name) + 4} + {_SAID.replace('{0}', v)} end" for v, name in (("a", "doc"), ("b", "source"), ("c", "summary"))) + ") as size from m) "
    + r"select case when len(list_filter(vs, lambda v: regexp_matches(v, '^(JVBERi0|iVBORw0KGgo|/9j/|data:[\w/+.-]+;base64,)') or contains(v, chr(0)))) > 0 then 'binary_value' when size > 4096 then 'too_large' else 'fine' end as problem, count(*) as n_docs from k group by 1"
)


def payload_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """Values that a chunk's payload keeps once nulls are dropped."""
    c = table(spark, sf, "chunks").select("chunk_id", "section_title", "section_kind", "split_method", "tokenizer_name", "item_uuid").distinct()
    m = ids.drop_nulls(F.create_map(*[x for n in ("section_title", "section_kind", "split_method", "tokenizer_name", "item_uuid") for x in (F.lit(n), F.col(n))]))
    return c.groupBy("chunk_id").agg(F.max(F.size(m)).alias("n_values"))


_PAYLOAD_SQL = "with c as (select distinct chunk_id, section_title, section_kind, split_method, tokenizer_name, item_uuid from chunks) select chunk_id, max((section_title is not null)::int + (section_kind is not null)::int + (split_method is not null)::int + (tokenizer_name is not null)::int + (item_uuid is not null)::int)::integer as n_values from c group by 1"


def gold_sample(spark: SparkSession, sf: str) -> DataFrame:
    """Twenty questions evenly spread over the gold set."""
    g = table(spark, sf, "gold_questions").groupBy("qid").agg(F.min("doc_id").alias("doc_id"))
    return evaluation.spread(g, 20, "qid").select("qid", "doc_id")


_SPREAD_SQL = "with g as (select qid, min(doc_id) as doc_id from gold_questions group by 1), r as (select *, row_number() over (order by qid) - 1 as r, count(*) over () as n from g) select qid, doc_id from r where n <= 20 or r in (select floor(i * (select max(n) from r) / 20.0)::bigint from range(20) t(i))"


def eligible_gold(spark: SparkSession, sf: str) -> DataFrame:
    g = table(spark, sf, "gold_questions")
    ok = evaluation.fit_length(F.col("passage_tokens")) & evaluation.stated_well(F.col("question"), F.col("answer_span"))
    return g.groupBy("section_kind").agg(F.count(F.lit(1)).alias("n_questions"), F.count_if(ok).alias("n_eligible"))


QUERIES = {
    "job_latest": (job_latest, _LATEST_SQL),
    "job_indexes": (job_indexes, _INDEX_SQL),
    "job_listing": (job_listing, _LISTING_SQL),
    "job_tallies": (job_tallies, f"with l as ({_LATEST_SQL}) select stage, count(*) as jobs, count_if(status in {_ACTIVE}) as active, count_if(status in {_DONE}) as done, count_if(status in {_FAILED}) as failed from l group by 1"),
    "queue_order": (queue_order, _QUEUE_SQL),
    "queue_status": (queue_status, f"with q as ({_QUEUE_SQL}) select resource, count(*) as queue_length, arg_min(request_id, position) as next_request, max(waited_seconds) as longest_wait from q group by 1"),
    "event_histogram": (event_histogram, "select event_type, " + ", ".join(f"count_if(value <= {b}) as le_{b}" for b in (1, 5, 30, 60, 300)) + ", count(value) as n_values, round(sum(value), 4) as total from events group by 1"),
    "manifest_latest": (manifest_latest, _MANIFEST_SQL),
    "manifest_pending": (manifest_pending, _PENDING_SQL),
    "reindex_replace": (reindex_replace, _REPLACE_SQL),
    "not_indexed": (not_indexed, "select distinct document_id from manifests where document_id not in (select document_id from chunks where document_id is not null)"),
    "upsert_quality": (upsert_quality, _UPSERT_SQL),
    "message_guard": (message_guard, _GUARD_SQL),
    "payload_sizes": (payload_sizes, _PAYLOAD_SQL),
    "gold_sample": (gold_sample, _SPREAD_SQL),
    "eligible_gold": (eligible_gold, "select section_kind, count(*) as n_questions, count_if(coalesce(passage_tokens between 60 and 420 and length(trim(question)) >= 12 and length(trim(answer_span)) >= 6, false)) as n_eligible from gold_questions group by 1"),
}
