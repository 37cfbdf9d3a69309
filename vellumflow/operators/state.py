"""Keyed state as tables: job records and their indexes, request queues, manifests, replacement of indexed runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellumflow.operators.running import running

#: States of jobs, in both languages in which they are written.
ACTIVE = ("na_fila", "processando", "queued", "running")
DONE = ("concluido", "succeeded")
FAILED = ("erro", "failed")
COMPLETED = ("completed", "succeeded")


def latest_jobs(records: DataFrame, key: str = "job_id", seq: str = "seq") -> DataFrame:
    """One merged record a job: of every column the last non-null value by ``seq``. Repeated and late rows don't matter; a null key is left out."""
    rows = records.where(F.col(key).isNotNull())
    columns = [c for c in records.columns if c not in (key, seq)]
    last = [F.max(F.when(F.col(c).isNotNull(), F.struct(seq, F.col(c).alias("v"))))["v"].alias(c) for c in columns]
    return rows.groupBy(key).agg(F.max(seq).alias(seq), *last)


def job_indexes(records: DataFrame, key: str = "job_id", seq: str = "seq", time: str = "updated_at", status: str = "status", error: str = "index_error") -> DataFrame:
    """(job_id, status, active_since, succeeded_at, failed): a job is active since it last became so, has succeeded when its last status is a done one and no index error was ever recorded, and failed on a failed one or an index error."""
    rows = records.where(F.col(key).isNotNull()).dropDuplicates([key, seq])
    active = F.coalesce(F.col(status).isin(*ACTIVE), F.lit(False))
    stops = rows.groupBy(key).agg(F.max(F.when(F.col(status).isNotNull() & ~active, F.col(seq))).alias("__stop"))
    marked = rows.join(stops, key)
    out = marked.groupBy(key).agg(
        F.max(F.when(F.col(status).isNotNull(), F.struct(seq, F.col(status).alias("v"))))["v"].alias("status"),
        F.min(F.when(active & (F.col("__stop").isNull() | (F.col(seq) > F.col("__stop"))), F.col(time))).alias("since"),
        F.max(F.when(F.col(error).isNotNull() & (F.col(error) != ""), F.lit(1))).alias("broken"),
        F.max(F.struct(seq, time))[time].alias("last_time"),
    )
    is_active = F.coalesce(F.col("status").isin(*ACTIVE), F.lit(False))
    done = F.coalesce(F.col("status").isin(*DONE), F.lit(False)) & F.col("broken").isNull()
    return out.select(key, "status", F.when(is_active, F.col("since")).alias("active_since"), F.when(done, F.col("last_time")).alias("succeeded_at"), (F.coalesce(F.col("status").isin(*FAILED), F.lit(False)) | F.col("broken").isNotNull()).alias("failed"))


def recent(index: DataFrame, score: str, limit: int, key: str = "job_id") -> DataFrame:
    """The ``limit`` entries with the latest scores, ties by key."""
    if not 1 <= limit <= 1000:
        raise ValueError("limit must be 1 to 1000")
    return index.where(F.col(score).isNotNull()).orderBy(F.desc(score), key).limit(limit)


def listed(index: DataFrame, score: str, records: DataFrame, limit: int, key: str = "job_id") -> tuple[DataFrame, DataFrame]:
    """(rows, orphans): the most recent entries that have a record, and those without one. The limit comes first, as in a listing of the index."""
    top = recent(index, score, limit, key)
    known = records.select(key).distinct()
    return top.join(known, key, "left_semi"), top.join(known, key, "left_anti")


def queue_entries(queue: DataFrame, requests: DataFrame, key: str = "request_id") -> tuple[DataFrame, DataFrame]:
    """(entries whose request has a record, orphans to be removed). A null key is an orphan."""
    known = requests.where(F.col(key).isNotNull()).select(key).distinct()
    return queue.join(known, key, "left_semi"), queue.join(known, key, "left_anti")


def flagged(rows: DataFrame, failures: DataFrame, key: str = "job_id", flag: str = "has_failure") -> DataFrame:
    """Rows with a flag that says whether their key is among the failures; a null key isn't."""
    known = failures.where(F.col(key).isNotNull()).select(key).distinct().withColumn(flag, F.lit(True))
    return rows.join(known, key, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def effective_priority(base: Column, waited_seconds: Column, interval: float = 60.0, step: int = 1, floor: int = 0) -> Column:
    """Priority less a step for each full interval waited, the floor at least; smaller goes first."""
    return F.greatest(F.lit(floor), base - F.floor(F.greatest(waited_seconds, F.lit(0.0)) / interval) * step)


def clamp_priority(p: Column, low: int = 0, high: int = 100, default: int = 50) -> Column:
    return F.least(F.greatest(F.coalesce(p, F.lit(default)), F.lit(low)), F.lit(high))


def queue_order(requests: DataFrame, now: Column, resource: str = "resource", base: str = "priority", enqueued: str = "enqueued_at", seq: str = "sequence", **aging) -> DataFrame:
    """Requests with waited_seconds, effective_priority and position (from 1) in their resource's queue: by effective priority, then sequence, a number."""
    waited = (F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col(enqueued).cast("timestamp"))) / 1e6
    rows = requests.withColumn("waited_seconds", waited).withColumn("effective_priority", effective_priority(F.col(base), waited, **aging))
    # the few priorities of a queue are scanned as counts, the requests of one in buckets: a long queue isn't one task
    sizes = rows.groupBy(resource, "effective_priority").agg(F.count(F.lit(1)).alias("__n"))
    ahead = sizes.select(resource, "effective_priority", F.coalesce(F.sum("__n").over(Window.partitionBy(resource).orderBy("effective_priority").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__ahead"))
    placed = running(rows, [resource, "effective_priority"], seq, sums={"__place": F.lit(1)})
    return placed.join(ahead, [resource, "effective_priority"]).withColumn("position", F.col("__ahead") + F.col("__place")).select(*requests.columns, "waited_seconds", "effective_priority", "position")


def queue_status(ordered: DataFrame, held: DataFrame | None = None, resource: str = "resource", request: str = "request_id") -> DataFrame:
    """A row for each resource: queue length, the next request, the longest wait, and who holds it."""
    out = ordered.groupBy(resource).agg(F.count(F.lit(1)).alias("queue_length"), F.min_by(request, "position").alias("next_request"), F.max("waited_seconds").alias("longest_wait"))
    return out if held is None else out.join(held, resource, "left")


def job_tallies(latest: DataFrame, status: str = "status", seconds: str | None = None, *by: str) -> DataFrame:
    """Counts by state, and mean and largest seconds where a column of them is named."""
    s = F.col(status)
    extra = [F.avg(seconds).alias("mean_seconds"), F.max(seconds).alias("max_seconds")] if seconds else []
    return latest.groupBy(*by).agg(F.count(F.lit(1)).alias("jobs"), F.count_if(s.isin(*ACTIVE)).alias("active"), F.count_if(s.isin(*DONE)).alias("done"), F.count_if(s.isin(*FAILED)).alias("failed"), *extra)


def event_counts(events: DataFrame, *by: str, value: str, bounds: tuple[float, ...] = (1, 5, 30, 60, 300)) -> DataFrame:
    """Events by group with cumulative counts up to each bound, their number and sum, as histograms have them."""
    return events.groupBy(*by).agg(*[F.count_if(F.col(value) <= b).alias(f"le_{b:g}".replace(".", "_")) for b in bounds], F.count(value).alias("count"), F.sum(value).alias("sum"))


def upsert(old: DataFrame, new: DataFrame, key: str, version: str) -> DataFrame:
    """Union of both by key; of equal keys the row with the largest version, new before old."""
    both = old.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)), allowMissingColumns=True)
    columns = [c for c in both.columns if c not in (key, "__new")]
    best = both.groupBy(key).agg(F.max_by(F.struct(*columns), F.struct(version, "__new")).alias("r"))
    return best.select(key, "r.*")


def replace_run(points: DataFrame, new: DataFrame, document: str = "document_id", run: str = "run_id") -> DataFrame:
    """Points after a run was written: of documents in the new run only its points, whatever their runs and versions before."""
    done = new.select(document).distinct()
    return points.join(done, document, "left_anti").unionByName(new, allowMissingColumns=True)


def not_indexed(documents: DataFrame, points: DataFrame, document: str = "document_id", version: str | None = None) -> DataFrame:
    """Documents without points; with ``version`` also those whose points are of another version. File names and stems count as one."""
    stem = lambda c: F.regexp_replace(F.lower(F.col(c)), r"\.pdf$", "")
    keys = points.select(stem(document).alias("__d"), *([F.col(version).alias("__v")] if version else [])).distinct()
    on = stem(document) == F.col("__d")
    return documents.join(keys, on & (F.col(version) == F.col("__v")) if version else on, "left_anti")


def propagate(points: DataFrame, metadata: DataFrame, document: str = "document_id") -> DataFrame:
    """Points with the metadata of their document; where both have a column, the metadata's value if it has one."""
    shared = [c for c in metadata.columns if c in points.columns and c != document]
    renamed = metadata.select(document, *[F.col(c).alias(f"__m_{c}" if c in shared else c) for c in metadata.columns if c != document])
    rows = points.join(renamed, document, "left")
    own = [F.coalesce(F.col(f"__m_{c}"), F.col(c)).alias(c) if c in shared else F.col(c) for c in points.columns]
    return rows.select(*own, *[c for c in metadata.columns if c not in points.columns])


def pending(manifests: DataFrame, stage: str, artifact: str, force: bool = False) -> DataFrame:
    """Manifests whose stage must run: not completed, or without its artifact."""
    if force:
        return manifests
    ready = F.coalesce(F.lower(F.col("stages")[stage]["status"]).isin(*COMPLETED), F.lit(False)) & F.col("artifacts")[artifact]["uri"].isNotNull()
    return manifests.where(~ready)


def latest_manifests(manifests: DataFrame, key: str = "document_id", revision: str = "revision") -> DataFrame:
    """The last revision of each document; of repeated rows one."""
    columns = [c for c in manifests.columns if c != key]
    best = manifests.groupBy(key).agg(F.max_by(F.struct(*columns), F.struct(revision, F.coalesce("updated_at", F.lit(None)))).alias("r"))
    return best.select(key, "r.*")


def apply_updates(current: DataFrame, updates: DataFrame, key: str = "document_id", revision: str = "revision") -> tuple[DataFrame, DataFrame]:
    """(manifests, conflicts): updates that name the current revision go in as the next one; others are conflicts. Of several updates of one revision the first by update_id goes in."""
    cur = current.select(key, F.col(revision).alias("__have"))
    seen = updates.join(cur, key, "left").withColumn("__n", F.row_number().over(Window.partitionBy(key, revision).orderBy("update_id")))
    ok = F.coalesce(F.col(revision) == F.col("__have"), F.col(revision) == 0) & (F.col("__n") == 1)
    good = seen.where(ok).drop("__have", "__n", "update_id").withColumn(revision, F.col(revision) + 1)
    return current.join(good.select(key), key, "left_anti").unionByName(good, allowMissingColumns=True), seen.where(~ok).drop("__n")
