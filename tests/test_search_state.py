import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from vellumflow.functions import vectors
from vellumflow.operators import evaluation, phrases, retrieval, state
from vellumflow.operators.pairs import group_pairs, within
from vellumflow.sources import stores


def points(spark, n=60, dims=8):
    rng = np.random.default_rng(3)
    return spark.createDataFrame([(i, [float(x) for x in rng.normal(size=dims)]) for i in range(n)] + [(900, None), (901, [0.0] * dims)], "id long, vector array<double>")


def test_dense_equals_brute_force(spark):
    p = points(spark)
    q = p.where("id % 20 = 0 and vector is not null").select(F.col("id").alias("query_id"), "vector")
    got = {}
    for r in retrieval.dense_topk(p, q, 5, query_block=2).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.id))
    x = {r.id: np.array(r.vector) for r in p.collect() if r.vector and any(r.vector)}
    for qid, pairs in got.items():
        scores = sorted(((-round(float(x[qid] @ v / np.linalg.norm(x[qid]) / np.linalg.norm(v)), 9), i) for i, v in x.items()))
        assert [i for _, i in sorted(pairs)] == [i for _, i in scores[:5]]
    assert len(got) == 3
    assert retrieval.dense_topk(p.limit(0), q, 5).count() == 0 and retrieval.dense_topk(p, q.limit(0), 5).count() == 0


def test_filters_and_unknown_values(spark):
    rows = [(1, True, None, "body"), (2, None, True, None), (3, False, False, "front_matter"), (4, True, None, None)]
    df = spark.createDataFrame(rows, "id int, searchable boolean, is_reference boolean, section_kind string").withColumn("chart_data_confidence", F.when(F.col("id") == 4, 0.5))
    ids = lambda **k: sorted(r.id for r in df.where(retrieval.search_filter(df.columns, **k)).collect())
    assert ids(profile="general") == [1]
    assert ids(profile="general", min_visual_confidence=None) == [1, 4]
    assert ids(profile="quantitative", min_visual_confidence=None) == [1, 4]
    assert ids(profile="bibliographic") == [2]
    assert ids(filtering=False) == [1, 2, 3]
    with pytest.raises(ValueError):
        retrieval.profile_filter("x", F.col("searchable"), F.col("is_reference"), F.col("section_kind"))
    for bad in (0, 51):
        with pytest.raises(ValueError):
            retrieval.check_limit(bad)


def test_sparse_and_fusion(spark):
    posts = spark.createDataFrame([(1, "a", 2.0), (1, "b", 1.0), (2, "a", 1.0), (3, "c", 9.0)], "id long, token string, weight double")
    q = spark.createDataFrame([(7, "a", 1.0), (7, "b", 1.0)], "id long, token string, weight double")
    got = [(r.id, r.score) for r in retrieval.sparse_topk(posts, q, 5).orderBy("rank").collect()]
    assert got == [(1, 3.0), (2, 1.0)]
    a = spark.createDataFrame([(7, 1, 1), (7, 2, 2)], "query_id long, id long, rank int")
    b = spark.createDataFrame([(7, 2, 1), (7, 3, 2)], "query_id long, id long, rank int")
    got = [r.id for r in retrieval.fuse(a, b, 3).orderBy("rank").collect()]
    assert got == [2, 1, 3]


def test_classes(spark):
    rows = [("paragraph", "body"), ("table", "body"), ("references", None), ("list", "list_of_tables"), ("paragraph", "administrative_appendix"), (None, None)]
    df = spark.createDataFrame(rows, "k string, s string").select(retrieval.retrieval_class(F.col("k"), F.col("s")).alias("r"))
    got = [(r.r.normalized_type, r.r.searchable, list(r.r.profiles)) for r in df.collect()]
    assert got == [
        ("body_paragraph", True, ["general", "quantitative", "methodological"]), ("structured_table", False, ["quantitative", "methodological"]), ("bibliographic_reference", False, ["bibliographic"]), ("navigation_list", False, []),
        ("body_paragraph", False, []), ("unknown", True, ["general"]),
    ]


def test_vectors(spark):
    df = spark.createDataFrame([([5, 7, 7, 1], [0.5, 0.2, 0.9, 3.0])], "t array<int>, w array<double>")
    m = df.select(vectors.lexical_weights(F.col("t"), F.col("w")).alias("m"))
    assert m.first().m == {"5": 0.5, "7": 0.9}
    assert tuple(m.select(vectors.sparse_parts(F.col("m")).alias("p")).first().p) == ([5, 7], [0.5, 0.9])
    r = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0])], "a array<double>, b array<double>").select(vectors.cosine(F.col("a"), F.col("a")).alias("x"), vectors.cosine(F.col("a"), F.col("b")).alias("y")).first()
    assert abs(r.x - 1) < 1e-12 and r.y is None


def test_metrics(spark):
    ranked = spark.createDataFrame([(1, 1, False), (1, 2, True), (1, 3, True), (2, 1, False)], "query_id int, rank int, relevant boolean")
    totals = spark.createDataFrame([(1, 4), (2, 0), (3, 2)], "query_id int, total_rel int")
    m = {r.query_id: r for r in evaluation.query_metrics(ranked, totals).collect()}
    assert m[1].p_at_3 == pytest.approx(2 / 3) and m[1].r_at_3 == 0.5 and m[1].reciprocal_rank == 0.5 and m[1].hit_at_1 == 0
    assert m[1].ndcg == pytest.approx((1 / np.log2(3) + 1 / np.log2(4)) / (1 + 1 / np.log2(3)))
    assert m[2].r_at_10 == 0 and m[3].reciprocal_rank == 0
    change = evaluation.compare(evaluation.query_metrics(ranked, totals), evaluation.query_metrics(ranked.withColumn("relevant", F.col("rank") == 1), totals))
    assert {r.query_id: r.change for r in change.collect()} == {1: "better", 2: "gained", 3: "same"}


def _gold_case(spark):
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice(["a", "b", "é", "漢", "  ", "\n", "A", "", " ", "\U0001f600"]) for _ in range(rnd.randrange(9)))
    blocks = lambda n, *ids: [rnd.choice([*ids, None]) for _ in range(rnd.randrange(n))]
    chunks = [(f"c{i % 140}" if i % 17 else None, rnd.choice(["x", "x", "y", "z", None]), "".join(word() for _ in range(rnd.randrange(6))) if i % 23 else None, blocks(3, "b1", "b2", "b3") if i % 9 else None) for i in range(160)]
    gold = [(i if i % 19 else None, rnd.choice(["x", "x", "y", "w", None]), blocks(2, "b1", "b8", "b9") if i % 7 else None, " \t" if i == 30 else word() + word() if i % 11 else None) for i in range(90)]
    return spark.createDataFrame(chunks, "chunk_id string, document_id string, text string, block_ids array<string>"), spark.createDataFrame(gold, "qid long, gold_doc string, gold_block_ids array<string>, answer_span string")


def test_relevant_pairs_equal_brute_force(spark):
    chunks, gold = _gold_case(spark)
    relevant = evaluation.is_relevant(*map(F.col, ("document_id", "block_ids", "text", "gold_doc", "gold_block_ids", "answer_span")))
    want = {(r.qid, r.chunk_id) for r in chunks.crossJoin(gold).where(relevant).collect()}
    got = [(r.qid, r.chunk_id) for r in evaluation.relevant_pairs(chunks, gold).collect()]
    assert want and set(got) == want and len(got) == len(want)


@pytest.mark.parametrize("few", [{}, {"slice_bytes": 1024, "window": 7, "places": 3}])
def test_phrases_in_windows_and_passes(spark, few):
    rnd = random.Random(8)
    draw = lambda n: "".join(rnd.choice("aab漢") for _ in range(rnd.randrange(n)))
    texts, asked = [(i, rnd.choice("gh"), draw(70)) for i in range(40)], [(rnd.choice("ghk"), draw(12)) for _ in range(60)]
    found = phrases.phrases_in(spark.createDataFrame(texts, "id int, grp string, t string").select("id", "grp", F.col("t").cast("binary").alias("text")), spark.createDataFrame(asked, "grp string, p string").select("grp", F.col("p").cast("binary").alias("phrase")), **few)
    got = {(r.id, r.grp, bytes(r.phrase).decode()) for r in found.collect()}
    assert got == {(i, g, p) for i, g, t in texts for h, p in asked if g == h and p in t}


def test_answers_of_one_document_are_no_product(spark):
    """8,000 questions to a document of 8,000 chunks: held against each other they would take minutes."""
    gold = spark.range(8000).select(F.col("id").alias("qid"), F.lit("d").alias("gold_doc"), F.array(F.concat(F.lit("b"), "id")).alias("gold_block_ids"), F.format_string("The answer %05d stands here", "id").alias("answer_span"))
    chunks = spark.range(8000).select(F.concat(F.lit("c"), "id").alias("chunk_id"), F.lit("d").alias("document_id"), F.concat(F.repeat(F.lit("Some  words of no account. "), 30), F.format_string("the ANSWER\n%05d stands here", F.col("id") + 1)).alias("text"), F.array(F.concat(F.lit("b"), "id")).alias("block_ids"))
    began = time.time()
    got = {(r.qid, r.chunk_id) for r in evaluation.relevant_pairs(chunks, gold).collect()}
    assert got == {(i, f"c{i}") for i in range(8000)} | {(i + 1, f"c{i}") for i in range(7999)}
    assert time.time() - began < 60


def test_spread(spark):
    df = spark.range(10).toDF("n")
    assert [r.n for r in evaluation.spread(df, 4, "n").orderBy("n").collect()] == [0, 2, 5, 7]
    assert evaluation.spread(df, 20, "n").count() == 10


JOBS = [("a", 1, "na_fila", None, 10), ("a", 2, "processando", None, 20), ("b", 1, "na_fila", None, 11), ("b", 2, "concluido", None, 30), ("c", 1, "concluido", "boom", 40), ("c", 2, "concluido", None, 50), ("d", 1, "erro", None, 5), ("d", 2, "na_fila", None, 60), ("d", 3, "processando", None, 70), ("a", 2, "processando", None, 20), (None, 9, "erro", None, 1)]


def jobs(spark, rows=JOBS):
    df = spark.createDataFrame(rows, "job_id string, seq long, status string, index_error string, s long")
    return df.withColumn("updated_at", F.timestamp_seconds("s")).drop("s")


def test_job_indexes(spark):
    got = {r.job_id: r for r in state.job_indexes(jobs(spark)).collect()}
    at = lambda x: None if x is None else int(x.timestamp())
    assert {k: (at(r.active_since), at(r.succeeded_at), r.failed) for k, r in got.items()} == {"a": (10, None, False), "b": (None, 30, False), "c": (None, None, True), "d": (60, None, False)}
    assert {r.job_id: r.index_error for r in state.latest_jobs(jobs(spark)).collect()}["c"] == "boom"
    rows, orphans = state.listed(state.job_indexes(jobs(spark)), "active_since", jobs(spark).where("job_id = 'a'"), 2)
    assert [r.job_id for r in rows.collect()] == ["a"] and [r.job_id for r in orphans.collect()] == ["d"]


def test_queue(spark):
    rows = [("gpu", "a", 10, 0, 1), ("gpu", "b", 5, 900, 2), ("gpu", "c", 10, 900, 3), ("cpu", "d", 1, 0, 4)]
    df = spark.createDataFrame(rows, "resource string, request_id string, priority long, s long, sequence long").withColumn("enqueued_at", F.timestamp_seconds("s"))
    got = {(r.resource, r.position): r.request_id for r in state.queue_order(df, F.timestamp_seconds(F.lit(1000)), interval=100.0).collect()}
    assert got == {("gpu", 1): "a", ("gpu", 2): "b", ("gpu", 3): "c", ("cpu", 1): "d"}
    status = {r.resource: (r.queue_length, r.next_request) for r in state.queue_status(state.queue_order(df, F.timestamp_seconds(F.lit(1000)), interval=100.0)).collect()}
    assert status == {"gpu": (3, "a"), "cpu": (1, "d")}
    assert spark.range(1).select(state.clamp_priority(F.lit(None).cast("int"))).first()[0] == 50


def test_runs_and_upserts(spark):
    old = spark.createDataFrame([("p1", "x", "r1"), ("p2", "x", "r1"), ("p3", "y", "r1")], "id string, document_id string, run_id string")
    new = spark.createDataFrame([("p1", "x", "r2")], "id string, document_id string, run_id string")
    once = state.replace_run(old, new)
    assert sorted((r.id, r.run_id) for r in once.collect()) == [("p1", "r2"), ("p3", "r1")]
    assert sorted(map(tuple, state.replace_run(once, new).collect())) == sorted(map(tuple, once.collect()))
    up = state.upsert(spark.createDataFrame([(1, 1, "a"), (2, 5, "b")], "id int, v int, t string"), spark.createDataFrame([(1, 1, "c"), (2, 4, "d"), (3, 1, "e")], "id int, v int, t string"), "id", "v")
    assert {r.id: r.t for r in up.collect()} == {1: "c", 2: "b", 3: "e"}
    docs = spark.createDataFrame([("X.pdf",), ("z.pdf",)], "document_id string")
    assert [r.document_id for r in state.not_indexed(docs, old).collect()] == ["z.pdf"]
    meta = spark.createDataFrame([("x", None, "2020")], "document_id string, run_id string, year string")
    assert {(r.id, r.run_id, r.year) for r in state.propagate(old, meta).collect()} == {("p1", "r1", "2020"), ("p2", "r1", "2020"), ("p3", "r1", None)}


def test_manifests(spark):
    cur = spark.createDataFrame([("d", 3, "a")], "document_id string, revision int, title string")
    upd = spark.createDataFrame([("d", 3, "b", 1), ("d", 3, "c", 2), ("d", 2, "x", 3), ("n", 0, "new", 4)], "document_id string, revision int, title string, update_id int")
    now, conflicts = state.apply_updates(cur, upd)
    assert sorted(map(tuple, now.collect())) == [("d", 4, "b"), ("n", 1, "new")] and sorted(r.title for r in conflicts.collect()) == ["c", "x"]


def test_pairs_of_a_hot_group(spark):
    df = spark.createDataFrame([("hot", i) for i in range(50)] + [("hot", 3), ("one", 1), (None, 2), ("two", 7), ("two", 9), ("two", None)], "g string, m int")
    got = [(r.g, r.a, r.b) for r in group_pairs(df, "g", "m", 7).collect()]
    want = {("hot", a, b) for a in range(50) for b in range(a + 1, 50)} | {("two", 7, 9)}
    assert len(got) == len(want) and set(got) == want
    hot = [(r.g, r.a, r.b) for r in group_pairs(df, "g", "m", 7, sampled=1, hot_members=20).collect()]
    assert len(hot) == len(want) and set(hot) == want
    assert group_pairs(df.limit(0), "g", "m").count() == 0
    large = spark.range(100).toDF("m")
    few = spark.createDataFrame([(3,), (5,)], "m long")
    assert sorted(r.m for r in within(few, large, "m").collect()) == sorted(r.m for r in within(few, large, "m", 1).collect()) == [3, 5]


def test_fusion_over_all_points(spark):
    rng = random.Random(4)
    points = [(i, [rng.random() for _ in range(3)]) for i in range(30)]
    posts = [(i, t, float(rng.randint(1, 3))) for i in range(30) for t in rng.sample("abcde", 2)]
    p = spark.createDataFrame(points, "id int, vector array<double>")
    q = spark.createDataFrame([(0, [1.0, 0.0, 0.0]), (1, [0.1, 0.7, 0.3])], "query_id int, vector array<double>")
    qp = spark.createDataFrame([(0, "a", 1.0), (1, "b", 2.0), (1, "c", 1.0)], "id int, token string, weight double")
    got = {}
    for r in retrieval.fuse_all(p, q, spark.createDataFrame(posts, "id int, token string, weight double"), qp, 30).collect():
        got.setdefault(r.query_id, {})[r.id] = (r.rank, round(r.score, 9))
    for name, v in ((0, [1.0, 0.0, 0.0]), (1, [0.1, 0.7, 0.3])):
        cos = {i: round(sum(a * b for a, b in zip(x, v)) / sum(a * a for a in x) ** 0.5 / sum(b * b for b in v) ** 0.5, 9) for i, x in points}
        asked = {t: w for n, t, w in ((0, "a", 1.0), (1, "b", 2.0), (1, "c", 1.0)) if n == name}
        lex = {i: sum(w * asked.get(t, 0) for j, t, w in posts if j == i) for i, _ in points}
        ranks = [{i: k for k, i in enumerate(sorted(s, key=lambda i: (-s[i], i)))} for s in (cos, lex)]
        score = {i: round(sum(1 / (60 + r[i]) for r in ranks), 9) for i in cos}
        assert {i: s for i, (_, s) in got[name].items()} == score and [i for i, _ in sorted(got[name].items(), key=lambda x: x[1][0])] == sorted(score, key=lambda i: (-score[i], i))


def test_hot_tokens_in_blocks(spark, monkeypatch):
    posts = spark.createDataFrame([(i, "de", 1.0) for i in range(50)] + [(3, "sol", 2.0)], "id int, token string, weight double")
    q = spark.createDataFrame([(1, "de", 1.0), (1, "sol", 1.0), (2, "de", 3.0)], "id int, token string, weight double")
    whole = sorted(map(tuple, retrieval.sparse_topk(posts, q, 20).collect()))
    monkeypatch.setattr(retrieval, "BROADCAST_BYTES", 0)
    assert sorted(map(tuple, retrieval.sparse_topk(posts, q, 20, hot_postings=7).collect())) == whole and len(whole) == 40


def test_spread_pairs_equal_a_join(spark):
    from vellumflow.operators.pairs import spread_pairs

    members = spark.createDataFrame([("p", i) for i in range(40)] + [("q", i) for i in range(100, 103)] + [("r", 7), ("r", 7), (None, 1), ("q", None)], "cls string, id int")
    links = spark.createDataFrame([("p", "q"), ("q", "r"), ("p", "x")], "a string, b string")
    want = sorted([(i, j) for i in range(40) for j in range(100, 103)] + [(j, 7) for j in range(100, 103)])
    for block in (2048, 8):
        assert sorted(map(tuple, spread_pairs(links, members.distinct(), block).collect())) == want


def test_stores(spark, tmp_path):
    df = spark.createDataFrame([("k1", b"abc"), ("k2", b"")], "object_key string, content binary")
    back = stores.put_artifacts(df, f"{tmp_path}/a")
    assert stores.damaged(back).count() == 0
    assert stores.damaged(back.withColumn("sha256", F.lit("x"))).count() == 2
    assert [r.object_key for r in stores.to_migrate(df, back.where("object_key = 'k1'")).collect()] == ["k2"]
    meta = spark.createDataFrame([('{"title": "T", "title_confidence": 0.4, "year_confidence": 7}',), ("{",), ('{"needs_review": false}',)], "j string").select(stores.parse_metadata(F.col("j")).alias("m"))
    assert [r[0] for r in meta.select(stores.needs_review(F.col("m"))).collect()] == [True, True, False]
    stores.write_json_lines(df.select("object_key"), f"{tmp_path}/j")
    assert spark.read.json(f"{tmp_path}/j").count() == 2
    img = spark.createDataFrame([("d", "b.PNG", 5), ("d", "a.jpg", 3)], "document_id string, name string, size_bytes long")
    r = stores.image_index(img).first()
    assert r["count"] == 2 and r.total_bytes == 8 and [i.new_name for i in r.images] == ["image_0001.jpg", "image_0002.png"]


def test_stream_equals_batch(spark, tmp_path):
    import random

    from vellumflow.streaming import jobs as streaming

    rows = [r for r in JOBS if r[0]]
    random.Random(4).shuffle(rows)
    for i in range(0, len(rows), 4):
        jobs(spark, rows[i : i + 4]).coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    stream = spark.readStream.schema(jobs(spark).schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    got: dict = {}

    def keep(batch, _):
        got.update({r.job_id: (r.status, r.active_since, r.succeeded_at, r.failed) for r in batch.collect()})

    q = streaming.job_index_stream(stream).writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{tmp_path}/c").start()
    deadline = time.time() + 60  # a query with processing-time timeouts never runs dry, so the rows are counted
    while time.time() < deadline and sum(p.numInputRows for p in q.recentProgress) < len(rows):
        time.sleep(0.3)
    q.stop()
    assert got == {r.job_id: (r.status, r.active_since, r.succeeded_at, r.failed) for r in state.job_indexes(jobs(spark)).collect()}
    s = spark.readStream.schema(jobs(spark).schema).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
    streaming.run_stage(s, lambda d: d.withColumn("done", F.lit(True)), f"{tmp_path}/good", f"{tmp_path}/bad", f"{tmp_path}/c2", lambda d: F.col("status") != "erro").awaitTermination(120)
    assert spark.read.parquet(f"{tmp_path}/good").count() == 9 and spark.read.parquet(f"{tmp_path}/bad").count() == 1
