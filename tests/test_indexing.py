from pyspark.sql import functions as F

from tests.test_structure import SMALL, blocks, words
from vellumflow.plans.indexing import index_documents


def test_runs_replace_and_repeat_nothing(spark):
    good = blocks(spark, [{"text": f"A frase {words(8)}."}, {"text": f"Outra parte {words(7, 30)}."}], "d1")
    bad = blocks(spark, [{"text": "| " + words(60) + " |", "block_type": "figure_caption"}], "d2")
    cfg = SMALL
    run = index_documents(good.unionByName(bad), "r1", cfg=cfg)
    first = run.points.select("id", "document_id", "run_id", "config_hash", "text").persist()
    assert {r.document_id for r in first.collect()} == {"d1"}
    assert [(r.document_id, r.largest_chunk) for r in run.quarantine.collect()] == [("d2", 62)]
    again = index_documents(good, "r2", first, cfg=cfg)
    assert again.documents.count() == 0 and sorted(map(tuple, again.points.select(*first.columns).collect())) == sorted(map(tuple, first.collect()))
    forced = index_documents(good, "r3", first, cfg=cfg, force=True).points
    assert {r.run_id for r in forced.collect()} == {"r3"} and {r.id for r in forced.collect()} == {r.id for r in first.collect()}
    assert index_documents(good, "r4", first, cfg=cfg, force=True, only=["zz"]).documents.count() == 0
    dry = index_documents(good.unionByName(bad), "r5", cfg=cfg, dry_run=True, limit=1)
    assert [r.document_id for r in dry.documents.collect()] == ["d1"] and dry.points is None and dry.quarantine is None
    v = run.points.select(F.size("dense").alias("n"), F.size("sparse").alias("m")).first()
    assert v.n == 32 and v.m > 5
