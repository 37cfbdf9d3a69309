import pytest
from pyspark.sql import functions as F

from vellumflow.sources import collections

POINT = "chunk_id string, text string, dense array<double>, sparse map<string,double>"


def test_a_collection_shows_whole_runs(spark, tmp_path):
    folder = f"file://{tmp_path}/points"
    with pytest.raises(ValueError):
        collections.write_run(spark.createDataFrame([], POINT), folder, "r1")
    assert collections.create(spark, folder, 2) and not collections.create(spark, folder, 2) and collections.read(spark, folder) is None
    with pytest.raises(ValueError):
        collections.create(spark, folder, 3)
    one = spark.createDataFrame([("a", "x", [1.0, 0.0], {"t": 1.0}), ("b", "yz", [0.0, 1.0], {})], POINT)
    collections.write_run(one, folder, "r1")
    assert {r.chunk_id for r in collections.read(spark, folder).collect()} == {"a", "b"}
    for bad in (spark.createDataFrame([("c", "x", [1.0], {})], POINT), spark.createDataFrame([("c", "x", None, {})], POINT)):
        with pytest.raises(ValueError):
            collections.write_run(bad, folder, "r2")
    assert collections.read(spark, folder).count() == 2
    collections.write_run(one.where("chunk_id = 'a'"), folder, "r2")
    assert [r.chunk_id for r in collections.read(spark, folder).collect()] == ["a"]
    assert collections.create(spark, folder, 3, reset=True) and collections.read(spark, folder) is None
    s = collections.index_statistics(one, seconds=2.0).first()
    assert (s.n_points, s.avg_sparse_tokens, s.n_chars, s.chars_per_second) == (2, 0.5, 3, 1.5)


def test_given_vectors(spark):
    chunks = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), (None, 4)], "chunk_id string, n int")
    dense = spark.createDataFrame([("a", [1.0]), ("a", [1.0]), ("b", [2.0]), (None, [3.0])], "chunk_id string, dense array<double>")
    sparse = spark.createDataFrame([("a", {"t": 1.0}), ("c", {"u": 1.0})], "chunk_id string, sparse map<string,double>")
    whole, without = collections.with_vectors(chunks, dense, sparse)
    assert [(r.chunk_id, r.n, r.dense, r.sparse) for r in whole.collect()] == [("a", 1, [1.0], {"t": 1.0})]
    assert sorted(r.n for r in without.collect()) == [2, 3, 4] and without.columns == chunks.columns
    left = collections.replace_documents(chunks.withColumn("document_id", F.col("chunk_id")), dense.withColumn("document_id", F.col("chunk_id")), chunks.where("n = 2").withColumn("document_id", F.col("chunk_id")))
    assert sorted(r.n for r in left.collect()) == [2, 3, 4]
