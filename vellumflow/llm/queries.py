"""Queries of the training-data operators, by name; each takes (spark, folder of the tables)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumflow.llm import markup, neardup, packing, quality, sameform, sentences, splitting, tokens
from vellumflow.operators.pairs import BROADCAST_BYTES, sized
from vellumflow.runtime import table

Query = Callable[[SparkSession, str], DataFrame]


def p6_ids(spark: SparkSession, sf: str) -> DataFrame:
    return tokens.encode_texts(table(spark, sf, "documents"), keep=["doc_id"])


def p6_texts(spark: SparkSession, sf: str) -> DataFrame:
    """The text that each document's ids decode to."""
    return tokens.decode_ids(p6_ids(spark, sf), keep=["doc_id"])


#: Problem 3 as TESTDATA.md states it: runs of three words, similarity 0.6, at least 30 runs.
P3 = {"id_col": "chunk_id", "text": "text", "run": 3, "threshold": 0.6, "least_runs": 30}


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    members, links = neardup.near_duplicates(table(spark, sf, "chunks"), **P3)
    return neardup.near_duplicate_pairs(members, links).toDF("chunk_id_a", "chunk_id_b")


def p3_classes(spark: SparkSession, sf: str) -> DataFrame:
    """Each chunk's class of equal run sets, and how many other classes are near duplicates of it."""
    members, links = neardup.near_duplicates(table(spark, sf, "chunks"), **P3)
    return neardup.near_duplicate_classes(members, links).withColumnRenamed("id", "chunk_id")


def units(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """Blocks and chunks under one name: document_id, unit_id and the columns, one row for each row delivered."""
    blocks = table(spark, sf, "blocks").select("document_id", F.col("block_id").alias("unit_id"), *columns)
    return blocks.unionByName(table(spark, sf, "chunks").select("document_id", F.col("chunk_id").alias("unit_id"), *columns))


def p1_statistics(spark: SparkSession, sf: str) -> DataFrame:
    """Statistics and prose score of every chunk."""
    chunks = table(spark, sf, "chunks")
    model = quality.fit_on_labels(chunks, table(spark, sf, "chunk_labels"))
    return quality.text_statistics(chunks, model, keep=["chunk_id"])


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return p1_statistics(spark, sf).where("prose_score < 0.5").select("chunk_id").distinct()


def _typed_units(spark: SparkSession, sf: str) -> DataFrame:
    """Units with their text and whether their type is formula."""
    blocks = table(spark, sf, "blocks").select("document_id", F.col("block_id").alias("unit_id"), "text", F.col("block_type").alias("kind"))
    chunks = table(spark, sf, "chunks").select("document_id", F.col("chunk_id").alias("unit_id"), "text", F.col("content_type").alias("kind"))
    return blocks.unionByName(chunks).withColumn("is_formula", F.coalesce(F.lower(F.trim("kind")) == "formula", F.lit(False))).drop("kind")


def p2_text(spark: SparkSession, sf: str) -> DataFrame:
    """Clean text of every block and chunk, with headings, lists, tables, code and formulas in one form; formula units stay as they are."""
    rows = _typed_units(spark, sf)
    texts = rows.where("not is_formula").drop("is_formula")
    done = markup.strip_markup(texts, keep=["document_id", "unit_id"], form="structured")
    formulas = rows.where("is_formula").select("document_id", "unit_id", F.col("text").alias("clean_text"), F.lit(0).alias("n_marks"), F.array().cast("array<string>").alias("mark_kinds"))
    return done.unionByName(formulas)


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    """Units in which the model finds residue; texts without any special character can't be among them."""
    rows = _typed_units(spark, sf).where(~F.col("is_formula") & markup.maybe_marked(F.col("text")))
    return markup.strip_markup(rows, keep=["document_id", "unit_id"]).where("n_marks > 0").select("document_id", "unit_id").distinct()


def p4_pieces(spark: SparkSession, sf: str) -> DataFrame:
    return splitting.split_oversized(units(spark, sf, "text", "section_path"), ["document_id", "unit_id"], keep=["section_path"])


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return p4_pieces(spark, sf).select("document_id", "unit_id").distinct()


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    sample = table(spark, sf, "sentence_sample").groupBy("document_id", "block_id").agg(F.max("lang").alias("lang"))
    sample = F.broadcast(sample) if sized(sample)[1] <= BROADCAST_BYTES else sample
    blocks = table(spark, sf, "blocks").select("document_id", "block_id", "text").join(sample, ["document_id", "block_id"])
    found = sentences.split_sentences(blocks, ["document_id", "block_id"], lang="lang")
    return found.drop("sentence_index").distinct()


def p5_sentences(spark: SparkSession, sf: str) -> DataFrame:
    """Sentences of every block; the language of a text is found from it."""
    return sentences.split_sentences(table(spark, sf, "blocks"), ["document_id", "block_id"]).distinct()


def p7_containers(spark: SparkSession, sf: str) -> DataFrame:
    """Documents in containers of each capacity, sized in tokens of byte_bpe_50k."""
    sizes = tokens.encode_texts(table(spark, sf, "documents"), keep=["doc_id"], out="n_tokens", only_count=True)
    return packing.fill_containers(sizes, table(spark, sf, "container_specs"), "doc_id").withColumnRenamed("id", "doc_id")


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    return sameform.equal_form_pairs(table(spark, sf, "documents"), "doc_id").toDF("doc_id_a", "doc_id_b")


def p8_classes(spark: SparkSession, sf: str) -> DataFrame:
    """Each document's class of texts that read the same, and how many other texts are in it."""
    return sameform.form_classes(sameform.form_members(table(spark, sf, "documents"), "doc_id")).withColumnRenamed("id", "doc_id")


def p8_forms(spark: SparkSession, sf: str) -> DataFrame:
    return sameform.same_form(table(spark, sf, "documents"), keep=["doc_id"])


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (p1_found, p1_statistics, p2_found, p2_text, p3_found, p3_classes, p4_found, p4_pieces, p5_found, p5_sentences, p6_ids, p6_texts, p7_containers, p8_found, p8_classes, p8_forms)}


_P3_SQL = """with c as (select distinct chunk_id, list_filter(string_split_regex(lower(text), '[ \\t\\r\\n]+'), lambda x: x <> '') as w from chunks where chunk_id is not null and text is not null),
r as (select distinct chunk_id, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || chr(31) || w[i + 1] || chr(31) || w[i + 2])) as run from c where len(w) > 2),
n as (select chunk_id, count(*) as n from r group by 1 having count(*) >= 30), k as (select r.* from r join n using (chunk_id)),
s as (select a.chunk_id as a, b.chunk_id as b, count(*) as shared from k a join k b on a.run = b.run and a.chunk_id < b.chunk_id group by 1, 2)
select s.a as chunk_id_a, s.b as chunk_id_b from s join n x on x.chunk_id = s.a join n y on y.chunk_id = s.b where shared >= 0.6 * (x.n + y.n - shared)"""
_P4_SQL = r"""with u as (select document_id, block_id as unit_id, text from blocks union all select document_id, chunk_id, text from chunks)
select distinct document_id, unit_id from u where length(text) > 6144 or len(regexp_extract_all(text, '[^ \t\n\r]+')) > 768"""


def oracle_sql() -> dict[str, str]:
    """Problem 3 and 4 by their definitions, decoded ids by the texts themselves; the others are tested against brute force, round trips and held-out data."""
    return {"p3_found": _P3_SQL, "p4_found": _P4_SQL, "p6_texts": "select doc_id, coalesce(text, '') as text from documents"}
