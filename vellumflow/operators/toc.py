"""Tables of contents: entries from lines, matching with headings, findings and reports."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vellumflow.functions.text import heading_level, is_short_title, match_key, numbering_of, special_section, squash_ws, strip_numbering
from vellumflow.runtime import ship_package

#: Patterns of entries and illustrations, and thresholds of matching.
ENTRY = r"^(.*?)[\s.·…_–-]*[\s.](\d{1,4})\s*$"
PAGE_ONLY = r"^[\s.·…_–-]*(\d{1,4})\s*$"
ILLUSTRATION = r"(?iu)^\s*(tabelas?|quadros?|gr[áa]ficos?|figuras?|mapas?|imagens?|box|ilustra[çc][ãa]o)\s*\d"
MIN_ENTRIES_PER_BLOCK, MIN_ENTRIES, MIN_MATCH_RATE = 3, 5, 0.6
PREFIX_CHARS, PREFIX_RATIO, FUZZY_RATIO, NARROW = 12, 0.6, 0.85, 0.35


def entries(blocks: DataFrame, doc: str = "document_id", block: str = "block_id", text: str = "text", page: str = "page_number", order: str = "order_index") -> DataFrame:
    """(document_id, block_id, entry_no, title, page, level, numbering, lines, level_inferred) of the blocks' lines.

    Lines gather until one carries a page; a line of a page alone closes what is gathered. Blocks of under three
    entries, and those of mostly illustrations, are left out. Lines of a block stay in one small group.
    """
    lines = blocks.select(doc, block, F.col(page).alias("source_page"), F.col(order).alias("block_order"), F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), r"\r?\n")).alias("line_no", "line")).withColumn("line", F.trim("line")).where("line <> ''")
    within = Window.partitionBy(doc, block).orderBy("line_no")
    whole = F.col("line").rlike(PAGE_ONLY)
    closes = whole | F.col("line").rlike(ENTRY)
    grouped = lines.withColumn("closes", closes.cast("int")).withColumn("g", F.coalesce(F.sum("closes").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    first_in_group = F.row_number().over(Window.partitionBy(doc, block, "g").orderBy("line_no")) == 1
    # a page alone with nothing gathered before it is an entry line without a title, if it has one at all
    tail = F.when(whole & ~first_in_group, "").when(F.col("closes") == 1, F.regexp_extract("line", ENTRY, 1)).otherwise(F.col("line"))
    number = F.when(whole, F.regexp_extract("line", PAGE_ONLY, 1)).when(F.col("closes") == 1, F.regexp_extract("line", ENTRY, 2))
    parts = grouped.withColumns({"part": tail, "number": number.try_cast("int")})
    made = parts.groupBy(doc, block, "source_page", "block_order", "g").agg(
        F.array_sort(F.collect_list(F.struct("line_no", "part"))).alias("parts"), F.max("number").alias("page"), F.max("closes").alias("closed")
    ).where("closed = 1")
    titled = made.withColumn("kept", F.filter(F.transform("parts", lambda p: p["part"]), lambda p: p != "")).withColumn("title", squash_ws(F.array_join("kept", " "))).where("title <> ''")
    per_block = Window.partitionBy(doc, block)
    good = titled.withColumn("__n", F.count(F.lit(1)).over(per_block)).withColumn("__i", F.avg(F.col("title").rlike(ILLUSTRATION).cast("double")).over(per_block)).where((F.col("__n") >= MIN_ENTRIES_PER_BLOCK) & (F.col("__i") <= 0.5))
    numbered = F.regexp_extract("title", r"^\s*(\d+(?:\.\d+)*)\.?\s+\S", 1)
    return good.select(
        doc, block, "source_page", "block_order", (F.row_number().over(per_block.orderBy("g")) - 1).alias("entry_no"), "title", "page", heading_level(F.col("title"), F.lit(None).cast("int")).alias("level"),
        F.nullif(numbered, F.lit("")).alias("numbering"), F.size("kept").alias("lines"), (numbered == "").alias("level_inferred"),
    )


def contents_blocks(blocks: DataFrame, doc: str = "document_id") -> DataFrame:
    """Blocks that may hold a table of contents: index blocks, and in documents without any the lists and paragraphs of a contents section."""
    index = blocks.where("block_type = 'index'")
    other = blocks.where("section_kind = 'table_of_contents' and block_type in ('list', 'paragraph')")
    return index.unionByName(other.join(index.select(doc).distinct(), doc, "left_anti"))


def match_headings(headings: DataFrame, toc: DataFrame, doc: str = "document_id") -> DataFrame:
    """(document_id, block_id, entry): each heading's entry number in its document's list, null without one; an entry is used once, in document order.

    Only headings and entries of a document meet, never its other blocks.
    """
    ship_package(headings.sparkSession)
    h = headings.select(doc, F.struct("order_index", "block_id", numbering_of(F.col("text")).alias("numbering"), match_key(strip_numbering(F.col("text"))).alias("key")).alias("h")).groupBy(doc).agg(F.array_sort(F.collect_list("h")).alias("hs"))
    e = toc.select(doc, F.struct(F.col("entry").alias("entry"), "numbering", match_key(strip_numbering(F.col("title"))).alias("key")).alias("e")).groupBy(doc).agg(F.array_sort(F.collect_list("e")).alias("es"))
    kind = headings.schema[doc].dataType.simpleString()

    def go(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from vellumflow.operators._toc import match

        for f in frames:
            out = [(d, block, entry) for d, hs, es in zip(f[doc], f["hs"], f["es"], strict=True) for block, entry in match([tuple(x.values()) for x in hs], [tuple(x.values()) for x in es])]
            yield pd.DataFrame(out, columns=[doc, "block_id", "entry"]).astype({"entry": "Int32"})

    return h.join(e, doc).select(doc, "hs", "es").mapInPandas(go, f"`{doc}` {kind}, block_id string, entry int")


def validate(blocks: DataFrame, toc: DataFrame, doc: str = "document_id") -> tuple[DataFrame, DataFrame]:
    """(report, findings) of each document with a table of contents.

    ``blocks``: document_id, block_id, order_index, block_type, text, heading_level, section_kind, page_number, bbox.
    ``toc``: entries(). A list of under five entries, or one that finds under 60 % of its own entries, judges nothing.
    """
    numbered = toc.withColumn("entry", F.row_number().over(Window.partitionBy(doc).orderBy("block_order", "block_id", "entry_no")) - 1)
    headings = blocks.where("block_type in ('heading', 'title')")
    matched = match_headings(headings, numbered, doc)
    hits = headings.join(matched, [doc, "block_id"], "left").join(numbered.select(doc, "entry", F.col("title").alias("toc_title"), F.col("level").alias("toc_level"), F.col("page").alias("toc_page"), "level_inferred"), [doc, "entry"], "left")
    width = F.when(F.size("bbox") >= 4, F.get("bbox", 2) - F.get("bbox", 0))
    hits = hits.withColumn("width", width)
    per = hits.groupBy(doc).agg(F.count(F.lit(1)).alias("headings_total"), F.count("entry").alias("headings_matched"), F.median(F.when(F.col("entry").isNotNull() & (F.col("width") > 0), F.col("width"))).alias("median_width"))
    sizes = numbered.groupBy(doc).agg(F.count(F.lit(1)).alias("entries"))
    report = sizes.join(per, doc, "left").na.fill(0, ["headings_total", "headings_matched"]).withColumn("match_rate", F.col("headings_matched") / F.col("entries"))
    report = report.withColumn("reliable", (F.col("entries") >= MIN_ENTRIES) & (F.col("match_rate") >= MIN_MATCH_RATE))
    report = report.withColumn("gate", F.when(F.col("entries") < MIN_ENTRIES, "too_few_entries").when(F.col("match_rate") < MIN_MATCH_RATE, "low_match_rate").otherwise("ok"))
    judged = hits.join(report.where("reliable").select(doc, "median_width"), doc)
    ratio = F.when(F.col("median_width") > 0, F.col("width") / F.col("median_width"))
    suspect = numbering_of(F.col("text")).isNull() & special_section(F.col("text")).isNull() & (is_short_title(F.col("text")) | F.coalesce(ratio < NARROW, F.lit(False)))
    kind = F.when(F.col("entry").isNull(), F.when(suspect, "likely_false_heading").otherwise("heading_not_in_toc")).when(F.col("heading_level") != F.col("toc_level"), "level_mismatch")
    impact = section_impact(blocks, doc)
    found = judged.withColumns({"kind": kind, "width_ratio": ratio}).where("kind is not null").join(impact, [doc, "block_id"], "left")
    columns = [doc, "kind", "block_id", F.col("text").alias("heading"), "heading_level", F.col("page_number").alias("heading_page"), "toc_title", "toc_level", "toc_page", "level_inferred", "width_ratio", *[F.when(F.col("kind") == "likely_false_heading", F.col(c)).alias(c) for c in ("kind_before", "kind_after", "blocks_affected")]]
    orphans = numbered.join(report.where("reliable").select(doc), doc, "left_semi").join(matched.where("entry is not null").select(doc, "entry"), [doc, "entry"], "left_anti").select(doc, F.lit("toc_entry_without_heading").alias("kind"), F.col("title").alias("toc_title"), F.col("level").alias("toc_level"), F.col("page").alias("toc_page"), "level_inferred")
    return report.drop("median_width"), found.select(*columns).unionByName(orphans, allowMissingColumns=True)


def section_impact(blocks: DataFrame, doc: str = "document_id") -> DataFrame:
    """(document_id, block_id, kind_before, kind_after, blocks_affected) of each heading: section kind of the block before and after, and blocks up to the next heading."""
    from vellumflow.operators.running import running

    is_heading = F.coalesce(F.col("block_type").isin("heading", "title"), F.lit(False))
    thin = blocks.select(doc, "block_id", "order_index", "section_kind", is_heading.alias("h"))
    state = running(thin, [doc], "order_index", "block_id", sums={"before": F.lit(1), "heading_no": F.col("h").cast("int")}, lasts={"kind_before": F.when(~F.col("h"), F.col("section_kind"))})
    heads = state.where("h").select(doc, "block_id", "heading_no", F.col("section_kind").alias("kind_after"), "kind_before")
    counted = state.where("not h").groupBy(doc, "heading_no").agg(F.count(F.lit(1)).alias("blocks_affected"))
    return heads.join(counted, [doc, "heading_no"], "left").na.fill(0, ["blocks_affected"]).drop("heading_no")


def summary(report: DataFrame, findings: DataFrame, doc: str = "document_id") -> DataFrame:
    """Findings by kind of each document and the blocks under doubtful headings, most affected first."""
    kinds = ("likely_false_heading", "heading_not_in_toc", "level_mismatch", "toc_entry_without_heading")
    counts = findings.groupBy(doc).agg(*[F.count_if(F.col("kind") == k).alias(k) for k in kinds], F.coalesce(F.sum("blocks_affected"), F.lit(0)).alias("blocks_affected"))
    return report.join(counts, doc, "left").na.fill(0, [*kinds, "blocks_affected"]).orderBy(F.desc("blocks_affected"), doc)
