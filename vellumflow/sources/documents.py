"""Readers of plain text, Markdown and nested page lists: documents to raw blocks in order.

Every reader gives rows (document_id, position, page, type, text, level and more) without a shuffle of texts:
lines of a document stay in the row's task.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vellumflow.functions import visual
from vellumflow.functions.text import WS, inline_text, source_note, squash_ws, strip_ws
from vellumflow.runtime import ship_package

INLINE = "ARRAY<STRUCT<type: STRING, content: STRING>>"
#: What a block of a page list may hold; other keys are ignored.
CONTENT = (
    f"STRUCT<title_content: {INLINE}, level: INT, paragraph_content: {INLINE}, index_content: {INLINE}, list_type: STRING, list_items: ARRAY<STRUCT<item_content: {INLINE}>>, html: STRING, "
    f"table_caption: {INLINE}, table_footnote: {INLINE}, table_type: STRING, chart_caption: {INLINE}, chart_footnote: {INLINE}, image_caption: {INLINE}, image_footnote: {INLINE}, "
    f"image_source: STRUCT<path: STRING>, math_content: STRING, content: STRING, text: STRING, page_header_content: {INLINE}, page_footer_content: {INLINE}, page_number_content: {INLINE}, page_footnote_content: {INLINE}>"
)
BLOCK = f"STRUCT<type: STRING, bbox: ARRAY<DOUBLE>, sub_type: STRING, content: {CONTENT}>"


def paragraphs(df: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Paragraphs of plain text, split at blank lines: (doc, position, text). Null and blank texts have none."""
    parts = F.posexplode(F.split(F.regexp_replace(F.col(text), r"\r\n?", "\n"), r"\n\s*\n"))
    rows = df.select(F.col(doc).alias("document_id"), parts.alias("position", "text"))
    return rows.select("document_id", "position", strip_ws(F.col("text")).alias("text")).where("text <> ''")


def line_class(line: Column) -> Column:
    """heading, table, list, blank or text: what a Markdown line is."""
    return F.when(line.rlike(r"^#{1,6}\s+"), "heading").when(F.length(line) - F.length(F.replace(line, F.lit("|"), F.lit(""))) >= 2, "table").when(line.rlike(r"^([-*+]|\d+[.)])\s+.+$"), "list").when(line == "", "blank").otherwise("text")


def markdown_blocks(df: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Blocks of Markdown: (document_id, position, type, level, text, items).

    Headings stand alone. Rows of a table go on while lines hold a pipe. Items and lines of running text gather
    until a line of another kind; a blank line between items ends the list. All is done inside the row, so a document
    needs no shuffle, and each line is looked at a fixed number of times.
    """
    lines = F.transform(F.split(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"\r\n?", "\n"), "\n"), strip_ws)
    # a letter for each line: its kind, in capitals where it holds a pipe and isn't the row of a table by itself
    letter = lambda x: visual.let(line_class(x), lambda k: F.when(k == "heading", F.when(x.contains("|"), "H").otherwise("h")).when(k == "table", "t").when(k == "list", F.when(x.contains("|"), "L").otherwise("l")).when(k == "blank", "b").otherwise(F.when(x.contains("|"), "X").otherwise("x")))
    kinds = lambda read: F.filter(F.split(F.lower(F.regexp_replace(F.array_join(F.transform(read, letter), ""), r"(?:(?<=t)|\G(?!^))[HLX]", "t")), ""), lambda c: c != "")

    def body(x: Column, k: Column) -> Column:
        return F.when(k == "h", strip_ws(F.regexp_replace(x, r"^#{1,6}\s+", ""))).when(k == "l", F.concat(F.lit("- "), strip_ws(F.regexp_replace(x, r"^([-*+]|\d+[.)])\s+", "")))).otherwise(x)

    def blocks(read: Column, k: Column, first: Column) -> Column:
        made = F.transform(first, lambda s, j: F.struct(F.get(k, s).alias("k"), F.length(F.regexp_extract(F.get(read, s), "^(#{1,6})", 1)).alias("level"), F.slice(read, s + 1, F.coalesce(F.get(first, j + 1), F.size(read)) - s).alias("lines")))
        return F.transform(F.filter(made, lambda b: b["k"] != "b"), lambda b: F.struct(b["k"].alias("k"), b["level"].alias("level"), F.transform(b["lines"], lambda x: body(x, b["k"])).alias("lines")))

    begins = lambda k: F.filter(F.sequence(F.lit(0), F.size(k) - 1), lambda i: (i == 0) | (F.get(k, i) == "h") | (F.get(k, i) != F.get(k, i - 1)))
    # each step is a value of its own inside the expression, computed once and not again for every line
    found = visual.let(lines, lambda read: visual.let(kinds(read), lambda k: visual.let(begins(k), lambda first: blocks(read, k, first))))
    rows = df.select(F.col(doc).alias("document_id"), F.posexplode(found).alias("position", "b"))
    joined = F.when(F.col("b.k") == "x", squash_ws(F.array_join("b.lines", " "))).otherwise(F.array_join("b.lines", "\n"))
    kind = F.when(F.col("b.k") == "x", "paragraph").when(F.col("b.k") == "h", "heading").when(F.col("b.k") == "t", "table").otherwise("list")
    return rows.select("document_id", "position", kind.alias("type"), F.when(F.col("b.k") == "h", F.col("b.level")).alias("level"), joined.alias("text"), F.when(F.col("b.k") == "l", F.size("b.lines")).alias("items")).where("text <> ''")


def read_page_lists(spark: SparkSession, path: str, suffix: str = "content_list.json") -> DataFrame:
    """Page lists below a folder: (path, json), whole files, sub-folders included."""
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix}").text(path, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("json"))


def parse_page_lists(df: DataFrame, doc: str = "document_id", json: str = "json") -> tuple[DataFrame, DataFrame]:
    """(pages, rejected): each document's pages as an array of arrays of blocks, and documents whose JSON is no list, with the reason."""
    t = F.trim(F.coalesce(F.col(json), F.lit("")))
    nested = F.from_json(t, f"ARRAY<ARRAY<{BLOCK}>>")
    flat = F.from_json(t, f"ARRAY<{BLOCK}>")
    is_list = F.coalesce(F.schema_of_variant(F.try_parse_json(t)).startswith("ARRAY"), F.lit(False))
    pages = F.when(t.rlike(r"^\[\s*\["), nested).otherwise(F.array(flat))
    rows = df.withColumn("__ok", is_list)
    good = rows.where("__ok").select(F.col(doc).alias("document_id"), pages.alias("pages"))
    bad = rows.where("not __ok").select(F.col(doc).alias("document_id"), F.when(F.try_parse_json(t).isNull(), "not JSON").otherwise("not a list").alias("reason"))
    return good, bad


def raw_blocks(pages: DataFrame) -> DataFrame:
    """One row for each block of the pages in order: document_id, position, page_index, page, source_type, bbox, content, printed_page_number.

    The printed number is that of the last page-number block of the page; it is found inside the row.
    """
    numbered = F.transform(
        "pages",
        lambda p, i: F.transform(
            p,
            lambda b, k: F.struct(
                i.alias("page_index"),
                k.alias("k"),
                b.alias("b"),
                F.try_element_at(F.concat(F.array(F.lit(None).cast("int")), F.filter(F.transform(F.filter(p, lambda x: x["type"] == "page_number"), lambda x: F.nullif(F.regexp_extract(inline_text(x["content"]["page_number_content"]), r"\d+", 0), F.lit("")).try_cast("int")), lambda n: n.isNotNull())), F.lit(-1)).alias("printed"),
            ),
        ),
    )
    rows = pages.select("document_id", F.posexplode(F.flatten(F.filter(numbered, lambda p: p.isNotNull()))).alias("position", "r"))
    return rows.where("r.b is not null").select("document_id", "position", F.col("r.page_index").alias("page_index"), (F.col("r.page_index") + 1).alias("page"), F.col("r.b.type").alias("source_type"), F.col("r.b.bbox").alias("bbox"), F.col("r.b.content").alias("content"), F.col("r.printed").alias("printed_page_number"))


def list_text(content: Column) -> Column:
    """Items with a dash or their number each; the number counts skipped items too."""
    ordered = F.coalesce(content["list_type"].contains("order"), F.lit(False))
    items = F.transform(content["list_items"], lambda x, i: F.struct(inline_text(x["item_content"]).alias("t"), (i + 1).alias("n")))
    kept = F.filter(items, lambda x: x["t"] != "")
    return F.array_join(F.transform(kept, lambda x: F.when(ordered, F.concat_ws(". ", x["n"].cast("string"), x["t"])).otherwise(F.concat(F.lit("- "), x["t"]))), "\n")


def table_markdown(html: Column) -> Column:
    """Pipe table of an HTML table: the first row is the header. Without rows, the text without tags."""
    rows = visual.html_rows(html)
    line = lambda r: F.concat(F.lit("| "), F.array_join(F.transform(r, squash_ws), " | "), F.lit(" |"))
    head = F.get(rows, 0)
    rule = F.concat(F.lit("| "), F.array_join(F.transform(head, lambda _: F.lit("---")), " | "), F.lit(" |"))
    return F.when(F.size(rows) == 0, squash_ws(F.regexp_replace(F.coalesce(html, F.lit("")), "<[^>]+>", " "))).otherwise(F.array_join(F.concat(F.array(line(head), rule), F.transform(F.slice(rows, 2, F.greatest(F.size(rows) - 1, F.lit(1))), line)), "\n"))


def typed_blocks(raw: DataFrame, images_base: str | None = None) -> DataFrame:
    """Raw blocks of page lists with their normalised type, text and what tables, charts, formulas and images bring along; blocks without text are dropped."""
    c, kind = F.col("content"), F.col("source_type")
    lines = lambda *parts: F.concat_ws("\n", *[F.when(p != "", p) for p in parts])
    caption = F.when(kind == "table", inline_text(c["table_caption"])).when(kind == "chart", inline_text(c["chart_caption"])).when(kind == "image", inline_text(c["image_caption"]))
    note = F.when(kind == "table", inline_text(c["table_footnote"])).when(kind == "chart", inline_text(c["chart_footnote"])).when(kind == "image", inline_text(c["image_footnote"]))
    markdown = F.when(kind == "table", table_markdown(c["html"]))
    confidence = F.when(kind == "chart", visual.chart_confidence(caption, note, c["content"]))
    chart_is_table = (kind == "chart") & c["content"].contains("|") & c["content"].contains("---") & (confidence >= 0.8)
    path = c["image_source"]["path"]
    picture = F.when(kind == "image", visual.image_kind(caption, c["content"], path))
    description = F.when(picture.isin("flowchart", "diagram"), visual.mermaid_text(c["content"])).otherwise(strip_ws(F.coalesce(c["content"], F.lit(""))))
    best = F.coalesce(F.nullif(strip_ws(c["content"]), F.lit("")), F.nullif(strip_ws(c["text"]), F.lit("")), F.nullif(inline_text(c["index_content"]), F.lit("")), F.lit(""))
    text = (
        F.when(kind == "title", inline_text(c["title_content"]))
        .when(kind == "paragraph", inline_text(c["paragraph_content"]))
        .when(kind == "list", list_text(c))
        .when(kind == "table", lines(caption, markdown, source_note(note)))
        .when(kind == "chart", visual.chart_text(caption, source_note(note), c["content"]))
        .when(kind == "image", lines(caption, description, source_note(note)))
        .when(kind == "equation_interline", F.when(F.trim(c["math_content"]) != "", F.concat(F.lit("$$ "), F.trim(c["math_content"]), F.lit(" $$"))))
        .when(kind == "page_header", inline_text(c["page_header_content"]))
        .when(kind == "page_footer", inline_text(c["page_footer_content"]))
        .when(kind == "page_number", inline_text(c["page_number_content"]))
        .when(kind == "page_footnote", inline_text(c["page_footnote_content"]))
        .otherwise(best)
    )
    names = {"title": "heading", "paragraph": "paragraph", "list": "list", "table": "table", "image": "figure_caption", "equation_interline": "formula", "page_header": "header", "page_footer": "footer", "page_number": "page_number", "page_footnote": "footnote"}
    block_type = F.when(kind == "chart", F.when(chart_is_table, "table").otherwise("figure_caption"))
    for source, target in names.items():
        block_type = block_type.when(kind == source, target)
    moved = F.concat(F.lit((images_base or "") + "/"), F.try_element_at(F.split(path, "/"), F.lit(-1))) if images_base else path
    rows = raw.select(
        "document_id", "position", "page", "page_index", "printed_page_number", "bbox", "source_type",
        block_type.otherwise("unknown").alias("type"), F.coalesce(text, F.lit("")).alias("text"), F.when(kind == "title", F.coalesce(c["level"], F.lit(1))).alias("level"),
        caption.alias("caption"), note.alias("note"), F.when(kind == "table", markdown).when(chart_is_table, strip_ws(c["content"])).alias("table_markdown"), c["html"].alias("table_html"),
        F.when(path != "", moved).alias("image_uri"), confidence.alias("chart_data_confidence"), F.when(kind == "equation_interline", visual.equation_confidence(c["math_content"])).alias("equation_confidence"),
        picture.alias("image_kind"), F.when(kind == "image", visual.image_is_indexable(picture, caption, description)).alias("image_indexable"), c["list_type"].alias("list_type"),
        F.when(kind == "list", F.size(F.filter(c["list_items"], lambda x: inline_text(x["item_content"]) != ""))).alias("item_count"),
    )
    return rows.where("text <> ''")


def with_fallback(first: DataFrame, second: DataFrame, key: str = "document_id") -> DataFrame:
    """Blocks of the first reader, and of the second for documents the first found none in."""
    seen = first.select(key).distinct()
    return first.unionByName(second.join(seen, key, "left_anti"), allowMissingColumns=True)


def html_blocks(df: DataFrame, doc: str, html: str) -> DataFrame:
    """Headings, paragraphs, list items, tables and page furniture of HTML pages in order: (document_id, position, type, level, text)."""
    ship_package(df.sparkSession)

    def go(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from vellumflow.sources._html import blocks

        for f in frames:
            out = [(d, i, *b) for d, h in zip(f["document_id"], f["html"], strict=True) for i, b in enumerate(blocks(h or ""))]
            yield pd.DataFrame(out, columns=["document_id", "position", "type", "level", "text"]).astype({"level": "Int32"})

    rows = df.select(F.col(doc).alias("document_id"), F.col(html).alias("html"))
    kind = rows.schema["document_id"].dataType.simpleString()
    return rows.mapInPandas(go, f"document_id {kind}, position int, type string, level int, text string")


def best_source(listing: DataFrame, key: str, path: str) -> DataFrame:
    """For each JSON file the Markdown file that belongs to it: same stem, then the folder's full.md, then its only Markdown, then the first by name."""
    folder = F.regexp_replace(F.col(path), "[^/]+$", "")
    stem = F.regexp_replace(F.try_element_at(F.split(F.col(path), "/"), F.lit(-1)), r"(_content_list(_v2)?)?\.(json|md)$", "")
    files = listing.select(F.col(key).alias("key"), F.col(path).alias("path"), folder.alias("folder"), stem.alias("stem"))
    md = files.where("path like '%.md'").withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("folder")))
    js = files.where("path like '%.json'").select(F.col("key").alias("json_key"), F.col("path").alias("json_path"), "folder", F.col("stem").alias("json_stem"))
    rank = F.when(F.col("stem") == F.col("json_stem"), 1).when(F.col("path").endswith("/full.md"), 2).when(F.col("n") == 1, 3).otherwise(4)
    met = js.join(md, "folder", "left").groupBy("json_key", "json_path").agg(F.min(F.when(F.col("path").isNotNull(), F.struct(rank.alias("rank"), F.col("path").alias("path")))).alias("best"))
    return met.select("json_key", "json_path", F.col("best.path").alias("markdown_path"), F.col("best.rank").alias("rank"))


def squashed_lower(c: Column) -> Column:
    return F.lower(squash_ws(F.coalesce(c, F.lit(""))))


__all__ = ["WS", "best_source", "html_blocks", "line_class", "list_text", "markdown_blocks", "paragraphs", "parse_page_lists", "raw_blocks", "read_page_lists", "squashed_lower", "table_markdown", "typed_blocks", "with_fallback"]
