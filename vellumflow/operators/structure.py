"""Document structure: repeated furniture, sections and their paths, paragraphs over page breaks, acronyms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellumflow.functions.text import WS, acronym, heading_level, is_numbered, special_section, squash_ws
from vellumflow.operators.running import running
from vellumflow.runtime import cut

MAX_LEVEL = 6
APPENDICES = ("analytical_appendix", "administrative_appendix")


def repeated_furniture(blocks: DataFrame, doc: str = "document_id", page: str = "page", kind: str = "type", text: str = "text") -> DataFrame:
    """(document_id, type, key, pages): header and footer texts on as many pages as make them furniture: min(3, max(2, half the pages)). Without pages a document counts as one page."""
    pages = blocks.groupBy(doc).agg(F.greatest(F.countDistinct(F.col(page)), F.lit(1)).alias("__pages"))
    limit = F.least(F.lit(3), F.greatest(F.lit(2), F.floor(F.col("__pages") * 0.5)))
    key = F.lower(squash_ws(F.coalesce(F.col(text), F.lit(""))))
    found = blocks.where(F.col(kind).isin("header", "footer")).groupBy(doc, F.col(kind).alias("type"), key.alias("key")).agg(F.countDistinct(F.coalesce(F.col(page), F.lit(0))).alias("pages"))
    return found.join(pages, doc).where(F.col("pages") >= limit).select(doc, "type", "key", "pages")


def drop_furniture(blocks: DataFrame, doc: str = "document_id", page: str = "page", kind: str = "type", text: str = "text", keep_footnotes: bool = True) -> DataFrame:
    """Blocks without page numbers and repeated headers and footers, on request without footnotes."""
    repeated = repeated_furniture(blocks, doc, page, kind, text).select(F.col(doc).alias("__d"), F.col("type").alias("__t"), F.col("key").alias("__k"))
    key = F.lower(squash_ws(F.coalesce(F.col(text), F.lit(""))))
    kept = blocks.join(repeated, (F.col(doc) == F.col("__d")) & (F.col(kind) == F.col("__t")) & (key == F.col("__k")), "left_anti")
    kept = kept.where(F.coalesce(F.col(kind), F.lit("")) != "page_number")
    return kept if keep_footnotes else kept.where(F.coalesce(F.col(kind), F.lit("")) != "footnote")


def assign_sections(blocks: DataFrame, doc: str = "document_id", order: str = "position", kind: str = "type", text: str = "text", level: str | None = "level", list_type: str | None = None, bucket: int = 4096) -> DataFrame:
    """Blocks with heading_level, section_kind, section_path and effective type.

    The state of a section is a closed form over the headings so far: a special heading names its own kind; else
    the last appendix holds, else the body once a numbered ordinary heading came, else the front matter. The path
    holds the last heading of each level that is later than those of all lower levels; levels beyond 6 count as 6.
    Prose, lists and footnotes under a bibliography, and lists marked as reference lists, become references.
    Blank texts are dropped; a null order comes first.
    """
    t = F.trim(F.coalesce(F.col(text), F.lit("")))
    rows = blocks.where(t != "")
    is_heading = F.coalesce(F.col(kind).isin("heading", "title"), F.lit(False))
    fallback = F.col(level).cast("int") if level else F.lit(None).cast("int")
    lev = F.least(heading_level(t, fallback), F.lit(MAX_LEVEL))
    special = special_section(t)
    lasts = {
        "__special": F.when(is_heading, F.struct(special.alias("v"))),
        "__appendix": F.when(is_heading & special.isin(*APPENDICES), special),
    }
    for k in range(1, MAX_LEVEL + 1):
        lasts[f"__h{k}"] = F.when(is_heading & (lev == k), F.struct(F.col(order).cast("long").alias("o"), t.alias("t")))
    maxima = {"__body": F.when(is_heading & special.isNull() & is_numbered(t), 1)}
    state = running(rows, [doc], order, lasts=lasts, maxima=maxima, bucket=bucket)
    base = F.coalesce(F.col("__appendix"), F.when(F.col("__body") == 1, F.lit("body")), F.lit("front_matter"))
    section = F.coalesce(F.col("__special.v"), base)
    parts = []
    for k in range(1, MAX_LEVEL + 1):
        later = F.lit(True)
        for j in range(1, k):
            later = later & (F.col(f"__h{j}").isNull() | (F.col(f"__h{k}.o") > F.col(f"__h{j}.o")))
        parts.append(F.when(F.col(f"__h{k}").isNotNull() & later, F.col(f"__h{k}.t")))
    marked = (F.col(list_type) == "reference_list") if list_type else F.lit(False)
    reference = ~is_heading & (((section == "bibliography") & F.col(kind).isin("paragraph", "list", "footnote")) | ((F.col(kind) == "list") & F.coalesce(marked, F.lit(False))))
    return state.select(
        *[c for c in blocks.columns if c not in ("heading_level", "section_kind", "section_path", "effective_type")],
        F.when(is_heading, lev).alias("heading_level"),
        section.alias("section_kind"),
        F.array_compact(F.array(*parts)).alias("section_path"),
        F.when(reference, F.lit("reference")).otherwise(F.col(kind)).alias("effective_type"),
    )


def acronyms(blocks: DataFrame, doc: str = "document_id", order: str = "position", text: str = "text") -> DataFrame:
    """(document_id, sigla, expansion): the first expansion of each acronym in the lines of the given blocks."""
    lines = blocks.select(doc, order, F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), "\n")).alias("line_no", "line")).withColumn("a", acronym(F.col("line"))).where("a is not null")
    return lines.groupBy(doc, F.col("a.sigla").alias("sigla")).agg(F.min_by("a.expansion", F.struct(order, "line_no")).alias("expansion"))


#: Ends after which a paragraph doesn't go on, and beginnings with which it does.
CONCLUSIVE = r"""[.!?:;”"')\]]\s*$"""
HYPHEN = r"[A-Za-zÀ-ÿ]-$"
TRAILING, LEADING = WS + "+$", "^" + WS + "+"
GOES_ON = r"^\s*(?:R\$|US\$|[a-zà-ÿ0-9(%,\-–—])"


def could_continue(a_text: Column, b_text: Column) -> Column:
    return ~F.coalesce(a_text, F.lit("")).rlike(CONCLUSIVE) & F.coalesce(b_text, F.lit("")).rlike(GOES_ON)


def merge_over_pages(blocks: DataFrame, doc: str = "document_id", order: str = "order_index", bbox_tolerance: float = 0.12) -> DataFrame:
    """Paragraphs cut by a page break put together: (document_id, order_index, text, pages, block_ids, merged).

    ``blocks`` has block_id, block_type, text, page_number, bbox, section_path and section_kind. Chains go on
    with the merged text; page and box stay those of the first block. Neighbours that can't join whatever was
    merged before are told from the row before, so only short runs are scanned, in the JVM and spread over all tasks: a run is
    a stretch of paragraphs each of which might continue the one before.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    path = F.xxhash64(F.coalesce("section_path", F.array().cast("array<string>")), F.col("section_kind"))
    # only flags take part in the scans; texts join once
    thin = cut(blocks.select(doc, order, "block_id", "block_type", path.alias("path"), F.col("page_number").isNotNull().alias("paged"), (~text.rlike(CONCLUSIVE)).alias("open"), text.rlike(GOES_ON).alias("goes_on")))
    seen = running(thin, [doc], order, "block_id", lasts={"__before": F.struct("block_type", "path", "open")}, exclusive=True)
    joined = F.coalesce((F.col("block_type") == "paragraph") & (F.col("__before.block_type") == "paragraph") & (F.col("path") == F.col("__before.path")) & F.col("paged") & F.col("__before.open") & F.col("goes_on"), F.lit(False))
    starts = seen.select(doc, order, "block_id", F.when(joined, 0).otherwise(1).alias("__start"))
    numbered = running(starts, [doc], order, "block_id", sums={"__run": F.col("__start")}).select(doc, order, "block_id", "__run")
    runs = blocks.select(doc, order, "block_id", "text", "page_number", "bbox").join(numbered, [doc, order, "block_id"])
    item = F.struct(F.col(order).alias("o"), "block_id", F.coalesce("text", F.lit("")).alias("text"), F.col("page_number").cast("int").alias("page"), "bbox")
    grouped = runs.groupBy(doc, "__run").agg(F.array_sort(F.collect_list(item)).alias("items"))
    # of a run, which neighbours join depends only on the page and the box of the block that the chain began with
    chain = "struct<n:int,page:int,left:double,right:double,of:array<int>>"

    def step(state: Column, x: Column) -> Column:
        left, right = F.get(x["bbox"], 0), F.when(F.size(x["bbox"]) >= 4, F.get(x["bbox"], 2))
        apart = F.abs(state["left"] - left) > F.greatest(F.lit(60.0), F.lit(bbox_tolerance) * F.greatest(state["right"], right, F.lit(1.0)))
        far = F.coalesce(apart & state["right"].isNotNull() & right.isNotNull(), F.lit(False))
        joins = F.coalesce((state["n"] >= 0) & (x["page"] > state["page"]), F.lit(False)) & ~far
        n = F.when(joins, state["n"]).otherwise(state["n"] + 1)
        begun = lambda old, new: F.when(joins, old).otherwise(new)
        return F.struct(n.alias("n"), begun(state["page"], x["page"]).alias("page"), begun(state["left"], left).alias("left"), begun(state["right"], right).alias("right"), F.concat(state["of"], F.array(n)).alias("of")).cast(chain)

    start = F.struct(F.lit(-1).alias("n"), F.lit(None).alias("page"), F.lit(None).alias("left"), F.lit(None).alias("right"), F.array().alias("of")).cast(chain)
    numbered_items = grouped.withColumn("of", F.when(F.size("items") == 1, F.array(F.lit(0))).otherwise(F.aggregate("items", start, step)["of"]))
    chains = numbered_items.select(doc, F.explode(F.sequence(F.lit(0), F.array_max("of"))).alias("__k"), "items", "of").withColumn("c", F.filter("items", lambda x, i: F.get(F.col("of"), i) == F.col("__k")))
    # a hyphen behind a letter goes where the next text is put on
    glue = lambda t, x: F.when(F.regexp_replace(t, TRAILING, "").rlike(HYPHEN), F.concat(F.regexp_replace(t, "-" + WS + "*$", ""), F.regexp_replace(x["text"], LEADING, ""))).otherwise(F.concat(F.regexp_replace(t, TRAILING, ""), F.lit(" "), F.regexp_replace(x["text"], LEADING, "")))
    text = F.when(F.size("c") == 1, F.get("c", 0)["text"]).otherwise(F.aggregate(F.slice("c", 2, F.size("c")), F.get("c", 0)["text"], glue))
    pages = F.array_sort(F.array_distinct(F.array_compact(F.transform("c", lambda x: x["page"]))))
    return chains.select(doc, F.get("c", 0)["o"].alias(order), text.alias("text"), pages.alias("pages"), F.transform("c", lambda x: x["block_id"]).alias("block_ids"), (F.size("c") > 1).alias("merged"))


def titles(blocks: DataFrame, doc: str = "document_id", order: str = "position", kind: str = "type", text: str = "text", given: DataFrame | None = None) -> DataFrame:
    """(document_id, title): the given title, else the text of the first heading."""
    first = blocks.where(F.col(kind) == "heading").groupBy(doc).agg(F.min_by(text, order).alias("title"))
    if given is None:
        return first
    return given.select(doc, F.col("title").alias("given")).join(first, doc, "full").select(doc, F.coalesce(F.nullif(F.trim("given"), F.lit("")), "title").alias("title"))


BLOCK_SCHEMA = T.StructType(
    [
        T.StructField("document_id", T.StringType()),
        T.StructField("block_id", T.StringType()),
        T.StructField("order_index", T.IntegerType()),
        T.StructField("block_type", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("raw_text", T.StringType()),
        T.StructField("page_number", T.IntegerType()),
        T.StructField("printed_page_number", T.IntegerType()),
        T.StructField("heading_level", T.IntegerType()),
        T.StructField("section_path", T.ArrayType(T.StringType())),
        T.StructField("section_kind", T.StringType()),
        T.StructField("chunkable", T.BooleanType()),
    ]
)


def materialise(blocks: DataFrame) -> DataFrame:
    """Sectioned blocks as records of BLOCK_SCHEMA: ids block-0001 by position, normalised text for running text, furniture not chunkable."""
    from vellumflow.functions.text import normalize_text

    as_is = F.col("effective_type").isin("list", "table", "figure_caption", "formula")
    return blocks.select(
        F.col("document_id").cast("string").alias("document_id"),
        F.format_string("block-%04d", F.col("position").cast("int")).alias("block_id"),
        F.col("position").cast("int").alias("order_index"),
        F.col("effective_type").alias("block_type"),
        F.when(as_is, F.col("text")).otherwise(normalize_text(F.col("text"))).alias("text"),
        F.col("text").alias("raw_text"),
        F.col("page").cast("int").alias("page_number"),
        F.col("printed_page_number").cast("int").alias("printed_page_number"),
        "heading_level",
        "section_path",
        "section_kind",
        (~F.col("effective_type").isin("header", "footer", "page_number")).alias("chunkable"),
    )
