"""Blocks to chunks: structural packing within token limits, tables and lists by rows and items, overlap, ids.

A document isn't folded as a whole. What decides is thin: keys, roles and token counts. Islands (stretches between
headings, tables, lists and changes of path) are numbered with running sums, cuts within an island are found from its
counts alone (16 bytes a block), and only then do texts meet, once, in one row per chunk, whose size is bounded by the
limits. No text is sorted with its document's or its island's, or written to a checkpoint.

Limits are counted by a token counter (functions.counting), by white space where none is given.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict, dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellumflow.functions import ids, visual
from vellumflow.functions.counting import WORDS, TokenCounter
from vellumflow.functions.quality import chunk_reason
from vellumflow.functions.text import looks_complete, spaced_capitals
from vellumflow.operators import _boundaries
from vellumflow.operators.running import running
from vellumflow.runtime import cut, ship_package

NAVIGATION = ("table_of_contents", "list_of_figures", "list_of_tables", "list_of_charts", "acronym_list")


@dataclass(frozen=True)
class ChunkConfig:
    target_tokens: int = 512
    max_tokens: int = 768
    min_tokens: int = 80
    overlap_tokens: int = 64
    max_overlap_tokens: int = 128
    table_max_tokens: int = 1024
    list_max_tokens: int = 768
    force_split_above_tokens: int = 1536
    embed_document_title: bool = True
    embed_section_context: bool = True
    references_mode: str = "separate"
    front_matter_mode: str = "metadata_only"
    appendix_mode: str = "index"
    equation_mode: str = "merge"
    equation_min_confidence: float = 0.4
    table_mode: str = "all"
    table_min_quality: float = 0.5
    chunking_version: str = "2"
    #: Overlap inside split paragraphs is applied again when the whole group gets its overlap.
    overlap_twice: bool = True

    def problems(self) -> list[str]:
        """All violated invariants together."""
        checks = [
            (self.min_tokens > 0, "min_tokens must be positive"),
            (self.min_tokens <= self.target_tokens, "min_tokens must not exceed target_tokens"),
            (self.target_tokens <= self.max_tokens, "target_tokens must not exceed max_tokens"),
            (self.max_tokens <= self.force_split_above_tokens, "max_tokens must not exceed force_split_above_tokens"),
            (0 <= self.overlap_tokens < self.target_tokens, "overlap_tokens must be below target_tokens"),
            (self.overlap_tokens <= self.max_overlap_tokens, "overlap_tokens must not exceed max_overlap_tokens"),
            (self.max_overlap_tokens < self.max_tokens, "max_overlap_tokens must be below max_tokens"),
            (self.table_max_tokens > 0, "table_max_tokens must be positive"),
            (self.list_max_tokens > 0, "list_max_tokens must be positive"),
            (self.references_mode in ("separate", "exclude", "metadata_only", "merge"), "unknown references_mode"),
            (self.front_matter_mode in ("metadata_only", "index"), "unknown front_matter_mode"),
            (self.equation_mode in ("merge", "separate", "all"), "unknown equation_mode"),
            (self.table_mode in ("all", "conditional"), "unknown table_mode"),
            (0 <= self.equation_min_confidence <= 1, "equation_min_confidence must lie in 0..1"),
            (0 <= self.table_min_quality <= 1, "table_min_quality must lie in 0..1"),
            (bool(self.chunking_version), "chunking_version must not be empty"),
        ]
        return [text for ok, text in checks if not ok]

    def __post_init__(self) -> None:
        if found := self.problems():
            raise ValueError("; ".join(found))

    @property
    def hash(self) -> str:
        return ids.config_hash({k: v for k, v in asdict(self).items() if k != "overlap_twice"})


def chunkable(cfg: ChunkConfig, columns: list[str]) -> Column:
    """Whether a block takes part: chunkable, not metadata only, no excluded reference, no weak formula."""
    get = lambda c: F.col(c) if c in columns else F.lit(None)
    out = F.coalesce(get("chunkable").cast("boolean"), F.lit(True))
    if cfg.front_matter_mode == "metadata_only":
        out = out & ~F.coalesce(F.col("section_kind").isin("front_matter", *NAVIGATION), F.lit(False))
    if cfg.references_mode in ("exclude", "metadata_only"):
        out = out & ~F.coalesce(F.col("block_type") == "reference", F.lit(False))
    if cfg.equation_mode == "merge":
        out = out & ~F.coalesce((F.col("block_type") == "formula") & (get("equation_confidence").cast("double") < cfg.equation_min_confidence), F.lit(False))
    return out


PIECE = "array<struct<text:string,method:string,n:int,overlap:int,first:int,last:int,goes_on:boolean>>"
_FIELDS = ("text", "method", "n", "overlap", "first", "last", "goes_on")


def _row(*values: object) -> dict:
    return dict(zip(_FIELDS, values, strict=True))


def _text_pieces(cfg: ChunkConfig, counter: TokenCounter):
    overlap = cfg.overlap_tokens if cfg.overlap_twice else 0

    @F.pandas_udf(PIECE)
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else [_row(*p, None, None, False) for p in _boundaries.cut_text(t, cfg.target_tokens, cfg.max_tokens, overlap, cfg.max_overlap_tokens, counter)] for t in texts])

    return run


def _table_pieces(cfg: ChunkConfig, counter: TokenCounter):
    @F.pandas_udf(PIECE)
    def run(markdown: pd.Series, caption: pd.Series) -> pd.Series:
        cut_one = lambda m, c: _boundaries.cut_table(m, c if isinstance(c, str) else None, cfg.table_max_tokens, counter)
        return pd.Series([None if m is None else [_row(t, "table_rows", None, 0, x, y, more) for t, x, y, more in cut_one(m, c)] or None for m, c in zip(markdown, caption, strict=True)])

    return run


def _list_pieces(cfg: ChunkConfig, counter: TokenCounter):
    @F.pandas_udf(PIECE)
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else [_row(p, "list_items", None, 0, x, y, more) for p, x, y, more in _boundaries.cut_list(t, cfg.list_max_tokens, counter)] for t in texts])

    return run


def _planner(cfg: ChunkConfig, joint: int):
    """Numbers of the drafts that each block of an island goes to, one for each of its pieces: blocks packed, then small drafts put to the one before."""

    @F.pandas_udf("array<array<int>>")
    def run(counts: pd.Series, pieces: pd.Series) -> pd.Series:
        out = []
        for sizes, cuts in zip(counts, pieces, strict=True):
            sizes = [int(n) for n in sizes]
            firsts = _boundaries.packed(sizes, cfg.target_tokens, cfg.max_tokens)
            drafts: list[int] = []
            span: list[tuple[int, int]] = []  # drafts that each block is in, before small ones move
            for a, b in _boundaries.spans(firsts, len(sizes)):
                own = [int(n) for n in cuts[a]] if cuts[a] is not None and len(cuts[a]) else [sum(sizes[a:b]) + joint * (b - a - 1)]
                span += [(len(drafts), len(drafts) + len(own))] * (b - a)
                drafts += own
            to = _boundaries.run_numbers(_boundaries.gathered(drafts, cfg.min_tokens, cfg.max_tokens, joint), len(drafts)).tolist()
            out.append([to[a:b] for a, b in span])
        return pd.Series(out)

    return run


def _tailer(cfg: ChunkConfig, counter: TokenCounter):
    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else _boundaries.tail(t, cfg.overlap_tokens, cfg.max_overlap_tokens, counter))

    return run


def roles(cfg: ChunkConfig, columns: list[str]) -> Column:
    """What a block is to chunking: heading, skip, table, list, figure, reference or text."""
    kind = F.lower(F.col("block_type"))
    return (
        F.when(kind.isin("heading", "title"), "heading")
        .when(~chunkable(cfg, columns), "skip")
        .when(kind == "table", "table")
        .when(kind == "list", "list")
        .when(kind.isin("figure_caption", "figure", "image"), "figure")
        .when((kind == "reference") & F.lit(cfg.references_mode == "separate"), "reference")
        .when(kind.isin("header", "footer", "page_number"), "skip")
        .otherwise("text")
    )


def islands(blocks: DataFrame, cfg: ChunkConfig, counter: TokenCounter = WORDS) -> DataFrame:
    """Keys of the blocks that take part, with their island, role, tokens (of running text) and level; no texts.

    Heading rows are gone. A block without a document, an id or a visible text takes no part.
    """
    rows = blocks.withColumn("role", roles(cfg, blocks.columns)).where("role <> 'skip' and trim(coalesce(text, '')) <> '' and document_id is not null and block_id is not null")
    path = F.xxhash64(F.coalesce(F.col("section_path"), F.array().cast("array<string>")))
    running_text = F.when(F.col("role").isin("text", "reference"), F.col("text"))
    thin = cut(rows.select("document_id", "order_index", "block_id", "role", path.alias("path"), "heading_level", F.when(running_text.isNotNull(), counter.column(running_text)).alias("n")))
    # a text block opens a new island behind anything that isn't text, or under another path
    seen = running(thin, ["document_id"], "order_index", "block_id", lasts={"__before": F.struct("role", "path"), "level": F.when(F.col("role") == "heading", F.col("heading_level"))}, exclusive=True)
    opens = ~F.coalesce((F.col("role") == "text") & (F.col("__before.role") == "text") & (F.col("__before.path") == F.col("path")), F.lit(False))
    opened = seen.select("document_id", "order_index", "block_id", "role", "level", "n", F.when(opens, 1).otherwise(0).alias("__opens"))
    return running(opened, ["document_id"], "order_index", "block_id", sums={"island": F.col("__opens")}).where("role <> 'heading'").drop("__opens")


def placed(base: DataFrame, cfg: ChunkConfig, counter: TokenCounter) -> DataFrame:
    """(document_id, block_id, role, island, level, large, drafts): the drafts of its island that each block's pieces go to; null for tables, lists and figures."""
    thin = cut(islands(base, cfg, counter))
    text = thin.where("role in ('text', 'reference')")
    large = text.where(F.col("n") > cfg.max_tokens).select("document_id", "block_id")
    # of oversized blocks alone the texts are looked at, for the sizes of their pieces
    sizes = base.select("document_id", "block_id", "text").join(large, ["document_id", "block_id"], "left_semi").select("document_id", "block_id", F.transform(_text_pieces(cfg, counter)("text"), lambda p: p["n"]).alias("cuts"))
    whole = text.where(F.col("n") <= cfg.max_tokens).withColumn("cuts", F.lit(None).cast("array<int>"))
    both = whole.unionByName(text.where(F.col("n") > cfg.max_tokens).join(sizes, ["document_id", "block_id"]))
    one = both.groupBy("document_id", "island").agg(F.array_sort(F.collect_list(F.struct("order_index", "block_id", "role", "level", "n", "cuts"))).alias("b"))
    planned = one.withColumn("to", _planner(cfg, counter.joint)(F.transform("b", lambda x: x["n"]), F.transform("b", lambda x: x["cuts"])))
    each = planned.select("document_id", "island", F.inline(F.arrays_zip("b", F.col("to").alias("drafts"))))
    texts = each.select("document_id", "b.block_id", "b.role", "island", "b.level", (F.col("b.n") > cfg.max_tokens).alias("large"), "drafts")
    alone = thin.where("role in ('table', 'list', 'figure')").select("document_id", "block_id", "role", "island", "level", F.lit(False).alias("large"), F.lit(None).cast("array<int>").alias("drafts"))
    return texts.unionByName(alone)


def drafts(blocks: DataFrame, cfg: ChunkConfig = ChunkConfig(), counter: TokenCounter = WORDS) -> DataFrame:
    """Chunk drafts before the verdict: document_id, island, part, order_index, text, tokens, content_type, split_method, block_ids, section_path, section_kind, pages and overlap.

    ``faulty`` is a reason that no verdict on the text can give: a table of too little quality in the conditional mode.
    ``blocks`` has a row for each (document_id, block_id).
    """
    ship_package(blocks.sparkSession)
    wanted = ["document_id", "block_id", "order_index", "block_type", "text", "page_number", "section_path", "section_kind", "heading_level", "chunkable", "equation_confidence", "table_markdown", "table_html", "caption", "note"]
    have = [c for c in wanted if c in blocks.columns]
    base = blocks.select(*have, *[F.lit(None).cast("string").alias(c) for c in ("table_markdown", "table_html", "caption", "note") if c not in blocks.columns])
    return _drafts_of(base, cut(placed(base, cfg, counter)), cfg, counter)


def _drafts_of(base: DataFrame, places: DataFrame, cfg: ChunkConfig, counter: TokenCounter) -> DataFrame:
    """Drafts from the blocks and their places."""
    rows = base.join(places, ["document_id", "block_id"])
    is_table = F.col("role") == "table"
    given = F.nullif(F.col("table_markdown"), F.lit(""))
    markdown = F.coalesce(given, F.when(F.col("text").contains("|"), F.array_join(F.filter(F.split("text", "\n"), lambda x: x.contains("|")), "\n")))
    # rows are told only by the markdown given with a table; without it the text stays whole, with its caption, source and unit lines
    cut_rows = is_table & given.isNotNull() & (counter.column(F.when(is_table, F.col("text"))) > cfg.table_max_tokens)
    shown, faulty = F.col("text"), F.lit(None).cast("string")
    if cfg.table_mode == "conditional":
        score = visual.table_quality(F.col("table_html"), F.col("caption"), F.coalesce(F.col("note"), F.lit("")), F.col("section_kind"), F.coalesce(F.col("table_markdown"), F.col("text")))
        by_rows = visual.table_rows_text(markdown, F.col("caption"))
        shown = F.when(is_table & (by_rows != "") & (counter.column(by_rows) <= cfg.table_max_tokens), by_rows).otherwise(F.col("text"))
        faulty = F.when(is_table & (score < cfg.table_min_quality), "table_low_quality")
    last = F.when(is_table, F.size(visual.markdown_rows(markdown))).when(F.col("role") == "figure", 1)
    first = F.when(is_table, 0).when(F.col("role") == "figure", 1)
    null_int = F.lit(None).cast("int")
    uncut = F.array(F.struct(shown.alias("text"), F.lit("block").alias("method"), null_int.alias("n"), F.lit(0).alias("overlap"), first.alias("first"), last.alias("last"), F.lit(False).alias("goes_on"))).cast(PIECE)
    pieces = F.coalesce(
        _text_pieces(cfg, counter)(F.when(F.col("large"), F.col("text"))), _list_pieces(cfg, counter)(F.when(F.col("role") == "list", F.col("text"))), _table_pieces(cfg, counter)(F.when(cut_rows, given), F.col("caption")), uncut
    )
    # each piece goes on by itself, with its draft; no row keeps the list it stood in
    aimed = F.transform(pieces, lambda p, i: F.struct(F.coalesce(F.get(F.col("drafts"), i), i).alias("part"), i.alias("piece"), p.alias("p")))
    level = F.when(F.col("drafts").isNull(), F.col("heading_level")).otherwise(F.col("level"))
    listed = rows.select("document_id", "island", "block_id", "order_index", "role", "page_number", "section_path", "section_kind", level.alias("level"), faulty.alias("faulty"), aimed.alias("pieces"))
    one = listed.withColumn("n_pieces", F.size("pieces")).select("document_id", "island", "block_id", "order_index", "role", "page_number", "section_path", "section_kind", "level", "faulty", "n_pieces", F.inline("pieces"))
    none = F.array().cast("array<string>")
    method = F.when((F.col("p.method") != "block") & (F.col("n_pieces") == 1) & F.col("role").isin("list", "table"), "block").otherwise(F.col("p.method"))
    item = F.struct(
        "order_index", "block_id", "piece", F.col("p.text").alias("text"), "page_number", "role", "section_path", "section_kind", "level", "faulty", method.alias("method"), F.col("p.overlap").alias("overlap"),
        F.when(F.col("p.overlap") > 0, F.array("block_id")).otherwise(none).alias("overlap_ids"), F.col("p.first").alias("first"), F.col("p.last").alias("last"), F.col("p.goes_on").alias("goes_on"),
    )
    gathered = one.select("document_id", "island", "part", item.alias("i")).groupBy("document_id", "island", "part").agg(F.array_sort(F.collect_list("i")).alias("b"))
    top = F.get(F.col("b"), 0)
    content = F.when(top["role"] == "text", "paragraph").when(top["role"] == "reference", "references").when(top["role"] == "figure", "figure_caption").otherwise(top["role"])
    made = gathered.select(
        "document_id", "island", "part", top["order_index"].alias("order_index"), top["block_id"].alias("first_block"), F.array_join(F.transform("b", lambda x: x["text"]), "\n\n").alias("text"), content.alias("content_type"),
        *[top[c].alias(name) for c, name in (("method", "split_method"), ("section_path", "section_path"), ("section_kind", "section_kind"), ("level", "heading_level"), ("overlap", "overlap_tokens"), ("overlap_ids", "overlap_block_ids"), ("first", "first_item"), ("last", "last_item"), ("goes_on", "is_continuation"), ("faulty", "faulty"))],
        F.array_distinct(F.transform("b", lambda x: x["block_id"])).alias("block_ids"), F.array_sort(F.array_distinct(F.array_compact(F.transform("b", lambda x: x["page_number"])))).alias("pages"),
    )
    sized = made.withColumns({"allow_overlap": F.col("content_type") == "paragraph", "tokens": counter.column(F.col("text"))})
    return with_overlap(sized, cfg, counter)


def with_overlap(drafts: DataFrame, cfg: ChunkConfig, counter: TokenCounter = WORDS) -> DataFrame:
    """Drafts of islands (document_id, island, part from 0), each with the end of the one before in front where that fits.

    Only the ends, bounded by the overlap, meet the next draft, by a join under its own key; no island is sorted.
    """
    if cfg.overlap_tokens <= 0:
        return drafts
    ends = drafts.where("allow_overlap").select("document_id", "island", (F.col("part") + 1).alias("part"), _tailer(cfg, counter)("text").alias("__tail"), F.col("block_ids").alias("__ids"))
    ends = ends.where("__tail <> ''").withColumn("__n", counter.column(F.col("__tail")))
    both = drafts.join(ends, ["document_id", "island", "part"], "left")
    fits = F.coalesce(F.col("allow_overlap") & F.col("__tail").isNotNull() & (F.col("tokens") + F.col("__n") <= cfg.max_tokens), F.lit(False))
    together = F.concat_ws("\n\n", "__tail", "text")
    return both.withColumns(
        {
            "text": F.when(fits, together).otherwise(F.col("text")),
            "tokens": F.when(fits, F.col("tokens") + F.col("__n") if not counter.joint else counter.column(F.when(fits, together))).otherwise(F.col("tokens")),
            "overlap_tokens": F.when(fits, F.col("__n")).otherwise(F.col("overlap_tokens")),
            "overlap_block_ids": F.when(fits, F.col("__ids")).otherwise(F.col("overlap_block_ids")),
        }
    ).drop("__tail", "__ids", "__n")


def contextualised(text: Column, title: Column, path: Column, cfg: ChunkConfig = ChunkConfig()) -> Column:
    """Title and section before the text, null where there is neither."""
    head = []
    if cfg.embed_document_title:
        head.append(F.when(F.coalesce(title, F.lit("")) != "", F.concat(F.lit("Documento: "), title)))
    if cfg.embed_section_context:
        head.append(F.when(F.coalesce(F.size(path), F.lit(0)) > 0, F.concat(F.lit("Seção: "), F.array_join(path, " > "))))
    if not head:
        return F.lit(None).cast("string")
    top = F.concat_ws("\n", *head)
    return F.when(top != "", F.concat_ws("\n\n", *head, text))


def embedding_input(row_text: Column, context: Column, field: str = "contextualized_text") -> Column:
    return F.coalesce(context, row_text) if field == "contextualized_text" else row_text


def chunks(blocks: DataFrame, titles: DataFrame | None = None, cfg: ChunkConfig = ChunkConfig(), checksum: Column | None = None, verdict: Callable[[Column, Column, Column], Column] | None = None, counter: TokenCounter = WORDS, rejected_texts: bool = True) -> tuple[DataFrame, DataFrame]:
    """(approved chunks, rejected drafts): chunks numbered densely by document over approved drafts, with ids, previous ids and context.

    ``verdict`` gives the reason of a draft from its text, type and tokens ("aprovado" approves), by default the
    structural rules. A chunk above the hard limit that isn't a table is rejected as too_large, so its document
    can be looked up and set aside; a table of too little quality is rejected as table_low_quality in the conditional
    mode. Without ``rejected_texts`` rejected drafts have keys, tokens and reason only, and cost nothing more.

    Verdicts, numbers and ids are found from a thin table of keys, counts and digests; texts are put together again
    for the result.
    """
    made = drafts(blocks, cfg, counter)
    reason = (verdict or (lambda t, k, n: chunk_reason(t, k, n)))(F.col("text"), F.col("content_type"), F.col("tokens"))
    too_large = (F.col("content_type") != "table") & (F.col("tokens") > cfg.force_split_above_tokens)
    key = ["document_id", "island", "part"]
    judged = cut(made.select(*key, "order_index", "first_block", F.col("tokens").alias("token_count"), F.coalesce("faulty", F.when(too_large, "too_large").otherwise(reason)).alias("reason"), ids.text_hash(F.col("text")).alias("text_hash")))
    good = judged.where("reason = 'aprovado'").withColumn("__place", F.struct("first_block", "island", "part"))
    good = running(good, ["document_id"], "order_index", "__place", sums={"chunk_index": F.lit(1)})
    index = F.col("chunk_index").cast("int") - 1
    identity = ids.chunk_id_of_hash(F.col("document_id"), F.lit(""), checksum if checksum is not None else F.lit(""), F.lit(cfg.chunking_version), F.lit(cfg.hash), index, F.col("text_hash"))
    named = cut(good.select(*key, "token_count", index.alias("chunk_index"), identity.alias("chunk_id")))
    previous = named.select("document_id", (F.col("chunk_index") + 1).alias("chunk_index"), F.col("chunk_id").alias("previous_chunk_id"))
    named = named.join(previous, ["document_id", "chunk_index"], "left")
    if titles is not None:
        named = named.join(titles.select("document_id", F.col("title").alias("document_title")), "document_id", "left")
    else:
        named = named.withColumn("document_title", F.lit(None).cast("string"))
    approved = made.join(named, key).select(
        "document_id", "chunk_index", "chunk_id", "text", contextualised(F.col("text"), F.col("document_title"), F.col("section_path"), cfg).alias("contextualized_text"),
        "token_count", F.length("text").alias("character_count"), "content_type", "split_method", "block_ids", "section_path", F.try_element_at("section_path", F.lit(-1)).alias("section_title"), "section_kind", "heading_level",
        F.array_min("pages").alias("page_start"), F.array_max("pages").alias("page_end"), F.col("pages").alias("page_numbers"), F.col("overlap_tokens").alias("overlap_token_count"), "overlap_block_ids", F.coalesce("is_continuation", F.lit(False)).alias("is_continuation"), "first_item", "last_item",
        F.lit(cfg.hash).alias("config_hash"), F.lit(counter.name).alias("tokenizer_name"), "previous_chunk_id",
    )
    bad = judged.where("reason <> 'aprovado'").select(*key, "token_count", "reason")
    return approved, made.join(bad, key) if rejected_texts else bad


def blocks_by_type(blocks: DataFrame) -> DataFrame:
    """(document_id, k, count): blocks with an id of each document by type in small letters, unknown where it has none."""
    return blocks.groupBy("document_id", F.coalesce(F.lower("block_type"), F.lit("unknown")).alias("k")).agg(F.count("block_id").alias("count"))


def chunk_report(approved: DataFrame, rejected: DataFrame, blocks: DataFrame) -> DataFrame:
    """A row for each document: blocks by type, rejections by reason, token statistics, pages, cuts and bytes."""
    by_type = blocks_by_type(blocks).groupBy("document_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "count")))).alias("blocks_by_type"))
    by_reason = rejected.groupBy("document_id", "reason").count().groupBy("document_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("reason", "count")))).alias("rejected_by_reason"))
    stats = token_statistics(approved, "document_id")
    counted = approved.groupBy("document_id").agg(
        F.sum("overlap_token_count").alias("overlap_tokens"), F.count_if(F.col("split_method") == "sentence").alias("sentence_splits"), F.count_if(F.col("split_method") == "token_fallback").alias("token_splits"),
        F.count_if(F.col("content_type") == "table").alias("table_chunks"), F.count_if(F.col("content_type") == "list").alias("list_chunks"), F.array_size(F.array_distinct(F.flatten(F.collect_set("page_numbers")))).alias("pages_covered"),
        F.count_if(F.col("content_type").isin("paragraph", "references") & ~looks_complete(F.col("text"))).alias("mid_sentence_cuts"), F.sum(F.octet_length(F.to_json(F.struct("chunk_id", "chunk_index", "text", "content_type"))) + 1).alias("jsonl_bytes"),
    )
    return by_type.join(by_reason, "document_id", "left").join(stats, "document_id", "left").join(counted, "document_id", "left")


def token_statistics(df: DataFrame, *by: str, tokens: str = "token_count", low: int = 80, high: int = 768) -> DataFrame:
    """Count, mean (2 digits), median, least, most and 95th percentile (the value at place int(.95 n) of the sorted ones) of tokens, and how many are below and above limits.

    Works on how often each number of tokens occurs, so no group's rows meet in one task. Null numbers are left out.
    """
    n, c = F.col(tokens), F.col("__c")
    counts = df.where(n.isNotNull()).groupBy(*by, tokens).agg(F.count(F.lit(1)).alias("__c"))
    scanned = counts.withColumn("__upto", F.sum("__c").over(Window.partitionBy(*by).orderBy(tokens))).withColumn("__n", F.sum("__c").over(Window.partitionBy(*by)))
    at = lambda place: F.min(F.when(F.col("__upto") > place, n))
    return scanned.groupBy(*by).agg(
        F.sum("__c").alias("chunk_count"), F.bround(F.sum(n * c) / F.sum("__c"), 2).alias("avg_tokens"), ((at(F.floor((F.col("__n") - 1) / 2)) + at(F.floor(F.col("__n") / 2))) / 2).alias("median_tokens"), F.min(n).alias("min_tokens"), F.max(n).alias("max_tokens"),
        at(F.floor(F.col("__n") * 0.95)).alias("p95_tokens"), F.sum(F.when(n < low, c).otherwise(0)).alias("below_min"), F.sum(F.when(n > high, c).otherwise(0)).alias("above_max"),
    )


def legacy_chunks(blocks: DataFrame, max_chars: int = 1200, overlap_chars: int = 250, min_chars: int = 300, default_section: str = "Introdução", doc: str = "document_id", order: str = "position") -> DataFrame:
    """The older strategy: section carried from the last title, tables whole, text above ``max_chars`` split by characters, every part filtered."""
    from vellumflow.functions.quality import document_rules, first_reason

    ship_package(blocks.sparkSession)
    rows = blocks.where(F.col("type").isin("heading", "title", "paragraph", "table"))
    with_section = running(rows, [doc], order, lasts={"section": F.when(F.col("type").isin("heading", "title"), F.trim("text"))})
    body = with_section.where(~F.col("type").isin("heading", "title")).withColumn("section", F.coalesce("section", F.lit(default_section)))
    cleaned = body.withColumn("text", F.when(F.col("type") == "table", F.col("text")).otherwise(spaced_capitals(F.col("text"))))
    reason = lambda: first_reason(document_rules(F.col("text"), F.col("type"), min_chars))
    kept = cleaned.where(reason() == "aprovado")

    @F.pandas_udf("array<string>")
    def cut(t: pd.Series) -> pd.Series:
        return t.map(lambda x: _boundaries.cut_characters(x, max_chars, overlap_chars))

    long = (F.col("type") != "table") & (F.length("text") > max_chars)
    split = kept.where(long).select(*[c for c in kept.columns if c != "text"], F.posexplode(cut("text")).alias("part", "text"))
    whole = kept.where(~long).withColumn("part", F.lit(0))
    return whole.unionByName(split.where(reason() == "aprovado")).select(doc, order, "part", "section", "type", "text")


def legacy_type(block_type: Column) -> Column:
    """Type of a block for ``legacy_chunks`` (P19): headings and tables keep theirs, every other block is a paragraph."""
    kind = F.lower(block_type)
    return F.when(kind.isin("heading", "table"), kind).otherwise("paragraph")


STRATEGIES: dict[str, Callable[..., object]] = {"structural_tokens": chunks, "legacy": legacy_chunks}


def strategy(name: str) -> Callable[..., object]:
    """A chunking strategy by name; unknown names are an error."""
    if name not in STRATEGIES:
        raise ValueError(f"unknown chunking strategy {name!r}; known: {', '.join(sorted(STRATEGIES))}")
    return STRATEGIES[name]
