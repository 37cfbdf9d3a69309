"""Kernels for charts, tables, formulas and images, as Column builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vellumflow.functions.text import squash_ws, strip_ws

#: States and signs of Brazilian geography, and foreign countries, in captions and data.
STATES = (
    "acre", "alagoas", "amapá", "amazonas", "bahia", "ceará", "distrito federal", "espírito santo", "goiás", "maranhão", "mato grosso", "mato grosso do sul",
    "minas gerais", "pará", "paraíba", "paraná", "pernambuco", "piauí", "rio de janeiro", "rio grande do norte", "rio grande do sul", "rondônia", "roraima",
    "santa catarina", "são paulo", "sergipe", "tocantins",
)
GEOGRAPHY = r"(?iu)unidade\s+federativa|\bUF\b|por\s+estado|por\s+regi[ãa]o|brasil|brasileir|nordeste|sudeste|centro-oeste"
FOREIGN = (
    "colômbia", "colombia", "argentina", "chile", "peru", "venezuela", "bolívia", "bolivia", "equador", "uruguai", "paraguai", "méxico", "mexico", "estados unidos",
    "espanha", "portugal", "frança", "alemanha", "itália",
)
#: What makes a formula, and what an ordinal written as one looks like.
MATH = r"[=<>+×·]|\\(frac|sum|int|prod|sqrt|underbrace|overbrace|times|cdot|le|ge|neq|approx|partial|nabla|alpha|beta|lambda|sigma|mu|log|ln|exp|min|max)\b"
ORDINAL = r"^\s*[_^]?\s*\{?\s*\d{1,3}\s*[\^_]?\s*\{?\s*[oaºª°0]\s*\}?\s*\}?\s*$"
_STATE = "(?iu)" + "|".join(STATES)
_ABROAD = r"(?iu)(?<![\p{L}\p{N}_])(" + "|".join(FOREIGN) + r")(?![\p{L}\p{N}_])"


def _t(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def _blank(c: Column) -> Column:
    return strip_ws(_t(c)) == ""


def chart_confidence(caption: Column, note: Column, data: Column) -> Column:
    """Whether data read off a chart fits its caption: 0 with foreign countries under a Brazilian caption, .5 without data or caption, .3 with little in common and a foreign country, else .85."""
    context = F.concat_ws(" ", _t(caption), _t(note))
    abroad = F.array_distinct(F.transform(F.regexp_extract_all(_t(data), F.lit(_ABROAD), F.lit(0)), F.lower))
    tokens = lambda c: F.array_distinct(F.regexp_extract_all(F.lower(_t(c)), F.lit(r"[\p{L}\p{N}_]{4,}"), F.lit(0)))
    a, b = tokens(caption), tokens(data)
    overlap = F.size(F.array_intersect(a, b)) / F.size(a)
    return (
        F.when((context.rlike(GEOGRAPHY) | context.rlike(_STATE)) & (F.size(abroad) >= 2) & ~_t(data).rlike(_STATE), 0.0)
        .when(_blank(data) | _blank(caption), 0.5)
        .when((F.size(a) > 0) & (F.size(b) > 0) & (overlap < 0.05) & _t(data).rlike(_ABROAD), 0.3)
        .otherwise(0.85)
    )


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often it is named."""
    return F.get(F.transform(F.array(value), body), 0)


def html_rows(html: Column) -> Column:
    """Cells of each row of an HTML table, without tags."""
    rows = F.regexp_extract_all(_t(html), F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), F.lit(1))
    cells = F.transform(rows, lambda r: F.transform(F.regexp_extract_all(r, F.lit(r"(?is)<t[hd][^>]*>(.*?)</t[hd]>"), F.lit(1)), lambda c: strip_ws(F.regexp_replace(c, "<[^>]+>", " "))))
    return F.filter(cells, lambda r: F.size(r) > 0)


def markdown_rows(markdown: Column) -> Column:
    """Cells of each pipe row, separator rows left out."""
    lines = F.filter(F.split(_t(markdown), r"\r?\n"), lambda x: x.contains("|"))
    cells = F.transform(lines, lambda x: F.transform(F.split(F.regexp_replace(strip_ws(x), r"^\|+|\|+$", ""), r"\|"), strip_ws))
    return F.filter(cells, lambda r: ~F.forall(r, lambda c: c.rlike(r"^[\s\-:]*$")))


def table_quality(html: Column, caption: Column, note: Column, section_kind: Column, markdown: Column) -> Column:
    """How well a table can be indexed: rows and columns .25, header .2, caption .15, even rows .15, section .15, note .1; 3 digits."""
    one = lambda p: F.when(p, 1.0).otherwise(0.0)
    section = F.when(section_kind.isNull(), 0.5).when(section_kind.isin("body", "analytical_appendix", "administrative_appendix"), 1.0).otherwise(0.0)

    def score(rows: Column) -> Column:
        sizes = F.transform(rows, lambda r: F.size(r))
        wide = F.coalesce(F.array_max(sizes), F.lit(0))
        even = F.when(F.size(rows) > 0, F.size(F.filter(rows, lambda r: F.size(r) == wide)) / F.size(rows)).otherwise(0.0)
        header = (F.size(rows) > 0) & F.coalesce(F.exists(F.get(rows, 0), lambda c: ~c.rlike(r"^[\d.,%\s\-]*$")), F.lit(False))
        return F.bround(0.25 * one((F.size(rows) >= 2) & (wide >= 2)) + 0.20 * one(header) + 0.15 * one(~_blank(caption)) + 0.15 * even + 0.15 * section + 0.10 * one(~_blank(note)), 3)

    return let(let(html_rows(html), lambda h: F.when((F.size(h) < 2) & (_t(markdown) != ""), markdown_rows(markdown)).otherwise(h)), score)


def table_rows_text(markdown: Column, caption: Column, max_rows: int = 40) -> Column:
    """A line ``Header: value. Header: value.`` for each row, under the caption; empty with under two rows."""
    top = F.when(_t(caption) != "", F.array(strip_ws(caption))).otherwise(F.array().cast("array<string>"))

    def text(rows: Column) -> Column:
        head = F.get(rows, 0)

        def line(r: Column) -> Column:
            pairs = F.transform(r, lambda v, i: F.when((i < F.size(head)) & (v != ""), F.concat(F.get(head, i), F.lit(": "), v)))
            return let(F.array_compact(pairs), lambda kept: F.when(F.size(kept) > 0, F.concat(F.array_join(kept, ". "), F.lit("."))))

        body = F.array_compact(F.transform(F.slice(rows, 2, max_rows), line))
        return F.when(F.size(rows) < 2, "").otherwise(strip_ws(F.array_join(F.concat(top, body), "\n")))

    return let(markdown_rows(markdown), text)


def equation_confidence(latex: Column) -> Column:
    """Whether LaTeX is a formula: 0 empty, .25 an ordinal, .9 operators and six characters, .3 under five characters that count, else .6."""
    s = strip_ws(_t(latex))
    return (
        F.when(s == "", 0.0)
        .when(s.rlike(ORDINAL) | s.contains("textdegree"), 0.25)
        .when((F.regexp_count(s, F.lit(MATH)) >= 1) & (F.length(s) >= 6), 0.9)
        .when(F.length(F.regexp_replace(s, r"[\s{}\\]", "")) < 5, 0.3)
        .otherwise(0.6)
    )


def image_kind(caption: Column, content: Column, path: Column) -> Column:
    """flowchart, diagram, logo, decorative or figure."""
    c = strip_ws(_t(content))
    drawn = c.startswith("```mermaid") | F.left(c, F.lit(40)).rlike(r"(?i)\b(graph|flowchart)\b")
    around = F.lower(F.concat_ws(" ", _t(caption), _t(path)))
    return (
        F.when(drawn, F.when(c.rlike(r"-->|---|==>|-\.->"), "flowchart").otherwise("diagram"))
        .when(around.rlike(r"logotipo|logomarca|bras[ãa]o|logo"), "logo")
        .when(_blank(caption) & (F.length(c) < 8), "decorative")
        .otherwise("figure")
    )


def image_is_indexable(kind: Column, caption: Column, description: Column) -> Column:
    return ~kind.isin("logo", "decorative") & ~_blank(caption) & ~_blank(description)


def mermaid_text(content: Column) -> Column:
    """The labels of a flow chart in a sentence; empty without labels."""
    found = F.regexp_extract_all(_t(content), F.lit(r"""[\[({]"?([^"\]}\)|]{2,80}?)"?[\])}]"""), F.lit(1))
    labels = F.array_distinct(F.filter(F.transform(found, lambda x: squash_ws(F.replace(x, F.lit("\\n"), F.lit(" ")))), lambda x: (x != "") & ~x.rlike(r"^[A-Za-z]\d*$")))
    return F.when(F.size(labels) == 0, "").otherwise(F.concat(F.lit("Diagrama de fluxo relacionando: "), F.array_join(F.slice(labels, 1, 24), "; "), F.lit(".")))


def chart_text(caption: Column, note: Column, data: Column, min_confidence: float = 0.8) -> Column:
    """A chart's text: caption, table and note where the data are a table and fit, else caption and note."""
    tabular = _t(data).contains("|") & _t(data).contains("---")
    good = tabular & (chart_confidence(caption, note, data) >= min_confidence)
    return F.concat_ws("\n", F.when(~_blank(caption), strip_ws(caption)), F.when(good, strip_ws(data)), F.when(~_blank(note), strip_ws(note)))
