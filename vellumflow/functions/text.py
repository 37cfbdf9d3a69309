"""Text kernels as Column builders. All patterns name their Unicode classes, so Java reads them as they stand."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters removed, spaces replaced and quotes mapped by normalize_text.
INVISIBLE = "­​‌‍⁠﻿"
ODD_SPACES = "              　"
QUOTES = {"“": '"', "”": '"', "„": '"', "‟": '"', "‘": "'", "’": "'", "‚": "'", "″": '"', "′": "'"}
LATIN = "A-Za-zÀ-ÿ"
WS = r"[\t-\r\x1c-\x20\x85\p{Z}]"
#: The characters of WS one by one.
WS_CHARS = "".join(map(chr, [*range(0x9, 0xE), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
#: Words that open special sections.
REFERENCES = r"(?iu)^\s*(refer[êe]ncias?|bibliografia|references|bibliography|obras\s+citadas)(?![\p{L}\p{N}_])"
APPENDIX = r"(?iu)^\s*(ap[êe]ndices?|anexos?)(?![\p{L}\p{N}_])"
CONTENTS = r"(?iu)^\s*(sum[áa]rio|[íi]ndice(?!\s+de)|conte[úu]do)(?![\p{L}\p{N}_])"
FIGURES = r"(?iu)lista\s+de\s+figuras|[íi]ndice\s+de\s+figuras"
TABLES = r"(?iu)lista\s+de\s+(tabelas|quadros)|[íi]ndice\s+de\s+(tabelas|quadros)"
CHARTS = r"(?iu)lista\s+de\s+gr[áa]ficos|[íi]ndice\s+de\s+gr[áa]ficos"
ACRONYMS = r"(?iu)lista\s+de\s+(siglas|abreviaturas|abreviaç[õo]es|s[íi]mbolos)|siglas\s+e\s+abreviaturas|lista\s+de\s+acr[ôo]nimos"
ADMINISTRATIVE = (
    r"(?iu)(?<![\p{L}\p{N}_])(instrumento|formul[áa]rio|question[áa]rio|roteiro|termo\s+de\s+refer[êe]ncia|participantes?|entrevistad|"
    r"lista\s+de\s+presen|documentos?\s+consultad|cronograma|matriz\s+de|of[íi]cio|portaria|ata)(?![\p{L}\p{N}_])"
)
#: How headings are numbered and acronyms listed.
NUMBERING = r"^\s*(\d+(?:\.\d+)*)\.?\s+\S"
ACRONYM_LINE = r"^\s*(?:[-•*]\s*)?([A-ZÀ-Ú][A-ZÀ-Ú0-9./&-]{1,15})\s*(?:[—–:\-]|\s{2,})\s*([A-Za-zÀ-ÿ].{3,})$"
#: Marks of what a query asks for.
ASKS_AUTHORS = (
    r"(?iu)quais?\s+(?:os\s+|as\s+)?autor|\bque\s+autores?\b|\bautoria\b|quem\s+(?:escreveu|é\s+o\s+autor|são\s+os\s+autores)"
    r"|(?:obras?|trabalhos?|estudos?|autores?|refer[êe]ncias?|artigos?|pesquisas?)\s+citad"
    r"|refer[êe]ncias?\s+bibliogr|\bbibliografia\b|fonte\s+bibliogr|cita[çc][õo]es\s+bibliogr"
)
FRAMES_AUTHORS = (
    r"(?iu)(segundo|conforme|de\s+acordo\s+com|para|na\s+vis[ãa]o\s+d[eo]s?|de\s+autores?\s+como)\s+os?\s+autor"
    r"|os\s+autores?\s+(afirm|apont|conclu|mostr|defend|identific|observ|sugere|indic)"
)
ASKS_METHOD = (
    r"(?iu)(?<![\p{L}\p{N}_])(metodolog|m[ée]todo|modelo|econom[ée]tric|regress|estimativ|amostra|vari[áa]vel|c[áa]lculo|"
    r"como\s+(foi|foram|se)\s+[\p{L}\p{N}_]*(calcul|estim|avali|model))(?![\p{L}\p{N}_])"
)
ASKS_AMOUNT = (
    r"(?iu)(?<![\p{L}\p{N}_])(quant[oa]s?|qual\s+foi|quanto\s+custou|valor(es)?|percentu|propor[çc]|m[ée]dia|total|n[úu]mero\s+de)(?![\p{L}\p{N}_])"
    r"|(?<![\p{L}\p{N}_])R\$|\d%|%|(?<![\p{L}\p{N}_])(19|20)\d{2}(?![\p{L}\p{N}_])"
)


def squash_ws(c: Column) -> Column:
    """One space between words, none around."""
    return F.trim(F.regexp_replace(c, WS + "+", " "))


def strip_ws(c: Column) -> Column:
    """No white space of any kind around."""
    return F.btrim(c, F.lit(WS_CHARS))


def normalize_text(c: Column, collapse_newlines: bool = True) -> Column:
    """Text for search: line ends, invisible characters, hyphens at line breaks, quotes, odd spaces and controls put right; digits never change. Null becomes empty."""
    t = F.coalesce(c, F.lit(""))
    t = F.regexp_replace(t, r"\r\n?", "\n")
    t = F.translate(t, INVISIBLE, "")
    t = F.regexp_replace(t, f"([{LATIN}])-\n(?=[a-zà-ÿ])", "$1")
    controls = "".join(chr(x) for x in [*range(0x9), *range(0xB, 0x20), *range(0x7F, 0xA0)])  # translate drops what has no partner
    t = F.translate(t, "".join(QUOTES) + ODD_SPACES + controls, "".join(QUOTES.values()) + " " * len(ODD_SPACES))
    if collapse_newlines:
        t = F.regexp_replace(t, "[ \t\n]+", " ")
    else:
        t = F.regexp_replace(F.regexp_replace(t, "[ \t]+", " "), " *\n *", "\n")
    t = F.regexp_replace(t, rf"([{LATIN}])\s+([,.;:!?])", "$1$2")
    return strip_ws(t)


def count_words(c: Column) -> Column:
    """Runs without white space; null has none."""
    return F.coalesce(F.regexp_count(c, F.lit(r"[^\t-\r\x1c-\x20\x85\p{Z}]+")), F.lit(0))


def words(c: Column) -> Column:
    return F.filter(F.split(F.coalesce(c, F.lit("")), WS + "+"), lambda w: w != "")


def word_pieces(c: Column, size: int) -> Column:
    """The text in pieces of ``size`` words, joined by single spaces."""
    if size < 1:
        raise ValueError("pieces hold a word at least")
    w = words(c)
    last = F.floor((F.size(w) - 1) / size).cast("int")
    return F.when(F.size(w) == 0, F.array().cast("array<string>")).otherwise(F.transform(F.sequence(F.lit(0), last), lambda i: F.array_join(F.slice(w, i * size + 1, F.lit(size)), " ")))


def truncate_words(c: Column, size: int) -> Column:
    return F.array_join(F.slice(words(c), 1, size), " ")


def split_sentences(c: Column) -> Column:
    """Sentences by the ingestion rule: behind . ! ? … before an upper-case letter, digit, quote or bracket."""
    return F.split(c, r"""(?<=[.!?…])\s+(?=[A-ZÀ-Ú0-9"'(\[])""")


def split_sentences_plain(c: Column) -> Column:
    return F.split(c, r"(?<=[.!?])\s+")


def _folding() -> tuple[str, str]:
    source, target = [], []
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        base = "".join(x for x in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(x))
        if len(base) == 1 and base != chr(code):
            source.append(chr(code))
            target.append(base)
    marks = "".join(map(chr, range(0x300, 0x370)))
    return "".join(source) + marks, "".join(target)


def fold_accents(c: Column) -> Column:
    """Letters without their accents, for Latin letters; combining marks vanish."""
    source, target = _folding()
    return F.translate(c, source, target)


#: Compatibility forms of several characters that titles hold.
_SPELT_OUT = {"ำ": "\u0e4d\u0e32", "ຳ": "\u0ecd\u0eb2", "№": "No", "™": "TM", "ﬁ": "fi", "ﬂ": "fl"}


@cache
def _folding_beyond() -> tuple[str, str]:
    """As ``_folding``, for the scripts behind U+024F that it leaves out."""
    source, target, gone = [], [], []
    for code in [*range(0x250, 0x300), *range(0x370, 0x1E00), *range(0x1F00, 0xD800), *range(0xF900, 0x10000)]:
        base = "".join(x for x in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(x))
        if not base:
            gone.append(chr(code))
        elif len(base) == 1 and base != chr(code):
            source.append(chr(code))
            target.append(base)
    return "".join(source + gone), "".join(target)


def match_key(c: Column) -> Column:
    """Form for comparing titles in any script: no accents, no punctuation, small letters, single spaces; empty for null.

    Behind U+024F letters are those of NFKD without combining marks, but Hangul syllables and most ligatures stay as they are.
    """
    t = F.translate(fold_accents(F.coalesce(c, F.lit(""))), *_folding_beyond())
    for one, several in _SPELT_OUT.items():
        t = F.replace(t, F.lit(one), F.lit(several))
    return squash_ws(F.regexp_replace(F.lower(t), r"[^\p{L}\p{N}_\s]", " "))


def numbering_of(c: Column) -> Column:
    """The number a title begins with, null without one."""
    return F.nullif(F.regexp_extract(F.coalesce(c, F.lit("")), r"^\s*(\d+(?:\.\d+)*)\.?\s+", 1), F.lit(""))


def strip_numbering(c: Column) -> Column:
    return strip_ws(F.regexp_replace(F.coalesce(c, F.lit("")), r"^\s*(\d+(?:\.\d+)*)\.?\s+", ""))


def is_numbered(c: Column) -> Column:
    return F.coalesce(c, F.lit("")).rlike(NUMBERING)


def heading_level(c: Column, fallback: Column) -> Column:
    """Number of numbering components, at most 6; else the fallback from 1 on; else 1."""
    number = F.regexp_extract(F.coalesce(c, F.lit("")), NUMBERING, 1)
    return F.when(number != "", F.least(F.size(F.split(number, r"\.")), F.lit(6))).when(fallback >= 1, fallback).otherwise(1).cast("int")


def is_short_title(c: Column, chars: int = 15, max_words: int = 2) -> Column:
    return (F.length(strip_ws(F.coalesce(c, F.lit("")))) <= chars) & (count_words(c) <= max_words)


def special_section(c: Column) -> Column:
    """Kind of the special section that a title opens, null for ordinary titles. References, contents and appendices must begin the title."""
    t = F.coalesce(c, F.lit(""))
    return (
        F.when(t.rlike(REFERENCES), "bibliography")
        .when(t.rlike(FIGURES), "list_of_figures")
        .when(t.rlike(TABLES), "list_of_tables")
        .when(t.rlike(CHARTS), "list_of_charts")
        .when(t.rlike(ACRONYMS), "acronym_list")
        .when(t.rlike(CONTENTS), "table_of_contents")
        .when(t.rlike(APPENDIX), F.when(t.rlike(ADMINISTRATIVE), "administrative_appendix").otherwise("analytical_appendix"))
    )


def acronym(c: Column) -> Column:
    """struct(sigla, expansion) of an acronym line, null for others."""
    t = strip_ws(F.coalesce(c, F.lit("")))
    sigla = F.regexp_replace(F.regexp_extract(t, ACRONYM_LINE, 1), "^[ .—–:-]+|[ .—–:-]+$", "")
    expansion = strip_ws(F.regexp_extract(t, ACRONYM_LINE, 2))
    return F.when((F.length(sigla) >= 2) & (expansion != ""), F.struct(sigla.alias("sigla"), expansion.alias("expansion")))


def query_profile(c: Column) -> Column:
    """What a query asks for: bibliographic, methodological, quantitative or general."""
    q = F.coalesce(c, F.lit(""))
    return F.when(q.rlike(ASKS_AUTHORS) & ~q.rlike(FRAMES_AUTHORS), "bibliographic").when(q.rlike(ASKS_METHOD), "methodological").when(q.rlike(ASKS_AMOUNT), "quantitative").otherwise("general")


def looks_complete(c: Column) -> Column:
    return F.right(F.regexp_replace(F.coalesce(c, F.lit("")), WS + "+$", ""), F.lit(1)).isin(".", "!", "?", "…", "”", '"', ")")


def cut_mid_sentence(c: Column) -> Column:
    """Whether a chunk's text ends in none of the marks that close a sentence, list or table."""
    last = F.right(F.regexp_replace(F.coalesce(c, F.lit("")), WS + "+$", ""), F.lit(1))
    return (last != "") & ~last.rlike(r"""[.!?…:;”"'»)\]|]""")


def strange_words(c: Column) -> Column:
    """Words that look misread: odd characters inside, over 28 letters, five consonants in a row, few vowels, four times one letter, digits amid letters."""
    found = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"(?<![\p{L}\p{N}_])[\p{L}\p{N}_÷×-]+(?![\p{L}\p{N}_])"), F.lit(0))

    def odd(w: Column) -> Column:
        n = F.regexp_replace(fold_accents(F.lower(w)), r"^[^\p{L}\p{N}_]+|[^\p{L}\p{N}_]+$", "")
        vowels = F.length(F.regexp_replace(n, "[^aeiou]", ""))
        return (F.length(n) > 2) & (
            n.rlike(r"[^a-z0-9\-]") | (F.length(n) > 28) | n.rlike("[bcdfghjklmnpqrstvwxyz]{5,}") | ((F.length(n) >= 8) & (vowels / F.length(n) < 0.25)) | n.rlike(r"(.)\1{3,}") | n.rlike(r"[a-z]+\d+[a-z]+|\d+[a-z]+\d+")
        )

    return F.filter(found, odd)


def broken_words(c: Column) -> Column:
    """Runs of three or more pieces of one or two letters and a last one."""
    found = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(rf"(?<![\p{{L}}\p{{N}}_])(?:[{LATIN}]{{1,2}}\s+){{3,}}[{LATIN}]{{1,8}}(?![\p{{L}}\p{{N}}_])"), F.lit(0))
    return F.transform(found, strip_ws)


def inline_text(items: Column) -> Column:
    """Text of inline items (array of struct type, content); formulas keep their dollar signs."""
    kept = F.filter(items, lambda i: i["content"].isNotNull())
    body = F.transform(kept, lambda i: F.when(i["type"] == "equation_inline", F.when(F.trim(i["content"]) == "", "").otherwise(F.concat(F.lit("$"), F.trim(i["content"]), F.lit("$")))).otherwise(i["content"]))
    return F.trim(F.coalesce(F.array_join(body, ""), F.lit("")))


def source_note(c: Column) -> Column:
    """A note with ``Fonte:`` before it, once."""
    t = F.trim(F.coalesce(c, F.lit("")))
    return F.when(t == "", "").when(t.rlike(r"(?i)^fonte\s*:"), t).otherwise(F.concat(F.lit("Fonte: "), t))


def spaced_capitals(c: Column) -> Column:
    """Single capitals with spaces between them joined, then white space squashed."""
    return squash_ws(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?<![\p{L}\p{N}_])([A-ZÀ-Ú])[\t-\r\x1c-\x20\x85\p{Z}](?=[A-ZÀ-Ú](?:[\t-\r\x1c-\x20\x85\p{Z}]|$))", "$1"))


def disposition_filename(header: Column, fallback: Column) -> Column:
    """File name of a Content-Disposition header, percent escapes resolved, base name only; the fallback without one."""
    extended = F.regexp_extract(header, r"(?i)filename\*\s*=\s*[^']*''([^;]+)", 1)
    plain = F.regexp_extract(header, r"""(?i)filename\s*=\s*"?([^";]+)"?""", 1)
    name = F.try_element_at(F.split(F.when(extended != "", F.try_url_decode(extended)).otherwise(F.trim(plain)), r"[/\\]"), F.lit(-1))
    return F.when(F.coalesce(name, F.lit("")) == "", fallback).otherwise(name)


def redact_url(c: Column) -> Column:
    """A URL whose user and password are replaced."""
    return F.regexp_replace(c, r"://[^/@\s]+@", "://***@")
