"""Quality kernels and rejection rules of chunks and documents, as Column builders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from vellumflow.functions.text import WS, count_words, strip_ws

#: The characters that count as clean, the URL pattern, and reasons in the order they are tried.
CLEAN = r"\p{L}\p{N}_\t-\r\x1c-\x20\x85\p{Z},.;:!?()\-–—/\[\]{}@#$%&*+=<>°ºª€£¥"
URL = r"""(?i)https?://[^\s<>"']+|www\.[^\s<>"']+"""
EXEMPT = ("table", "list", "figure_caption", "references", "formula", "quote", "footnote")
NOISE_TYPES = ("paragraph", "references", "quote", "footnote")


def _n(c: Column, pattern: str) -> Column:
    return F.regexp_count(c, F.lit(pattern))


def _chars(c: Column, pattern: str) -> Column:
    """Characters in matches of the pattern."""
    return F.length(F.array_join(F.regexp_extract_all(c, F.lit(pattern), F.lit(0)), ""))


def ocr_noise(c: Column, digits: int | None = 2) -> Column:
    """Noise of recognition between 0 and 1: odd characters and patterns, few letters, other characters beyond ASCII. Null and empty: 0."""
    t = F.coalesce(c, F.lit(""))
    n = F.length(t)
    w = r"[\p{L}\p{N}_]"
    s = r"[\t-\r\x1c-\x20\x85\p{Z}]"
    noise = _n(t, f"[^{CLEAN}]") + _n(t, f"{w}{s}{w}{s}{w}{s}{w}") + _chars(t, r"\|{2,}") + _chars(t, "_{3,}") + _chars(t, r"\.{4,}") + 2 * _n(t, rf"(?:\p{{Nd}}{s}){{5,}}")
    letters = F.length(F.regexp_replace(t, r"\P{L}+", ""))
    beyond = _n(t, r"[^\x00-\x7F\p{L}]")
    score = F.least(noise / n * 0.5 + (1.0 - letters / n) * 0.3 + beyond / n * 0.2, F.lit(1.0))
    return F.when(n == 0, 0.0).otherwise(score if digits is None else F.bround(score, digits))


def url_chars(c: Column) -> Column:
    return _chars(F.coalesce(c, F.lit("")), URL)


def is_heading_only(c: Column) -> Column:
    """At most 120 characters in one line without a sentence's end."""
    t = strip_ws(F.coalesce(c, F.lit("")))
    return (t != "") & (F.length(t) <= 120) & ~t.contains("\n") & ~t.rlike(r"[.!?;:]\z")


def has_no_body(c: Column) -> Column:
    """Under ten letters or digits; the match stops at the tenth."""
    return ~F.coalesce(c, F.lit("")).rlike("^(?:[^a-zA-ZÀ-ÿ0-9]*+[a-zA-ZÀ-ÿ0-9]){10}")


def has_fewer_words(c: Column, n: int) -> Column:
    """Under ``n`` words; the match stops at the n-th."""
    return ~F.coalesce(c, F.lit("")).rlike(rf"^(?:{WS}*+[^{WS[1:-1]}]++){{{n}}}") if n > 0 else F.lit(False)


def is_complete(c: Column) -> Column:
    """A short text that stands by itself: 20 characters, five words, a good start and a sentence's end."""
    t = strip_ws(F.coalesce(c, F.lit("")))
    return (F.length(t) >= 20) & t.rlike(r"""^[A-ZÀ-ÚÄ-Ü0-9"'(\[]""") & t.rlike(r"[.!?;:]$") & (count_words(t) >= 5)


def is_mostly_urls(c: Column) -> Column:
    solid = F.length(F.regexp_replace(F.coalesce(c, F.lit("")), WS, ""))
    return F.coalesce(c, F.lit("")).rlike(r"(?i)https?://|www\.") & (solid > 0) & (url_chars(c) / solid > 0.85)


def is_table_fragment(c: Column) -> Column:
    """Under two rows of data, no caption in the first two lines, under 50 characters outside the table."""
    lines = F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), "\n"), strip_ws), lambda x: x != "")
    cells = lambda x: x.contains("|") | x.contains("\t")
    rows = F.filter(lines, lambda x: cells(x) & ~x.rlike(r"^\|?[\s\-:]+\|"))
    caption = F.exists(F.slice(lines, 1, 2), lambda x: F.lower(x).startswith("tabela") | F.lower(x).startswith("table"))
    outside = F.length(F.array_join(F.filter(lines, lambda x: ~cells(x)), " "))
    return (F.size(rows) < 2) & ~caption & (outside < 50)


def quality_score(c: Column, noise: Column, heading_only: Column, block_type: Column, digits: int | None = 2) -> Column:
    """One less the penalties for noise, lone headings, shortness, few words, URLs and thin tables; 0 at least."""
    t = F.coalesce(c, F.lit(""))
    n = F.length(t)
    penalty = (
        noise * 0.35
        + F.when(heading_only, 0.30).otherwise(0.0)
        + F.when(n < 200, (1.0 - n / 200) * 0.20).otherwise(0.0)
        + F.when(count_words(t) < 15, 0.4).otherwise(0.0)
        + F.when((n > 0) & (url_chars(t) / n > 0.6), 0.25).otherwise(0.0)
        + F.when((block_type == "table") & (F.length(t) - F.length(F.replace(t, F.lit("\n"), F.lit(""))) < 2), 0.20).otherwise(0.0)
    )
    score = F.greatest(F.lit(0.0), 1.0 - penalty)
    return score if digits is None else F.bround(score, digits)


Rules = Sequence[tuple[Column, str]]


def document_rules(c: Column, block_type: Column, min_chars: int = 300, min_tokens: int = 10, noise_threshold: float = 0.65) -> list[tuple[Column, str]]:
    """The seven rules in their order; each a predicate that rejects, and its reason."""
    empty = strip_ws(F.coalesce(c, F.lit(""))) == ""
    return [
        (has_no_body(c), "sem_corpo_textual"),
        (empty, "vazio"),
        (is_mostly_urls(c), "apenas_urls"),
        (is_heading_only(c), "apenas_titulo"),
        ((block_type == "table") & is_table_fragment(c), "fragmento_tabela_isolado"),
        (ocr_noise(c) >= noise_threshold, "ruido_ocr_excessivo"),
        (has_fewer_words(c, min_tokens), "abaixo_do_minimo_de_tokens"),
        ((F.length(F.coalesce(c, F.lit(""))) < min_chars) & ~is_complete(c), "abaixo_do_minimo_de_caracteres"),
    ]


def first_reason(rules: Rules, approved: str = "aprovado") -> Column:
    """Reason of the first rule that rejects. Rules may be any list of (predicate, reason)."""
    return F.coalesce(*[F.when(p, F.lit(reason)) for p, reason in rules], F.lit(approved))


def chunk_reason(c: Column, content_type: Column, tokens: Column, min_tokens: int = 10, noise_threshold: float = 0.65) -> Column:
    """Verdict on a formed chunk: empty, no body, noise for running text, too few tokens unless complete; seven types are exempt from the minimum."""
    exempt = F.coalesce(content_type.isin(*EXEMPT), F.lit(False))
    noisy = F.coalesce(content_type.isin(*NOISE_TYPES), F.lit(False))
    return first_reason(
        [
            (strip_ws(F.coalesce(c, F.lit(""))) == "", "vazio"),
            (has_no_body(c) & ~exempt, "sem_corpo_textual"),
            (noisy & (ocr_noise(c) >= noise_threshold), "ruido_ocr_excessivo"),
            (~exempt & (tokens < min_tokens) & ~is_complete(c), "abaixo_do_minimo_de_tokens"),
        ]
    )
