"""Problem 1: text statistics that tell natural prose from lists, tables and junk.

Method: structure is read off the lines of a text. Vertical delimiter alignment is the share of delimiters (pipes, tabs,
gaps, ends of numbers) that stand in the same column of the next line, and the share of lines with as many as the next.
Periodicity comes from spectra: how often lines that are one to eight lines apart begin alike or are indented alike, and
the autocorrelation of line lengths over these lags, are turned into power by frequency, of which the highest peak
against the mean counts. With them go word, symbol and punctuation ratios, shares of lines that end in punctuation
and of common words, repetition, and two word statistics learned from labelled chunks: which word endings
running sentences have, and how words follow one another in them as against the same words shuffled. An
additive model over binned statistics, fitted on a bounded sample of labelled chunks, gives the probability
that most of a text is prose.

All statistics are computed on arrays of the code points of many texts at once.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellumflow.runtime import ship_package

#: Most labelled rows the model is fitted on; of more, those with the least hashes of their ids.
MAX_LABELS = 20_000
#: Characters of text whose statistics are computed at once.
SLICE_CHARS = 150_000

#: Frequent small words of the corpus' languages.
COMMON = (
    "a o as os um uma de da do das dos em no na nos nas por para com sem que e ou se ao à à às aos entre até desde sob sobre segundo "
    "el la los las un una del en y con por al que su lo es se no para the of and to in for on with by is was at from as that this it be are or "
    "le les des du et une dans sur pour par au aux que qui ne pas est avec der die das des dem den ein eine und im mit zu für auf von ist nicht "
    "и в на с по за из от не что до к как это о при для или η ο το τα της του των και σε με από για που στην στο τον την "
    "के का की में से को और है पर तक ने यह कि في من على إلى عن مع أن هذا و"
).split()

LOWER, UPPER, CASELESS, DIGIT, SPACE, BREAK, STOP, COMMA, SEMICOLON, PIPE, BRACKET, DASH, BULLET, SYMBOL, MARK, TAB, SLASH, BROKEN = range(18)
NAMES = [
    "lower", "upper", "caseless", "digit", "space", "stop", "comma", "semicolon", "pipe", "bracket", "dash", "bullet", "symbol", "tab", "slash", "broken",
    "chars_log", "lines_log", "line_mean", "line_spread", "line_long", "length_autocorrelation", "length_like_next", "alignment", "column_alignment", "delimiter_columns", "number_columns", "begin_period", "begin_period2", "begin_spectrum", "indent_spectrum", "length_spectrum", "length_lags", "marked_lines", "numbered_lines",
    "lines_end_stop", "lines_end_word", "leaders", "gaps", "words_log", "word_mean", "word_longest", "digit_words", "single_words", "capital_words", "common_words", "distinct_words", "repeated_words",
    "stops_per_word", "between_stops", "in_sentences", "colon_lines", "years", "endings", "order",
]


#: The statistics of the lines' structure.
STRUCTURE = ("length_autocorrelation", "length_like_next", "alignment", "column_alignment", "delimiter_columns", "number_columns", "begin_period", "begin_period2", "begin_spectrum", "indent_spectrum", "length_spectrum", "length_lags")


@lru_cache(maxsize=1)
def _classes() -> tuple[np.ndarray, np.ndarray]:
    """Class and lower-case form of each code point."""
    kind, low = np.full(0x110000, SYMBOL, dtype=np.uint8), np.arange(0x110000, dtype=np.uint32)
    kind[0x3400:0xA000] = kind[0xAC00:0xD7A4] = kind[0x20000:0x32000] = CASELESS
    for c in [*range(0x3400), *range(0xA000, 0xAC00), *range(0xF900, 0x20000)]:
        cat = unicodedata.category(chr(c))
        if cat == "Ll":
            kind[c] = LOWER
        elif cat in ("Lu", "Lt"):
            kind[c] = UPPER
            small = chr(c).lower()
            low[c] = ord(small) if len(small) == 1 else c
        elif cat[0] == "L":
            kind[c] = CASELESS
        elif cat[0] == "M":
            kind[c] = MARK
        elif cat == "Nd":
            kind[c] = DIGIT
        elif cat == "Zs":
            kind[c] = SPACE
        elif cat in ("Ps", "Pe", "Pi", "Pf"):
            kind[c] = BRACKET
        elif cat == "Pd":
            kind[c] = DASH
    for chars, k in ((".!?…。！？।؟", STOP), (",、，،", COMMA), (";:；：", SEMICOLON), ("|｜", PIPE), ("•▪◦‣·●*", BULLET), ("/\\", SLASH), ("\"'’", BRACKET), ("ÃÂƒ¬¨´¦■□▓▒░█†‡※◊¤→↑", BROKEN), ("\t", TAB), ("\n\r", BREAK)):
        for ch in chars:
            kind[ord(ch)] = k
    return kind, low


_P = np.uint64(0x9E3779B97F4A7C15)
_P_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


_POWERS: list[np.ndarray] = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, 0 to n."""
    if len(_POWERS[0]) <= n:
        size = max(n + 1, 2 * len(_POWERS[0]))
        for i, base in enumerate((_P, _P_INVERSE)):
            x = np.full(size, base, dtype=np.uint64)
            x[0] = 1
            _POWERS[i] = np.cumprod(x)
    return _POWERS[0][: n + 1], _POWERS[1][: n + 1]


def _prefix(code: np.ndarray) -> np.ndarray:
    """Prefix sums of a polynomial in the code points modulo 2**64."""
    up, _ = _powers(len(code))
    return np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum((code.astype(np.uint64) + np.uint64(0x1F123BB5)) * up[:-1])])


def _hashes(prefix: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of the code points from a[i] to b[i] for each i, from their prefix sums."""
    x = (prefix[b] - prefix[a]) * _powers(len(prefix) - 1)[1][a]
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


@lru_cache(maxsize=1)
def _common() -> np.ndarray:
    words = [np.frombuffer(w.encode("utf-32-le"), dtype=np.uint32) for w in sorted(set(COMMON))]
    ends = np.cumsum([len(w) for w in words])
    return np.sort(_hashes(_prefix(np.concatenate(words)), ends - [len(w) for w in words], ends))


_PUNCTUATION = re.compile(r"[.,;:!?¿¡“”«»()。，！？；：、।؟،…\"]")
#: Classes of words in the learned tables: each common word its own, then endings, then numbers and the rest.
_ENDINGS = 192


@dataclass(frozen=True)
class WordTables:
    """Log odds of word classes in prose as against other text, and of pairs of classes in their order as against shuffled."""

    endings: np.ndarray
    order: np.ndarray


def n_classes() -> int:
    return len(_common()) + _ENDINGS + 2


def _word_classes(prefix: np.ndarray, a: np.ndarray, b: np.ndarray, hashed: np.ndarray, alpha: np.ndarray, digits: np.ndarray) -> np.ndarray:
    common = _common()
    at = np.minimum(np.searchsorted(common, hashed), len(common) - 1)
    tail = _hashes(prefix, np.maximum(a, b - 2), b) % np.uint64(_ENDINGS)
    out = np.where(alpha, len(common) + tail.astype(np.int64), len(common) + _ENDINGS + np.where(digits, 0, 1))
    return np.where(common[at] == hashed, at, out)


#: Lines apart over which lines are compared, and the cosines that turn values by lag into power by frequency.
LAGS = 8
_COSINES = np.cos(np.pi * np.outer(np.arange(1, LAGS + 1), np.arange(1, LAGS + 1)) / LAGS)


def _spectral_peak(by_lag: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Highest power over all frequencies of each row of values by lag, taken about the mean of those known; lags longer than a text add nothing."""
    mean = (by_lag * known).sum(axis=1, keepdims=True) / np.maximum(1, known.sum(axis=1, keepdims=True))
    centred = np.where(known, by_lag - mean, 0.0)
    return (centred @ _COSINES).max(axis=1) * 2 / LAGS


def _in_next_line(line: np.ndarray, column: np.ndarray, slack: int) -> np.ndarray:
    """Which of the marks, in order of line and column, have one in the next line within ``slack`` columns."""
    key = line * (1 << 32) + column
    low = np.searchsorted(key, key + (1 << 32) - slack, side="left")
    return np.searchsorted(key, key + (1 << 32) + slack, side="right") > low


def statistics(texts: list[str | None], tables: WordTables | None = None, want_words: bool = False):
    """Matrix of NAMES for each text (the last two are 0 without tables); with ``want_words`` also the word classes, and the text of each."""
    kind_of, low_of = _classes()
    n = len(texts)
    joined = "\n".join(t or "" for t in texts) + "\n"
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    sizes = np.array([len(t or "") for t in texts], dtype=np.int64)
    doc_start = np.concatenate([[0], np.cumsum(sizes + 1)])
    kind = kind_of[code]
    low = low_of[code]
    doc = np.repeat(np.arange(n), sizes + 1)
    out = np.zeros((n, len(NAMES)))
    col = {c: i for i, c in enumerate(NAMES)}

    def per_doc(weights, who=doc) -> np.ndarray:
        return np.bincount(who, weights=weights, minlength=n)

    by_kind = np.bincount(doc * 18 + kind, minlength=n * 18).reshape(n, 18).astype(float)
    solid = np.maximum(1, by_kind.sum(axis=1) - by_kind[:, SPACE] - by_kind[:, BREAK] - by_kind[:, TAB])
    for name, k in (("lower", LOWER), ("upper", UPPER), ("caseless", CASELESS), ("digit", DIGIT), ("space", SPACE), ("stop", STOP), ("comma", COMMA), ("semicolon", SEMICOLON), ("pipe", PIPE), ("bracket", BRACKET), ("dash", DASH), ("bullet", BULLET), ("symbol", SYMBOL), ("tab", TAB), ("slash", SLASH), ("broken", BROKEN)):
        out[:, col[name]] = by_kind[:, k] / solid
    out[:, col["chars_log"]] = np.log1p(solid)

    # lines: ends at line feeds, blank ones left out
    blank = (kind == SPACE) | (kind == TAB) | (kind == BREAK)
    ink = np.concatenate([[0], np.cumsum(~blank)])
    ends = np.flatnonzero(code == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    full = ink[ends] > ink[starts]
    starts, ends = starts[full], ends[full]
    place = np.arange(len(code))
    next_ink = np.minimum.accumulate(np.where(blank, len(code), place)[::-1])[::-1]
    last_ink = np.maximum.accumulate(np.where(blank, -1, place))
    first, last = next_ink[starts], last_ink[ends]
    of = doc[starts]
    length = (last - first + 1).astype(float)
    lines = np.maximum(1, per_doc(None, of) if len(of) else np.zeros(n))
    chars = np.maximum(1, per_doc(length, of))

    def share(flag: np.ndarray) -> np.ndarray:
        """Share of the characters of lines with the flag."""
        return per_doc(length * flag, of) / chars

    mean = per_doc(length, of) / lines
    spread = np.sqrt(np.maximum(0, per_doc(length**2, of) / lines - mean**2))
    out[:, col["lines_log"]] = np.log1p(per_doc(None, of) if len(of) else 0)
    out[:, col["line_mean"]] = np.log1p(mean)
    out[:, col["line_spread"]] = spread / np.maximum(1, mean)
    out[:, col["line_long"]] = share(length > 100)
    same = of[1:] == of[:-1]
    pairs = np.maximum(1, np.bincount(of[1:][same], minlength=n))

    def over_pairs(x: np.ndarray) -> np.ndarray:
        return np.bincount(of[1:][same], weights=x[same].astype(float), minlength=n) / pairs

    centred = length - mean[of]
    out[:, col["length_autocorrelation"]] = over_pairs(centred[1:] * centred[:-1]) / np.maximum(1, spread**2)
    out[:, col["length_like_next"]] = over_pairs(np.minimum(length[1:], length[:-1]) / np.maximum(length[1:], length[:-1]))

    def count(flag: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(flag)  # rare marks: search instead of sums over all characters
        return np.searchsorted(at, last, side="right") - np.searchsorted(at, first, side="left")

    wide = (kind == SPACE) & np.concatenate([(kind[1:] == SPACE), [False]])
    gap_begin = wide & ~np.concatenate([[False], kind[:-1] == SPACE])
    pipes, tabs, gaps, digits_in = count(kind == PIPE), count(kind == TAB), count(gap_begin), count(kind == DIGIT)
    delimiters = pipes + tabs + gaps
    both = (delimiters[1:] > 0) & (delimiters[:-1] > 0)
    out[:, col["alignment"]] = over_pairs(both & (np.abs(delimiters[1:] - delimiters[:-1]) <= 0))
    spaces = count(kind == SPACE)
    out[:, col["column_alignment"]] = over_pairs((digits_in[1:] > 0) & (digits_in[:-1] > 0) & (np.abs(spaces[1:] - spaces[:-1]) <= 2) & (length[1:] < 110))
    out[:, col["gaps"]] = share(gaps >= 2)
    is_digit = kind == DIGIT
    gap_end = (kind == SPACE) & ~wide & np.concatenate([[False], kind[:-1] == SPACE])
    goes_on = np.concatenate([same, [False]]) if len(of) else same  # lines with a next one
    for name, marks, slack in (("delimiter_columns", (kind == PIPE) | (kind == TAB) | gap_end, 1), ("number_columns", is_digit & ~np.concatenate([is_digit[1:], [False]]), 0)):
        at = np.flatnonzero(marks)
        line = np.searchsorted(starts, at, side="right") - 1
        inside = (line >= 0) & (at <= last[np.maximum(line, 0)]) if len(starts) else np.zeros(len(at), dtype=bool)
        at, line = at[inside], line[inside]
        met = _in_next_line(line, at - starts[line], slack)
        counted = goes_on[line]
        who = of[line][counted]
        out[:, col[name]] = np.bincount(who, weights=met[counted].astype(float), minlength=n) / np.maximum(1, np.bincount(who, minlength=n))
    begin = kind[first].astype(np.int64) * 64 + np.minimum(first - starts, 63)
    out[:, col["begin_period"]] = over_pairs(begin[1:] == begin[:-1])
    same2 = of[2:] == of[:-2]
    out[:, col["begin_period2"]] = np.bincount(of[2:][same2], weights=(begin[2:] == begin[:-2])[same2].astype(float), minlength=n) / np.maximum(1, np.bincount(of[2:][same2], minlength=n))
    indent = first - starts
    alike, indented, lengths = (np.zeros((n, LAGS)) for _ in range(3))
    known = np.zeros((n, LAGS), dtype=bool)
    for lag in range(1, LAGS + 1):
        own = of[lag:] == of[:-lag]
        who = of[lag:][own]
        pairs_of = np.bincount(who, minlength=n)
        known[:, lag - 1], pairs_of = pairs_of > 0, np.maximum(1, pairs_of)
        alike[:, lag - 1] = np.bincount(who, weights=(begin[lag:] == begin[:-lag])[own].astype(float), minlength=n) / pairs_of
        indented[:, lag - 1] = np.bincount(who, weights=((indent[lag:] == indent[:-lag]) & (indent[lag:] > 0))[own].astype(float), minlength=n) / pairs_of
        lengths[:, lag - 1] = np.bincount(who, weights=(centred[lag:] * centred[:-lag])[own], minlength=n) / pairs_of / np.maximum(1, spread**2)
    out[:, col["begin_spectrum"]], out[:, col["indent_spectrum"]], out[:, col["length_spectrum"]] = (_spectral_peak(x, known) for x in (alike, indented, lengths))
    out[:, col["length_lags"]] = np.abs(lengths).sum(axis=1) / np.maximum(1, known.sum(axis=1))
    second = kind[np.minimum(first + 1, len(code) - 1)]
    third = kind[np.minimum(first + 2, len(code) - 1)]
    k1 = kind[first]
    marked = ((k1 == BULLET) | (k1 == DASH)) & ((second == SPACE) | (second == TAB))
    is_close = (code == 41) | (code == 46) | (code == 93)
    numbered = (k1 == DIGIT) & (is_close[np.minimum(first + 1, len(code) - 1)] | (second == DIGIT) & is_close[np.minimum(first + 2, len(code) - 1)])
    numbered |= (k1 == LOWER) & (code[np.minimum(first + 1, len(code) - 1)] == 41) & ((third == SPACE) | (third == TAB))
    numbered |= (code[first] == 91) & (second == DIGIT)
    out[:, col["marked_lines"]], out[:, col["numbered_lines"]] = share(marked), share(numbered)
    end_kind = kind[last]
    before_end = kind[np.maximum(last - 1, 0)]
    stopped = (end_kind == STOP) | (end_kind == BRACKET) & (before_end == STOP)
    out[:, col["lines_end_stop"]] = share(stopped)
    out[:, col["lines_end_word"]] = share((end_kind == LOWER) | (end_kind == UPPER))
    out[:, col["colon_lines"]] = share(((code[last] == 58) | (count(code == 58) == 1)) & (length < 60))
    dots = np.concatenate([(code[1:] == 46) & (code[:-1] == 46), [False]])
    out[:, col["leaders"]] = share(count(dots) >= 4)

    # words: runs between blanks, stripped to their letters where they have any
    edge = np.flatnonzero(np.concatenate([[True], blank]) != np.concatenate([blank, [True]]))
    wa, wb = edge[0::2], edge[1::2]
    wdoc = doc[wa]
    letter = (kind == LOWER) | (kind == UPPER) | (kind == CASELESS) | (kind == MARK)
    letters = np.concatenate([[0], np.cumsum(letter)])
    n_letters = letters[wb] - letters[wa]
    wsize = wb - wa
    numbers = np.concatenate([[0], np.cumsum(kind == DIGIT)])
    has_digit = numbers[wb] > numbers[wa]
    la = np.minimum(np.minimum.accumulate(np.where(letter, place, len(code))[::-1])[::-1][wa], wb)
    lb = np.maximum(np.maximum.accumulate(np.where(letter, place, -1))[wb - 1] + 1, la) if len(wa) else wb
    words = np.maximum(1, np.bincount(wdoc, minlength=n))
    prefix = _prefix(low)
    hashed = _hashes(prefix, la, lb)
    alpha = n_letters > 0
    w_mean = lambda x: np.bincount(wdoc, weights=x.astype(float), minlength=n) / words
    out[:, col["words_log"]] = np.log1p(np.bincount(wdoc, minlength=n))
    out[:, col["word_mean"]] = np.log1p(w_mean(wsize))
    longest = np.zeros(n)
    np.maximum.at(longest, wdoc, wsize)
    out[:, col["word_longest"]] = np.log1p(longest)
    out[:, col["digit_words"]], out[:, col["single_words"]] = w_mean(has_digit), w_mean((wsize == 1) & (kind[wa] != LOWER))
    out[:, col["capital_words"]] = w_mean(kind[np.minimum(la, len(code) - 1)] == UPPER)
    common = _common()
    is_common = common[np.minimum(np.searchsorted(common, hashed), len(common) - 1)] == hashed
    out[:, col["common_words"]] = w_mean(is_common & alpha)
    whole = _hashes(prefix, wa, wb)
    order = np.lexsort((whole, wdoc))
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = (whole[order][1:] != whole[order][:-1]) | (wdoc[order][1:] != wdoc[order][:-1])
    out[:, col["distinct_words"]] = np.bincount(wdoc[order], weights=fresh.astype(float), minlength=n) / np.power(words, 0.8)
    follows = (wdoc[1:] == wdoc[:-1]) & (whole[1:] == whole[:-1])
    out[:, col["repeated_words"]] = np.bincount(wdoc[1:], weights=follows.astype(float), minlength=n) / words
    ends_stop = (kind[wb - 1] == STOP) | (kind[wb - 1] == BRACKET) & (kind[np.maximum(wb - 2, 0)] == STOP) if len(wa) else np.zeros(0, dtype=bool)
    out[:, col["stops_per_word"]] = w_mean(ends_stop & alpha)
    out[:, col["years"]] = w_mean((wsize >= 4) & (numbers[wb] - numbers[wa] == 4) & (wsize <= 7))

    # running sentences: stretches up to a stop (or a blank line), of five words or fifteen letters without case at least
    real_stop = (kind == STOP) & ((code > 0x2FF) | np.concatenate([blank[1:], [True]]) | np.concatenate([kind[1:] == BRACKET, [True]]))
    hard = np.concatenate([(code[1:] == 10) & (code[:-1] == 10), [False]])
    cut_at = real_stop | hard
    cut_at[doc_start[1:] - 1] = True
    tips = np.flatnonzero(cut_at)
    tails = np.concatenate([[0], tips[:-1] + 1])
    in_words = np.concatenate([[0], np.cumsum(np.bincount(wa, minlength=len(code)) > 0)])
    low_letters = np.concatenate([[0], np.cumsum((kind == LOWER) | (kind == CASELESS) | (kind == MARK))])
    caseless = np.concatenate([[0], np.cumsum(kind == CASELESS)])
    breaks = np.concatenate([[0], np.cumsum(code == 10)])
    s_words, s_low = in_words[tips + 1] - in_words[tails], low_letters[tips + 1] - low_letters[tails]
    s_ink = ink[tips + 1] - ink[tails]
    s_breaks = breaks[tips + 1] - breaks[tails]
    runs = real_stop[tips] & ((s_words >= 5) | (caseless[tips + 1] - caseless[tails] >= 8)) & (s_low > 0.6 * s_ink) & (s_ink >= 18 * np.maximum(0, s_breaks - 1)) & (s_ink < 900)
    out[:, col["in_sentences"]] = np.bincount(doc[tips], weights=(s_ink * runs).astype(float), minlength=n) / solid
    out[:, col["between_stops"]] = np.log1p(solid / (1 + np.bincount(doc[tips], weights=real_stop[tips].astype(float), minlength=n)))

    classes = _word_classes(prefix, la, lb, hashed, alpha, has_digit)
    if tables is not None:
        out[:, col["endings"]] = w_mean(tables.endings[classes])
        pair = (wdoc[1:] == wdoc[:-1])
        value = tables.order[classes[:-1], classes[1:]] * pair
        out[:, col["order"]] = np.bincount(wdoc[1:], weights=value, minlength=n) / words
    return (out, classes, wdoc) if want_words else out


def learn_tables(classes: list[np.ndarray], prose: np.ndarray, seed: int = 11) -> WordTables:
    """Tables from the word classes of labelled texts and each text's share of prose labels."""
    n = n_classes()
    rng = np.random.default_rng(seed)
    in_prose, other = np.full(n, 1.0), np.full(n, 1.0)
    following, shuffled = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    for words, p in zip(classes, prose, strict=True):
        counts = np.bincount(words, minlength=n)
        in_prose += p * counts
        other += (1 - p) * counts
        if p > 0.5 and len(words) > 8:
            following.append(words[:-1] * n + words[1:])
            for _ in range(2):
                mixed = rng.permutation(words)
                shuffled.append(mixed[:-1] * n + mixed[1:])
    straight = np.bincount(np.concatenate(following), minlength=n * n).reshape(n, n) + 0.1
    mixed = np.bincount(np.concatenate(shuffled), minlength=n * n).reshape(n, n) * 0.5 + 0.1
    endings = np.clip(np.log(in_prose / in_prose.sum()) - np.log(other / other.sum()), -3, 3)
    order = np.clip(np.log(straight / straight.sum()) - np.log(mixed / mixed.sum()), -3, 3)
    return WordTables(endings, order)


@dataclass(frozen=True)
class ProseModel:
    tables: WordTables
    edges: np.ndarray
    weights: np.ndarray

    def prose(self, stats: np.ndarray) -> np.ndarray:
        """Probability that most of the text is prose."""
        return 1 / (1 + np.exp(-np.clip(_binned(stats, self.edges) @ self.weights, -30, 30)))


def _binned(stats: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Each statistic as ramps between its edges (0 below the first, 1 above the last of each ramp), and a constant."""
    parts = [np.ones((len(stats), 1))]
    for j in range(stats.shape[1]):
        for a, b in zip(edges[j][:-1], edges[j][1:], strict=True):
            parts.append(np.clip((stats[:, j] - a) / max(b - a, 1e-9), 0, 1)[:, None] if b > a else np.zeros((len(stats), 1)))
    return np.concatenate(parts, axis=1)


def _fit_additive(stats: np.ndarray, prose: np.ndarray, weight: np.ndarray, penalty: float) -> tuple[np.ndarray, np.ndarray]:
    """Ridge logistic regression on ramps, by Newton steps."""
    edges = np.stack([np.quantile(stats[:, j], [0, 0.03, 0.1, 0.25, 0.6, 0.9, 1]) for j in range(stats.shape[1])])
    x = _binned(stats, edges)
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], penalty)
    ridge[0] = 1e-3
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - prose)) + ridge * w
        hess = (x * (weight * np.maximum(p * (1 - p), 1e-4))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(hess, grad)
        w = w - step
        if np.abs(step).max() < 1e-4:
            break
    return edges, w


def altered(text: str, how: int, rng: np.random.Generator) -> tuple[str, bool] | None:
    """A text of prose changed as texts in the corpus are, and whether it is still prose; None where the change says nothing.

    0 no punctuation, 1 no punctuation and small letters, 2 no accents, 3 shuffled words, 4 shuffled without punctuation and
    capitals, 5 small letters.
    """
    words = text.split()
    if how in (0, 1):
        bare = _PUNCTUATION.sub("", text)
        return (bare.lower() if how == 1 else bare), True
    if how == 2:
        return "".join(c for c in unicodedata.normalize("NFD", text) if not unicodedata.combining(c)), True
    if how == 5:
        return text.lower(), True
    if len(words) < 20:
        return None
    mixed = " ".join(words[i] for i in rng.permutation(len(words)))
    return (_PUNCTUATION.sub("", mixed).lower() if how == 4 else mixed), False


def fit(texts: list[str], prose: np.ndarray, penalty: float = 2.0, folds: int = 4, without: tuple[str, ...] = ()) -> ProseModel:
    """Model from texts and each one's share of prose labels; ``without`` names statistics that have no say.

    Each text of prose also takes part, with half the weight, in two altered forms. Word tables enter the fit
    out of fold, as they'd fit their own texts too well.
    """
    prose, weight, rng = np.asarray(prose, dtype=float), np.ones(len(texts)), np.random.default_rng(5)
    of = list(range(len(texts)))
    texts = list(texts)
    extra = []
    for k, i in enumerate(i for i in range(len(texts)) if prose[i] > 0.5):
        for how in ((k + 0) % 3, 3 + k % 3):
            if changed := altered(texts[i], how, rng):
                texts.append(changed[0])
                extra.append(float(changed[1]))
                of.append(i)
    labelled = len(prose)
    prose, weight = np.concatenate([prose, extra]), np.concatenate([weight, np.full(len(extra), 0.5)])
    stats, classes, who = [], [], []
    for part in slices(texts):
        s, c, d = statistics(texts[part], None, True)
        stats.append(s)
        cuts = np.searchsorted(d, np.arange(1, len(s)))
        classes += np.split(c, cuts)
        who.append(d)
    stats = np.concatenate(stats)
    fold = np.array(of) % folds  # a text and its altered forms are in one fold
    for k in range(folds):
        rest, own = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
        rest = rest[rest < labelled]
        tables = learn_tables([classes[i] for i in rest], prose[rest])
        for i in own:
            c = classes[i]
            stats[i, -2] = tables.endings[c].sum() / max(1, len(c))
            stats[i, -1] = tables.order[c[:-1], c[1:]].sum() / max(1, len(c))
    for name in without:
        stats[:, NAMES.index(name)] = 0.0
    edges, w = _fit_additive(stats, prose, weight, penalty)
    return ProseModel(learn_tables(classes[:labelled], prose[:labelled]), edges, w)


def slices(texts: list[str | None]) -> Iterator[slice]:
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= SLICE_CHARS:
            yield slice(start, i + 1)
            start, size = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def fit_on_labels(chunks: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS) -> ProseModel | None:
    """Model from the labelled chunks (chunk_id, label), at most ``max_labels`` of them; None where there are too few to learn from.

    A chunk read by several annotators has the share of those who called it prose. Only labelled texts reach the driver.
    """
    shares = labels.where("chunk_id is not null and label is not null").groupBy("chunk_id").agg(F.avg((F.col("label") == "prose").cast("double")).alias("prose"))
    taken = shares.orderBy(F.xxhash64("chunk_id"), "chunk_id").limit(max_labels)
    texts = chunks.where("text is not null").join(F.broadcast(taken), "chunk_id").groupBy("chunk_id").agg(F.min("text").alias("text"), F.max("prose").alias("prose"))
    rows = texts.toPandas().sort_values("chunk_id")
    if len(rows) < 20 or rows["prose"].nunique() < 2:
        return None
    return fit(rows["text"].tolist(), rows["prose"].to_numpy())


REPORTED = ["chars", "words", "mean_word_length", "symbol_ratio", "digit_ratio", "lines", "lines_end_punctuation", "common_word_share", "delimiter_alignment", "begin_periodicity", "length_autocorrelation", "in_sentences", "prose_score"]


def text_statistics(df: DataFrame, model: ProseModel | None, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns and the REPORTED statistics of every row; prose_score is the model's probability of prose.

    Null, empty and blank texts have zero counts and ratios and prose_score 0, as they hold no prose. Without a
    model prose_score is the share of characters in running sentences. Repeated rows stay; no shuffle.
    """
    keep = keep if keep is not None else [c for c in df.columns if c != text]
    if clash := set(REPORTED).intersection(keep):
        raise ValueError(f"columns {sorted(clash)} are already there")
    ship_package(df.sparkSession)
    rows = df.select(F.col(f"`{text}`").alias("__t"), *[F.col(f"`{c}`") for c in keep])
    fields = [rows.schema[c] for c in keep]
    from pyspark.sql.pandas.types import to_arrow_type

    schema = T.StructType([*fields, *(T.StructField(c, T.IntegerType() if c in ("chars", "words", "lines") else T.DoubleType()) for c in REPORTED)])
    arrow = pa.schema([pa.field(f.name, to_arrow_type(f.dataType)) for f in schema.fields])
    col = {c: i for i, c in enumerate(NAMES)}

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for part in slices(texts):
                s = statistics(texts[part], model.tables if model else None)
                blank = s[:, col["words_log"]] == 0
                score = np.where(blank, 0.0, model.prose(s) if model else s[:, col["in_sentences"]])
                sizes = np.array([len(t or "") for t in texts[part]], dtype=np.int32)
                symbols = s[:, [col[c] for c in ("pipe", "bullet", "symbol", "slash", "broken", "dash")]].sum(axis=1)
                values = {
                    "chars": sizes, "words": np.rint(np.expm1(s[:, col["words_log"]])).astype(np.int32), "mean_word_length": np.expm1(s[:, col["word_mean"]]), "symbol_ratio": symbols, "digit_ratio": s[:, col["digit"]],
                    "lines": np.rint(np.expm1(s[:, col["lines_log"]])).astype(np.int32), "lines_end_punctuation": s[:, col["lines_end_stop"]], "common_word_share": s[:, col["common_words"]], "delimiter_alignment": s[:, col["delimiter_columns"]],
                    "begin_periodicity": s[:, col["begin_spectrum"]], "length_autocorrelation": s[:, col["length_autocorrelation"]], "in_sentences": s[:, col["in_sentences"]], "prose_score": score,
                }
                yield pa.RecordBatch.from_arrays([*(c.slice(part.start, part.stop - part.start) for c in batch.columns[1:]), *(pa.array(values[c]) for c in REPORTED)], schema=arrow)

    return rows.mapInArrow(go, schema)
